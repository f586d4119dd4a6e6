import datetime as dt
import random

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagemill.operators import dedup
from pagemill.operators.enrich import enrich
from pagemill.operators.extract import extract, with_content
from pagemill.plans.queries import REGISTRY
from pagemill.streaming import ingest

SF = "/root/testdata/sf0.001"


def test_stream_equals_batch_over_several_batches(spark, tmp_path):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    source = str(tmp_path / "in")
    pages.repartition(4).write.parquet(source)
    when = F.timestamp_seconds(F.col("page_id"))
    labelled = lambda rows: rows.withColumn("language", F.lit("en"))
    stream = ingest.read_stream(spark, source, pages.schema, files_per_trigger=1)
    docs = ingest.stream_documents(labelled(stream), None, when)
    out = str(tmp_path / "out")
    query = ingest.write_available(docs, out, str(tmp_path / "cp"))
    query.awaitTermination()
    batch = enrich(with_content(extract(labelled(pages), links=False)), None, when)
    got = spark.read.parquet(out).select(batch.columns)
    assert got.count() == batch.count() > 0
    assert got.exceptAll(batch).count() == 0
    again = ingest.write_available(docs, out, str(tmp_path / "cp"))
    again.awaitTermination()
    assert spark.read.parquet(out).count() == batch.count()


def _log(spark, path, rows):
    frame = spark.createDataFrame(rows, "fetched_at timestamp, outcome string, url string")
    frame.coalesce(1).write.mode("append").parquet(path)
    return frame.schema


def test_urls_seen_in_earlier_batches_are_dropped(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "cp"))
    at = dt.datetime(2025, 1, 1, 12)
    schema = _log(spark, source, [(at, "crawled", "a"), (at, "crawled", "b"), (at, "crawled", "a")])
    for _ in range(2):
        fresh = ingest.stream_first_urls(ingest.read_stream(spark, source, schema), "url", "fetched_at", "1 hour")
        ingest.write_available(fresh, out, state).awaitTermination()
        _log(spark, source, [(at + dt.timedelta(minutes=5), "crawled", "b"), (at, "crawled", "c")])
    assert sorted(r.url for r in spark.read.parquet(out).collect()) == ["a", "b", "c"]


def test_only_closed_windows_are_emitted(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "cp"))
    at = dt.datetime(2025, 1, 1, 12)
    rows = [(at + dt.timedelta(seconds=s), o, "u") for s, o in [(0, "crawled"), (30, "crawled"), (59, "error"), (61, "crawled"), (600, "crawled")]]
    schema = _log(spark, source, rows)
    rate = ingest.crawl_rate(ingest.read_stream(spark, source, schema), lateness="5 minutes")
    ingest.write_available(rate, out, state).awaitTermination()
    got = sorted((r.window_start.minute, r.outcome, r.n) for r in spark.read.parquet(out).collect())
    assert got == [(0, "crawled", 2), (0, "error", 1), (1, "crawled", 1)]


@pytest.mark.parametrize("name", ["stream_documents", "stream_first_urls", "stream_crawl_rate"])
def test_tables_of_many_files(spark, tmp_path, name):
    for table in ("pages", "events", "documents"):
        spark.read.parquet(f"{SF}/{table}.parquet").repartition(3).write.parquet(f"{tmp_path}/{table}.parquet")
    split, whole = (REGISTRY[name](spark, folder).count() for folder in (str(tmp_path), SF))
    assert split == whole > 0


@pytest.mark.parametrize("shuffled", [False, True])
def test_first_rows_equal_batch(spark, tmp_path, shuffled):
    """Three batches, in order of time or not: the stream keeps what the batch keeps."""
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "cp"))
    at = dt.datetime(2025, 1, 1, 12)
    draw = random.Random(8)
    rows = [(at + dt.timedelta(seconds=draw.randrange(3600)), draw.choice(["crawled", "error"]), f"u{draw.randrange(40)}") for _ in range(400)]
    rows += [(at, "tie b", "u50"), (at, "tie a", "u50"), (None, "no time", "u51"), (at, "no key", None)]
    rows.sort(key=lambda r: (r[0] is None, r[0] or at))
    if shuffled:
        draw.shuffle(rows)
    schema = None
    for part in range(3):
        schema = _log(spark, source, rows[part * len(rows) // 3:(part + 1) * len(rows) // 3])
        stream = ingest.read_stream(spark, source, schema)
        firsts = ingest.stream_first_rows(stream, "url", "fetched_at", "outcome", horizon=dt.timedelta(hours=3), lateness="2 hours")
        ingest.write_available(firsts, out, state).awaitTermination()
        assert spark.read.schema(schema).parquet(out).count() == 0
    _log(spark, source, [(at + dt.timedelta(days=1), "end", "end")])
    firsts = ingest.stream_first_rows(ingest.read_stream(spark, source, schema), "url", "fetched_at", "outcome",
                                      horizon=dt.timedelta(hours=3), lateness="2 hours")
    ingest.write_available(firsts, out, state).awaitTermination()
    batch = dedup.keep_first(spark.createDataFrame([r for r in rows if None not in r], schema), "url", "fetched_at", "outcome")
    assert sorted(map(tuple, spark.read.parquet(out).collect())) == sorted(map(tuple, batch.collect()))


class _State:
    """A group's state and timers, and how often they are called."""

    def __init__(self):
        self.value, self.timers, self.calls = None, set(), 0

    def getValueState(self, name, schema):  # noqa: N802
        return self

    def get(self):
        self.calls += 1
        return self.value

    def update(self, value):
        self.calls += 1
        self.value = value

    def clear(self):
        self.calls += 1
        self.value = None

    def registerTimer(self, at):  # noqa: N802
        self.calls += 1
        self.timers.add(at)

    def deleteTimer(self, at):  # noqa: N802
        self.calls += 1
        self.timers.discard(at)


class _Now:
    def __init__(self, watermark, fired=None):
        self.watermark, self.fired = watermark, fired

    def getCurrentWatermarkInMs(self):  # noqa: N802
        return self.watermark

    def getExpiryTimeInMs(self):  # noqa: N802
        return self.fired


def test_state_is_called_by_the_group_not_by_the_key():
    schema = T.StructType().add("k", "string").add("at", "long").add("o", "string")
    row, state = Row(*schema.names), _State()
    firsts = ingest._FirstRows(schema, "k", ("at", "o"), dt.timedelta(seconds=10))
    firsts.init(state)
    second = 1_000_000
    assert list(firsts.handleInputRows(0, iter([row(f"k{n}", n * second, "b") for n in range(1000)]), _Now(0))) == []
    assert list(firsts.handleInputRows(0, iter([row("k5", 2 * second, "x"), row("k7", 7 * second, "a"), row("k9", 50 * second, "z")]), _Now(0))) == []
    assert state.calls < 10 and state.timers == {10_000}
    state.timers.discard(10_000)
    out = list(firsts.handleExpiredTimer(0, _Now(17_001), _Now(0, 10_000)))
    assert sorted((r.k, r.at, r.o) for r in out) == [(f"k{n}", (2 if n == 5 else n) * second, {5: "x", 7: "a"}.get(n, "b")) for n in range(8)]
    assert state.calls < 15 and state.timers == {18_000}
    state.timers.clear()
    assert len(list(firsts.handleExpiredTimer(0, _Now(10**9), _Now(0, 18_000)))) == 992
    assert state.value is None and not state.timers
