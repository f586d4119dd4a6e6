"""The same work on arriving pages: extraction, URL dedup, crawl-rate metrics."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from pagemill.operators.enrich import enrich
from pagemill.operators.extract import extract, with_content
from pagemill.session import SESSION_CONF, ship_package


def read_stream(spark: SparkSession, path: str, schema: T.StructType,
                files_per_trigger: int | None = None) -> DataFrame:
    """Parquet files of a folder as they arrive."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def read_table_stream(spark: SparkSession, folder: str, name: str, schema: T.StructType,
                      files_per_trigger: int | None = None) -> DataFrame:
    """The files of one table as they arrive, be the table one file or a folder of many.

    As a pattern the path may name either; a plain path would have to be a folder.
    """
    return read_stream(spark, f"{folder}/{{{name}}}.parquet", schema, files_per_trigger)


def stream_documents(pages: DataFrame, profile: DataFrame | None, fetched_at=None) -> DataFrame:
    """Page stream to document rows: the batch operators, all row-local."""
    return enrich(with_content(extract(pages, links=False)), profile, fetched_at)


def stream_first_urls(rows: DataFrame, key: str, event_time: str | None = None,
                      horizon: str | None = None) -> DataFrame:
    """Rows whose key was not seen before.

    With a ``horizon`` a key is remembered that long after its event time, which bounds
    the state; without one every key is remembered, which is exact.
    """
    thinned = _one_per_batch(rows, key, event_time if horizon else None)
    if horizon is None:
        return thinned.dropDuplicates([key])
    return thinned.withWatermark(event_time, horizon).dropDuplicatesWithinWatermark([key])


def _one_per_batch(rows: DataFrame, key: str, event_time: str | None) -> DataFrame:
    """Drop repeats of a key inside each Arrow batch, before they are shuffled to its state.

    A URL that fills a third of the stream thus reaches its one state task as a few rows.
    The newest repeat stays, so a row that comes too late never stands for one in time.
    """
    ship_package(rows.sparkSession)

    def thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(batch.schema.get_field_index(key)).to_pandas()
            if event_time:
                times = batch.column(batch.schema.get_field_index(event_time)).to_pandas()
                keys = keys.iloc[times.argsort(kind="stable")[::-1]]
            yield batch.take(pa.array(sorted(keys.index[~keys.duplicated()]), pa.int64()))

    return rows.mapInArrow(thin, rows.schema)


def _use_timers(spark: SparkSession) -> None:
    """Keyed state with timers needs the store of ``SESSION_CONF``; a session built elsewhere is given it."""
    store = "spark.sql.streaming.stateStore.providerClass"
    if "RocksDB" not in spark.conf.get(store, ""):
        spark.conf.set(store, SESSION_CONF[store])


class _FirstRows(StatefulProcessor):
    """Holds the earliest row of every key of a group until the horizon has passed after it, then hands it on and forgets it.

    The rows of a group are one state value and its earliest end one timer, so a batch calls the state a few
    times a group, not a few times a key. Times are microseconds, in the rows as in the state.
    """

    def __init__(self, schema: T.StructType, key: str, order: tuple[str, ...], horizon: dt.timedelta):
        self.schema, self.horizon = schema, horizon // dt.timedelta(microseconds=1)
        self.key, self.order = schema.names.index(key), [schema.names.index(name) for name in order]
        self.stored = T.StructType([T.StructField("rows", T.ArrayType(schema))])

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", self.stored)

    def _load(self) -> dict:
        """The held row of each key."""
        value = self.held.get()
        return {row[self.key]: tuple(row) for row in value[0]} if value else {}

    def _place(self, row: tuple) -> tuple:
        return tuple((row[at] is not None, 0 if row[at] is None else row[at]) for at in self.order)

    def _ends(self, row: tuple) -> int:
        """When a row is handed on, in milliseconds."""
        return (row[self.order[0]] + self.horizon) // 1000

    def _store(self, held: dict, timer: int | None) -> None:
        """Keep the rows; the timer, if it is set, is moved to the earliest end."""
        first = min(map(self._ends, held.values()), default=None)
        if timer is not None and timer != first:
            self.handle.deleteTimer(timer)
        if first is None:
            self.held.clear()
            return
        self.held.update((list(held.values()),))
        if timer != first:
            self.handle.registerTimer(first)

    def handleInputRows(self, key, rows, timerValues):  # noqa: N802, N803
        held = self._load()
        timer = min(map(self._ends, held.values()), default=None)
        changed = False
        for row in rows:
            new = tuple(row[name] for name in self.schema.names)
            old = held.get(new[self.key])
            if old is None or self._place(new) < self._place(old):
                held[new[self.key]] = new
                changed = True
        if changed:
            self._store(held, timer)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):  # noqa: N802, N803
        held, now = self._load(), timerValues.getCurrentWatermarkInMs()
        due = [row for row in held.values() if self._ends(row) <= now]
        for row in due:
            del held[row[self.key]]
        self._store(held, None)
        as_row = Row(*self.schema.names)
        return (as_row(*row) for row in due)

    def close(self) -> None:
        pass


def stream_first_rows(rows: DataFrame, key: str, event_time: str, *order: str, horizon: dt.timedelta,
                      lateness: str = "5 minutes", groups: int = 4096) -> DataFrame:
    """The earliest row of every key, whole, ties by ``order``: what a batch's keep-first returns.

    A row is handed on when the watermark, ``lateness`` behind the newest row, has passed its time by the
    horizon; until then an earlier row that arrives later takes its place. Rows of the key that come meanwhile are
    repeats; after that the key is forgotten, so state is bounded. Rows older than the watermark are late and
    dropped. Rows without key or time are not passed on. Of each Arrow batch only a key's earliest
    row reaches its state, so a key that fills a third of the stream stays cheap. Keys are held in
    ``groups`` groups by a hash; a batch reads and writes the groups it touches whole, and a task holds one
    group in memory: more groups for more keys at a time, or for many small batches. A started stream keeps its number.
    """
    ship_package(rows.sparkSession)
    _use_timers(rows.sparkSession)
    present = rows.filter(F.col(key).isNotNull() & F.col(event_time).isNotNull())
    sort = [(event_time, "ascending"), *[(name, "ascending") for name in order]]

    def thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = pc.sort_indices(batch, sort_keys=sort, null_placement="at_start")
            keys = batch.column(batch.schema.get_field_index(key)).take(places).to_pandas()
            yield batch.take(places.filter(pa.array(~keys.duplicated().to_numpy())))

    times = [f.name for f in rows.schema.fields if isinstance(f.dataType, T.TimestampType)]
    in_micros = T.StructType([T.StructField(f.name, T.LongType() if f.name in times else f.dataType) for f in rows.schema.fields])
    counted = (present.mapInArrow(thin, rows.schema).withColumn("_event_time", F.col(event_time)).withWatermark("_event_time", lateness)
               .withColumns({name: F.unix_micros(name) for name in times})
               .withColumn("_group", F.pmod(F.xxhash64(key), F.lit(groups))))
    firsts = counted.groupBy("_group").transformWithState(
        _FirstRows(in_micros, key, (event_time, *order), horizon), in_micros, "Append", "EventTime")
    return firsts.withColumns({name: F.timestamp_micros(name) for name in times})


def crawl_rate(outcomes: DataFrame, event_time: str = "fetched_at", window: str = "1 minute",
               lateness: str = "5 minutes") -> DataFrame:
    """(window_start, window_end, outcome, n) of every closed tumbling window."""
    return (outcomes.withWatermark(event_time, lateness)
            .groupBy(F.window(event_time, window).alias("w"), "outcome")
            .agg(F.count("*").alias("n"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "outcome", "n"))


def write_available(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Process everything that is there, append it to parquet exactly once, and stop."""
    return (stream.writeStream.format("parquet").outputMode("append")
            .option("path", path).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
