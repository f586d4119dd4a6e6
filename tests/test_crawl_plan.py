"""What moves in a crawl round, and documents that come out of a crawl."""

import re

import pytest
from pyspark.sql import functions as F

from pagemill.operators import crawl, dedup
from pagemill.operators.profile import collection_stats
from tests.test_crawl import random_graph


def _site(spark, seed=3):
    outcomes, links = random_graph(seed)
    pages = spark.createDataFrame(list(outcomes.items()), ["url", "outcome"])
    edges = spark.createDataFrame([(u, i, v) for u, vs in links.items() for i, v in enumerate(vs)], ["src_url", "pos", "dst_url"])
    return crawl.site_graph(pages, edges)


@pytest.fixture
def no_broadcast(spark):
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)


def _scans_below_exchanges(frame):
    """Tables scanned somewhere below an Exchange before any join or grouping has thinned them."""
    plan = frame._jdf.queryExecution().executedPlan().toString()
    found, open_exchange = [], None
    for line in plan.splitlines():
        depth = len(line) - len(line.lstrip(" :+-*()0123456789"))
        if open_exchange is not None and depth <= open_exchange:
            open_exchange = None
        if re.search(r"(?<!Broadcast)Exchange hashpartitioning", line):
            open_exchange = depth
        elif "Join" in line:
            open_exchange = None
        if open_exchange is not None and "FileScan" in line:
            found.append(re.search(r"default\.(\w+?)_[0-9a-f]{32}", line).group(1))
    return found


def test_only_the_frontier_moves(spark, no_broadcast):
    site = _site(spark)
    visited = crawl.crawl(site, "u0", None, 2)
    table = spark.table(crawl._add_level(crawl._looked_up(
        spark.range(1).select(F.lit("u0").alias("url"), F.lit(0).alias("place")), site.pages), 0, None, True))
    frontier = crawl._next_frontier(site, table.filter("depth = 0"), table)
    plan = crawl._looked_up(frontier, site.pages)
    scanned = set(_scans_below_exchanges(plan))
    # The accepted pages of the level are sent to their links' blocks; edges, pages and visits stay.
    assert scanned <= {"visited"}
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning(src_url") <= 1 and text.count("Exchange hashpartitioning(dst_url") == 1
    assert text.count("Exchange hashpartitioning(") == 2
    assert "Bucketed: true" in text and visited.count() > 1


def test_no_exchange_of_wide_rows(spark, tmp_path):
    path = str(tmp_path / "rows")
    (spark.range(1000).select("id", (F.col("id") % 300).alias("key"), F.repeat(F.lit("x"), 50).alias("html"))
     .repartition(5).write.parquet(path))
    kept = dedup.keep_first(spark.read.parquet(path).filter("id >= 0"), "key", "id")
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "BroadcastHashJoin" in plan
    assert sorted(r.id for r in kept.select("id").collect()) == list(range(300))


@pytest.mark.parametrize("broadcast_words", [1_000_000, 0])
def test_ties_and_missing_keys(spark, tmp_path, monkeypatch, broadcast_words):
    monkeypatch.setattr(dedup, "BROADCAST_WORDS", broadcast_words)
    rows = [("a", 2, "late"), ("a", 1, "first"), ("a", 1, "tie"), (None, 1, "n1"), (None, 1, "n2"), ("b", None, "no order"), ("b", 5, "x")]
    frame = spark.createDataFrame(rows, "key string, at int, html string").coalesce(1)
    frame.write.parquet(str(tmp_path / "t"))
    for source in (spark.read.parquet(str(tmp_path / "t")), frame):
        got = sorted(r.html for r in dedup.keep_first(source, "key", "at").collect())
        assert got == ["first", "n1", "n2", "no order"]
    assert dedup.keep_first(frame.limit(0), "key", "at").count() == 0


def test_rows_that_share_a_place_are_written_first(spark, tmp_path):
    """Exploded rows come from one place of the scan; none may vanish with another."""
    spark.createDataFrame([(["a", "b", "a"],)], "keys array<string>").write.parquet(str(tmp_path / "t"))
    rows = spark.read.parquet(str(tmp_path / "t")).select(F.posexplode("keys").alias("pos", "key"))
    assert sorted((r.key, r.pos) for r in dedup.keep_first(rows, "key", "pos").collect()) == [("a", 0), ("b", 1)]


def test_documents_and_report_of_a_crawl(spark):
    def html(text, *hrefs):
        return f"<title>t</title><body>{text * 30}" + "".join(f"<a href='{h}'>x</a>" for h in hrefs) + "</body>"
    pages = spark.createDataFrame([
        (0, "https://e.com/docs/", html("start ", "/b", "/c", "/gone"), 200), (1, "https://e.com/b", html("words ", "/d"), 203),
        (2, "https://e.com/c", "<body>thin</body>", 200), (3, "https://e.com/d", html("deep "), 200)],
        "page_id long, url string, html string, http_status int")
    site, extracted = crawl.snapshot_site(pages, "https://e.com/docs/")
    visited = crawl.visit_order(crawl.crawl(site, "https://e.com/docs/"))
    docs = crawl.crawl_documents(visited, extracted, None, F.timestamp_seconds(F.col("position") * 10)) \
        if "language" in extracted.columns else crawl.crawl_documents(
            visited, extracted.withColumn("language", F.lit("en")), None, F.timestamp_seconds(F.col("position") * 10))
    got = sorted((r.url, r.crawl_depth, r.http_status, r.word_count) for r in docs.collect())
    assert got == [("https://e.com/b", 1, 203, 31), ("https://e.com/d", 2, 200, 30), ("https://e.com/docs/", 0, 200, 33)]
    report = crawl.crawl_report(visited, docs).first()
    assert (report.pages_crawled, report.pages_skipped, report.errors, report.duration_seconds) == (3, 1, 1, 40.0)
    assert report.total_words == 94 == collection_stats(docs).first().total_words and report.languages == ["en"]
