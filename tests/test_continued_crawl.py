"""A crawl over arriving pages against one over all of them."""

import random

import pytest
from pyspark.sql import functions as F

from pagemill.operators import crawl
from pagemill.streaming import ingest
from pagemill.streaming.crawl import ContinuedCrawl

START = "https://e.com/docs/"
SCHEMA = "page_id long, url string, html string, http_status int"


def _pages(seed, n=40):
    draw = random.Random(seed)
    urls = [START, *[f"https://e.com/p{i}" for i in range(1, n)]]
    rows = []
    for i, url in enumerate(urls):
        links = "".join(f"<a href='{draw.choice(urls)}'>x</a>" for _ in range(draw.choice([0, 1, 2, 4])))
        links += "<a href='/gone'>x</a>" * (i == 3) + (f"<a href='{urls[1]}'>x</a>" * 2 if i == 0 else "")
        body = "thin" if i % 9 == 8 else "some words " * 20
        rows.append((i, url + ("#top" if i % 5 == 4 else ""), f"<body>{body}{links}</body>", 404 if i % 11 == 10 else 200))
        if i % 6 == 5:                                       # a later copy that leads elsewhere
            rows.append((1000 + i, url, f"<body>{body}<a href='/p{(i + 7) % n}'>x</a><a href='/only-in-the-copy'>x</a></body>", 200))
    return sorted(rows), draw


def _whole(spark, rows, max_depth):
    site, _ = crawl.snapshot_site(spark.createDataFrame(rows, SCHEMA), START)
    return sorted(tuple(r) for r in crawl.crawl(site, START, None, max_depth).select("url", "outcome", "depth").collect())


def _got(going):
    return sorted(tuple(r) for r in going.visited().collect())


@pytest.mark.parametrize("seed, max_depth", [(1, None), (2, 2)])
def test_batches_in_any_order_equal_one_crawl(spark, tmp_path, seed, max_depth):
    rows, draw = _pages(seed)
    firsts, copies = [r for r in rows if r[0] < 1000], [r for r in rows if r[0] >= 1000]
    draw.shuffle(firsts)
    going = ContinuedCrawl(spark, str(tmp_path / "state"), START, max_depth)
    for number, batch in enumerate([firsts[:13], [], firsts[13:26], firsts[26:] + copies, [(5000, None, "<body>no url</body>", 200)]], 1):
        going.extend(spark.createDataFrame(batch, SCHEMA), number)
    assert _got(going) == _whole(spark, rows, max_depth)
    again = ContinuedCrawl(spark, str(tmp_path / "state"), START, max_depth)
    again.extend(spark.createDataFrame([(1, START, "<body>replayed</body>", 200)], SCHEMA), 3)     # committed before
    assert _got(again) == _whole(spark, rows, max_depth)
    with pytest.raises(ValueError):
        ContinuedCrawl(spark, str(tmp_path / "state"), "https://e.com/other", max_depth).visited()


@pytest.mark.parametrize("cut", ["edges", "depths", "commits"])
def test_a_crawl_cut_off_within_a_batch_goes_on(spark, tmp_path, monkeypatch, cut):
    rows, _ = _pages(3)
    spark.createDataFrame(rows, SCHEMA).repartition(3, F.col("url")).write.parquet(str(tmp_path / "in"))
    stream = lambda: ingest.read_stream(spark, str(tmp_path / "in"), spark.createDataFrame([], SCHEMA).schema, files_per_trigger=1)
    write, writes = ContinuedCrawl._write, []

    def failing(self, frame, name, number, inside=""):
        write(self, frame, name, number, inside)
        writes.append(name)
        if number == 2 and name == cut:
            raise RuntimeError("lost driver")
    monkeypatch.setattr(ContinuedCrawl, "_write", failing)
    with pytest.raises(Exception, match="lost driver"):
        ContinuedCrawl(spark, str(tmp_path / "state"), START).follow(stream()).awaitTermination()
    monkeypatch.setattr(ContinuedCrawl, "_write", write)
    going = ContinuedCrawl(spark, str(tmp_path / "state"), START)
    going.follow(stream()).awaitTermination()
    assert going.committed() == 3 and writes.count("commits") >= 2
    assert _got(going) == _whole(spark, rows, None)
    docs = crawl.crawl_documents(going.visited(), going.extracted().withColumn("language", F.lit("en")), None, F.timestamp_seconds(F.lit(0)))
    assert docs.count() == sum(outcome == "crawled" for _, outcome, _ in _got(going))
