import random
from collections import deque

import pytest
from pyspark.sql import functions as F

from pagemill.operators import crawl


def walk(outcomes, links, start, max_pages, max_depth):
    """Plain first-in first-out visit of a small graph."""
    waiting, seen, visits, accepted = deque([(start, 0)]), set(), [], 0
    while waiting and (max_pages is None or accepted < max_pages):
        url, depth = waiting.popleft()
        if url in seen:
            continue
        seen.add(url)
        outcome = outcomes.get(url, "error")
        visits.append((url, depth, outcome))
        if outcome != "crawled":
            continue
        accepted += 1
        if max_depth is None or depth < max_depth:
            waiting.extend((target, depth + 1) for target in links.get(url, []))
    return visits


def random_graph(seed, n=60):
    rng = random.Random(seed)
    names = [f"u{i}" for i in range(n)]
    outcomes = {u: rng.choice(["crawled"] * 4 + ["skipped", "error"]) for u in names if rng.random() < 0.9}
    outcomes["u0"] = "crawled"
    links = {u: [rng.choice(names) for _ in range(rng.randrange(5))] for u in names}
    return outcomes, links


@pytest.mark.parametrize("seed, max_pages, max_depth", [
    (1, 100, 3), (2, 5, 3), (3, 1, 3), (4, None, None), (5, 12, None), (6, 100, 0), (7, 7, 2)])
def test_visits_equal_a_queue(spark, monkeypatch, seed, max_pages, max_depth):
    monkeypatch.setattr(crawl, "LINKS_PER_BLOCK", 2)
    outcomes, links = random_graph(seed)
    pages = spark.createDataFrame(list(outcomes.items()), ["url", "outcome"])
    edges = spark.createDataFrame([(u, i, v) for u, vs in links.items() for i, v in enumerate(vs)],
                                  ["src_url", "pos", "dst_url"])
    visited = crawl.visit_order(crawl.crawl(crawl.site_graph(pages, edges), "u0", max_pages, max_depth))
    rows = visited.orderBy("position").collect()
    assert [(r.url, r.depth, r.outcome) for r in rows] == walk(outcomes, links, "u0", max_pages, max_depth)
    assert [r.position for r in rows] == list(range(len(rows)))


def test_no_pages_wanted(spark):
    outcomes, links = random_graph(9)
    pages = spark.createDataFrame(list(outcomes.items()), ["url", "outcome"])
    edges = spark.createDataFrame([("u0", 0, "u1")], ["src_url", "pos", "dst_url"])
    assert crawl.crawl(crawl.site_graph(pages, edges), "u0", max_pages=0).count() == 0


def test_page_with_most_of_the_links(spark, monkeypatch):
    """One page holds nearly all links and one target is linked from everywhere."""
    monkeypatch.setattr(crawl, "LINKS_PER_BLOCK", 100)
    hub = spark.range(5000).select(F.lit("hub").alias("src_url"), F.col("id").alias("pos"),
                                   F.concat(F.lit("p"), "id").alias("dst_url"))
    back = spark.range(5000).select(F.concat(F.lit("p"), "id").alias("src_url"), F.lit(0).alias("pos"),
                                    F.lit("hub").alias("dst_url"))
    edges = hub.unionByName(back)
    pages = edges.select(F.col("src_url").alias("url")).distinct().withColumn("outcome", F.lit("crawled"))
    site = crawl.site_graph(pages, edges)
    assert site.pages.filter("url = 'hub'").first().link_blocks.__len__() == 50
    got = {(r.depth, r["n"]) for r in crawl.reachable(site, "hub").groupBy("depth").agg(F.count("*").alias("n")).collect()}
    assert got == {(0, 1), (1, 5000)}


def html(text, *hrefs):
    return f"<title>t</title><body>{text * 30}" + "".join(f"<a href='{h}'>x</a>" for h in hrefs) + "</body>"


def test_snapshot(spark):
    pages = spark.createDataFrame([
        (0, "https://e.com", html("start ", "/", "/b/", "/gone", "https://x.org/", "/login"), 200),
        (1, "https://e.com/", html("start ", "/b"), 200),
        (2, "https://e.com/b#frag", html("words ", "/c", "/fail"), 200),
        (3, "https://e.com/b/", html("later copy ", "/never"), 200),
        (4, "https://e.com/c", "<body>thin</body>", 200),
        (5, "https://e.com/fail", html("words ", "/never"), 500),
        (6, "https://e.com/never", html("words "), 200),
    ], "page_id long, url string, html string, http_status int")
    site, extracted = crawl.snapshot_site(pages, "https://e.com")
    visited = crawl.visit_order(crawl.crawl(site, "https://e.com"))
    got = [(r.url, r.depth, r.outcome) for r in visited.orderBy("position").collect()]
    assert got == [
        ("https://e.com", 0, "crawled"), ("https://e.com/", 1, "crawled"), ("https://e.com/b", 1, "crawled"),
        ("https://e.com/gone", 1, "error"), ("https://e.com/c", 2, "skipped"), ("https://e.com/fail", 2, "error")]
    assert extracted.count() == 6
    summary = crawl.crawl_summary(visited).first()
    assert (summary.pages_crawled, summary.pages_skipped, summary.errors, summary.pages_per_second) == (3, 1, 2, None)


def test_snapshot_start_keeps_its_raw_key(spark):
    pages = spark.createDataFrame([
        (0, "https://e.com/a/", html("first ", "/a", "/b")), (1, "https://e.com/b", html("second ", "/a/"))],
        "page_id long, url string, html string")
    site, _ = crawl.snapshot_site(pages, "https://e.com/a/")
    rows = crawl.visit_order(crawl.crawl(site, "https://e.com/a/")).orderBy("position").collect()
    assert [(r.url, r.depth) for r in rows] == [("https://e.com/a/", 0), ("https://e.com/a", 1), ("https://e.com/b", 1)]
