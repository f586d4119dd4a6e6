"""Breadth-first crawl over a page snapshot, as rounds of joins.

Two tables describe a site: ``pages`` (url, outcome, link_blocks), bucketed by URL, and ``edges``
(src_url, block, pos, dst_url), bucketed by source and block. Visited URLs are a table bucketed by URL that
every round adds to. A round joins the frontier with the pages, writes the level in visiting order, and
turns the links of accepted pages into the next frontier: only the frontier and its links move, the
tables stay where they are. Levels lie in the shared folder, so a lost executor never restarts a crawl.

A page with very many links would make one hot bucket, so its edges are cut into blocks of
positions and joined on (src_url, block).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagemill.functions.urls import normalize_url, url_host
from pagemill.operators.dedup import keep_first
from pagemill.operators.enrich import as_documents, enrich
from pagemill.operators.extract import extract, page_outcome, with_content
from pagemill.operators.links import extract_links
from pagemill.operators.profile import collection_stats
from pagemill.session import bucketed_table, new_table_path

LINKS_PER_BLOCK = 65_536
_ROWS_PER_PARTITION_BITS = 33
_POSITIONS = 1 << 40

LEVEL = T.StructType([
    T.StructField("url", T.StringType()),
    T.StructField("outcome", T.StringType()),
    T.StructField("rank", T.LongType()),
    T.StructField("depth", T.IntegerType()),
])


@dataclass(frozen=True)
class Site:
    pages: DataFrame
    edges: DataFrame


def site_graph(outcomes: DataFrame, links: DataFrame) -> Site:
    """Site tables from (url, outcome) and (src_url, pos, dst_url).

    Every round reads them, so both are written once to the shared folder, in buckets.
    """
    spark = links.sparkSession
    edges = spark.table(bucketed_table(
        links.select("src_url", F.call_function("div", F.col("pos"), F.lit(LINKS_PER_BLOCK)).alias("block"),
                     F.col("pos").cast("long").alias("pos"), "dst_url"), "edges", "src_url", "block"))
    # A set of block numbers per source: one for every 65,536 link positions.
    blocks = edges.groupBy(F.col("src_url").alias("url")).agg(F.collect_set("block").alias("link_blocks"))
    pages = outcomes.select("url", "outcome").join(blocks, "url", "left")
    return Site(spark.table(bucketed_table(pages, "pages", "url")), edges)


def _add_level(found: DataFrame, depth: int, table: str | None, ordered: bool) -> str:
    """Add a level to the visited table; in visiting order, ``rank`` grows with ``place`` over all of it."""
    if ordered:
        found = found.repartitionByRange("place").sortWithinPartitions("place")
    level = found.select("url", "outcome", "link_blocks", F.monotonically_increasing_id().alias("rank"),
                         F.lit(depth).alias("depth"))
    return bucketed_table(level, "visited", "url", partition="depth", into=table)


def _accepted_per_part(level: DataFrame) -> list:
    """(part, rows, accepted) for each sorted partition: as many rows as partitions."""
    part = F.shiftright("rank", _ROWS_PER_PARTITION_BITS).alias("part")
    counts = level.groupBy(part).agg(
        F.count("*").alias("rows"), F.count_if(F.col("outcome") == "crawled").alias("accepted"))
    return sorted(counts.collect(), key=lambda row: row["part"])


def _rank_of_nth_accepted(level: DataFrame, parts: list, n: int) -> int:
    """Rank of the n-th accepted page; only the one partition that holds it is sorted."""
    for row in parts:
        if n <= row["accepted"]:
            first = row["part"] << _ROWS_PER_PARTITION_BITS
            last = ((row["part"] + 1) << _ROWS_PER_PARTITION_BITS) - 1
            return (level.filter((F.col("outcome") == "crawled") & F.col("rank").between(first, last))
                    .select("rank").orderBy("rank").offset(n - 1).limit(1).first()["rank"])
        n -= row["accepted"]
    raise ValueError("fewer accepted pages than asked for")


def _place(rank: Column, pos: Column) -> Column:
    """(rank of the linking page, position of the link) as one number of up to 35 digits.

    Unlike a struct, a decimal keeps the minimum per URL a hash aggregate.
    """
    return rank.cast("decimal(20,0)") * F.lit(_POSITIONS).cast("decimal(13,0)") + pos.cast("decimal(20,0)")


def _next_frontier(site: Site, level: DataFrame, visited: DataFrame) -> DataFrame:
    sources = (level.filter(F.col("outcome") == "crawled")
               .select(F.col("url").alias("src_url"), "rank", F.explode("link_blocks").alias("block")))
    return (site.edges.join(sources, ["src_url", "block"])
            .groupBy(F.col("dst_url").alias("url"))
            .agg(F.min(_place(F.col("rank"), F.col("pos"))).alias("place"))
            .join(visited.select("url"), "url", "left_anti"))


def _looked_up(frontier: DataFrame, pages: DataFrame) -> DataFrame:
    """The frontier with what the site has for each URL; an absent page is a failed fetch."""
    return frontier.join(pages, "url", "left").withColumn("outcome", F.coalesce("outcome", F.lit("error")))


def crawl(site: Site, start_url: str, max_pages: int | None = 100, max_depth: int | None = 3) -> DataFrame:
    """(url, outcome, rank, depth) of every visited URL.

    outcome is crawled, skipped (thin page) or error (failed or absent page); only crawled
    pages are expanded. The visit ends when ``max_pages`` pages are crawled: later URLs of
    that level were never fetched and do not appear. ``None`` lifts either limit. ``rank``
    gives the visiting order within a depth.
    """
    return _visit(site, start_url, max_pages, max_depth, ordered=True)


def _visit(site: Site, start_url: str, max_pages: int | None, max_depth: int | None, ordered: bool) -> DataFrame:
    spark = site.pages.sparkSession
    if max_pages is not None and max_pages <= 0:
        return spark.createDataFrame([], LEVEL)
    frontier = spark.range(1).select(F.lit(start_url).alias("url"), F.lit(0).alias("place"))
    table, left, depth, cut = None, max_pages, 0, None
    while True:
        table = _add_level(_looked_up(frontier, site.pages), depth, table, ordered)
        visited = spark.table(table)
        level = visited.filter(F.col("depth") == depth)
        parts = _accepted_per_part(level)
        accepted = sum(row["accepted"] for row in parts)
        if left is not None and accepted >= left:
            cut = _rank_of_nth_accepted(level, parts, left)
            break
        if accepted == 0 or (max_depth is not None and depth >= max_depth):
            break
        left = None if left is None else left - accepted
        frontier = _next_frontier(site, level, visited)
        depth += 1
    visited = visited.drop("link_blocks")
    return visited if cut is None else visited.filter((F.col("depth") < depth) | (F.col("rank") <= cut))


def visit_order(visited: DataFrame) -> DataFrame:
    """Add ``position``, 0 for the start page, without sorting everything in one task.

    Each written partition is numbered on its own and shifted by the rows before it; the
    shifts are one number per partition.
    """
    placed = visited.withColumn("part", F.shiftright("rank", _ROWS_PER_PARTITION_BITS))
    before = Window.orderBy("depth", "part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (placed.groupBy("depth", "part").agg(F.count("*").alias("rows"))
              .select("depth", "part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("shift")))
    own = F.row_number().over(Window.partitionBy("depth", "part").orderBy("rank"))
    return (placed.join(shifts, ["depth", "part"])
            .withColumn("position", F.col("shift") + own - 1).drop("part", "shift"))


def reachable(site: Site, start_url: str, max_depth: int | None = None) -> DataFrame:
    """(url, depth): smallest number of links from the start. No visiting order, so no sorting."""
    return _visit(site, start_url, None, max_depth, ordered=False).select("url", "depth")


def snapshot_site(pages: DataFrame, start_url: str, page_id: str = "page_id") -> tuple[Site, DataFrame]:
    """Site tables of a snapshot (page_id, url, html[, http_status]) and its extracted pages.

    Pages are keyed by normalised URL, first copy kept (the start URL's own page before
    other forms of it); only the start page keeps its raw key. Every page is read once and the
    extraction is written for the rounds that follow.
    """
    once = under_start_url(keep_first(keyed_pages(pages, start_url, page_id), "key", "form", "id"), start_url)
    path = new_table_path(pages.sparkSession, "site")
    extract(once).write.parquet(f"{path}/pages")
    extracted = pages.sparkSession.read.parquet(f"{path}/pages")
    return site_graph(*outcomes_and_links(extracted, start_url)), extracted


def keyed_pages(pages: DataFrame, start_url: str, page_id: str = "page_id") -> DataFrame:
    """(key, html, http_status, form, id): pages by normalised URL; the start URL's own page has form 0, others 1."""
    status = F.coalesce("http_status", F.lit(200)) if "http_status" in pages.columns else F.lit(200)
    return pages.select(
        normalize_url(F.col("url")).alias("key"), "html", status.cast("int").alias("http_status"),
        F.when(F.col("url") == F.lit(start_url), 0).otherwise(1).alias("form"), F.col(page_id).alias("id"))


def under_start_url(once: DataFrame, start_url: str) -> DataFrame:
    """(url, html, http_status): the start is fetched under its raw key and, when linked, again under its normal form."""
    start, start_form = F.lit(start_url), normalize_url(F.lit(start_url))
    twice = (F.col("key") == start_form) & (start != start_form)
    return once.select(F.explode(F.when(twice, F.array("key", start)).otherwise(F.array("key"))).alias("url"), "html", "http_status")


def outcomes_and_links(extracted: DataFrame, start_url: str) -> tuple[DataFrame, DataFrame]:
    """(url, outcome) of extracted pages, and (src_url, pos, dst_url) of those with content."""
    outcomes = extracted.select("url", page_outcome(
        F.col("http_status"), F.col("body_text"), F.col("error")).alias("outcome"))
    crawled = with_content(extracted.filter(F.col("http_status") < 400))
    return outcomes, extract_links(crawled, url_host(F.lit(start_url)))


def crawl_documents(visited: DataFrame, extracted: DataFrame, profile: DataFrame | None = None,
                    fetched_at: Column | None = None) -> DataFrame:
    """The document rows of a crawl: every accepted visit with its page, at its true depth and status.

    ``visited`` is the result of :func:`crawl` (or :func:`visit_order`, whose ``position`` may then be used
    in ``fetched_at``), ``extracted`` the second result of :func:`snapshot_site`. Only URLs, depths and
    positions of the visits are joined to the stored pages.
    """
    accepted = visited.filter(F.col("outcome") == "crawled").drop("outcome", "rank").withColumnRenamed("depth", "crawl_depth")
    return as_documents(enrich(extracted.drop("crawl_depth").join(accepted, "url"), profile, fetched_at))


def crawl_report(visited: DataFrame, documents: DataFrame) -> DataFrame:
    """One row on a finished crawl: its summary by outcome, and the statistics of its documents."""
    times = documents.groupBy().agg(F.min("fetched_at").alias("started"), F.max("fetched_at").alias("ended"))
    summary = crawl_summary(visited.crossJoin(F.broadcast(times)), F.col("started"), F.col("ended"))
    return summary.crossJoin(collection_stats(documents))


def crawl_summary(visited: DataFrame, started: Column | None = None, ended: Column | None = None) -> DataFrame:
    """Crawled, skipped and error counts, duration in seconds and pages per second.

    The rate is null when no time passed.
    """
    seconds = F.lit(None).cast("double")
    if started is not None and ended is not None:
        seconds = (F.unix_micros(F.max(ended)) - F.unix_micros(F.min(started))).cast("double") / 1e6
    return (visited.groupBy()
            .agg(F.count_if(F.col("outcome") == "crawled").alias("pages_crawled"),
                 F.count_if(F.col("outcome") == "skipped").alias("pages_skipped"),
                 F.count_if(F.col("outcome") == "error").alias("errors"),
                 seconds.alias("duration_seconds"))
            .withColumn("pages_per_second", F.when(
                F.col("duration_seconds") > 0, F.col("pages_crawled") / F.col("duration_seconds"))))
