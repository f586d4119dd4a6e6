"""Inputs of the registered queries, derived from the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.functions import text as tx
from pagemill.functions.page_rules import content_type
from pagemill.operators.crawl import Site, crawl, site_graph, snapshot_site, visit_order
from pagemill.session import new_table_path
from pagemill.sources.readers import read_pages, read_table

FIRST_FETCH = 1735689600  # 2025-01-01T00:00:00Z
SHOP = "https://shop.example.com"


def spread(scan: DataFrame) -> DataFrame:
    """A scan of fewer splits than cores over all cores: reading pages and texts is work of the processor."""
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan


def pages(spark: SparkSession, sf: str) -> DataFrame:
    return spread(read_pages(spark, f"{sf}/pages.parquet"))


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return spread(read_table(spark, sf, "documents"))


_STORED: dict[tuple[str, str, str], str] = {}


def _stored(spark: SparkSession, sf: str, name: str, build: Callable[[SparkSession, str], DataFrame]) -> DataFrame:
    """A derived table, written once per application and then scanned like any other."""
    key = (spark.sparkContext.applicationId, sf, name)
    if key in _STORED:
        try:
            return spark.read.parquet(_STORED[key])
        except AnalysisException:  # the shared folder was emptied
            pass
    _STORED[key] = new_table_path(spark, name)
    build(spark, sf).write.parquet(_STORED[key])
    return spark.read.parquet(_STORED[key])


def collection(spark: SparkSession, sf: str) -> DataFrame:
    """The derived collection as a stored table, so that filters and columns reach the scan."""
    return _stored(spark, sf, "collection", build_collection)


def build_collection(spark: SparkSession, sf: str) -> DataFrame:
    """A document collection whose metadata reaches every branch of the filters."""
    key = F.col("doc_id")
    folder = F.element_at(F.array(*map(F.lit, FOLDERS)), (key % 5 + 1).cast("int"))
    rows = documents(spark, sf).select(
        key.alias("doc_ord"),
        F.concat(F.lit("https://"), F.col("source"), F.lit(".example.org/"), folder, F.lit("/"), key).alias("url"),
        F.concat(F.when(key % 3 == 0, F.lit("Guide ")).otherwise(F.lit("Page ")), key).alias("title"),
        tx.clean_text(F.col("text")).alias("body_text"),
        F.timestamp_seconds(F.lit(FIRST_FETCH) + key).alias("fetched_at"),
        F.col("lang"),
        (key % 4 == 0).alias("has_code_blocks"),
        ((key % 61) / F.lit(100.0)).alias("link_density"),
        F.when(key % 17 == 0, F.lit(404)).otherwise(F.lit(200)).alias("http_status"),
        F.lit(0).alias("crawl_depth"))
    body = F.col("body_text")
    counted = rows.withColumns({
        "word_count": tx.word_count(body),
        "char_count": tx.char_count(body),
        "paragraph_count": tx.paragraph_count(body),
        "language": F.when(F.length(body) < 50, F.lit("unknown")).otherwise(F.col("lang")),
        "content_type": content_type(F.col("url"), F.col("title"), body, F.col("link_density")),
    }).drop("lang")
    return counted.withColumn("estimated_read_time_minutes", tx.read_time_minutes(F.col("word_count")))


def collection_with_gaps(spark: SparkSession, sf: str) -> DataFrame:
    """The collection with missing counts, densities and languages."""
    key = F.col("doc_ord")
    return collection(spark, sf).withColumns({
        "word_count": F.when(key % 7 != 0, F.col("word_count")),
        "link_density": F.when(key % 11 != 0, F.col("link_density")),
        "language": F.when(key % 13 != 0, F.col("language")),
    })


def imperfect_collection(spark: SparkSession, sf: str) -> DataFrame:
    """The collection with rows that break the schema rules, by their source."""
    source = F.regexp_extract("url", r"//([^.]+)", 1)
    return collection(spark, sf).withColumns({
        "url": F.when(source == "src1", F.concat(F.lit("no uri "), F.col("url"))).otherwise(F.col("url")),
        "title": F.when(source != "src2", F.col("title")),
        "content_type": F.when(source == "src3", F.lit("forum")).otherwise(F.col("content_type")),
        "word_count": F.when(source == "src4", -F.col("word_count")).otherwise(F.col("word_count")),
        "link_density": F.col("link_density") * 2,
        "http_status": F.when(source == "src5", F.lit(999)).otherwise(F.col("http_status")),
        "fetched_at": F.when(source == "src6", F.lit("yesterday")).otherwise(
            F.date_format("fetched_at", "yyyy-MM-dd'T'HH:mm:ssXXX")),
    })


def shop_links(spark: SparkSession, sf: str) -> DataFrame:
    """(src_url, pos, dst_url): order and part pages linked by the order lines."""
    pairs = read_table(spark, sf, "lineitem").select("l_orderkey", "l_partkey").distinct()
    order = F.concat(F.lit(f"{SHOP}/o/"), "l_orderkey")
    part = F.concat(F.lit(f"{SHOP}/p/"), "l_partkey")
    both = F.array(
        F.struct(order.alias("src_url"), F.col("l_partkey").alias("pos"), part.alias("dst_url")),
        F.struct(part.alias("src_url"), F.col("l_orderkey").alias("pos"), order.alias("dst_url")))
    return pairs.select(F.inline(both))


def shop_pages(spark: SparkSession, sf: str) -> DataFrame:
    """(url, outcome): pending orders have no page, urgent ones fail, low ones and small parts are thin."""
    orders = (read_table(spark, sf, "orders").filter(F.col("o_orderstatus") != "P")
              .select(F.concat(F.lit(f"{SHOP}/o/"), "o_orderkey").alias("url"),
                      F.when(F.col("o_orderpriority") == "1-URGENT", "error")
                      .when(F.col("o_orderpriority") == "5-LOW", "skipped")
                      .otherwise("crawled").alias("outcome")))
    parts = (read_table(spark, sf, "part")
             .select(F.concat(F.lit(f"{SHOP}/p/"), "p_partkey").alias("url"),
                     F.when(F.col("p_size") < 10, "skipped").otherwise("crawled").alias("outcome")))
    return orders.unionByName(parts)


def shop_site(spark: SparkSession, sf: str) -> tuple[Site, str]:
    """Site tables and the start: the first part page with enough content."""
    first = (read_table(spark, sf, "part").filter("p_size >= 10")
             .agg(F.min("p_partkey").alias("k")).first()["k"])
    return site_graph(shop_pages(spark, sf), shop_links(spark, sf)), f"{SHOP}/p/{first}"


ARCHIVE = "https://archive.example.net"
FOLDERS = ("docs", "blog", "product", "wiki", "catalogue")
ARCHIVE_START = f"{ARCHIVE}/{FOLDERS[0]}/0"


def _archive_path(key):
    return F.concat(F.lit("/"), F.element_at(F.array(*map(F.lit, FOLDERS)), (key % 5 + 1).cast("int")), F.lit("/"), key.cast("string"))


def archive_pages(spark: SparkSession, sf: str) -> DataFrame:
    """(page_id, url, html, http_status): a page of every document, whose links lead to other such pages.

    Page k links to pages 4k + 1 to 4k + 4, each in another form, and back to page k div 3. Titles,
    regions, code, boilerplate and statuses go through every rule of the page reader by k.
    """
    k = F.col("doc_id")

    def choose(value, *cases):
        picked = F.when(value == 0, F.lit(cases[0]) if isinstance(cases[0], str) else cases[0])
        for number, case in enumerate(cases[1:], 1):
            picked = picked.when(value == number, F.lit(case) if isinstance(case, str) else case)
        return picked

    def text(*parts):
        return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])

    body = F.coalesce(tx.clean_text(F.col("text")), F.lit(""))
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        body = F.replace(body, F.lit(char), F.lit(entity))
    head = choose(k % 6, text("<title>Archive ", k, "</title>"), "<title></title>", "",
                  text('<meta property="og:title" content=" Shared ', k, ' ">'), "", text("<title>Two \n words &amp; ", k, "</title>"))
    heading = F.when(k % 6 == 1, text("<h1> Heading <b>", k, "</b></h1>")).when(k % 6 == 2, text("<h1>Guide to ", k, "</h1>")).otherwise("")
    code = F.when(k % 8 == 0, text("<pre>code ", k, "</pre>")).when(k % 8 == 1, text("<p>``` ", k, "</p>")).when(
        k % 8 == 2, F.lit("<nav><code>x</code></nav>")).otherwise("")

    def link(number: int):
        child = k * 4 + number
        path = _archive_path(child)
        href = (text(ARCHIVE, path), text(path, "#part"), text("..", path), text("//archive.example.net", path, ";v=1"))[number - 1]
        label = F.when(k % 11 == 3, text("read the long story of page ", child, " in the archive")).otherwise(text("page ", child))
        return text('<a href="', href, '">', label, "</a>\n")

    back = text('<a href="', _archive_path(F.floor(k / 3).cast("long")), '/">back</a>')
    main = text('<aside id="sidebar">aside</aside><script>var a = "<p>";</script><style>p {}</style>', heading, "<p>", body, "</p>", code,
                *[link(n) for n in (1, 2, 3, 4)], back)
    before = '<nav class="navbar"><a href="/login">Log in</a></nav><div class="banner-ad">banner</div>'
    after = text('<footer class="site-footer"><a href="https://other.example.org/', k, '">elsewhere</a></footer>')
    plain = text("<body>", before, main, after, "</body>")
    region = choose(
        k % 7, text("<body>", before, "<main>", main, "</main>", after, "</body>"),
        text("<body>", before, '<div class="Page-Content wide">', main, "</div>", after, "</body>"),
        text("<body>", before, '<div id="the-main">', main, "</div>", after, "</body>"), plain, text(before, main, after),
        text("<body>", before, '<div class="outer"><div class="site-main-content">', main, "</div></div>", after, "</body>"), plain)
    status = F.when(k % 17 == 5, 404).when(k % 13 == 4, 203).otherwise(200)
    return documents(spark, sf).select(k.alias("page_id"), text(ARCHIVE, _archive_path(k)).alias("url"),
                                       text(head, region).alias("html"), status.alias("http_status"))


def archive_crawl(spark: SparkSession, sf: str, **limits) -> tuple[DataFrame, DataFrame]:
    """Ordered visits of the archive from page 0 on, and its extracted pages."""
    site, extracted = snapshot_site(archive_pages(spark, sf), ARCHIVE_START)
    return visit_order(crawl(site, ARCHIVE_START, **limits)), extracted


def fetch_log(events: DataFrame) -> DataFrame:
    """Events read as fetches: when, with which outcome, of which (normalisable) URL."""
    kind = F.col("event_type")
    epoch = F.lit("1970-01-01").cast("timestamp_ntz")
    return events.select(
        F.timestamp_micros(F.timestamp_diff("MICROSECOND", epoch, F.col("ts"))).alias("fetched_at"),
        F.when(kind == "error", "error").when(kind == "signup", "skipped").otherwise("crawled").alias("outcome"),
        F.concat(F.lit(f"{SHOP}/u/"), "user_id", F.lit("/"), kind, F.lit("/#e"), "event_id").alias("url"))
