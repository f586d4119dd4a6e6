"""The registered queries: name -> function of (spark, folder of parquet tables)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.functions import text as tx
from pagemill.functions import urls
from pagemill.functions.page_rules import is_boilerplate
from pagemill.operators import conformance, crawl, dedup, filters, language, prepare, profile
from pagemill.operators.enrich import as_documents, enrich
from pagemill.operators.extract import extract, page_outcome, with_content
from pagemill.operators.links import extract_links
from pagemill.plans import inputs
from pagemill.schema import DOCUMENT_FIELDS
from pagemill.session import new_table_path
from pagemill.sources import readers, writers
from pagemill.streaming import ingest
from pagemill.streaming.crawl import ContinuedCrawl

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function: Callable[[SparkSession, str], DataFrame]):
    REGISTRY[function.__name__] = function
    return function


def _flat(docs: DataFrame) -> DataFrame:
    """Document rows with the fetch time as seconds, for comparison."""
    return docs.select(*[F.unix_seconds(c).alias(c) if c == "fetched_at" else F.col(c) for c in DOCUMENT_FIELDS])


def _profile(spark: SparkSession, sf: str) -> DataFrame:
    return language.learn_profile(inputs.documents(spark, sf))


def _page_time():
    return F.timestamp_seconds(F.lit(inputs.FIRST_FETCH) + F.col("page_id"))


# Scans and sinks

@query
def scan_jsonl(spark, sf):
    path = new_table_path(spark, "collection")
    writers.save_jsonl(inputs.collection(spark, sf).select(DOCUMENT_FIELDS), path)
    return _flat(readers.load_collection(spark, path))


@query
def scan_detected_format(spark, sf):
    path = new_table_path(spark, "collection")
    writers.save_jsonl(inputs.collection_with_gaps(spark, sf).select(DOCUMENT_FIELDS), path)
    return _flat(readers.load_documents(spark, path))


def _pages_with_status(spark, sf):
    """Plain-http pages play the failed fetches."""
    return inputs.pages(spark, sf).withColumn(
        "http_status", F.when(F.startswith("url", F.lit("http:")), F.lit(404)).otherwise(F.col("http_status")))


@query
def scan_pages(spark, sf):
    return filters.fetched_ok(_pages_with_status(spark, sf)).select("page_id", "url", "http_status")


@query
def sink_export(spark, sf):
    path = new_table_path(spark, "export")
    writers.save_export(inputs.collection(spark, sf), path)
    return readers.load_collection(spark, path).select("url", "language", "word_count", "link_density", "body_text")


@query
def sink_vectors(spark, sf):
    path = new_table_path(spark, "vectors")
    docs = inputs.collection(spark, sf)
    writers.save_vectors(docs, path)
    return _flat_vectors(spark.read.schema(prepare.vector_records(docs).schema).json(path))


def _flat_vectors(records):
    return records.select("id", "text", "metadata.url", "metadata.title", "metadata.content_type",
                          "metadata.language", "metadata.word_count",
                          F.unix_seconds("metadata.fetched_at").alias("fetched_at"))


@query
def sink_partitioned(spark, sf):
    path = new_table_path(spark, "columnar")
    writers.save_collection(inputs.collection(spark, sf).select(DOCUMENT_FIELDS), path)
    return _flat(spark.read.parquet(path))


@query
def route_by_metadata(spark, sf):
    path = new_table_path(spark, "columnar")
    writers.save_collection(inputs.collection(spark, sf).select(DOCUMENT_FIELDS), path)
    docs = spark.read.parquet(path)
    return filters.route(docs, "en", "doc_page", has_code_blocks=True).select("url", "language", "content_type", "word_count")


# Extraction

@query
def page_title(spark, sf):
    return extract(inputs.pages(spark, sf), links=False).select("page_id", "title")


@query
def boilerplate_elements(spark, sf):
    found = extract(inputs.pages(spark, sf), links=False, elements=True).select("page_id", F.inline("elements"))
    return (found.filter(is_boilerplate(F.col("tag"), F.col("css_class"), F.col("element_id")))
            .groupBy("page_id", "tag").agg(F.count("*").alias("n")))


@query
def page_body(spark, sf):
    return extract(inputs.pages(spark, sf), links=False).select("page_id", "body_text", "paragraph_count")


@query
def page_signals(spark, sf):
    return extract(inputs.pages(spark, sf)).select(
        "page_id", "has_code_blocks", "link_text_len", "link_ratio", F.size("hrefs").alias("n_links"),
        F.col("error").isNotNull().alias("failed"))


@query
def clean_text(spark, sf):
    return inputs.documents(spark, sf).select("doc_id", tx.clean_text(F.col("text")).alias("body_text"))


@query
def paragraph_counts(spark, sf):
    text = F.col("text")
    return inputs.documents(spark, sf).select(
        "doc_id", tx.paragraph_count(tx.clean_text(text)).alias("paragraph_count"),
        tx.raw_paragraph_count(text).alias("raw_paragraph_count"))


@query
def code_fence_flag(spark, sf):
    return inputs.documents(spark, sf).select("doc_id", tx.has_code_fence(F.col("text")).alias("has_code_blocks"))


# Enrichment

@query
def text_counts(spark, sf):
    body = tx.clean_text(F.col("text"))
    return inputs.documents(spark, sf).select(
        "doc_id", tx.char_count(body).alias("char_count"), tx.word_count(body).alias("word_count"))


@query
def read_time(spark, sf):
    counted = text_counts(spark, sf)
    return counted.select("doc_id", tx.read_time_minutes(F.col("word_count")).alias("estimated_read_time_minutes"))


@query
def link_density_rounded(spark, sf):
    """Words stand in for anchor characters: a ratio of two counts of every text."""
    counted = text_counts(spark, sf)
    return counted.select("doc_id", tx.py_round_ratio(
        F.col("word_count"), F.greatest("char_count", F.lit(1)), 3).alias("link_density"))


@query
def language_profile(spark, sf):
    return _profile(spark, sf)


@query
def language_of_documents(spark, sf):
    docs = inputs.documents(spark, sf).select("doc_id", tx.clean_text(F.col("text")).alias("body_text"))
    return language.with_language(docs, _profile(spark, sf)).select("doc_id", "language")


@query
def language_scores(spark, sf):
    """Scores of every language by joining all trigrams with the weights of all trigrams."""
    docs = inputs.documents(spark, sf).select("doc_id", tx.clean_text(F.col("text")).alias("body_text"))
    return language.language_scores(docs, "doc_id", "body_text", language.learn_trigrams(inputs.documents(spark, sf)))


@query
def language_by_join(spark, sf):
    docs = inputs.documents(spark, sf).select("doc_id", tx.clean_text(F.col("text")).alias("body_text"))
    return language.detect_by_join(docs, "doc_id", "body_text", _profile(spark, sf))


@query
def language_of_pages(spark, sf):
    bodies = extract(inputs.pages(spark, sf), links=False).select("page_id", "body_text")
    return language.with_language(bodies, _profile(spark, sf)).select("page_id", "language")


@query
def build_collection(spark, sf):
    """The derived collection straight from the documents: counts, read time, content type."""
    return _flat(inputs.build_collection(spark, sf))


@query
def content_types(spark, sf):
    return inputs.collection(spark, sf).select("url", "title", "content_type")


@query
def page_documents(spark, sf):
    """Every page as a full document row."""
    extracted = with_content(extract(inputs.pages(spark, sf), links=False))
    return _flat(as_documents(enrich(extracted, _profile(spark, sf), _page_time())))


@query
def url_normalized(spark, sf):
    return inputs.pages(spark, sf).select("page_id", urls.normalize_url(F.col("url")).alias("url_norm"))


@query
def url_crawlable(spark, sf):
    """Each page URL against the host of the link targets' own page and the skip list."""
    url = urls.normalize_url(F.col("url"))
    return inputs.pages(spark, sf).select(
        "page_id", urls.url_host(F.col("url")).alias("host"),
        urls.is_crawlable(url, "spam-farm.example.org").alias("on_spam_farm"),
        urls.is_crawlable(url, urls.url_host(F.col("url"))).alias("crawlable"))


@query
def page_links(spark, sf):
    return extract_links(extract(inputs.pages(spark, sf)))


@query
def vector_records(spark, sf):
    return _flat_vectors(prepare.vector_records(inputs.collection(spark, sf)))


@query
def rag_records(spark, sf):
    return prepare.rag_records(inputs.collection(spark, sf)).select(
        "text", "metadata.source", "metadata.title", "metadata.type", "metadata.language",
        F.unix_seconds("metadata.fetched_at").alias("fetched_at"))


@query
def chunks(spark, sf):
    return prepare.chunk(inputs.collection(spark, sf))


@query
def chunks_200_50(spark, sf):
    return prepare.chunk(inputs.collection(spark, sf), chunk_size=200, overlap=50)


# Filters

@query
def filter_min_content(spark, sf):
    return with_content(extract(inputs.pages(spark, sf), links=False)).select("page_id", F.length("body_text").alias("chars"))


@query
def filter_http_status(spark, sf):
    return filters.fetched_ok(inputs.collection(spark, sf)).select("url", "http_status")


@query
def filter_clean(spark, sf):
    return filters.clean(inputs.collection(spark, sf)).select("url", "word_count", "link_density")


@query
def filter_clean_with_gaps(spark, sf):
    return filters.clean(inputs.collection_with_gaps(spark, sf)).select("url", "word_count", "link_density")


@query
def filter_export(spark, sf):
    return filters.export_ready(inputs.collection(spark, sf)).select("url", "language")


@query
def filter_export_with_gaps(spark, sf):
    return filters.export_ready(inputs.collection_with_gaps(spark, sf)).select("url", "language")


def _use_case(name: str):
    def run(spark, sf):
        return filters.use_case(inputs.collection(spark, sf), name).select(
            "url", "content_type", "word_count", "has_code_blocks", "link_density")
    run.__name__ = f"use_case_{name}"
    return run


for _name in (*filters.USE_CASES, "anything_else"):
    query(_use_case(_name))


@query
def filter_same_host(spark, sf):
    """Pages on the host of the first page of the snapshot."""
    pages = inputs.pages(spark, sf).withColumn("host", urls.url_host(F.col("url")))
    first = pages.groupBy().agg(F.min_by("host", "page_id").alias("host"))
    return pages.join(F.broadcast(first), "host", "left_semi").select("page_id", "url", "host")


# Joins, sets, duplicates

@query
def frontier_outcomes(spark, sf):
    """Every linked URL looked up in the snapshot; an absent page is a fetch error."""
    targets = inputs.shop_links(spark, sf).groupBy(F.col("dst_url").alias("url")).agg(F.count("*").alias("in_links"))
    return (targets.join(inputs.shop_pages(spark, sf), "url", "left")
            .select("url", "in_links", F.coalesce("outcome", F.lit("error")).alias("outcome")))


@query
def unvisited_links(spark, sf):
    """Links that lead to no page of the snapshot."""
    known = inputs.pages(spark, sf).select(urls.normalize_url(F.col("url")).alias("dst_url"))
    return page_links(spark, sf).join(known, "dst_url", "left_anti").select("src_url", "pos", "dst_url")


@query
def url_dedup(spark, sf):
    pages = inputs.pages(spark, sf).select("page_id", urls.normalize_url(F.col("url")).alias("url_norm"))
    return dedup.distinct_urls(pages, "url_norm", "page_id")


@query
def keep_first_page(spark, sf):
    pages = readers.read_pages(spark, f"{sf}/pages.parquet").withColumn("url_norm", urls.normalize_url(F.col("url")))
    return dedup.keep_first(pages, "url_norm", "page_id").select("page_id", "url_norm", F.length("html").alias("html_chars"))


@query
def keep_first_body(spark, sf):
    docs = inputs.collection(spark, sf).withColumn("body_hash", F.md5(F.col("body_text").cast("binary")))
    return dedup.keep_first(docs, "body_hash", "doc_ord").select("doc_ord", "url", "body_hash")


@query
def distinct_languages(spark, sf):
    return profile.distinct_values(inputs.collection(spark, sf), "language")


@query
def duplicate_bodies(spark, sf):
    return dedup.duplicate_bodies(inputs.collection(spark, sf))


# Aggregations

@query
def word_stats(spark, sf):
    return profile.word_stats(inputs.collection_with_gaps(spark, sf))


@query
def language_distribution(spark, sf):
    return profile.distribution(inputs.collection_with_gaps(spark, sf), "language")


@query
def content_type_distribution(spark, sf):
    return profile.distribution(inputs.collection(spark, sf), "content_type")


@query
def content_type_map(spark, sf):
    return profile.counts_map(inputs.collection(spark, sf), "content_type").select(_map_text("counts"))


@query
def language_map(spark, sf):
    return profile.counts_map(inputs.collection_with_gaps(spark, sf), "language").select(_map_text("counts"))


def _map_text(column: str):
    entries = F.array_sort(F.map_entries(column))
    return F.array_join(F.transform(entries, lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))),
                        ",").alias(column)


@query
def modal_language(spark, sf):
    docs = inputs.collection_with_gaps(spark, sf)
    return profile.most_common(docs, F.coalesce("language", F.lit("unknown")), "doc_ord", "language").limit(1)


@query
def quality_counts(spark, sf):
    return profile.quality_counts(inputs.collection_with_gaps(spark, sf))


@query
def collection_profile(spark, sf):
    return profile.collection_profile(inputs.collection_with_gaps(spark, sf))


@query
def profile_by_increments(spark, sf):
    """The profile of a collection that arrived in three parts, from the stored counts of each."""
    docs, stored = inputs.collection_with_gaps(spark, sf), []
    for part in range(3):
        path = new_table_path(spark, "profile-counts")
        profile.profile_counts(docs.filter(F.col("doc_ord") % 3 == part)).write.parquet(path)
        stored.append(spark.read.schema(profile.COUNTS).parquet(path))
    return profile.profile_of_counts(profile.merged_counts(*stored))


@query
def training_audit(spark, sf):
    return profile.training_audit(inputs.collection(spark, sf)).select(
        "total_docs", F.array_join("quality_issues", " | ").alias("quality_issues"),
        F.array_join("recommendations", " | ").alias("recommendations"))


@query
def collection_stats(spark, sf):
    return profile.collection_stats(inputs.collection(spark, sf)).select(
        "total_words", "avg_words_per_page", F.array_join("languages", ",").alias("languages"),
        _map_text("content_types"))


@query
def first_documents(spark, sf):
    return prepare.head(inputs.collection(spark, sf)).select("doc_ord", "url", "word_count")


# Crawl

@query
def crawl_site(spark, sf):
    """Default limits: 100 pages, depth 3; with the position of every visit."""
    site, start = inputs.shop_site(spark, sf)
    return crawl.visit_order(crawl.crawl(site, start)).select("url", "depth", "outcome", "position")


@query
def crawl_depth_limit(spark, sf):
    site, start = inputs.shop_site(spark, sf)
    return crawl.crawl(site, start, max_pages=None, max_depth=1).select("url", "depth", "outcome")


@query
def crawl_reachable(spark, sf):
    site, start = inputs.shop_site(spark, sf)
    return crawl.reachable(site, start)


@query
def crawl_snapshot(spark, sf):
    """From the first page of the snapshot."""
    pages = inputs.pages(spark, sf)
    start = pages.groupBy().agg(F.min_by("url", "page_id").alias("url")).first()["url"]
    site, _ = crawl.snapshot_site(pages, start)
    return crawl.visit_order(crawl.crawl(site, start)).select("url", "depth", "outcome", "position")


def _position_time():
    return F.timestamp_seconds(F.lit(inputs.FIRST_FETCH) + F.col("position"))


@query
def crawl_documents(spark, sf):
    """The documents of a crawl of the archive with the default limits, at their depth and status."""
    visited, extracted = inputs.archive_crawl(spark, sf)
    return _flat(crawl.crawl_documents(visited, extracted, _profile(spark, sf), _position_time()))


@query
def crawl_report(spark, sf):
    """Summary and document statistics of a crawl of all that can be reached in the archive."""
    visited, extracted = inputs.archive_crawl(spark, sf, max_pages=None, max_depth=None)
    docs = crawl.crawl_documents(visited, extracted, _profile(spark, sf), _position_time())
    return crawl.crawl_report(visited, docs).select(
        "pages_crawled", "pages_skipped", "errors", "duration_seconds", "pages_per_second", "total_words",
        "avg_words_per_page", F.array_join("languages", ",").alias("languages"), _map_text("content_types"))


@query
def archive_pages(spark, sf):
    """What the page reader finds on pages that go through all of its rules."""
    return extract(inputs.archive_pages(spark, sf)).select(
        "page_id", "title", "body_text", "has_code_blocks", "link_text_len", "link_ratio", F.size("hrefs").alias("n_links"),
        page_outcome(F.col("http_status"), F.col("body_text"), F.col("error")).alias("outcome"))


@query
def archive_boilerplate(spark, sf):
    """Boilerplate elements by tag, class and id."""
    found = extract(inputs.archive_pages(spark, sf), links=False, elements=True).select("page_id", F.inline("elements"))
    return (found.filter(is_boilerplate(F.col("tag"), F.col("css_class"), F.col("element_id")))
            .groupBy("page_id", "tag").agg(F.count("*").alias("n")))


@query
def archive_links(spark, sf):
    """Links in all forms: absolute, rooted, relative, without scheme, with fragment and parameters."""
    return extract_links(extract(inputs.archive_pages(spark, sf)))


@query
def crawl_summary(spark, sf):
    log = inputs.fetch_log(readers.read_table(spark, sf, "events"))
    return crawl.crawl_summary(log, F.col("fetched_at"), F.col("fetched_at"))


@query
def page_outcomes(spark, sf):
    extracted = extract(_pages_with_status(spark, sf), links=False)
    outcome = page_outcome(F.col("http_status"), F.col("body_text"), F.col("error"))
    return extracted.groupBy(outcome.alias("outcome")).agg(F.count("*").alias("n"))


# Streaming

def _drain(spark, stream: DataFrame, name: str) -> DataFrame:
    path = new_table_path(spark, name)
    ingest.write_available(stream, f"{path}/rows", f"{path}/checkpoint").awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{path}/rows")


@query
def stream_documents(spark, sf):
    schema = readers.read_table(spark, sf, "pages").schema
    arriving = ingest.read_table_stream(spark, sf, "pages", schema)
    rows = ingest.stream_documents(arriving, _profile(spark, sf), _page_time())
    return _flat(_drain(spark, as_documents(rows), "stream-documents"))


def _fetch_stream(spark, sf):
    schema = readers.read_table(spark, sf, "events").schema
    return inputs.fetch_log(ingest.read_table_stream(spark, sf, "events", schema))


@query
def stream_first_urls(spark, sf):
    rows = _fetch_stream(spark, sf).select("fetched_at", urls.normalize_url(F.col("url")).alias("url_norm"))
    fresh = ingest.stream_first_urls(rows, "url_norm", "fetched_at", "400 days")
    return _drain(spark, fresh.select("url_norm"), "stream-urls")


@query
def stream_first_fetches(spark, sf):
    """The first fetch of every URL and day, once a day has passed after it."""
    date = F.date_from_unix_date(F.floor(F.unix_seconds("fetched_at") / 86_400).cast("int")).cast("string")
    day = F.concat(urls.normalize_url(F.col("url")), F.lit("/"), date)
    rows = _fetch_stream(spark, sf).select(day.alias("url_day"), "fetched_at", "outcome", "url")
    firsts = ingest.stream_first_rows(rows, "url_day", "fetched_at", "url", horizon=dt.timedelta(days=1))
    return _drain(spark, firsts, "stream-firsts").select("url_day", F.unix_micros("fetched_at").alias("fetched_at"), "outcome", "url")


@query
def stream_crawl_rate(spark, sf):
    rates = _drain(spark, ingest.crawl_rate(_fetch_stream(spark, sf)), "stream-rate")
    return rates.select(F.unix_seconds("window_start").alias("window_start"),
                        F.unix_seconds("window_end").alias("window_end"), "outcome", "n")


@query
def crawl_continued(spark, sf):
    """All that can be reached in the archive, its pages arriving in three batches in no order."""
    path = new_table_path(spark, "archive")
    pages = inputs.archive_pages(spark, sf)
    part = F.pmod(F.xxhash64("page_id"), F.lit(3))
    going = ContinuedCrawl(spark, f"{path}/state", inputs.ARCHIVE_START)
    for number in range(3):
        pages.filter(part == number).write.mode("append").parquet(f"{path}/pages")
        going.follow(ingest.read_stream(spark, f"{path}/pages", pages.schema)).awaitTermination()
    return going.visited()


# Conformance

@query
def schema_violations(spark, sf):
    return conformance.with_violations(inputs.imperfect_collection(spark, sf)).select(
        "doc_ord", F.array_join("violations", ",").alias("violations"))


@query
def violation_summary(spark, sf):
    return conformance.violation_summary(inputs.imperfect_collection(spark, sf))
