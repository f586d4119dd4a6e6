"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from pagemill.plans.queries import REGISTRY
from pagemill.session import build_session

HEADLINE = [
    "page_documents", "page_links", "language_profile", "language_of_documents", "language_scores",
    "build_collection", "chunks", "collection_profile", "word_stats", "language_distribution",
    "training_audit", "rag_records", "filter_export", "use_case_general_qa", "vector_records",
    "duplicate_bodies", "keep_first_body", "keep_first_page", "url_dedup", "schema_violations",
    "sink_partitioned", "crawl_site", "crawl_reachable", "crawl_snapshot", "stream_documents",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("pagemill-bench", f"local[{cpus}]", **{
        "spark.driver.memory": "16g", "spark.ui.enabled": "false",
        "spark.sql.shuffle.partitions": cpus, "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    # Starting the JVM, its compiler and the Python workers is not part of any query.
    started = time.perf_counter()
    small = os.path.join(os.path.dirname(folder.rstrip("/")), "sf0.001")
    if os.path.isdir(small):
        for name in ("page_documents", "collection_profile", "crawl_depth_limit"):
            REGISTRY[name](spark, small).write.format("noop").mode("overwrite").save()
    warmup = round(time.perf_counter() - started, 3)
    seconds = {}
    for name in HEADLINE:
        started = time.perf_counter()
        REGISTRY[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    pages = spark.read.parquet(f"{folder}/pages.parquet").count()
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "warmup_seconds": warmup, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        "pages_per_second": round(pages / seconds["page_documents"], 1)}))
    spark.stop()


if __name__ == "__main__":
    main()
