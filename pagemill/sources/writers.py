"""Sinks: JSON Lines, vector records, partitioned parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.operators.filters import export_ready
from pagemill.operators.prepare import vector_records

# Fixed value: ISO 8601 with microseconds and an explicit UTC offset.
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"


def save_jsonl(docs: DataFrame, path: str) -> None:
    """One object per line, UTF-8 unescaped, nulls keep their key, times in ISO 8601 UTC."""
    (docs.write.option("ignoreNullFields", False)
     .option("timestampFormat", ISO_FORMAT).option("timeZone", "UTC").json(path))


def save_export(docs: DataFrame, path: str, order: str = "doc_ord") -> None:
    """The clean, single-language part of a collection as JSON Lines."""
    save_jsonl(export_ready(docs, order), path)


def save_vectors(docs: DataFrame, path: str) -> None:
    """Nested records for a vector store."""
    save_jsonl(vector_records(docs), path)


def save_collection(docs: DataFrame, path: str) -> None:
    """Parquet partitioned by language and content type, so that routing filters prune.

    The rebalance hint gathers each value's rows, so tasks do not all open a file per
    value, and lets adaptive execution split the large values by size: the commonest
    language is written by as many tasks as it needs.
    """
    (docs.hint("rebalance", F.col("language"), F.col("content_type"))
     .write.partitionBy("language", "content_type").parquet(path))
