"""Shaping documents for retrieval: chunks, RAG records, vector records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.functions.binding import let
from pagemill.functions.text import words
from pagemill.operators.filters import rag_ready


def chunk(docs: DataFrame, chunk_size: int = 512, overlap: int = 50, keep: tuple[str, ...] = ()) -> DataFrame:
    """(text, source_url, chunk_id, total_chunks): overlapping windows of words.

    A text of at most ``chunk_size`` words stays as it is. Ids and totals come from the
    array of window starts, so a document is chunked in place and nothing is shuffled.
    """
    if not 0 <= overlap < chunk_size:
        raise ValueError("need 0 <= overlap < chunk_size")
    step = chunk_size - overlap

    def windows(tokens):
        starts = F.sequence(F.lit(1), F.size(tokens), F.lit(step))
        return F.when(F.size(tokens) <= chunk_size, F.array("body_text")).otherwise(
            F.transform(starts, lambda at: F.array_join(F.slice(tokens, at, F.lit(chunk_size)), " ")))

    # Exploding an expression, not a bare column, keeps Spark from deriving a filter on the
    # array, which would chunk every text a second time below.
    none = F.array().cast("array<string>")
    return (docs.select(*keep, "url", let(words(F.col("body_text")), windows).alias("pieces"))
            .select(*keep, "url", F.size("pieces").alias("total_chunks"),
                    F.posexplode(F.coalesce("pieces", none)).alias("chunk_id", "text"))
            .select(*keep, "text", F.col("url").alias("source_url"), "chunk_id", "total_chunks"))


def rag_records(docs: DataFrame, min_words: int = 100, max_words: int = 2000) -> DataFrame:
    """(text, metadata) of the documents fit for retrieval."""
    return rag_ready(docs, min_words, max_words).select(
        F.col("body_text").alias("text"),
        F.struct(F.col("url").alias("source"), "title", F.col("content_type").alias("type"),
                 "language", "fetched_at").alias("metadata"))


def vector_records(docs: DataFrame) -> DataFrame:
    """(id, text, metadata) keyed by the md5 of the URL; duplicates stay."""
    return docs.select(
        F.md5(F.col("url").cast("binary")).alias("id"), F.col("body_text").alias("text"),
        F.struct("url", "title", "content_type", "language", "word_count", "fetched_at").alias("metadata"))


def head(docs: DataFrame, n: int = 5, order: str = "doc_ord") -> DataFrame:
    """The first ``n`` documents of the collection."""
    return docs.orderBy(order).limit(n)
