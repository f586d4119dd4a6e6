"""Enrichment: extracted pages to full document rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.functions import text as tx
from pagemill.functions.page_rules import content_type
from pagemill.operators.language import with_language
from pagemill.schema import DOCUMENT


def enrich(extracted: DataFrame, profile: DataFrame | None = None,
           fetched_at: Column | None = None) -> DataFrame:
    """Add counts, language, read time and content type.

    ``http_status`` and ``crawl_depth`` are read from the input and default to 200 and 0.
    Without a profile the input's own ``language`` column is kept.
    """
    body, url = F.col("body_text"), F.col("url")

    def given(name: str, default: int) -> Column:
        value = F.col(name) if name in extracted.columns else F.lit(None)
        return F.coalesce(value.cast("int"), F.lit(default))

    counted = extracted.withColumns({
        "word_count": tx.word_count(body),
        "char_count": tx.char_count(body),
        "content_type": content_type(url, F.col("title"), body, F.col("link_ratio")),
        "link_density": tx.py_round_ratio(
            F.col("link_text_len"), F.greatest(F.length(body), F.lit(1)), 3),
        "http_status": given("http_status", 200),
        "crawl_depth": given("crawl_depth", 0),
        "fetched_at": F.current_timestamp() if fetched_at is None else fetched_at,
    })
    timed = counted.withColumn("estimated_read_time_minutes", tx.read_time_minutes(F.col("word_count")))
    return with_language(timed, profile) if profile is not None else timed


def as_documents(enriched: DataFrame) -> DataFrame:
    """Exactly the columns and types of the document row."""
    return enriched.select(*[F.col(f.name).cast(f.dataType) for f in DOCUMENT.fields])
