"""Row filters over a document collection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.operators.profile import most_common

def fetched_ok(pages: DataFrame) -> DataFrame:
    """Pages whose fetch did not fail; a missing status counts as success."""
    return pages.filter(F.coalesce("http_status", F.lit(200)) < 400)


def rag_ready(docs: DataFrame, min_words: int = 100, max_words: int = 2000) -> DataFrame:
    """Neither too short nor too long, not a navigation page, of a known language."""
    return docs.filter(F.col("word_count").between(min_words, max_words)
                       & (F.col("link_density") <= 0.4)
                       & (F.col("language") != "unknown"))


def is_clean() -> Column:
    """At least 100 words and few links; a missing density does not pass."""
    return ((F.coalesce("word_count", F.lit(0)) >= 100)
            & (F.coalesce("link_density", F.lit(1.0)) <= 0.3))


def clean(docs: DataFrame) -> DataFrame:
    return docs.filter(is_clean())


def export_ready(docs: DataFrame, order: str = "doc_ord") -> DataFrame:
    """Clean documents in the collection's most common language.

    A missing language counts as unknown when the mode is taken, yet never equals it.
    """
    mode = most_common(docs, F.coalesce("language", F.lit("unknown")), order, "language").limit(1)
    # The mode is one row, so the semi join is a filter against one broadcast value.
    return clean(docs).join(F.broadcast(mode.select("language")), "language", "left_semi")


def _of_type(*types: str) -> Column:
    return F.col("content_type").isin(*types)


# The named uses, with the types and limits that make a document fit for each.
USE_CASES = {
    "code_qa": lambda: _of_type("doc_page", "tutorial") & F.col("has_code_blocks"),
    "general_qa": lambda: (_of_type("article", "doc_page")
                           & (F.col("word_count") >= 100) & (F.col("link_density") <= 0.3)),
    "product_info": lambda: _of_type("product_page") & (F.col("word_count") >= 50),
}


def use_case(docs: DataFrame, name: str) -> DataFrame:
    """Documents fit for a named use; an unknown name keeps everything."""
    return docs.filter(USE_CASES[name]()) if name in USE_CASES else docs


def route(docs: DataFrame, language: str | None = None, content_type: str | None = None,
          has_code_blocks: bool | None = None) -> DataFrame:
    """Pick documents by metadata; language and type prune a partitioned collection."""
    for column, value in (("language", language), ("content_type", content_type),
                          ("has_code_blocks", has_code_blocks)):
        if value is not None:
            docs = docs.filter(F.col(column) == value)
    return docs
