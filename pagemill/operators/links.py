"""Link extraction: the edges of the site graph."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.functions.urls import (base_parts, is_crawlable, join_pieces, join_reference, normalize_url,
                                     reference, tidy_url, url_host)


def extract_links(extracted: DataFrame, allowed_host: Column | str | None = None,
                  base: str = "url") -> DataFrame:
    """(src_url, pos, dst_url): crawlable links in document order, duplicates kept.

    Without ``allowed_host`` a link must stay on the host of its own page.
    """
    host = url_host(F.col(base)) if allowed_host is None else allowed_host
    if isinstance(host, str):
        host = F.lit(host)

    def once(value: Column) -> Column:
        # Exploding a one-element array computes a value once per link; as a plain column
        # it would be merged into every later step that reads it.
        return F.explode(F.array(value))

    page = ("src_url", "host")
    return (extracted
            .select(F.col(base).alias("src_url"), host.alias("host"), "hrefs", once(tidy_url(F.col(base))).alias("tidy"))
            .select(*page, base_parts(F.col("tidy")).alias("parts"), F.posexplode("hrefs").alias("pos", "href"))
            .select(*page, "parts", "pos", once(tidy_url(F.col("href"))).alias("tidy"))
            .select(*page, "parts", "pos", once(reference(F.col("tidy"))).alias("link"))
            .select(*page, "pos", once(join_reference(F.col("parts"), F.col("link"))).alias("pieces"))
            .select(*page, "pos", once(join_pieces(F.col("pieces"))).alias("target"))
            .select(*page, "pos", once(normalize_url(F.col("target"))).alias("dst_url"))
            .filter(is_crawlable(F.col("dst_url"), F.col("host")))
            .select("src_url", F.col("pos").cast("long").alias("pos"), "dst_url"))
