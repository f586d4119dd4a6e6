"""Line dedup by site-relative frequency.

For every host, the pages that contain a line are divided by all pages of the host; lines above a
boilerplate ratio are dropped from the pages of that host. Copies of one page are one page: an article that
a host has three times repeats its lines, but none of them is boilerplate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.llm.tables import written

RATIO = 0.05      # share of a host's pages from which a line is boilerplate: one page in twenty
LEAST_PAGES = 3   # pages a line must be on; on sites of up to 60 pages this decides, below it nothing counts as repeated
# A tag that ends a line of a page, and parts of a page that are not text.
_BREAK = r"(?i)</?(?:p|div|br|hr|li|ul|ol|nav|article|section|header|footer|main|aside|h[1-6]|tr|table|td|th|form|title|body|head|html)\b[^>]*>"
# What is opened and never closed hides the rest, so no part of a page is read twice.
_HIDDEN = r"(?is)<script\b.*?(?:</script\s*>|\z)|<style\b.*?(?:</style\s*>|\z)|<!--.*?(?:-->|\z)"


def line_key(line: Column) -> Column:
    """Lines are compared without the white space around them."""
    return F.xxhash64(F.btrim(line, F.lit(" \t\r\f")))


def _is_line(line: Column) -> Column:
    return F.btrim(line, F.lit(" \t\r\f")) != ""


def boilerplate(pages: DataFrame, *, host: str, text: str, ratio: float = RATIO,
                least_pages: int = LEAST_PAGES) -> DataFrame:
    """(host, line, pages, host_pages, ratio): hashed lines that are boilerplate on their host.

    A page counts a line once however often it repeats it, and pages of the same text count once. Counts are
    partial sums of hashes; a line on every page of a huge host is spread by the pages it is on before
    it comes to one number.
    """
    rows = pages.select(F.col(f"`{host}`").alias("host"), F.col(f"`{text}`").alias("text")).withColumn("page", F.xxhash64("text"))
    totals = rows.select("host", "page").distinct().groupBy("host").agg(F.count("*").alias("host_pages"))
    keys = F.array_distinct(F.transform(F.filter(F.split("text", "\n"), _is_line), line_key))
    counts = (rows.select("host", "page", F.explode(keys).alias("line")).distinct()
              .groupBy("host", "line").agg(F.count("*").alias("pages")).filter(F.col("pages") >= least_pages))
    return (counts.join(totals, counts["host"].eqNullSafe(totals["host"])).drop(totals["host"])
            .withColumn("ratio", F.col("pages") / F.col("host_pages")).filter(F.col("ratio") >= ratio))


def drop_boilerplate(pages: DataFrame, *, host: str, text: str, ratio: float = RATIO, least_pages: int = LEAST_PAGES,
                     into: str | None = None, dropped: str | None = None) -> DataFrame:
    """The rows with boilerplate lines taken out of ``text`` (or written to ``into``).

    The lines that stay keep their order and white space, empty lines stay. A host has at most
    1 / ratio times the mean number of lines of its pages as boilerplate, so the lines to drop are
    one short array a host, joined to the pages by host; pages stay one row each.

    Rows without host are the pages of one unnamed host. Null texts stay null and count as one page a host;
    repeated rows count as one page and each get the result; a page whose lines all go becomes empty; columns named like
    ``into`` or ``dropped`` (the number of dropped lines) are replaced.
    """
    into = into or text
    pages = written(pages, "site-pages")     # the texts may be taken from html, which is to be done once
    found = boilerplate(pages, host=host, text=text, ratio=ratio, least_pages=least_pages)
    # Written, so that their true size decides whether they travel to the pages or the pages to them.
    lists = written(found.groupBy("host").agg(F.collect_set("line").alias("boilerplate lines")), "site-lists") \
        .withColumnRenamed("host", "boilerplate host")
    joined = pages.join(lists, F.col(f"`{host}`").eqNullSafe(F.col("`boilerplate host`")), "left")
    lines = F.split(F.col(f"`{text}`"), "\n")
    stays = F.filter(lines, lambda line: ~(_is_line(line) & F.array_contains("boilerplate lines", line_key(line))))
    have = F.col("`boilerplate lines`").isNotNull() & F.col(f"`{text}`").isNotNull()
    if dropped:
        joined = joined.withColumn("dropped lines", F.when(have, F.size(lines) - F.size(stays)).otherwise(0).cast("long"))
    joined = joined.withColumn("kept text", F.when(have, F.array_join(stays, "\n")).otherwise(F.col(f"`{text}`")))
    place = {into: F.col("`kept text`").alias(into)}
    columns = [place.get(c, F.col(f"`{c}`")) for c in pages.columns if c != dropped]
    columns += [] if into in pages.columns else [place[into]]
    columns += [F.col("`dropped lines`").alias(dropped)] if dropped else []
    return joined.select(*columns)


def page_lines(html: Column) -> Column:
    """The visible text of a page, one block a line, white space runs as one space."""
    text = F.regexp_replace(html, _HIDDEN, "")
    text = F.regexp_replace(text, r"\s+", " ")
    text = F.regexp_replace(text, _BREAK, "\n")
    text = F.regexp_replace(text, r"<[^>]*>", "")
    return F.regexp_replace(F.regexp_replace(text, r" ?\n ?", "\n"), r"\n{2,}", "\n")


def page_host(url: Column) -> Column:
    """Lower-case host of a URL; null if there is none."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.when(host != "", host)
