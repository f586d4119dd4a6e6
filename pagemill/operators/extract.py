"""Extraction: raw pages to title, cleaned body, flags and links, one pass per page."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagemill.functions import text as tx
from pagemill.functions.html import read_page
from pagemill.session import ship_package

MIN_BODY_CHARS = 100
# Bytes of html whose findings a task holds at once.
SLICE_BYTES = 1 << 20

_READ = T.StructType([
    T.StructField("title", T.StringType()),
    T.StructField("body_text", T.StringType()),
    T.StructField("has_code_tag", T.BooleanType()),
    T.StructField("link_text_len", T.LongType()),
    T.StructField("hrefs", T.ArrayType(T.StringType())),
    T.StructField("error", T.StringType()),
])
_ELEMENTS = T.ArrayType(T.StructType([
    T.StructField("tag", T.StringType()),
    T.StructField("css_class", T.StringType()),
    T.StructField("element_id", T.StringType()),
]))
_ARROW = {
    "title": pa.string(), "body_text": pa.string(), "has_code_tag": pa.bool_(),
    "link_text_len": pa.int64(), "hrefs": pa.list_(pa.string()), "error": pa.string(),
    "elements": pa.list_(pa.struct([("tag", pa.string()), ("css_class", pa.string()),
                                    ("element_id", pa.string())])),
}


def read_pages_html(pages: DataFrame, links: bool = True, elements: bool = False) -> DataFrame:
    """Replace ``html`` by what a page reader finds in it; other columns pass through.

    A page that cannot be read gets its message in ``error`` and the job goes on.
    """
    ship_package(pages.sparkSession)
    keep = [f for f in pages.schema.fields if f.name != "html"]
    fields = [f for f in _READ.fields if links or f.name != "hrefs"] + ([T.StructField("elements", _ELEMENTS)] if elements else [])
    names = [f.name for f in fields]

    def read_one(html):
        try:
            return read_page(html, elements)
        except Exception as problem:
            return {"error": f"{type(problem).__name__}: {problem}"}

    def read_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in page_slices(batch, batch.column(batch.schema.get_field_index("html"))):
                kept = [part.column(part.schema.get_field_index(f.name)) for f in keep]
                rows = [read_one(html.as_py()) for html in part.column(part.schema.get_field_index("html"))]
                found = [pa.array([row.get(name) for row in rows], type=_ARROW[name]) for name in names]
                yield pa.RecordBatch.from_arrays(kept + found, names=[f.name for f in keep] + names)

    return pages.mapInArrow(read_batches, T.StructType(keep + fields))


def page_slices(batch: pa.RecordBatch, html: pa.Array) -> Iterator[pa.RecordBatch]:
    """The rows of a batch, in slices of about SLICE_BYTES of html; a longer page is a slice of its own."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(html), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + SLICE_BYTES, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def extract(pages: DataFrame, links: bool = True, elements: bool = False) -> DataFrame:
    """``html`` to title, body_text, paragraph_count, has_code_blocks, link text and ratio, hrefs.

    Links and elements leave the Python workers only when asked for.
    """
    body = F.col("body_text")
    return (read_pages_html(pages, links, elements)
            .withColumns({
                "paragraph_count": tx.paragraph_count(body),
                "has_code_blocks": F.col("has_code_tag") | tx.has_code_fence(body),
                "link_ratio": (F.col("link_text_len").cast("double")
                               / F.greatest(F.length(body), F.lit(1)).cast("double")),
            })
            .drop("has_code_tag"))


def page_outcome(http_status, body, error):
    """error for a failed fetch or an unreadable page, skipped for thin content, else crawled."""
    failed = (http_status >= 400) | error.isNotNull()
    return (F.when(F.coalesce(failed, F.lit(False)), "error")
            .when(F.length(body) < MIN_BODY_CHARS, "skipped")
            .otherwise("crawled"))


def with_content(extracted: DataFrame) -> DataFrame:
    """Only pages that were read and hold enough text."""
    return extracted.filter(F.col("error").isNull() & (F.length("body_text") >= MIN_BODY_CHARS))
