"""The document row and the page row."""

from __future__ import annotations

from pyspark.sql import types as T

DOCUMENT = T.StructType([
    T.StructField("url", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("body_text", T.StringType()),
    T.StructField("fetched_at", T.TimestampType()),
    T.StructField("content_type", T.StringType()),
    T.StructField("word_count", T.LongType()),
    T.StructField("char_count", T.LongType()),
    T.StructField("language", T.StringType()),
    T.StructField("estimated_read_time_minutes", T.DoubleType()),
    T.StructField("has_code_blocks", T.BooleanType()),
    T.StructField("link_density", T.DoubleType()),
    T.StructField("paragraph_count", T.LongType()),
    T.StructField("http_status", T.IntegerType()),
    T.StructField("crawl_depth", T.IntegerType()),
])

DOCUMENT_FIELDS = DOCUMENT.fieldNames()

# The content types a document row may carry.
CONTENT_TYPES = ("article", "doc_page", "product_page", "list_page", "tutorial")

_COUNT = {"type": "integer", "minimum": 0}
# The published rules of a document row, as a JSON Schema.
DOCUMENT_RULES = {
    "type": "object",
    "required": list(DOCUMENT_FIELDS),
    "properties": {
        "url": {"type": "string", "format": "uri"},
        "title": {"type": "string"},
        "body_text": {"type": "string"},
        "fetched_at": {"type": "string", "format": "date-time"},
        "content_type": {"type": "string", "enum": list(CONTENT_TYPES)},
        "word_count": _COUNT,
        "char_count": _COUNT,
        "language": {"type": "string"},
        "estimated_read_time_minutes": {"type": "number", "minimum": 0},
        "has_code_blocks": {"type": "boolean"},
        "link_density": {"type": "number", "minimum": 0, "maximum": 1},
        "paragraph_count": _COUNT,
        "http_status": {"type": "integer", "minimum": 100, "maximum": 599},
        "crawl_depth": _COUNT,
    },
}
