"""Text columns: whitespace, counts, read time, rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The 29 code points Python's str.split and re \s treat as whitespace.
# Java's own \s and (?U)\s each miss some of them.
_NOT_SPACE = (r"\t\n\x0b\f\r\x1c-\x1f\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}"
              r"\x{202f}\x{205f}\x{3000}")
WHITESPACE = rf"[ {_NOT_SPACE}]"

# Matches every whitespace run except a lone space, which is already in its final form.
_UNNORMALISED_RUN = rf"(?: {WHITESPACE}|[{_NOT_SPACE}]){WHITESPACE}*"

WORDS_PER_MINUTE = 200


def clean_text(text: Column) -> Column:
    """Collapse whitespace runs to one space and strip both ends."""
    return F.trim(F.regexp_replace(text, _UNNORMALISED_RUN, " "))


def char_count(body: Column) -> Column:
    return F.length(body).cast("long")


def word_count(body: Column) -> Column:
    """Words of a cleaned text: single spaces plus one."""
    spaces = F.length(body) - F.length(F.replace(body, F.lit(" "), F.lit("")))
    return F.when(body == "", F.lit(0)).otherwise(spaces + 1).cast("long")


def words(text: Column) -> Column:
    """Whitespace tokens; an empty text has none."""
    return F.array_remove(F.split(clean_text(text), " ", -1), "")


def paragraph_count(body: Column) -> Column:
    """A cleaned text holds no blank line, so it is one paragraph or none."""
    return F.when(body == "", F.lit(0)).otherwise(F.lit(1)).cast("long")


def raw_paragraph_count(text: Column) -> Column:
    """Blank-line separated, non-blank paragraphs of a text not yet cleaned."""
    parts = F.split(text, "\n\n", -1)
    return F.size(F.filter(parts, lambda p: clean_text(p) != "")).cast("long")


def has_code_fence(body: Column) -> Column:
    return F.contains(body, F.lit("```"))


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def py_round_ratio(a: Column, b: Column | int, digits: int) -> Column:
    """``round(a / b, digits)`` as Python does it, for integers a >= 0, b > 0.

    Away from a decimal tie integer arithmetic decides. On a tie the quotient's
    own binary error decides, read off by splitting it into two exact halves.
    """
    a = a.cast("long")
    b = (F.lit(b) if isinstance(b, int) else b).cast("long")
    scale = 10 ** digits
    twice = a * F.lit(2 * scale).cast("long")
    halves = _div(twice, b)
    down = _div(halves, F.lit(2).cast("long"))
    quotient = a.cast("double") / b.cast("double")
    high = quotient.cast("float").cast("double")
    error = (a.cast("double") - b.cast("double") * high) - b.cast("double") * (quotient - high)
    tie = (F.when(error < 0, down + 1)
           .when(error > 0, down)
           .otherwise(down + down % 2))
    rounded = (F.when((twice % b == 0) & (halves % 2 == 1), tie)
               .otherwise(_div(twice + b, b * 2)))
    return rounded.cast("double") / F.lit(float(scale))


def read_time_minutes(word_count: Column) -> Column:
    return py_round_ratio(word_count, WORDS_PER_MINUTE, 2)


def percent(part: Column, total: Column) -> Column:
    """``part / total * 100`` shown without decimals, half to even."""
    return F.bround(part.cast("double") / total.cast("double") * F.lit(100.0), 0)
