"""Secrets in texts, and whose they are, by corpus-wide ownership frequency.

Patterns find candidates; the values of all candidates are counted by distinct repositories and
distinct owners. A value that many owners hold is a copied example; one that a single owner holds, and
that looks random, is probably a live credential. Only built-in functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.functions.binding import let
from pagemill.llm.tables import written

# Fixed patterns: name, expression, group that is the value, least length of the value.
KINDS = (
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]+", 0, 24),
    ("bearer", r"(?i:bearer)\x20+([A-Za-z0-9+/_.=~-]{16,})", 1, 16),
    ("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 28),
    ("repo", r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 40),
    ("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}", 0, 15),
    ("key", r"-----BEGIN\x20[A-Z0-9\x20]*PRIVATE\x20KEY-----", 0, 1),
)
BASE = ("assign", "access", "hex")
WIDE_OWNERS = 3          # owners from which a value is a copied example
WIDE_REPOSITORIES = 20   # repositories from which it is one, be they of one owner
STEPS_OF_A_RUN = 256
_SPANS = "array<struct<start:int,kind:int,end:int,value:string>>"
LIVE_OWNERS = 1          # owners up to which a value is one owner's
LEAST_CHARACTERS = 6     # different characters of a value that looks random
# What must stand in a text for a pattern to match at all; cheaper than the pattern.
_HINT = {"assign": r"(?i)pass|secret|token|api", "access": "AKIA", "hex": "[0-9a-f]{24}", "bearer": "(?i)bearer",
         "jwt": "eyJ", "repo": "gh[pousr]_", "chat": "xox", "key": "PRIVATE"}


def _spans_of(text: Column, number: int) -> Column:
    """Array of (start, kind, end, value) of one kind, leftmost matches that do not overlap; code points.

    The pieces between the matches and the matches alternate, so their lengths add up to the places.
    """
    name, pattern, group, least = KINDS[number]
    gaps = F.split(text, pattern, -1)
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = whole if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    sizes = F.zip_with(gaps, whole, lambda g, w: F.struct(F.length(g).alias("gap"), F.length(w).alias("size")))
    steps = F.zip_with(sizes, values, lambda s, v: F.struct(s["gap"].alias("gap"), s["size"].alias("size"), v.alias("value")))
    none = F.array().cast(_SPANS)

    def walk(part: Column, at: Column) -> Column:
        """Where a run of steps ends, and its spans, begun at a place."""
        return F.aggregate(
            part, F.struct(at.alias("at"), none.alias("spans")),
            lambda done, s: F.struct(
                (done["at"] + s["gap"] + F.coalesce(s["size"], F.lit(0))).alias("at"),
                F.when(F.length(s["value"]) >= least, F.array_append(done["spans"], F.struct(
                    (done["at"] + s["gap"]).alias("start"), F.lit(number).alias("kind"),
                    (done["at"] + s["gap"] + s["size"]).alias("end"), s["value"].alias("value"))))
                .otherwise(done["spans"]).alias("spans")))

    # Lists grow by copying, so steps are walked in runs of STEPS_OF_A_RUN: work in proportion to the matches.
    def runs(all_steps: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(all_steps), F.lit(1)), F.lit(STEPS_OF_A_RUN))
        return F.aggregate(
            F.transform(starts, lambda first: F.slice(all_steps, first, F.lit(STEPS_OF_A_RUN))),
            F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{_SPANS}>").alias("parts")),
            lambda done, part: let(walk(part, done["at"]), lambda w: F.struct(
                w["at"].alias("at"), F.array_append(done["parts"], w["spans"]).alias("parts"))),
            lambda done: F.flatten(done["parts"]))

    return F.when(text.rlike(_HINT[name]), let(steps, runs)).otherwise(none)


def candidates(text: Column) -> Column:
    """Array of (start, kind, end, value), ordered by start and kind; empty for a null text."""
    text = F.coalesce(text, F.lit(""))
    return F.array_sort(F.flatten(F.array(*[_spans_of(text, k) for k in range(len(KINDS))])))


def span_list(spans: Column, kinds=tuple(k[0] for k in KINDS)) -> Column:
    """kind:start:end of the spans of the given kinds, joined by commas."""
    names = F.array(*[F.lit(k[0]) for k in KINDS])
    chosen = F.filter(spans, lambda s: F.element_at(names, s["kind"] + 1).isin(*kinds))
    return F.array_join(F.transform(chosen, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")


def ownership(found: DataFrame) -> DataFrame:
    """(value_key, repositories, owners) from rows (repository, owner, spans).

    Distinct pairs are taken before the counts, level by level, so a value that a third of the corpus
    holds is spread over its repositories, then over its owners. A null repository or owner counts as one.
    """
    held = found.select("repository", "owner", F.explode(F.array_distinct(F.transform("spans", lambda s: s["key"]))).alias("value_key"))
    by_repository = held.groupBy("value_key", "owner", "repository").agg(F.lit(1).alias("one"))
    by_owner = by_repository.groupBy("value_key", "owner").agg(F.count("*").alias("repositories"))
    return by_owner.groupBy("value_key").agg(F.sum("repositories").alias("repositories"), F.count("*").alias("owners"))


def scan(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", repository: str = "doc_id", owner: str = "source") -> DataFrame:
    """(doc_id, spans) of every row, a span being (start, kind, end, verdict, repositories, owners).

    ``verdict`` is ``copied`` if WIDE_OWNERS or WIDE_REPOSITORIES hold the value, ``live`` if at most LIVE_OWNERS do and it
    has LEAST_CHARACTERS different characters and a digit, else ``unclear``. Whole texts are scanned.

    Null and empty texts have no spans. Repeated rows are rows of their own, of one repository. Rows
    without id are scanned like others. Columns other than the four named are not read.
    """
    spans = F.transform(candidates(F.col(f"`{text}`")), lambda s: F.struct(
        s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"),
        F.substring(F.sha2(s["value"].cast("binary"), 256), 1, 32).alias("key"),
        ((F.size(F.array_distinct(F.split(s["value"], ""))) >= LEAST_CHARACTERS) & s["value"].rlike("[0-9]")).alias("random")))
    found = written(docs.select(
        F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{repository}`").alias("repository"),
        F.col(f"`{owner}`").alias("owner"), spans.alias("spans"), F.monotonically_increasing_id().alias("row")), "candidates")
    each = found.select("row", F.explode("spans").alias("s"))
    counted = each.join(ownership(found), F.col("s.key") == F.col("value_key"))
    verdict = (F.when((F.col("owners") >= WIDE_OWNERS) | (F.col("repositories") >= WIDE_REPOSITORIES), "copied")
               .when((F.col("owners") <= LIVE_OWNERS) & F.col("s.random"), "live").otherwise("unclear"))
    judged = counted.groupBy("row").agg(F.array_sort(F.collect_list(F.struct(
        "s.start", "s.kind", "s.end", verdict.alias("verdict"), "repositories", "owners"))).alias("spans"))
    none = F.array().cast("array<struct<start:int,kind:int,end:int,verdict:string,repositories:long,owners:long>>")
    return found.select("doc_id", "row").join(judged, "row", "left").select("doc_id", F.coalesce("spans", none).alias("spans"))
