"""Mixing sources to target weights by pivotal dependent rounding.

A source's target divided by its size is the number of copies each of its documents should have. The
whole part is given to all; the fractional parts are rounded in pairs: mass moves at random from one
document of a pair to the other, words for words, until one of the two is 0 or 1. Expected copies of
every document and the words of the source stay what they were at every step. Blocks of documents are
rounded side by side; each leaves at most one fraction, and these meet in a tree of further blocks.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagemill.llm.tables import written
from pagemill.session import ship_package

WEIGHTS = (1, 2, 3)       # of the sources in their order, repeating
MOST_COPIES = 3
BLOCK = 4096              # documents rounded together, about
FAN_IN = 64               # blocks whose fractions meet on the next level
_SEED = 20250101
_ROW = "source_no int, block long, doc_id long, size long, whole int, p double"


def word_count(text):
    """Runs of anything but space, tab and line ends; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame) -> DataFrame:
    """(source, source_no, source_size, source_docs, target) from rows (source, size).

    Sources in the order of their code points, null last, weigh WEIGHTS in turn and share the size of
    all. No target exceeds MOST_COPIES times its source; what is above is shared out again by weight.
    Filling sources by their room per weight gives that limit in one pass over the sources, one row each.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("source_docs"))
    by_name = Window.orderBy(F.asc_nulls_last("source"))
    weights = F.array(*[F.lit(float(w)) for w in WEIGHTS])
    rows = totals.withColumn("source_no", F.row_number().over(by_name))
    rows = rows.withColumn("weight", F.element_at(weights, (F.col("source_no") - 1) % len(WEIGHTS) + 1))
    rows = rows.withColumn("room", F.col("source_size") * F.lit(float(MOST_COPIES)))
    by_room = Window.orderBy(F.col("room") / F.col("weight"), "source_no")
    rows = rows.withColumns({
        "open_mass": F.sum("source_size").over(Window.partitionBy(F.lit(1))) - F.sum("room").over(by_room) + F.col("room"),
        "open_weight": F.sum("weight").over(Window.partitionBy(F.lit(1))) - F.sum("weight").over(by_room) + F.col("weight")})
    level = F.col("open_mass") / F.col("open_weight")
    fill = F.col("room") / F.col("weight")
    # The first source that does not fill up sets the level of all that follow.
    rows = rows.withColumn("open", F.when(fill > level, F.struct(fill.alias("fill"), "source_no", level.alias("level"))))
    rows = rows.withColumn("level", F.min("open").over(Window.partitionBy(F.lit(1)))["level"])
    target = F.when(F.col("open").isNull(), F.col("room")).otherwise(F.col("weight") * F.col("level"))
    return rows.select("source", "source_no", "source_size", "source_docs", target.alias("target"))


def round_block(size: np.ndarray, p: np.ndarray, draw: np.random.Generator) -> np.ndarray:
    """Fractions to 0 or 1 but for at most one; the sum of size * p stays.

    Of each pair, one gains words from the other until it is at 0 or 1; which one gains is drawn so
    that the expected fraction of both stays.
    """
    out = p.astype(float).copy()
    held = -1
    coins = draw.random(len(p))
    for i in range(len(p)):
        if not 0.0 < out[i] < 1.0:
            continue
        if held < 0:
            held = i
            continue
        j, ratio = held, size[i] / size[held]
        up = min(1 - out[i], out[j] / ratio)          # i gains, j gives
        down = min(out[i], (1 - out[j]) / ratio)      # j gains, i gives
        if coins[i] * (up + down) < down:
            done_i, out_i, out_j = up >= 1 - out[i], out[i] + up, out[j] - up * ratio
            i_to, j_to = 1.0, 0.0
        else:
            done_i, out_i, out_j = down >= out[i], out[i] - down, out[j] + down * ratio
            i_to, j_to = 0.0, 1.0
        if done_i:
            out[i], out[j] = i_to, min(max(out_j, 0.0), 1.0)
            held = j
        else:
            out[j], out[i] = j_to, min(max(out_i, 0.0), 1.0)
            held = i
        for k in (i, j):
            if out[k] < 1e-12 or out[k] > 1 - 1e-12:
                out[k] = round(out[k])
        if not 0.0 < out[held] < 1.0:
            held = -1
    return out


def _rounded(level: int, last: bool):
    def block(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["size", "doc_id"], ascending=[False, True], kind="stable", na_position="last").reset_index(drop=True)
        draw = np.random.default_rng([_SEED, level, int(rows["source_no"][0]), int(rows["block"][0]) & 0x7FFFFFFF])
        p = round_block(rows["size"].to_numpy(), rows["p"].to_numpy(), draw)
        if last:
            left = (p > 0) & (p < 1)
            p[left] = (draw.random(left.sum()) < p[left]).astype(float)
        rows["p"] = p
        return rows
    return block


def mixing_plan(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, taken) of every row.

    ``copies`` is floor or ceiling of target / source_size, at most MOST_COPIES; ``taken`` is
    copies * size. The words taken of a source differ from its target by less than one document.
    Draws depend on ids and sizes alone, so reruns agree whatever the partitioning.

    Null and empty texts have size 0 and take nothing; rows without source are one source, the last;
    repeated rows are rows of their own; rows without id take part; an empty table has an empty plan;
    other columns are not read.
    """
    spark = docs.sparkSession
    ship_package(spark)
    sizes = written(docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{source}`").cast("string").alias("source"),
                                word_count(F.col(f"`{text}`")).alias("size")), "sizes")
    targets = written(source_targets(sizes), "targets")
    share = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    of_source = targets.select(F.col("source").alias("named"), "source_no", "source_docs", share.alias("share"))
    rows = sizes.join(of_source, sizes["source"].eqNullSafe(F.col("named"))).select(
        "source_no", F.pmod(F.xxhash64("doc_id", "size"), F.ceil(F.col("source_docs") / BLOCK)).cast("long").alias("block"),
        "doc_id", "size", F.floor("share").cast("int").alias("whole"), (F.col("share") - F.floor("share")).alias("p"))
    fractional = (F.col("p") > 0) & (F.col("p") < 1) & (F.col("size") > 0)
    settled = [rows.filter(~fractional)]
    open_ = rows.filter(fractional)
    most = targets.agg(F.max("source_docs").alias("n")).first()["n"] or 0
    blocks, level = max(1, -(-most // BLOCK)), 0
    while True:
        last = blocks == 1
        done = written(open_.groupBy("source_no", "block").applyInPandas(_rounded(level, last), _ROW), "rounded")
        settled.append(done if last else done.filter(~fractional))
        if last:
            break
        open_ = done.filter(fractional).withColumn("block", F.floor(F.col("block") / FAN_IN).cast("long"))
        blocks, level = -(-blocks // FAN_IN), level + 1
    plan = settled[0]
    for part in settled[1:]:
        plan = plan.unionByName(part)
    copies = F.col("whole") + F.when(F.col("size") > 0, F.col("p")).otherwise(0).cast("int")
    return plan.join(targets, "source_no").select(
        "doc_id", "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).cast("long").alias("taken"))
