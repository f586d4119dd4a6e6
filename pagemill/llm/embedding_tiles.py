"""Near-duplicate embeddings by int8 tile products with rigorous error bounds.

Unit vectors are rounded to int8; each keeps the length of its own rounding error. The product of two
rounded vectors then differs from the true cosine by at most e + f + e * f, so a tile of integer
products tells which pairs could reach the threshold. Only those are computed again in double precision.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.llm.tables import connected_components, written
from pagemill.session import ship_package

THRESHOLD = 0.9
BLOCK = 4096              # vectors in a block, about; a tile is a pair of blocks
_ROWS, _PAIRS = 512, 50_000   # rows of a product and pairs of a recheck held at once
_EXACT = 1024             # components whose products of codes add up exactly in single precision
_SLACK = 1e-6             # for rounding in single and double precision


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(int8 codes, scale, error) of the unit vectors along the rows of x; none of them zero."""
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    scale = np.abs(unit).max(axis=1) / 127
    code = np.rint(unit / scale[:, None]).astype(np.int8)
    error = np.linalg.norm(unit - scale[:, None] * code, axis=1)
    return code, scale, error


def _block(table: pa.Table) -> pa.Table:
    """One row for the vectors of a block: ids, copies, codes, scales, errors and the vectors themselves."""
    x = np.array(table.column("embedding").to_pylist(), np.float64)
    # A power of two changes no cosine and no digit, and keeps squares of very large and small numbers in range.
    x = np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])
    code, scale, error = quantise(x)
    columns = [table.column("id").to_numpy(), table.column("copies").to_numpy(), code, scale, error, x]
    return pa.table([table.column("dim").slice(0, 1), table.column("block").slice(0, 1),
                     *[pa.array([np.ascontiguousarray(c).tobytes()], pa.binary()) for c in columns]],
                    names=["dim", "block", "ids", "copies", "codes", "scales", "errors", "vectors"])


def linked_pairs(code_a, scale_a, error_a, x_a, code_b, scale_b, error_b, x_b, threshold: float, upper: bool):
    """(row of a, row of b) of all pairs with a cosine of at least ``threshold``; ``upper`` takes only row a < row b."""
    right = np.ascontiguousarray(code_b.astype(np.float32).T)
    norm_a, norm_b = np.linalg.norm(x_a, axis=1), np.linalg.norm(x_b, axis=1)
    worst = error_a.max(initial=0.0)
    need = (threshold - _SLACK - (1 + worst) * error_b).astype(np.float64)
    found = []
    for r in range(0, len(code_a), _ROWS):
        left = code_a[r:r + _ROWS].astype(np.float32)
        product = left[:, :_EXACT] @ right[:_EXACT]     # integer sums below 2**24 are exact
        if left.shape[1] > _EXACT:
            product = product.astype(np.float64)
            for first in range(_EXACT, left.shape[1], _EXACT):
                product += left[:, first:first + _EXACT] @ right[first:first + _EXACT]
        product *= scale_a[r:r + _ROWS, None].astype(np.float32)
        product *= scale_b[None, :].astype(np.float32)
        product += error_a[r:r + _ROWS, None].astype(np.float32)
        i, j = np.nonzero(product >= need[None, :].astype(np.float32))
        i += r
        if upper:
            i, j = i[i < j], j[i < j]
        for k in range(0, len(i), _PAIRS):
            a, b = i[k:k + _PAIRS], j[k:k + _PAIRS]
            cosine = np.einsum("nd,nd->n", x_a[a], x_b[b]) / (norm_a[a] * norm_b[b])
            found.append((a[cosine >= threshold], b[cosine >= threshold]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest member of the component of each of n nodes."""
    label = np.arange(n)
    while True:
        low = label.copy()
        np.minimum.at(low, a, label[b])
        np.minimum.at(low, b, label[a])
        np.minimum.at(low, label, low.copy())       # the root of a tree follows its members
        while (low[low] != low).any():
            low = low[low]
        if (low == label).all():
            return label
        label = low


def _tile(threshold: float):
    def product(table: pa.Table) -> pa.Table:
        sides = []
        for k in range(table.num_rows):
            ids, copies, scale, error, x = (
                np.frombuffer(table.column(c)[k].as_py(), t) for c, t in
                (("ids", np.int64), ("copies", np.int64), ("scales", float), ("errors", float), ("vectors", float)))
            code = np.frombuffer(table.column("codes")[k].as_py(), np.int8)
            sides.append((ids, copies, code.reshape(len(ids), -1), scale, error, x.reshape(len(ids), -1)))
        first, second = sides[0], sides[-1]
        own = len(sides) == 1
        a, b = linked_pairs(*first[2:], *second[2:], threshold, upper=own)
        ids = first[0] if own else np.concatenate([first[0], second[0]])
        copies = first[1] if own else np.concatenate([first[1], second[1]])
        b = b if own else b + len(first[0])
        links = np.bincount(a, weights=copies[b], minlength=len(ids)) + np.bincount(b, weights=copies[a], minlength=len(ids))
        order = np.argsort(ids, kind="stable")
        place = np.empty(len(ids), np.int64)
        place[order] = np.arange(len(ids))
        root = ids[order][_roots(len(ids), place[a], place[b])][place]
        have = links > 0
        return pa.table([ids[have], links[have].astype(np.int64), root[have]], names=["id", "links", "root"])
    return product


def near_duplicates(vectors: DataFrame, *, vec_id: str = "vec_id", embedding: str = "embedding",
                    threshold: float = THRESHOLD) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row.

    All pairs of cosine >= ``threshold`` in double precision are linked, and no other. Equal vectors are
    compared once and counted as often as they occur, so a large group of copies is one row of one
    tile. A tile returns, for each vector, the number of its links and the smallest vector that it
    reaches inside the tile; pairs never leave a tile.

    Null and zero vectors and those with null or non-finite components link with nothing, as do vectors
    of different lengths with each other. A row without id links with nothing, has no component and is
    not kept. Repeated rows are vectors of their own. Rows of one id with different vectors are one node.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    rows = vectors.select(F.col(f"`{vec_id}`").cast("long").alias("id"), F.col(f"`{embedding}`").cast("array<double>").alias("embedding"))
    finite = F.forall("embedding", lambda v: v.isNotNull() & (F.abs(v) < F.lit(float("inf"))) & ~F.isnan(v))
    usable = rows.filter(F.col("id").isNotNull() & F.col("embedding").isNotNull() & finite & F.exists("embedding", lambda v: v != 0))
    distinct = written(usable.groupBy("embedding").agg(F.min("id").alias("id"), F.count("*").alias("copies")), "vectors")
    blocks = max(1, -(-distinct.count() // BLOCK))
    packed = written(
        distinct.withColumns({"dim": F.size("embedding"), "block": F.pmod(F.xxhash64("embedding"), F.lit(blocks)).cast("int")})
        .groupBy("dim", "block").applyInArrow(_block, (
            "dim int, block int, ids binary, copies binary, codes binary, scales binary, errors binary, vectors binary")), "blocks")
    tiles = packed.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).withColumns({
        "low": F.least("block", "other"), "high": F.greatest("block", "other")})
    # A block without vectors leaves tiles of one side that are not of one block.
    paired = tiles.groupBy("dim", "low", "high").applyInArrow(
        _whole_tile(threshold), "id long, links long, root long")
    found = written(paired, "tiles")
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    classes = connected_components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    named = written(distinct.join(links, "id", "left").join(classes, F.col("id") == F.col("node"), "left").select(
        F.col("embedding").alias("same"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "id").alias("component_id")), "named")
    out = usable.join(named, F.col("embedding") == F.col("same")).select("id", "n_links", "component_id")
    usable_row = (F.col("id").isNotNull() & F.col("embedding").isNotNull() & F.coalesce(finite, F.lit(False))
                  & F.exists("embedding", lambda v: v != 0))
    rest = rows.filter(~F.coalesce(usable_row, F.lit(False))).select(
        "id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return out.unionByName(rest).select(
        F.col("id").alias("vec_id"), "n_links", "component_id",
        F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))


def _whole_tile(threshold: float):
    product = _tile(threshold)

    def tile(table: pa.Table) -> pa.Table:
        low, high = table.column("low")[0].as_py(), table.column("high")[0].as_py()
        if low != high and table.num_rows < 2:
            return pa.table([pa.array([], pa.int64())] * 3, names=["id", "links", "root"])
        return product(table)
    return tile
