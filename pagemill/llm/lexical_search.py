"""Ranked lexical search by one Aho-Corasick scan of the documents; no document index is built.

The terms of all items form an automaton whose words carry a boundary on both sides, so that only whole
terms match. Every document runs through it once, which gives the frequencies of all item terms in it;
an output of the automaton is a term, and a term maps to the items that hold it. Document frequencies
and lengths are summed over all documents, then every hit list is scored and each task keeps the best
documents of each item, so the final ranking meets a few rows a task and not one a document.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from operator import itemgetter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagemill.llm.arrow import lean
from pagemill.llm.tables import written
from pagemill.session import ship_package

TOP = 50
# Bytes of item texts whose terms make one automaton; more items are more scans, not more memory.
PART_BYTES = 8 << 20
# Scores held at once, as documents times items.
CELLS = 1 << 21
SALTS = 32

# Bytes of terms: ASCII letters and digits and all bytes beyond ASCII; only A-Z change, the rest is a boundary.
_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 0 for b in range(256))
_HITS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("n", T.LongType()),
    T.StructField("terms", T.ArrayType(T.IntegerType())), T.StructField("tfs", T.ArrayType(T.LongType()))])
_BEST = "item_id long, doc_id long, score long"


def marked(text: str) -> bytes:
    """The text as UTF-8 with every byte that belongs to no term as a boundary."""
    return text.encode("utf-8", "replace").translate(_TERM_BYTES)


def term_total(data: bytes) -> int:
    """Terms of a marked text, repeats counted."""
    inside = np.frombuffer(data, np.uint8) != 0
    return int(inside[:1].sum() + np.count_nonzero(inside[1:] & ~inside[:-1]))


def terms_of(text: str | None) -> set[bytes]:
    return set(marked(text or "").split(b"\0")) - {b""}


class Searcher:
    """The terms of some items, as an automaton over bytes, and the items of every term."""

    def __init__(self, items: list, texts: list[set[bytes]]):
        self.items = items
        self.terms = sorted(set().union(*texts)) if texts else []
        place = {term: i for i, term in enumerate(self.terms)}
        pairs = np.array(sorted((place[t], i) for i, held in enumerate(texts) for t in held), np.int64).reshape(-1, 2)
        self.bounds = np.searchsorted(pairs[:, 0], np.arange(len(self.terms) + 1))
        self.holders = pairs[:, 1]

    def automaton(self) -> ahocorasick.Automaton:
        """Words are bytes read as Latin-1, which the library takes as text of one byte a letter."""
        found = ahocorasick.Automaton()
        for number, term in enumerate(self.terms):
            found.add_word("\0" + term.decode("latin-1") + "\0", number)
        found.make_automaton()
        return found


def _list_array(counts: list[int], values: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def _item_parts(items: DataFrame) -> Iterator[DataFrame]:
    """The items in parts of PART_BYTES at most (one item alone may be longer); an item is never divided.

    Items are dealt to buckets by hash, and buckets are packed by their summed sizes: what comes to the
    driver is one number a bucket.
    """
    sized = items.withColumn("bytes", F.octet_length("text").cast("long"))
    buckets, most = 1, math.inf
    while most > PART_BYTES and buckets <= 1 << 16:
        dealt = sized.withColumn("bucket", F.pmod(F.xxhash64("item_id"), F.lit(buckets)))
        sizes = {r["bucket"]: r["size"] for r in dealt.groupBy("bucket").agg(F.sum("bytes").alias("size")).collect()}
        most, buckets = max(sizes.values(), default=0), buckets * 16
    begun, held = None, 0
    for bucket in sorted(sizes):
        if begun is not None and held + sizes[bucket] > PART_BYTES:
            yield dealt.filter(F.col("bucket").between(begun, bucket - 1)).select("item_id", "text")
            begun, held = None, 0
        begun, held = bucket if begun is None else begun, held + sizes[bucket]
    if begun is not None:
        yield dealt.filter(F.col("bucket") >= begun).select("item_id", "text")


def _hits(docs: DataFrame, searcher) -> DataFrame:
    """(doc_id, n, terms, tfs) of every document with a term; ``terms`` holds numbers of item terms."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = searcher.value.automaton()
        for batch in batches:
            rows, totals, counts, terms, tfs = [], [], [], [], []
            for row, text in enumerate(batch.column(1)):
                data = marked(text.as_py() or "")
                total = term_total(data)
                if not total:
                    continue
                found = Counter(map(itemgetter(1), automaton.iter("\0" + data.decode("latin-1") + "\0"))) if len(automaton) else {}
                rows.append(row)
                totals.append(total)
                counts.append(len(found))
                terms.extend(found.keys())
                tfs.extend(found.values())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(totals, pa.int64()),
                 _list_array(counts, np.array(terms, np.int32), pa.int32()),
                 _list_array(counts, np.array(tfs, np.int64), pa.int64())], names=_HITS.names)

    return docs.mapInArrow(lean(scan), _HITS)


class _Best:
    """The best documents of every item seen so far, ties by ascending document, unknown documents last."""

    def __init__(self, items: int, top: int):
        self.top, self.least = top, np.ones(items, np.int64)
        self.held = [np.zeros(0, np.int64)] * 3

    def add(self, item: np.ndarray, doc: np.ndarray, score: np.ndarray) -> None:
        good = score >= self.least[item]
        item, doc, score = (np.concatenate([a, b[good]]) for a, b in zip(self.held, (item, doc, score)))
        order = np.lexsort((doc, -score, item))
        item, doc, score = item[order], doc[order], score[order]
        first = np.searchsorted(item, np.arange(len(self.least)))
        place = np.arange(len(item)) - first[item]
        kept = place < self.top
        last = place == self.top - 1
        self.least[item[last]] = score[last]
        self.held = [item[kept], doc[kept], score[kept]]


def _scored(hits: DataFrame, model, top: int) -> DataFrame:
    """(item_id, doc_id, score): the best documents of every item in every task."""
    nowhere = np.iinfo(np.int64).max

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searcher, weights, documents, length = model.value
        number = len(searcher.items)
        best, degree = _Best(number, top), np.diff(searcher.bounds)
        step = max(1, CELLS // number)
        for batch in batches:
            ids = batch.column(0)
            ids = np.where(ids.is_null().to_numpy(zero_copy_only=False), nowhere, ids.fill_null(0).to_numpy(zero_copy_only=False))
            sizes = {n: 50 + 50 * n * documents // length for n in batch.column(1).unique().to_pylist()}
            lengths = np.array([sizes[n] for n in batch.column(1).to_pylist()], np.int64)
            for begun in range(0, len(ids), step):
                part = batch.slice(begun, step)
                counts = part.column(2).value_lengths().to_numpy(zero_copy_only=False)
                term = part.column(2).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                tf = part.column(3).flatten().to_numpy(zero_copy_only=False)
                doc = np.repeat(np.arange(len(counts)), counts)
                gain = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * lengths[begun:begun + step][doc]))
                many = degree[term]
                at = np.repeat(searcher.bounds[term] - (np.cumsum(many) - many), many) + np.arange(many.sum())
                cells = np.zeros(len(counts) * number, np.int64)
                np.add.at(cells, np.repeat(doc * number, many) + searcher.holders[at], np.repeat(gain, many))
                found = np.flatnonzero(cells > 0)
                best.add(found % number, ids[begun:begun + step][found // number], cells[found])
        item, doc, total = best.held
        yield pa.RecordBatch.from_arrays(
            [pa.array([searcher.items[i] for i in item], pa.int64()), pa.array(doc, pa.int64(), mask=doc == nowhere),
             pa.array(total, pa.int64())], names=["item_id", "doc_id", "score"])

    return hits.mapInArrow(lean(score), _BEST)


def _ranked(rows: DataFrame, top: int, *keys) -> DataFrame:
    order = Window.partitionBy("item_id", *keys).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def rank(docs: DataFrame, items: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
         item_id: str = "item_id", item_text: str = "text", top: int = TOP) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` documents of every item with a score above 0.

    Every row of ``docs`` is a document of its own, also where ids repeat; its whole text is scanned. A
    null text has no term and does not count, nor does a text without terms. Equal scores rank by
    ascending doc_id, rows without id last. Rows of one item_id (null is one) are one item with the terms
    of all of them; an item without terms ranks nothing. Empty tables give an empty result. Columns
    other than the four named are not read.
    """
    spark = docs.sparkSession
    ship_package(spark)
    texts = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    wanted = items.select(F.col(f"`{item_id}`").cast("long").alias("item_id"), F.col(f"`{item_text}`").alias("text")).na.drop(subset=["text"])
    result = None
    for part in _item_parts(wanted):
        held: dict = {}
        for row in part.collect():
            held.setdefault(row["item_id"], set()).update(terms_of(row["text"]))
        searcher = Searcher(list(held), list(held.values()))
        hits = written(_hits(texts, spark.sparkContext.broadcast(searcher)), "term-hits")
        total = hits.agg(F.count("*").alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("length")).first()
        df = np.zeros(len(searcher.terms), np.int64)
        for row in hits.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")).collect():
            df[row["term"]] = row["df"]
        documents = total["documents"]
        weights = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
        model = spark.sparkContext.broadcast((searcher, weights, documents, max(1, total["length"])))
        scored = _scored(hits.filter(F.size("terms") > 0), model, top)
        salted = _ranked(scored.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS))), top, "salt")
        best = _ranked(salted.select("item_id", "doc_id", "score"), top)
        result = best if result is None else result.unionByName(best)
    if result is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return result.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
