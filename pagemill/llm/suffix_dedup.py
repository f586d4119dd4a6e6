"""Exact substring dedup over suffix arrays.

A byte goes if it is covered by a string of LENGTH bytes that also starts earlier in the corpus.

Texts are cut into pieces so that equal strings of LENGTH bytes lie in pieces of the same key: the key
of a string is the least hash of its short substrings, and a piece is a run of strings with one key.
Pieces of equal bytes collapse onto the first of them. Where a key still has different pieces, its
pieces go to a shard. A shard sorts all suffixes of its pieces (Larsson-Sadakane refinement: order by a
few bytes, then double the sorted length, touching only groups not yet told apart), takes the common
prefixes of neighbours (Kasai), and reads the repeated strings off them. A key too large for one shard
is spread over several, and every two of these are merged by binary search in their suffix arrays.
Pieces longer than half a shard are cut into overlapping ones before, and what a shard still has too
much goes to several suffix arrays, so none is ever longer than it can be.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagemill.llm.arrow import lean, mix, prefix_hash, slices, span_hash
from pagemill.llm.tables import written
from pagemill.session import ship_package

LENGTH = 100
GRAM = 24                     # bytes of the substrings whose least hash is the key of a string
SHARD_BYTES = 1 << 19         # of pieces in a shard, about; suffixes are packed into 21 bits
_FIRST = 5                    # bytes that the first sorting looks at
_INDEX_BITS = 21
_SPAN = "array<struct<start:long,end:long>>"


# Pieces

def _sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours."""
    have = 1
    while have * 2 <= width:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    return np.minimum(x[:len(x) - (width - have)], x[width - have:]) if width > have else x


def pieces(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """(text, start, end, key, fingerprint, tied) of the pieces of a slice; start and end within the text.

    ``tied`` says that a piece may repeat a string within itself.
    """
    gram = min(GRAM, length)
    width = length - gram + 1
    n = len(data)
    if n < length:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64, bool))
    prefix = prefix_hash(data)
    at = np.arange(n - gram + 1)
    hashes = span_hash(prefix, at, at + gram)
    bits = np.uint64(max(n, 2).bit_length())
    low = (np.uint64(1) << bits) - np.uint64(1)
    left = _sliding_least((hashes & ~low) | at.astype(np.uint64), width)
    right = _sliding_least((hashes & ~low) | (low - at.astype(np.uint64)), width)
    first = (left & low).astype(np.int64)
    twice = first != (low - (right & low)).astype(np.int64)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[:len(first)]
    inside = np.arange(len(first)) + length <= offsets[1:][text]
    starts = np.flatnonzero(inside)
    key = hashes[first[starts]]
    new = np.ones(len(starts), bool)
    new[1:] = (key[1:] != key[:-1]) | (np.diff(starts) != 1) | (text[starts[1:]] != text[starts[:-1]])
    head = np.flatnonzero(new)
    if not len(head):
        return pieces(data[:0], offsets[:1], length)
    runs = np.diff(np.append(head, len(starts)))
    begin, of = starts[head], text[starts[head]]
    end = begin + runs + length - 1
    tied = np.maximum.reduceat(twice[starts], head) | (runs > width)
    return of, begin - offsets[of], end - offsets[of], key[head], span_hash(prefix, begin, end) ^ mix(runs), tied


def _merged(of: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Union of intervals [start, end) that are ordered by (of, start); touching ones join."""
    if not len(of):
        return of, start, end
    shift = of.astype(np.int64) * (int(end.max()) + 1 - min(0, int(start.min())))
    reach = np.maximum.accumulate(end + shift)
    new = np.append(True, (start + shift)[1:] > reach[:-1])
    new[1:] |= of[1:] != of[:-1]
    head = np.flatnonzero(new)
    return of[head], start[head], np.maximum.reduceat(end, head)


def _ranked(doc: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place of each (doc, row) in the order of all, and doc and row by place."""
    order = np.lexsort((row, doc))
    new = np.append(True, (doc[order][1:] != doc[order][:-1]) | (row[order][1:] != row[order][:-1]))[:len(order)]
    rank = np.zeros(len(order), np.int64)
    rank[order] = np.cumsum(new) - 1
    return rank, doc[order[new]], row[order[new]]


def _cut(length: int):
    """(doc, row, text) to (key, print, doc, row, place) of its pieces; those without print are repeats already found.

    Within a batch, pieces of equal bytes are reduced to the first, so that a large group of copies
    reaches the shuffle once a batch, not once a copy.
    """
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rank, docs, rows = _ranked(*(batch.column(c).to_numpy(zero_copy_only=False) for c in (0, 1)))
            parts = [(of + first, start, end, key, mark, tied)
                     for first, _, data, offsets in slices(batch.column(2), lower=False)
                     for of, start, end, key, mark, tied in [pieces(data, offsets, length)]]
            if not parts:
                continue
            of, start, end, key, mark, tied = (np.concatenate(c) for c in zip(*parts))
            of = rank[of] if len(of) else np.zeros(0, np.int64)
            order = np.lexsort((start, of, mark, key))
            of, start, end, key, mark, tied = (x[order] for x in (of, start, end, key, mark, tied))
            group = np.ones(len(of), bool)
            group[1:] = (key[1:] != key[:-1]) | (mark[1:] != mark[:-1])
            leader = np.flatnonzero(group)[np.cumsum(group) - 1] if len(of) else np.zeros(0, np.int64)
            repeat = (of != of[leader]) | (start != start[leader])
            first = of[~repeat]
            yield _piece_rows(key[~repeat].view(np.int64), mark[~repeat].view(np.int64), docs[first], rows[first],
                              start[~repeat], end[~repeat], tied[~repeat])
            order = np.lexsort((start[repeat], of[repeat]))
            o, s, e = _merged(of[repeat][order], start[repeat][order], end[repeat][order])
            spread = mix(rows[o].astype(np.uint64) + s.astype(np.uint64)).view(np.int64)
            yield _piece_rows(spread, None, docs[o], rows[o], s, e, np.zeros(len(o), bool))
    return cut


def _piece_rows(key, mark, doc, row, start, end, tied) -> pa.RecordBatch:
    # Start, end and tie share one number: rows of the large shuffle stay short.
    place = (start.astype(np.int64) << 32) | ((end - start).astype(np.int64) << 1) | tied
    marks = pa.nulls(len(key), pa.int64()) if mark is None else pa.array(mark)
    return pa.RecordBatch.from_arrays([pa.array(key), marks, pa.array(doc), pa.array(row), pa.array(place)],
                                      names=["key", "print", "doc", "row", "place"])


# Suffix arrays

def suffix_array(data: np.ndarray) -> np.ndarray:
    """The suffixes of up to 2**21 - 2 bytes in order."""
    n = len(data)
    if n > (1 << _INDEX_BITS) - 2:
        raise ValueError(f"{n} bytes in one suffix array")
    index = np.arange(n, dtype=np.uint64)
    mask = np.uint64((1 << _INDEX_BITS) - 1)
    padded = np.append(data, np.zeros(_FIRST, np.uint8)).astype(np.uint64)
    key = np.zeros(n, np.uint64)
    for i in range(_FIRST):
        key = (key << np.uint64(8)) | padded[i:i + n]
    packed = np.sort((key << np.uint64(_INDEX_BITS)) | index)
    order = (packed & mask).astype(np.int64)
    value = packed >> np.uint64(_INDEX_BITS)
    new = np.append(True, value[1:] != value[:-1]) if n else np.zeros(0, bool)
    # A suffix ranks as the place of its group; 0 is the rank of what lies beyond the end.
    rank = np.zeros(n + 1, np.uint64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0)).astype(np.uint64) + np.uint64(1)
    done = _FIRST
    while True:
        alone = new & np.append(new[1:], True)
        slots = np.flatnonzero(~alone)
        if not len(slots):
            break
        who = order[slots]
        after = rank[np.minimum(who + done, n)]
        packed = np.sort((rank[who] << np.uint64(2 * _INDEX_BITS)) | (after << np.uint64(_INDEX_BITS)) | who.astype(np.uint64))
        who = (packed & mask).astype(np.int64)
        value = packed >> np.uint64(_INDEX_BITS)
        order[slots] = who
        split = np.append(True, value[1:] != value[:-1])
        new[slots] = split
        rank[who] = slots[np.maximum.accumulate(np.where(split, np.arange(len(slots)), 0))].astype(np.uint64) + np.uint64(1)
        done *= 2
    return order


def common_prefixes(data: np.ndarray, order: np.ndarray, cap: int, lane: int = 64) -> np.ndarray:
    """Common prefix, up to ``cap``, of every suffix with the one before it in ``order`` (0 for the first).

    Kasai's rule, a suffix shares at most one byte less with its neighbour than the suffix one byte
    earlier, is followed along lanes of neighbouring suffixes, all lanes side by side.
    """
    n = len(order)
    before = np.full(n, -1)
    before[order[1:]] = order[:-1]
    padded = np.append(data, np.zeros(cap + 8, np.uint8))
    word = np.zeros(n + cap, np.uint64)
    for i in range(8):
        word = (word << np.uint64(8)) | padded[i:i + n + cap].astype(np.uint64)
    found = np.zeros(n, np.int64)
    lanes = np.arange(0, n, lane)
    held = np.zeros(len(lanes), np.int64)
    for t in range(lane):
        i = lanes + t
        live = i < n
        i = i[live]
        j = before[i]
        h = np.where(j >= 0, np.maximum(held[live] - 1, 0), 0)
        active = np.flatnonzero(j >= 0)
        while len(active):
            a, b = i[active] + h[active], j[active] + h[active]
            differ = word[a] ^ word[b]
            same = np.sum([differ < (1 << b) for b in range(0, 64, 8)], axis=0)
            h[active] += np.minimum(same, n - np.maximum(a, b))
            active = active[(same == 8) & (h[active] < cap) & (np.maximum(a, b) + 8 <= n)]
        h = np.minimum(h, cap)
        found[i] = h
        held[np.flatnonzero(live)] = h
    return found[order]


def _heads(data: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """The ``length`` bytes at each place, as fixed-width strings that compare bytewise."""
    windows = np.lib.stride_tricks.sliding_window_view(data, length)[at]
    return np.ascontiguousarray(windows).view(f"V{length}").ravel()


def repeats_within(data: np.ndarray, valid: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(repeats, order, group heads): ``repeats`` marks valid starts whose string starts validly before, too."""
    order = suffix_array(data)
    prefix = common_prefixes(data, order, length)
    group = np.cumsum(prefix < length)
    real = valid[order]
    order, group = order[real], group[real]
    first = np.flatnonzero(np.append(True, group[1:] != group[:-1])) if len(order) else np.zeros(0, np.int64)
    least = np.minimum.reduceat(order, first) if len(first) else first
    repeat = np.zeros(len(data), bool)
    repeat[order] = order != np.repeat(least, np.diff(np.append(first, len(order))))
    return repeat, order, first


def found_by_search(data: np.ndarray, order: np.ndarray, heads: np.ndarray, length: int) -> np.ndarray:
    """Place in the sorted suffixes ``order`` of the string equal to each head, or -1: binary search, all heads at once."""
    low, high = np.zeros(len(heads), np.int64), np.full(len(heads), len(order))
    columns = np.frombuffer(heads.tobytes(), np.uint8).reshape(len(heads), length)
    while (open_ := np.flatnonzero(low < high)).size:
        middle = (low[open_] + high[open_]) // 2
        suffix = np.lib.stride_tricks.sliding_window_view(data, length)[order[middle]]
        differ = suffix != columns[open_]
        at = differ.argmax(axis=1)
        rows = np.arange(len(open_))
        less = differ.any(axis=1) & (suffix[rows, at] < columns[open_][rows, at])
        low[open_[less]] = middle[less] + 1
        high[open_[~less]] = middle[~less]
    hit = np.flatnonzero(low < len(order))
    out = np.full(len(heads), -1)
    same = (np.lib.stride_tricks.sliding_window_view(data, length)[order[low[hit]]] == columns[hit]).all(axis=1)
    out[hit[same]] = low[hit[same]]
    return out


class _Shard:
    """Pieces in the order of their places, their suffixes and the repeats among them."""

    def __init__(self, doc: np.ndarray, start: np.ndarray, blobs: list[bytes], length: int):
        order = np.lexsort((start, doc))
        if len(order):      # a piece of a repeated row comes once
            place = np.column_stack([doc[order], start[order]])
            order = order[np.append(True, (place[1:] != place[:-1]).any(axis=1))]
        self.doc, self.start, self.length = doc[order], start[order], length
        blobs = [blobs[i] for i in order]
        sizes = np.array([len(b) for b in blobs], np.int64)
        self.data = np.frombuffer(b"".join(blobs), np.uint8)
        self.begin = np.append(0, np.cumsum(sizes))
        self.piece = np.repeat(np.arange(len(blobs)), sizes)
        inside = np.arange(len(self.data)) - self.begin[self.piece]
        self.valid = inside + length <= sizes[self.piece]
        self.repeat, self.order, self.heads = repeats_within(self.data, self.valid, length)

    def place(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self.doc[self.piece[at]], self.start[self.piece[at]] + at - self.begin[self.piece[at]]

    def mark_repeats_of(self, other: _Shard) -> None:
        """Mark the strings that start earlier in the other shard."""
        at = np.flatnonzero(self.valid & ~self.repeat)
        found = found_by_search(other.data, other.order, _heads(self.data, at, self.length), self.length)
        at, found = at[found >= 0], found[found >= 0]
        # The first of a group of equal strings in the order of places.
        least = np.minimum.reduceat(other.order, other.heads) if len(other.heads) else other.heads
        group = np.searchsorted(other.heads, found, side="right") - 1
        doc, start = self.place(at)
        first_doc, first_start = other.place(least[group])
        self.repeat[at[(first_doc < doc) | ((first_doc == doc) & (first_start < start))]] = True

    def spans(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        at = np.flatnonzero(self.repeat)
        doc, start = self.place(at)
        of, s, e = _merged(self.piece[at], start, start + self.length)
        return self.doc[of], s, e


def _packs(key: np.ndarray, size: np.ndarray, limit: int) -> list[np.ndarray]:
    """The pieces in the order of their keys, in packs of at most ``limit`` bytes (or one piece)."""
    packs, held, total = [], [], 0
    for i in np.argsort(key, kind="stable"):
        if held and total + size[i] > limit:
            packs.append(np.array(held))
            held, total = [], 0
        held.append(i)
        total += int(size[i])
    return packs + [np.array(held)]


def _shard_repeats(length: int, limit: int):
    def find(table: pa.Table) -> pa.Table:
        start, key, side = (table.column(c).to_numpy() for c in ("start", "key", "side"))
        doc, docs, rows = _ranked(table.column("doc").to_numpy(), table.column("row").to_numpy())
        blobs = table.column("bytes").to_pylist()
        size = np.array([len(b) for b in blobs], np.int64)
        packs = []
        for s in np.unique(side):
            of = np.flatnonzero(side == s)
            packs += [(s, of[p]) for p in _packs(key[of], size[of], limit)]
        two = len(np.unique(side)) == 2
        shards = [_Shard(doc[p], start[p], [blobs[i] for i in p], length) for _, p in packs]
        # Each side of two was searched within itself under its own shard; here only one against the other.
        # A string that starts earlier in its own suffix array was found there.
        known = [shard.repeat.copy() if two else np.zeros(len(shard.repeat), bool) for shard in shards]
        for i, (a, one) in enumerate(packs):
            for j, (b, other) in enumerate(packs[:i]):
                if (a != b) if two else (key[one].min() <= key[other].max()):
                    shards[i].mark_repeats_of(shards[j])
                    shards[j].mark_repeats_of(shards[i])
        for shard, before in zip(shards, known):
            shard.repeat &= ~before
        of, first, end = (np.concatenate(c) for c in zip(*(s.spans() for s in shards)))
        return pa.table([docs[of], rows[of], first, end], names=["doc", "row", "start", "end"])
    return find


def _row_key(doc_id: str, text: str) -> tuple[Column, Column]:
    """(doc, row) by which texts are told apart and ordered: the id, the greatest number for none, and a hash of the text."""
    last = F.lit((1 << 63) - 1)
    return F.coalesce(F.col(f"`{doc_id}`").cast("long"), last).alias("doc"), F.xxhash64(F.col(f"`{text}`")).alias("row")


def repeated_spans(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """(doc, row, spans): for documents that repeat anything, the byte ranges to remove, not yet joined where they overlap.

    ``doc`` and ``row`` are those of ``_row_key``.
    """
    spark = docs.sparkSession
    ship_package(spark)
    slim = docs.select(*_row_key(doc_id, text), F.col(f"`{text}`").alias("text"))
    long_enough = slim.filter(F.octet_length("text") >= length)
    rows = long_enough.mapInArrow(lean(_cut(length)), "key long, print long, doc long, row long, place long")
    by_key = Window.partitionBy("key")
    by_print = Window.partitionBy("key", "print").orderBy("doc", "row", "place")
    first = F.first(F.struct("doc", "row", "place")).over(by_print)
    seen = rows.withColumns({
        "first": first, "turn": F.row_number().over(by_print),
        "low": F.min("print").over(by_key), "high": F.max("print").over(by_key)})
    known = F.col("print").isNull()
    repeat = known | (F.struct("doc", "row", "place") != F.col("first"))
    several = F.col("low") != F.col("high")
    tied = F.col("place").bitwiseAND(1) == 1
    placed = written(seen.filter(repeat | several | tied).select(
        "key", "doc", "row", F.shiftright("place", 32).alias("start"),
        F.shiftright(F.col("place").bitwiseAND((1 << 32) - 1), 1).alias("size"), repeat.alias("repeat"),
        "turn"), "pieces")
    whole = placed.filter("repeat").select("doc", "row", "start", (F.col("start") + F.col("size")).alias("end"))

    # A piece longer than half a shard is cut; a string of ``length`` bytes lies in exactly one of its parts.
    step = max(SHARD_BYTES // 2, length)
    cuts = F.sequence(F.lit(0).cast("long"), F.col("size") - length, F.lit(step).cast("long"))
    open_ = (placed.filter("not repeat and turn = 1").select("key", "doc", "row", "start", "size", F.explode(cuts).alias("cut"))
             .select("key", "doc", "row", (F.col("start") + F.col("cut")).alias("start"),
                     F.least(F.col("size") - F.col("cut"), F.lit(step + length - 1)).alias("size")))
    total = open_.agg(F.sum("size").alias("n")).first()["n"] or 0
    shards = max(1, -(-total // SHARD_BYTES))
    large = open_.groupBy("key").agg(F.ceil(F.sum("size") / SHARD_BYTES).alias("parts")).filter("parts > 1")
    spread = open_.join(large, "key", "left")
    part = F.pmod(F.xxhash64("doc", "row", "start"), F.col("parts")).cast("int")
    # A key of several parts: each part alone, and with every other part.
    pairs = F.transform(F.sequence(F.lit(0), F.col("parts").cast("int") - 1), lambda other: F.struct(
        F.concat_ws(" ", F.col("key"), F.least(other, part), F.greatest(other, part)).alias("shard"),
        F.when(other < part, 1).otherwise(0).alias("side")))
    bundle = F.array(F.struct(F.pmod("key", F.lit(shards)).cast("string").alias("shard"), F.lit(0).alias("side")))
    wanted = spread.withColumn("to", F.when(F.col("parts").isNull(), bundle).otherwise(pairs))
    lists = wanted.groupBy("doc", "row").agg(F.collect_list(F.struct("key", "start", "size", "to")).alias("wanted"))
    # Rows repeated as a whole bring each of their pieces once a copy; a shard keeps one.
    bytes_ = slim.join(lists, ["doc", "row"]).select("doc", "row", F.encode("text", "utf-8").alias("text"), F.explode("wanted").alias("w"))
    blobs = bytes_.select("doc", "row", F.col("w.key").alias("key"), F.col("w.start").alias("start"), F.explode("w.to").alias("t"),
                          F.substring(F.col("text"), F.col("w.start").cast("int") + 1, F.col("w.size").cast("int")).alias("bytes")) \
        .select("doc", "row", "key", "start", "bytes", "t.shard", "t.side")
    inner = blobs.groupBy("shard").applyInArrow(_shard_repeats(length, 2 * SHARD_BYTES), "doc long, row long, start long, end long")
    spans = whole.unionByName(inner)
    return spans.groupBy("doc", "row").agg(F.collect_list(F.struct("start", "end")).alias("spans"))


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text, spans) to (doc_id, n_bytes, spans, kept): maximal spans and the bytes outside them."""
    for batch in batches:
        maximal, kept, sizes = [], [], []
        for text, spans in zip(batch.column(1), batch.column(2)):
            data = text.as_py()
            data = b"" if data is None else data
            pairs = np.array([(s["start"], s["end"]) for s in spans.as_py()] if spans.is_valid else [], np.int64).reshape(-1, 2)
            pairs = np.minimum(pairs[np.argsort(pairs[:, 0], kind="stable")], len(data))
            _, start, end = _merged(np.zeros(len(pairs), np.int64), pairs[:, 0], pairs[:, 1])
            keep, at = [], 0
            for s, e in zip(start, end):
                keep.append(data[at:s])
                at = e
            keep.append(data[at:])
            maximal.append([{"start": int(s), "end": int(e)} for s, e in zip(start, end)])
            kept.append(b"".join(keep))
            sizes.append(len(data))
        yield pa.RecordBatch.from_arrays([
            batch.column(0), pa.array(sizes, pa.int64()),
            pa.array(maximal, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
            pa.array(kept, pa.binary())], names=["doc_id", "n_bytes", "spans", "kept"])


def without_repeats(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """(doc_id, n_bytes, spans, kept) of every row: maximal removed byte ranges, and the bytes that stay.

    Texts are UTF-8 bytes; a string counts as repeated if it starts earlier in the same document or in
    one of smaller id, whether or not that part is removed itself. Cuts may fall inside a character, so
    ``kept`` is binary.

    Null texts count as empty. Rows of equal id and text are one document and get equal results. Rows
    that share an id with different texts are documents of their own, ordered by a hash of the text; rows
    without id come last, in the same order. So every string that is removed stays in an earlier row, and
    the order of the rows decides nothing. Very long texts are cut into pieces like others. Other columns
    are not read.
    """
    found = repeated_spans(docs, doc_id=doc_id, text=text, length=length)
    rows = docs.select(*_row_key(doc_id, text), F.col(f"`{doc_id}`").cast("long").alias("doc_id"),
                       F.encode(F.col(f"`{text}`"), "utf-8").alias("text"))
    joined = rows.join(found, ["doc", "row"], "left").select("doc_id", "text", "spans")
    return joined.mapInArrow(lean(_removed), f"doc_id long, n_bytes long, spans {_SPAN}, kept binary")
