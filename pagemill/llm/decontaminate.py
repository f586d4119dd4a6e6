"""Benchmark decontamination by spaced seeds.

A seed is a fixed mask over a run of words; it ignores the masked-out positions, so a passage with
substituted words still hashes like its benchmark item wherever the substitutions fall on ignored
positions. Hashes of both sides are joined, and around every hit the two texts are aligned word by
word: an overlap counts if it is long enough and most of its words agree.

No overlap is missed. One of 2 * MIN_WORDS words or more has a half that agrees enough, so it is enough that
the masks hit every pattern of at most n / 5 replaced words among n, from MIN_WORDS to 2 * MIN_WORDS - 1; a test
goes through all of them. An item of fewer words must be found whole and has one mask as long as its least run.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagemill.llm.arrow import lean, mix, slices, Words
from pagemill.llm.tables import without, written
from pagemill.session import ship_package

MASKS = ("111011", "101111")     # five words each, one place ignored
MIN_WORDS = 13      # shortest overlap, in words; a shorter item must be found whole
MIN_AGREE = 0.8     # share of equal words in an overlap
PART_BYTES = 16 << 20   # benchmark text held in memory at once; a larger benchmark takes several passes
_LOOKUP_BITS = 20
_REACH = 2 * MIN_WORDS  # words around a seed in which enough must agree before the texts are aligned
_HITS_AT_ONCE = 1 << 14
HITS = T.ArrayType(T.StructType([
    T.StructField("item_id", T.LongType()), T.StructField("overlap", T.LongType()),
    T.StructField("agreement", T.DoubleType())]))
_ARROW_HITS = pa.list_(pa.struct([("item_id", pa.int64()), ("overlap", pa.int64()), ("agreement", pa.float64())]))


@dataclass
class _Seeds:
    """The seeds of one part of a benchmark: sorted hashes with the item and the position of each."""
    items: np.ndarray       # item ids
    bounds: np.ndarray      # words of each item
    words: np.ndarray       # their hashes
    masks: list[np.ndarray]
    keys: np.ndarray
    item: np.ndarray
    position: np.ndarray
    seen: np.ndarray        # by the low bits of a hash: whether any seed has them


def _seed_hashes(words: np.ndarray, text: np.ndarray, mask: np.ndarray, number: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions, hashes) of the windows that lie within one text."""
    span = int(mask[-1]) + 1
    if len(words) < span:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at = np.flatnonzero(text[:len(text) - span + 1] == text[span - 1:])
    total = np.full(len(at), np.uint64((number + 1) * 0xD1B54A32D192ED03 % (1 << 64)))
    for offset in mask:
        total *= np.uint64(0x9E3779B97F4A7C15)
        total += words[at + offset]
    return at, mix(total)


def _short_run(words: int) -> int:
    """Equal words in a row in any overlap of so many words that agrees enough."""
    replaced = int((1 - MIN_AGREE) * words + 1e-9)
    return -(-(words - replaced) // (replaced + 1))


def _seeds(ids: list, texts: list[str]) -> _Seeds:
    """Masks for items of MIN_WORDS words and more, and for shorter ones a mask of the length of their least run."""
    parts = [(Words(data, offsets), first) for first, _, data, offsets in slices(pa.array(texts, pa.string()), lower=True)]
    words = np.concatenate([w.hashes for w, _ in parts] or [np.zeros(0, np.uint64)])
    counts = np.concatenate([w.counts for w, _ in parts] or [np.zeros(0, np.int64)])
    bounds = np.append(0, np.cumsum(counts))
    text = np.repeat(np.arange(len(counts)), counts)
    masks = [np.flatnonzero([c == "1" for c in m]) for m in MASKS]
    runs = np.array([0 if n >= MIN_WORDS or n == 0 else _short_run(int(n)) for n in counts], np.int64)
    short = sorted({int(r) for r in runs if r})
    masks += [np.arange(r) for r in short]
    found = []
    for number, mask in enumerate(masks):
        at, keys = _seed_hashes(words, text, mask, number)
        wanted = runs[text[at]] == (0 if number < len(MASKS) else short[number - len(MASKS)])
        at, keys = at[wanted], keys[wanted]
        found.append((keys, text[at], at - bounds[text[at]]))
    keys, item, position = (np.concatenate([f[i] for f in found]) for i in range(3))
    order = np.argsort(keys, kind="stable")
    seen = np.zeros(1 << _LOOKUP_BITS, bool)
    seen[(keys & np.uint64(len(seen) - 1)).astype(np.int64)] = True
    return _Seeds(np.array(ids, np.int64), bounds, words, masks, keys[order], item[order], position[order], seen)


def _best_stretch(equal: np.ndarray) -> tuple[int, float]:
    """Longest stretch, from an equal word to an equal word, of which MIN_AGREE agree."""
    at = np.flatnonzero(equal)
    if not len(at):
        return 0, 0.0
    # Word i scores 1 - MIN_AGREE if equal, else -MIN_AGREE: a stretch agrees enough if its sum is not negative.
    level = np.append(0.0, np.cumsum(np.where(equal, 1 - MIN_AGREE, -MIN_AGREE)))
    ahead = np.maximum.accumulate(level[::-1])[::-1]
    best, share, end = 0, 0.0, 0
    for start in at:
        end = max(end, start + 1)
        while end < len(equal) and ahead[end + 1] >= level[start] - 1e-9:
            end += 1
        stop = end
        while stop > start and (level[stop] < level[start] - 1e-9 or not equal[stop - 1]):
            stop -= 1
        if stop - start > best:
            best, share = int(stop - start), float(equal[start:stop].mean())
    return best, share


def _promising(seeds: _Seeds, words: Words, at: np.ndarray, item: np.ndarray, shift: np.ndarray) -> np.ndarray:
    """Which hits may lie in an overlap.

    An overlap of 2 * MIN_WORDS words or more is two halves, one of which agrees enough; so there is a
    part of under 2 * MIN_WORDS words that does, all of it within _REACH of a seed of its own.
    """
    text = words.text[at]
    low, high = np.maximum(words.bounds[text], shift), np.minimum(words.bounds[text + 1], shift + seeds.bounds[item + 1] - seeds.bounds[item])
    equal = np.zeros(len(at), np.int64)
    for offset in range(-_REACH, _REACH + 1):
        place = at + offset
        inside = np.flatnonzero((place >= low) & (place < high))
        place = place[inside]
        equal[inside] += words.hashes[place] == seeds.words[seeds.bounds[item[inside]] + place - shift[inside]]
    least = np.minimum(MIN_WORDS, seeds.bounds[item + 1] - seeds.bounds[item])
    return equal >= np.ceil(MIN_AGREE * least - 1e-9)


def _overlaps(seeds: _Seeds, words: Words) -> dict[int, dict[int, tuple[int, float]]]:
    """text -> item -> (longest overlap, share of equal words)."""
    diagonals = set()
    for number, mask in enumerate(seeds.masks):
        at, keys = _seed_hashes(words.hashes, words.text, mask, number)
        maybe = seeds.seen[(keys & np.uint64(len(seeds.seen) - 1)).astype(np.int64)]
        at, keys = at[maybe], keys[maybe]
        low, high = np.searchsorted(seeds.keys, keys, "left"), np.searchsorted(seeds.keys, keys, "right")
        ends = np.cumsum(high - low)
        for begin in range(0, int(ends[-1]) if len(ends) else 0, _HITS_AT_ONCE):
            # The n-th hit is of the first window whose hits reach beyond n.
            hit = np.arange(begin, min(begin + _HITS_AT_ONCE, int(ends[-1])))
            of = np.searchsorted(ends, hit, "right")
            seed = high[of] - (ends[of] - hit)
            item, shift = seeds.item[seed], at[of] - seeds.position[seed]
            good = _promising(seeds, words, at[of], item, shift)
            diagonals.update(zip(words.text[at[of]][good].tolist(), item[good].tolist(), shift[good].tolist()))
    found: dict[int, dict[int, tuple[int, float]]] = {}
    for text, item, shift in diagonals:
        first, last = seeds.bounds[item], seeds.bounds[item + 1]
        begin = max(words.bounds[text] - shift, 0)
        end = min(words.bounds[text + 1] - shift, last - first)
        length, share = _best_stretch(
            words.hashes[shift + begin:shift + end] == seeds.words[first + begin:first + end])
        if length >= min(MIN_WORDS, last - first) and share >= MIN_AGREE - 1e-9:
            of = found.setdefault(text, {})
            of[item] = max(of.get(item, (0, 0.0)), (length, share))
    return found


def _parts(bench: DataFrame, item_id: str, text: str) -> Iterator[_Seeds]:
    """The benchmark in parts of bounded size, each brought to the driver on its own."""
    rows = bench.select(F.col(item_id).cast("long").alias("id"), F.col(text).alias("text")).filter("id is not null and text is not null")
    size = rows.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    parts = -(-size // PART_BYTES)
    for part in range(parts):
        held = rows.filter(F.pmod(F.xxhash64("id", "text"), F.lit(parts)) == part).orderBy("id", "text").collect()
        if held:
            yield _seeds([r["id"] for r in held], [r["text"] for r in held])


def overlaps(docs: DataFrame, bench: DataFrame, *, text: str = "text", item_id: str = "item_id",
             item_text: str = "text", into: str = "overlaps") -> DataFrame:
    """The rows of ``docs`` with an array ``into`` of (item_id, overlap, agreement).

    An item is listed if at least MIN_WORDS consecutive words of the row stand, with at most
    1 - MIN_AGREE of them replaced, in the item (an item of fewer words: as a whole). Case and
    punctuation do not count. Rows are neither dropped nor moved: the benchmark travels, in parts of
    at most PART_BYTES of text, and every part is one pass over the rows.

    Null, empty and wordless texts overlap with nothing; items without id, text or word are ignored;
    items that share an id are listed once, with their longest overlap; repeated rows get equal
    arrays; a column named like ``into`` is replaced; an empty benchmark gives empty arrays.
    """
    spark = docs.sparkSession
    ship_package(spark)
    docs = without(docs, into)
    result = docs.withColumn(into, F.array().cast(HITS))
    held = None
    for seeds in _parts(bench, item_id, item_text):
        if held is not None:    # the part before is done with; neither memory nor the plan grows with the parts
            result = written(result, "overlaps")
            held.destroy()
        held = spark.sparkContext.broadcast(seeds)
        result = _one_part(result, held, text, into)
    return result


def _one_part(docs: DataFrame, sent, text: str, into: str) -> DataFrame:
    place = docs.columns.index(into)
    where = docs.columns.index(text)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seeds = sent.value
        for batch in batches:
            hits = batch.column(place).to_pylist()
            for first, _, data, offsets in slices(batch.column(where), lower=True):
                for row, items in _overlaps(seeds, Words(data, offsets)).items():
                    best = {h["item_id"]: h for h in hits[first + row]}
                    for item, (length, share) in items.items():
                        new = {"item_id": int(seeds.items[item]), "overlap": length, "agreement": share}
                        old = best.get(new["item_id"])
                        if old is None or (old["overlap"], old["agreement"]) < (length, share):
                            best[new["item_id"]] = new
                    hits[first + row] = [best[k] for k in sorted(best)]
            columns = list(batch.columns)
            columns[place] = pa.array(hits, _ARROW_HITS)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return docs.mapInArrow(lean(scan), docs.schema)


def contaminated_pairs(docs: DataFrame, bench: DataFrame, *, doc_id: str = "doc_id", text: str = "text", **names) -> DataFrame:
    """(doc_id, item_id, overlap, agreement): every contaminated row with every item it repeats."""
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    found = overlaps(slim, bench, text="text", into="overlaps", **names)
    return found.select("doc_id", F.inline("overlaps"))


def clean_rows(docs: DataFrame, bench: DataFrame, **names) -> DataFrame:
    """The rows of ``docs`` that repeat no benchmark item, columns unchanged."""
    into = "overlaps with the benchmark"
    return overlaps(docs, bench, into=into, **names).filter(F.size(F.col(f"`{into}`")) == 0).select(
        *[F.col(f"`{c}`") for c in docs.columns])
