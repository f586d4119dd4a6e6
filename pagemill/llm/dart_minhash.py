"""Near-duplicate documents by DartMinHash signatures of weighted word shingles.

Every shingle of a text owns a strip as wide as its weight. Darts with hashed places land in the
strips: a dart has a height (its rank) and a coordinate. A text keeps, for each coordinate, the
lowest dart in its strips; two texts keep the same dart with a probability equal to their weighted
Jaccard similarity. Darts are thrown only as high as needed to hit every coordinate, so the cost of a
signature does not grow with weights times coordinates. Equal bands of signatures make candidates,
which are then compared exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.llm.arrow import Words, lean, mix, occurrences, slices, uniform, windows
from pagemill.llm.tables import connected_components, written
from pagemill.operators.dedup import place_words, placed, rows_by_place
from pagemill.session import ship_package

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 24, 5       # a pair at 0.8 is missed by all bands once in 14,000 times
COORDINATES = BANDS * ROWS
# Heights are cut into floors; darts of a floor are drawn from the shingle, the unit and the floor.
_LOWEST = 1.0 / 8
_DARTS = COORDINATES * (np.log(COORDINATES) + 2)    # expected darts that hit all coordinates
_CHUNK = 1 << 18
PEELS = 2               # times that the texts left in a bucket meet their first one, before all meet
BLOCK = 1 << 10         # texts of a bucket compared at once with as many others, and
BLOCK_SHINGLES = 1 << 20    # shingles of these texts
_COLUMNS = 1 << 12      # shingles of a block held at once as a table


def _floor_edges(number: int) -> tuple[float, float]:
    return (0.0 if number == 0 else _LOWEST * 2.0 ** (number - 1)), _LOWEST * 2.0 ** number


def _poisson(u: np.ndarray, mean: float) -> np.ndarray:
    """Poisson numbers by inversion of uniform ones."""
    count, term = np.zeros(len(u), np.int64), np.exp(-mean)
    total, k = term, 0
    left = np.flatnonzero(u >= total)
    while len(left) and k < mean * 4 + 60:
        k += 1
        count[left] = k
        term *= mean / k
        total += term
        left = left[u[left] >= total]
    return count


def _throw(units: np.ndarray, text: np.ndarray, number: int, tops: np.ndarray) -> tuple[np.ndarray, ...]:
    """(text, coordinate, height, name) of the darts of one floor, below the top of each text."""
    low, high = _floor_edges(number)
    # A floor is cut into steps with at most one dart on average.
    steps = max(1, int(np.ceil(high - low)))
    width = (high - low) / steps
    step = np.tile(np.arange(steps), len(units))
    unit = np.repeat(np.arange(len(units)), steps)
    used = low + width * step < tops[text[unit]]
    step, unit = step[used], unit[used]
    seeds = mix(units + np.uint64((number + 1) * 0xA0761D6478BD642F % (1 << 64)))
    base = mix(seeds[unit] + step.astype(np.uint64))
    counts = _poisson(uniform(base), width)
    owner = np.repeat(np.arange(len(base)), counts)
    turn = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    names = mix(base[owner] + (turn + 1).astype(np.uint64) * np.uint64(0xE7037ED1A0B428DB))
    height = low + width * (step[owner] + uniform(mix(names + np.uint64(1))))
    coordinate = (mix(names + np.uint64(2)) % np.uint64(COORDINATES)).astype(np.int64)
    of = text[unit[owner]]
    below = height < tops[of]
    return of[below], coordinate[below], height[below], names[below]


def signatures(hashes: np.ndarray, text: np.ndarray, texts: int) -> np.ndarray:
    """(texts, COORDINATES) names of the lowest darts; rows of texts without shingles are 0."""
    of, shingle, weight = occurrences(hashes, text)
    # The strip of a shingle with weight w is w units wide.
    unit = np.arange(weight.sum()) - np.repeat(np.cumsum(weight) - weight, weight)
    units = mix(np.repeat(shingle, weight) + unit.astype(np.uint64) * np.uint64(0x8EBC6AF09C88C6E3))
    owner = np.repeat(of, weight)
    total = np.bincount(owner, minlength=texts).astype(float)
    out = np.zeros(texts * COORDINATES, np.uint64)
    lowest = np.full(texts * COORDINATES, np.inf)
    tops = np.where(total > 0, _DARTS / np.maximum(total, 1), 0.0)
    open_ = total > 0
    done = np.zeros(texts)                                   # height already thrown
    while open_.any():
        number = 0
        while _floor_edges(number)[0] < tops[open_].max():
            low, high = _floor_edges(number)
            takes = (open_ & (tops > low) & (done < high))[owner]
            for part in np.array_split(np.flatnonzero(takes), max(1, int(takes.sum() * max(1.0, high - low)) // _CHUNK)):
                t, c, h, name = _throw(units[part], owner[part], number, tops)
                cell = t * COORDINATES + c
                np.minimum.at(lowest, cell, h)
                best = h == lowest[cell]
                out[cell[best]] = name[best]
            number += 1
        done[open_] = tops[open_]
        open_ &= np.isinf(lowest).reshape(texts, COORDINATES).any(axis=1)
        tops[open_] *= 2
    return out.reshape(texts, COORDINATES)


def band_keys(signature: np.ndarray) -> np.ndarray:
    """(texts, BANDS) hashes of the bands of a signature."""
    mult = np.random.default_rng(7).integers(1, 1 << 63, ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    mixed = (signature.reshape(-1, BANDS, ROWS) * mult).sum(axis=2, dtype=np.uint64)
    return mix(mixed + np.arange(BANDS, dtype=np.uint64) * np.uint64(0x589965CC75374CC3))


def _list_column(values: np.ndarray, per_row: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(per_row)), pa.int32()), pa.array(values.view(np.int64)))


def _content(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit keys of the words of each text in their order."""
    at = np.arange(len(words.hashes)) - words.bounds[words.text] + 1
    keys = []
    for salt in (np.uint64(0), np.uint64(0x6A09E667F3BCC909)):
        whole = np.zeros(len(words.hashes) + 1, np.uint64)
        np.cumsum(mix(words.hashes ^ salt) * (mix(at.astype(np.uint64) + salt) | np.uint64(1)), out=whole[1:])
        keys.append(mix(whole[words.bounds[1:]] - whole[words.bounds[:-1]] + words.counts.astype(np.uint64)).view(np.int64))
    return keys[0], keys[1]


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text) to (doc_id, content keys, bands): texts of the same words in order share both keys."""
    for batch in batches:
        for first, upto, data, offsets in slices(batch.column(1), lower=True):
            words = Words(data, offsets)
            n = upto - first
            shingles, text = windows(words, SHINGLE)
            content, check = _content(words)
            have = words.counts > 0
            bands = band_keys(signatures(shingles, text, n))[have]
            yield pa.RecordBatch.from_arrays([
                batch.column(0).slice(first, n).filter(pa.array(have)), pa.array(content[have]), pa.array(check[have]),
                _list_column(bands.ravel(), np.full(have.sum(), BANDS))], names=["doc", "content", "check", "bands"])


def _shingle_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, text) to (doc, content keys, 32-bit hashes of its shingles); the n-th repeat of a shingle is one of its own."""
    for batch in batches:
        for first, upto, data, offsets in slices(batch.column(1), lower=True):
            words = Words(data, offsets)
            content, check = _content(words)
            shingles, text = windows(words, SHINGLE)
            of, shingle, weight = occurrences(shingles, text)
            unit = np.arange(weight.sum()) - np.repeat(np.cumsum(weight) - weight, weight)
            units = mix(np.repeat(shingle, weight) + unit.astype(np.uint64) * np.uint64(0x8EBC6AF09C88C6E3))
            owner = np.repeat(of, weight)
            short = (units >> np.uint64(32)).astype(np.int64)
            pairs = np.sort((owner << 32) | short)
            pairs = pairs[np.append(True, pairs[1:] != pairs[:-1])] if len(pairs) else pairs
            ends = np.searchsorted(pairs >> 32, np.arange(upto - first + 1))
            values = pa.array((pairs & 0xFFFFFFFF).astype(np.uint32).view(np.int32))
            yield pa.RecordBatch.from_arrays([
                batch.column(0).slice(first, upto - first), pa.array(content), pa.array(check),
                pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)], names=["doc", "content", "check", "shingles"])


def _verified(edges: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) of at least SIMILARITY, by their whole sets of shingles."""
    left = sets.select(F.col("doc").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("doc").alias("b"), F.col("shingles").alias("sb"))
    common = F.size(F.array_intersect("sa", "sb"))
    small, large = F.least(F.size("sa"), F.size("sb")), F.greatest(F.size("sa"), F.size("sb"))
    near = (small >= SIMILARITY * large) & (common >= SIMILARITY * (small + large - common) - 1e-9)
    return written(edges.join(left, "a").join(right, "b").filter(near).select("a", "b"), "links")


def _in_classes(buckets: DataFrame, classes: DataFrame) -> DataFrame:
    named = classes.select(F.col("node").alias("doc"), F.col("component").alias("class"))
    return buckets.join(named, "doc", "left").withColumn("class", F.coalesce("class", "doc"))


def _joined(classes: DataFrame, links: DataFrame) -> DataFrame:
    """The classes with those joined that the links connect; only links between classes are followed."""
    merged = connected_components(_between(links, classes).select(F.col("ca").alias("a"), F.col("cb").alias("b"))) \
        .select(F.col("node").alias("old"), F.col("component").alias("new"))
    moved = classes.join(merged, F.col("component") == F.col("old"), "left").select("node", F.coalesce("new", "component").alias("component"))
    fresh = merged.join(classes.select(F.col("node").alias("old")), "old", "left_anti").select(F.col("old").alias("node"), F.col("new").alias("component"))
    return written(moved.unionByName(fresh), "classes")


def _between(edges: DataFrame, classes: DataFrame) -> DataFrame:
    """The edges (a, b) between different classes, with these as (ca, cb); a text of no class is its own."""
    left = classes.select(F.col("node").alias("a"), F.col("component").alias("ca"))
    right = classes.select(F.col("node").alias("b"), F.col("component").alias("cb"))
    return (edges.join(left, "a", "left").join(right, "b", "left")
            .select("a", "b", F.coalesce("ca", "a").alias("ca"), F.coalesce("cb", "b").alias("cb")).filter("ca <> cb"))


def _left_in_buckets(buckets: DataFrame, classes: DataFrame) -> DataFrame:
    """(band, doc, low): the texts outside the class of ``low`` in each bucket that are of several classes, with their first one."""
    named = _in_classes(buckets, classes)
    heads = classes.select(F.col("node").alias("low"), F.col("component").alias("head"))
    rest = named.join(heads, "low", "left").filter(F.col("class") != F.coalesce("head", "low")).select("band", "doc", "class")
    lows = (rest.groupBy("band").agg(F.min("doc").alias("low"), F.min("class").alias("least"), F.max("class").alias("most"))
            .filter("least < most").select("band", "low"))
    return rest.join(lows, "band").select("band", "doc", "low")


def _may_be_near(sizes: np.ndarray, values: np.ndarray) -> np.ndarray:
    """(n, n): which sets may reach SIMILARITY, by the first shingles of each, those of few sets first.

    Sets of at least SIMILARITY have SIMILARITY of the shingles of either in common. So one that they share is among
    the first of both, where a set of n brings all but that share and one more, in one order for all sets.
    """
    n = len(sizes)
    of = np.repeat(np.arange(n), sizes)
    _, column, frequency = np.unique(values, return_inverse=True, return_counts=True)
    order = np.lexsort((column, frequency[column], of))
    turn = np.arange(len(of)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    least = np.ceil(SIMILARITY * sizes - 1e-9).astype(np.int64)
    taken = (turn <= (sizes - least)[of]) & (frequency[column[order]] > 1)
    column, of = column[order][taken], of[taken]
    by = np.lexsort((of, column))
    column, of = column[by], of[by]
    may = np.zeros((n, n), bool)
    for holders in np.split(of, np.flatnonzero(np.diff(column)) + 1):
        if len(holders) > 1:
            may[np.ix_(holders, holders)] = True
    return may


def _near_in_block(owner: np.ndarray, shingles: list[np.ndarray], apart: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of at least SIMILARITY among those that ``apart`` marks, by their whole sets of shingles."""
    n, sizes = len(owner), np.array([len(s) for s in shingles])
    wanted = apart & (np.minimum.outer(sizes, sizes) >= SIMILARITY * np.maximum.outer(sizes, sizes))
    wanted &= _may_be_near(sizes, np.concatenate(shingles))
    use = np.flatnonzero(wanted.any(axis=1))
    if not len(use):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    of = np.repeat(np.arange(len(use)), sizes[use])
    values, column = np.unique(np.concatenate([shingles[i] for i in use]), return_inverse=True)
    shared = np.flatnonzero(np.bincount(column, minlength=len(values)) > 1)     # others are in no two sets
    place = np.full(len(values), -1)
    place[shared] = np.arange(len(shared))
    order = np.argsort(place[column], kind="stable")
    of, column = of[order], place[column][order]
    common = np.zeros((len(use), len(use)), np.int64)
    for first in range(0, len(shared), _COLUMNS):
        low, high = np.searchsorted(column, [first, first + _COLUMNS])
        has = np.zeros((len(use), min(_COLUMNS, len(shared) - first)), np.float32)
        has[of[low:high], column[low:high] - first] = 1
        common += (has @ has.T).astype(np.int64)
    total = np.add.outer(sizes[use], sizes[use])
    near = wanted[np.ix_(use, use)] & (common >= SIMILARITY * (total - common) - 1e-9)
    a, b = np.nonzero(np.triu(near, 1))
    return owner[use[a]], owner[use[b]]


def _compared_block(table: pa.Table) -> pa.Table:
    """(a, b) of a block: each text of one part of a bucket with each of another part, or of the same one."""
    doc, group, side = (table.column(c).to_numpy() for c in ("doc", "class", "side"))
    held = table.column("shingles").combine_chunks()
    held = held if isinstance(held, pa.Array) else pa.concat_arrays(held.chunks)
    shingles = [np.asarray(held[i].values) for i in range(len(doc))]
    apart = np.not_equal.outer(group, group)
    if side.max():
        apart &= np.not_equal.outer(side, side)
    a, b = _near_in_block(doc, shingles, apart)
    return pa.table([pa.array(np.maximum(a, b), pa.int64()), pa.array(np.minimum(a, b), pa.int64())], names=["a", "b"])


def _verified_in_blocks(buckets: DataFrame, classes: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) of at least SIMILARITY within a bucket and of different classes, without those of ``low``.

    A bucket is dealt to parts of about BLOCK texts and BLOCK_SHINGLES shingles, and every two parts are compared
    in a task of their own. A part holds each text once a bucket, so no pair becomes a row unless it is near.
    """
    sizes = sets.select("doc", F.size("shingles").cast("long").alias("size"))
    rest = written(_in_classes(buckets.filter("doc <> low"), classes).join(sizes, "doc").select("band", "doc", "class", "size"), "rest")
    parts = F.greatest(F.ceil(F.col("n") / BLOCK), F.ceil(F.col("shingles") / BLOCK_SHINGLES)).cast("int")
    sized = (rest.groupBy("band").agg(F.count("*").alias("n"), F.sum("size").alias("shingles"),
                                      F.min("class").alias("least"), F.max("class").alias("most"))
             .filter("least < most").select("band", parts.alias("parts")))
    part = F.pmod(F.xxhash64("doc"), F.col("parts")).cast("int")
    blocks = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda other: F.struct(
        F.least(other, part).alias("one"), F.greatest(other, part).alias("two"), F.when(other < part, 1).otherwise(0).alias("side")))
    dealt = rest.join(sized, "band").select("band", "doc", "class", F.explode(blocks).alias("k"))
    rows = dealt.join(sets, "doc").select("band", "k.one", "k.two", "k.side", "doc", "class", "shingles")
    return written(rows.groupBy("band", "one", "two").applyInArrow(_compared_block, "a long, b long").distinct(), "links")


def near_duplicates(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, class_id): for every row with an id, the smallest id of its class of near duplicates.

    Two texts are linked if the weighted Jaccard similarity of their five-word shingles is at least
    SIMILARITY; classes are the connected components. Texts of the same words collapse before any
    comparison, so copies cost one row. Each text of a bucket meets the first one of the bucket, first
    its overall first one, then all from which it is still apart. PEELS times, the texts left in other
    classes meet the first one of those. In the end all texts of a bucket that are in
    different classes are compared with each other, in blocks; no bucket is capped.

    A text of fewer than five words is one shingle. Null, empty and wordless texts are classes of their
    own. Rows without id are not returned. Rows that share an id are one document: all its texts are in one
    class. The order of the rows decides nothing.
    """
    spark = docs.sparkSession
    ship_package(spark)
    stored = placed(docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc"), F.col(f"`{text}`").alias("text")))
    slim = stored.filter("doc is not null").select("doc", "text")
    signed = written(slim.mapInArrow(lean(_signed), "doc long, content long, check long, bands array<long>"), "signed")
    # A node is a distinct text; its first document brings its shingles. Where every document is one text,
    # that document's id names the node; else nodes are numbered.
    several = written(signed.select("doc", "content", "check").distinct().groupBy("doc").agg(F.count("*").alias("n"))
                      .filter("n > 1").select("doc"), "several")
    plain = several.isEmpty()
    found = signed.groupBy("content", "check").agg(F.min("doc").alias("first"), F.first("bands").alias("bands"))
    nodes = written(found.withColumn("node", F.col("first") if plain else F.monotonically_increasing_id()), "nodes")
    members = written(signed.select("doc", "content", "check").distinct()
                      .join(nodes.select("content", "check", "node"), ["content", "check"]).select("doc", "node"), "members")
    banded = nodes.select(F.explode(F.array_distinct("bands")).alias("band"), F.col("node").alias("doc"))
    buckets = written(banded.join(banded.groupBy("band").agg(F.min("doc").alias("low"), F.max("doc").alias("high"))
                                  .filter("low < high"), "band").select("band", "doc", "low"), "buckets")
    stars = written(buckets.filter("doc <> low").select(F.col("doc").alias("a"), F.col("low").alias("b")).distinct(), "stars")
    wanted = written(nodes.drop("bands").join(stars.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "node", "left_semi"), "wanted")
    # The texts to compare are picked out where they are scanned; what moves is their shingles.
    places = stored.select("doc", "_place_file", "_place_row").join(wanted.select(F.col("first").alias("doc")).distinct(), "doc", "left_semi")
    picked = rows_by_place(stored, place_words(places), listed=True)
    by_content = ["content", "check", "first"]
    sets = written(picked.mapInArrow(lean(_shingle_sets), "doc long, content long, check long, shingles array<int>")
                   .withColumnRenamed("doc", "first").join(wanted, by_content)
                   .groupBy(*by_content, "node").agg(F.first("shingles").alias("shingles"))
                   .select(F.col("node").alias("doc"), "shingles"), "shingles")

    tried = written(stars.groupBy("a").agg(F.min("b").alias("b")), "tried")
    links = _verified(tried, sets)
    if not plain:    # the texts of one document are linked as they are
        own = members.join(several, "doc", "left_semi")
        links = written(links.unionByName(own.join(own.groupBy("doc").agg(F.min("node").alias("low")), "doc").filter("node <> low")
                                          .select(F.col("node").alias("a"), F.col("low").alias("b"))), "links")
    classes = connected_components(links)

    edges = written(_between(stars.join(tried, ["a", "b"], "left_anti"), classes).select("a", "b"), "edges")
    if not edges.isEmpty():
        classes = _joined(classes, _verified(edges, sets))
    # All have met the first text of each bucket; what is left may still be linked among itself.
    left = buckets
    for _ in range(PEELS):
        left = written(_left_in_buckets(left, classes), "left")
        if left.isEmpty():
            break
        pairs = left.filter("doc <> low").select(F.col("doc").alias("a"), F.col("low").alias("b")).distinct()
        edges = written(_between(pairs, classes).select("a", "b"), "edges")
        more = _verified(edges, sets)
        if more.isEmpty():
            break
        classes = _joined(classes, more)
    more = _verified_in_blocks(buckets, classes, sets)
    if not more.isEmpty():
        classes = _joined(classes, more)

    named = members.join(classes, "node", "left").select("doc", F.coalesce("component", "node").alias("class")).distinct()
    if not plain:
        named = written(named, "named")
        least = named.groupBy("class").agg(F.min("doc").alias("least"))
        named = named.join(least, "class").select("doc", F.col("least").alias("class")).distinct()
    ids = slim.select("doc").distinct()
    return ids.join(named, "doc", "left").select(
        F.col("doc").alias("doc_id"), F.coalesce("class", "doc").alias("class_id"))


def one_of_each(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs``, columns unchanged, with one row of each class: that of the smallest id.

    Of repeated rows of one id one stays; rows without id stay.
    """
    kept = near_duplicates(docs, doc_id=doc_id, text=text).filter("doc_id = class_id").select(F.col("doc_id").alias("kept id"))
    named = docs.join(kept, F.col(f"`{doc_id}`").cast("long") == F.col("`kept id`"), "left_semi").dropDuplicates([doc_id])
    return named.unionByName(docs.filter(F.col(f"`{doc_id}`").isNull()))
