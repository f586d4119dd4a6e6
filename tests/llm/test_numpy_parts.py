"""The numpy parts of the operators against plain versions."""

import numpy as np
import pyarrow as pa
import pytest

from pagemill.llm import byte_language, dart_minhash, decontaminate, embedding_tiles, pivotal_mix, suffix_dedup
from pagemill.llm.arrow import Words, slices, windows


def one_slice(texts):
    (_, _, data, offsets), = slices(pa.array(texts, pa.string()), lower=True)
    return data, offsets


def test_words_and_windows():
    words = Words(*one_slice(["The cat, the CAT", None, "", "thé cat"]))
    assert words.counts.tolist() == [4, 0, 0, 2]
    h = words.hashes
    assert h[0] == h[2] and h[1] == h[3] == h[5] and h[4] != h[0]
    hashes, text = windows(words, 3)
    assert text.tolist() == [0, 0, 3]


def test_slices_cover_all_rows_whatever_their_size():
    texts = ["x" * n for n in (0, 5, 1000, 3)] + [None]
    parts = list(slices(pa.array(texts), lower=False, limit=4))
    assert [a for a, *_ in parts][0] == 0 and parts[-1][1] == 5
    assert sum(len(d) for _, _, d, _ in parts) == 1008


def test_suffix_array_and_common_prefixes():
    draw = np.random.default_rng(0)
    for trial in range(20):
        data = draw.integers(97, 98 + trial % 4, 1 + 13 * trial).astype(np.uint8)
        text, order = data.tobytes(), suffix_dedup.suffix_array(data)
        assert [text[i:] for i in order] == sorted(text[i:] for i in range(len(text)))
        found = suffix_dedup.common_prefixes(data, order, 10)
        for k in range(1, len(order)):
            a, b = text[order[k - 1]:], text[order[k]:]
            same = next((m for m in range(min(len(a), len(b))) if a[m] != b[m]), min(len(a), len(b)))
            assert found[k] == min(same, 10)


def test_shards_merge_like_one():
    draw = np.random.default_rng(1)
    blobs = [draw.integers(97, 99, int(n)).astype(np.uint8).tobytes() for n in draw.integers(8, 30, 40)]
    doc, start = np.arange(40), np.zeros(40, np.int64)
    whole = suffix_dedup._Shard(doc, start, blobs, 8)
    expected = {(int(d), int(s)) for d, s in zip(*whole.place(np.flatnonzero(whole.repeat)))}
    sides = [suffix_dedup._Shard(doc[k::2], start[k::2], blobs[k::2], 8) for k in (0, 1)]
    found = {(int(d), int(s)) for side in sides for d, s in zip(*side.place(np.flatnonzero(side.repeat)))}
    for side, other in (sides, sides[::-1]):
        side.repeat[:] = False
        side.mark_repeats_of(other)
        found |= {(int(d), int(s)) for d, s in zip(*side.place(np.flatnonzero(side.repeat)))}
    assert found == expected


def test_dart_signatures_estimate_weighted_jaccard():
    draw = np.random.default_rng(2)
    words = [f"w{i}" for i in range(400)]
    errors = []
    for _ in range(30):
        a = draw.choice(words, 120).tolist() + ["same"] * 20
        b = a[:]
        for i in draw.choice(len(a), 8, replace=False):
            b[i] = "new"
        shingles, text = windows(Words(*one_slice([" ".join(a), " ".join(b)])), 5)
        signature = dart_minhash.signatures(shingles, text, 2)
        x, y = (dict(zip(*np.unique(shingles[text == k], return_counts=True))) for k in (0, 1))
        keys = set(x) | set(y)
        exact = sum(min(x.get(k, 0), y.get(k, 0)) for k in keys) / sum(max(x.get(k, 0), y.get(k, 0)) for k in keys)
        errors.append((signature[0] == signature[1]).mean() - exact)
    assert abs(np.mean(errors)) < 0.03 and np.std(errors) < 0.08


def test_network_gradients():
    net = byte_language.fresh(["a", "b", "c"], 1, np.float64)
    draw = np.random.default_rng(0)
    codes, label = draw.integers(1, 256, (7, 4)), draw.integers(0, 3, 4)
    codes[5:, 1] = 0
    _, slopes = byte_language.loss_and_slopes(net, codes, label)
    for weights, slope in zip(net.arrays(), slopes):
        for _ in range(4):
            at = tuple(draw.integers(0, n) for n in weights.shape)
            if weights.shape[-1] == 256:
                at = (at[0], codes[draw.integers(0, 5), 0])
            kept, sides = weights[at], []
            for step in (1e-5, -1e-5):
                weights[at] = kept + step
                sides.append(byte_language.loss_and_slopes(net, codes, label)[0])
            weights[at] = kept
            assert abs((sides[0] - sides[1]) / 2e-5 - slope[at]) < 1e-7


def test_positions_pool_to_the_text():
    net = byte_language.fresh(["a", "b"], 3)
    text = "abc déf " * 40
    data = np.frombuffer(text.encode(), np.uint8)
    pooled = byte_language.pooled(net, data, np.array([0, 0, len(data)]))
    padded = np.append(data, np.zeros(-len(data) % byte_language.SEGMENT, np.uint8)).reshape(-1, byte_language.SEGMENT).T.astype(int)
    p = byte_language.position_probabilities(net, padded)
    mean = np.array([p[:, c][padded != 0].mean() for c in (0, 1)])
    assert (pooled[0] == 0).all() and np.allclose(pooled[1], mean, atol=1e-4)


def test_rounding_keeps_words_and_expectation():
    sizes, p = np.array([9, 7, 7, 4, 2, 1]), np.full(6, 0.3)
    total, runs = np.zeros(6), 4000
    for seed in range(runs):
        out = pivotal_mix.round_block(sizes, p, np.random.default_rng(seed))
        assert abs((out * sizes).sum() - (p * sizes).sum()) < 1e-9
        assert ((out > 0) & (out < 1)).sum() <= 1
        total += out
    assert np.abs(total / runs - p).max() < 0.04


def test_quantised_pairs_are_the_exact_ones():
    draw = np.random.default_rng(4)
    x = draw.normal(size=(300, 24))
    x[100:200] = x[:100] + draw.normal(size=(100, 24)) * draw.uniform(0, 0.7, (100, 1))
    side = (*embedding_tiles.quantise(x), x)
    a, b = embedding_tiles.linked_pairs(*side, *side, 0.9, upper=True)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    i, j = np.nonzero(np.triu(unit @ unit.T >= 0.9, 1))
    assert set(zip(a.tolist(), b.tolist())) == set(zip(i.tolist(), j.tolist())) and len(a) > 20


def test_best_stretch():
    same = np.array([c == "1" for c in "0011111011110000011"])
    length, share = decontaminate._best_stretch(same)
    assert (length, round(share, 2)) == (10, 0.9)
    assert decontaminate._best_stretch(np.zeros(5, bool)) == (0, 0.0)


def test_every_replacement_pattern_has_a_seed():
    from itertools import combinations

    def hit(mask, equal, n):
        bits = sum(1 << i for i, c in enumerate(mask) if c == "1")
        return any((equal >> at) & bits == bits for at in range(n - len(mask) + 1))
    for n in range(1, 2 * decontaminate.MIN_WORDS):
        short = n < decontaminate.MIN_WORDS
        masks = ["1" * decontaminate._short_run(n)] if short else decontaminate.MASKS
        for gone in combinations(range(n), n // 5):
            equal = (1 << n) - 1 - sum(1 << i for i in gone)
            assert any(hit(m, equal, n) for m in masks), (n, gone)


def test_overlaps_with_replaced_words_are_found():
    draw = np.random.default_rng(4)
    items = [[f"w{draw.integers(1 << 40)}" for _ in range(n)] for n in [*range(1, 41), 200, 500]]
    # Two neighbours in the middle; every fourth word; at random, never the first or the last one.
    cases = [(items[21], [10, 11]), (items[14], [3, 7, 11])]
    cases += [(item, 1 + draw.permutation(len(item) - 2)[:len(item) // 5]) for item in items if len(item) > 2 for _ in range(5)]
    texts = []
    for item, gone in cases:
        changed = list(item)
        for i in gone:
            changed[i] = "other"
        texts.append(" ".join(["some", "words", *changed, "more"]))
    seeds = decontaminate._seeds(list(range(len(items))), [" ".join(i) for i in items])
    found = decontaminate._overlaps(seeds, Words(*one_slice(texts)))
    for number, (item, gone) in enumerate(cases):
        length, share = found[number][items.index(item)]
        assert length == len(item) and round(share * length) == length - len(gone)


def test_a_shard_of_many_keys_is_sorted_in_packs():
    draw = np.random.default_rng(6)
    texts = [bytes(draw.integers(97, 99, 40, dtype=np.uint8)) for _ in range(60)]
    key = np.arange(60) % 4
    table = pa.table({"doc": np.arange(60), "row": np.zeros(60, np.int64), "start": np.zeros(60, np.int64), "key": key, "side": np.zeros(60, np.int32), "bytes": texts})

    def starts(limit):
        out = suffix_dedup._shard_repeats(8, limit)(table.filter(key == 1)).to_pydict()
        return sorted((d, i) for d, s, e in zip(out["doc"], out["start"], out["end"]) for i in range(s, e))
    assert starts(100) == starts(1 << 20)
    packs = suffix_dedup._packs(key, np.full(60, 40), 100)
    assert max(map(len, packs)) == 2 and sorted(np.concatenate(packs)) == list(range(60))


@pytest.mark.parametrize("seed", range(6))
def test_no_near_pair_of_a_block_is_left_out(seed):
    rng = np.random.default_rng(seed)
    shared = rng.choice(1 << 20, 300, replace=False)
    sets = [np.unique(rng.choice(shared, rng.integers(1, 120))) for _ in range(20)]
    for base in list(sets):                                  # near ones, some of them of exactly SIMILARITY
        for lost in (1, 2, len(base) // 5, len(base) // 4):
            kept = rng.permutation(base)[lost:]
            sets.append(np.unique(np.append(kept, rng.integers(1 << 21, 1 << 22, rng.integers(0, 3)))))
    sets = [s.astype(np.int32) for s in sets if len(s)]
    owner = np.arange(len(sets))
    a, b = dart_minhash._near_in_block(owner, sets, ~np.eye(len(sets), dtype=bool))
    near = {(i, j) for i in owner for j in owner[i + 1:]
            if len(c := np.intersect1d(sets[i], sets[j])) >= 0.8 * (len(sets[i]) + len(sets[j]) - len(c)) - 1e-9}
    assert set(zip(a.tolist(), b.tolist())) == near and len(near) > 20
