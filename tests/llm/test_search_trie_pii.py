"""Prefix trie, lexical search and personal data against brute force on small tables."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from pagemill.llm import lexical_search, prefix_trie, weak_pii

TURNS = "conv_id long, turn long, role string, text string, depth string, f1 int"
DOCS = "doc_id long, text string, terms string, spans int"


def trie(rows):
    held = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            key = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16]
            held[conv].append(((turn is not None, turn or 0), key, (role, text)))
    held = {c: [t[2] for t in sorted(turns, key=lambda t: t[:2])] for c, turns in held.items()}
    whole = {}
    for conv, own in held.items():
        h = zlib.crc32(str(conv).encode()) % 4
        whole[conv] = tuple(held.get(conv - int(math.fmod(conv, 20)), [])[:h] + own[h:])
    members, children, out = defaultdict(list), defaultdict(list), {}
    for conv in sorted(whole):
        for depth in range(len(whole[conv]) + 1):
            members[whole[conv][:depth]].append(conv)
    for path in members:
        if path:
            children[path[:-1]].append(path)
    for path in sorted(members, key=len, reverse=True):
        own = members[path]
        leaves = sum(out[c][5] for c in children[path]) or 1
        words = len(re.findall(r"[^\x20\x09-\x0D]+", path[-1][1])) if path else 0
        saved = sum(out[c][6] for c in children[path]) + (len(own) - 1) * words
        ends = ",".join(str(c) for c in own if len(whole[c]) == len(path))
        out[path] = (own[0], len(path), members[path[:-1]][0] if path else None, len(own), len(children[path]), leaves, saved,
                     hashlib.sha256(ends.encode()).hexdigest())
    return sorted(map(repr, out.values()))


def found_trie(spark, rows):
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], TURNS).repartition(4)
    return sorted(repr(tuple(r)) for r in prefix_trie.prefix_trie(frame).collect())


@pytest.fixture(scope="module")
def talks():
    draw, rows = random.Random(3), []
    for conv in [*range(-45, 90), None]:
        for turn in range(draw.choice([0, 1, 2, 3, 4, 6, 9])):
            text = draw.choice(["x y", "z", "", None, "hi there\tyou", "é 中"]) if draw.random() < 0.6 else "same text"
            rows.append((conv, draw.choice([turn, turn, turn, None, 1]), draw.choice(["u", "a", None]) if draw.random() < 0.1 else "u", text))
    for conv in (200, 201, 202, 203, 220, 221):
        rows += [(conv, turn, "u", f"t {turn % 3}") for turn in range(150)]
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize("tasks", ["3", "40"])
def test_trie_equals_brute_force(spark, talks, tasks):
    """Also where one conversation spreads over many tasks, and tasks hold parts of one conversation only."""
    held = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", tasks)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert found_trie(spark, talks) == trie(talks)
    finally:
        for key, value in held.items():
            spark.conf.set(key, value)


def test_trie_edges(spark, monkeypatch):
    assert found_trie(spark, []) == []
    assert found_trie(spark, [(None, 1, "u", "a")]) == []
    turnless = next(c for c in range(1, 20) if prefix_trie.shared_turns(c) == 3)
    rows = [(turnless, 0, "u", "alone"), (turnless, 0, "u", "alone"), (40, None, None, None)]
    assert found_trie(spark, rows) == trie(rows)
    long = [(60, 0, "u", "word " * 200_000), (61, 0, "u", "other")]
    assert found_trie(spark, long) == trie(long)
    # A sketch that proves almost nothing sends more to the exact grouping and changes no row.
    monkeypatch.setattr(prefix_trie, "LEAST_CELLS", 64)
    monkeypatch.setattr(prefix_trie, "MOST_CELLS", 64)
    many = [(c, t, "u", f"{c % 7} {t}") for c in range(60) for t in range(4)]
    assert found_trie(spark, many) == trie(many)


def ranking(docs, items, top=50):
    def terms(text):
        return [t.translate({c: c + 32 for c in range(65, 91)})
                for t in re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")]
    counted = [(i, Counter(terms(t))) for i, t in docs if terms(t)]
    number, length = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    held = defaultdict(set)
    for item, text in items:
        held[item].update(terms(text))
    rows = []
    for item, wanted in held.items():
        scores = []
        for doc, c in counted:
            m = 50 + 50 * sum(c.values()) * number // length
            scores.append((sum(math.floor(1000 * math.log((2 * number + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m))
                               for t in wanted if c[t]), doc))
        best = sorted((s for s in scores if s[0] > 0), key=lambda s: (-s[0], s[1] is None, s[1] or 0))[:top]
        rows += [(item, k, doc, score) for k, (score, doc) in enumerate(best, 1)]
    return sorted(map(repr, rows))


def found_ranking(spark, docs, items, **options):
    left = spark.createDataFrame([(*d, "x", 1) for d in docs], DOCS).repartition(3)
    right = spark.createDataFrame(items, "item_id long, text string")
    return sorted(repr(tuple(r)) for r in lexical_search.rank(left, right, **options).collect())


def test_search_equals_brute_force(spark, monkeypatch):
    draw = random.Random(5)
    stock = ["the", "The", "of", "Straße", "straße", "a", "ab", "abc", "b", "x9", "9", "日本", "É", "é", "kilo"]
    docs = [(i if i % 9 else None, " ".join(draw.choices(stock, k=draw.randint(1, 30))).replace("of ", draw.choice(["of,", "of_", "of\x00"])))
            for i in range(150)]
    docs += [(7, "kilo kilo"), (7, "kilo kilo"), (900, None), (901, ""), (902, "-- !!"), (903, "the " * 300_000 + "kilo")]
    items = [(1, "the straße"), (1, "kilo"), (2, "AB abc-x9"), (3, None), (4, "..."), (None, "日本 É"), (5, "absent words"), (6, "b" * 5000)]
    assert found_ranking(spark, docs, items) == ranking(docs, items)
    assert found_ranking(spark, docs, items, top=3) == ranking(docs, items, 3)
    assert found_ranking(spark, [], items) == [] and found_ranking(spark, docs, []) == []
    assert found_ranking(spark, [(1, None)], items) == []
    # Several automata, and few scores at once, give the same ranking.
    monkeypatch.setattr(lexical_search, "PART_BYTES", 16)
    monkeypatch.setattr(lexical_search, "CELLS", 8)
    assert found_ranking(spark, docs, items) == ranking(docs, items)


PATTERNS = (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_base(text):
    found = []
    for kind, pattern in enumerate(PATTERNS):
        for match in re.finditer(pattern, text):
            digits = re.sub(r"\D", "", match.group())
            total = sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(map(int, reversed(digits))))
            good = (True, all(int(p) <= 255 for p in match.group().split(".")) if kind == 1 else True,
                    12 <= len(digits) <= 19 and total % 10 == 0, 9 <= len(digits) <= 15)[kind]
            if good:
                found.append((match.start(), kind, match.end()))
    return sorted(found)


def test_base_spans_equal_patterns():
    draw = random.Random(1)
    stock = ["a", "Z", "0", "1", "25", "255", "300", ".", ".", "@", "@", " ", "-", "+", "(", ")", "%", "é", "😀", "\n", "4111111111111111", "12 34"]
    for _ in range(20_000):
        text = "".join(draw.choices(stock, k=draw.randint(1, 30)))
        assert weak_pii.base_spans(text) == plain_base(text), text


@pytest.mark.parametrize("piece", ["a", "1", "1.", "+1 ", "a@", "Mr ", "12 ", "A-", "AB12 ", "john at ", "a [at] "])
def test_long_texts_take_time_in_proportion(piece):
    text = piece * (400_000 // len(piece))
    assert all(0 <= s < e <= len(text) for s, _, e in weak_pii.base_spans(text) + weak_pii.loose_spans(text))


def test_reliabilities_are_found():
    """Votes drawn from known labelers: expectation-maximisation tells the good ones from the noise."""
    draw = np.random.default_rng(0)
    truth = draw.random(20_000) < 0.3
    right = np.array([0.95, 0.9, 0.8, 0.75, 0.7, 0.5])
    said = np.where(draw.random((20_000, 6)) < right, truth[:, None], ~truth[:, None]) * 2 - 1
    patterns, place, counts = np.unique(said, axis=0, return_inverse=True, return_counts=True)
    posterior, table = weak_pii.reliabilities(np.zeros(len(patterns), int), patterns, counts.astype(float))
    assert ((posterior[place.ravel()] > 0.5) == truth).mean() > 0.95
    assert abs(table[1, 0, 2] - 0.95) < 0.03 and abs(table[1, 5, 2] - 0.5) < 0.03


def personal(count, seed):
    """Texts with planted data and with look-alikes; the planted substring or None."""
    draw = random.Random(seed)
    rows = []
    for i in range(count):
        digits = "".join(draw.choices("23456789", k=7))
        names = draw.choice(sorted(weak_pii.FIRST_NAMES)).capitalize(), draw.choice(["Miller", "Weber", "Garcia", "Laurent"])
        body = f"{draw.randint(100, 999)}{i:06d}"
        tail = f"{draw.randint(0, 10**9):018d}"
        check = 98 - int(f"{tail}131400") % 97
        good = [f"please call {digits[:3]}-{digits[3:6]}-{digits[3:7]}", f"write to {names[0].lower()} [at] mail{i} [dot] com",
                f"her name {names[0]} {names[1]}", f"bank account DE{check:02d}{tail}", f"born {i % 28 + 1}.0{i % 9 + 1}.19{60 + i % 39}",
                f"social security {body[:3]}-{i % 89 + 10}-{int(body[3:]) % 8999 + 1000}", f"mail someone{i}@host{i % 9}.org", f"server 10.{i % 250}.3.4"]
        bad = [f"version {digits[:3]}-{digits[3:6]}-{digits[3:7]}x", f"table {i % 28 + 40}.{i % 9 + 13}.{i % 9 + 4100}", f"x{i}/{body[:3]}-00-{i % 8999 + 1000}=",
               f"model AB12 {digits[:4]} {digits[3:7]}_", "plain words only", f"order {digits[:3]} {digits[3:6]} {digits[3:7]}/"]
        pick = draw.choice([True, False])
        phrase = draw.choice(good if pick else bad)
        rows.append((i, f"Some words here, {phrase} and then more words.", pick))
    return rows


def test_personal_data(spark):
    rows = personal(1500, 1)
    frame = spark.createDataFrame([(i, t, "x", 1) for i, t, _ in rows], DOCS).repartition(3)
    model = weak_pii.train(weak_pii.candidates(frame, "doc_id", "text"))
    assert model.candidates > 500
    fresh = personal(600, 2) + [(None, "no id, a@b.co", True), (9000, None, False), (9001, "", False), (9001, "x@y.zz twice", True), (9001, "x@y.zz twice", True)]
    other = spark.createDataFrame([(i, t, "x", 1) for i, t, _ in fresh], DOCS).repartition(3)
    found = weak_pii.scan(other, model=model).collect()
    assert len(found) == len(fresh)
    by_text = Counter((r.doc_id, r.base) for r in found)
    assert by_text == Counter((i, weak_pii.listed(plain_base(t or ""))) for i, t, _ in fresh)
    planted = {i: good for i, t, good in fresh}
    hits = {r.doc_id: bool(r.spans) for r in found}
    assert np.mean([hits[i] for i in planted if planted[i]]) > 0.9
    assert np.mean([hits[i] for i in planted if not planted[i]]) < 0.1
    for r in found:
        assert set(filter(None, r.base.split(","))) <= set(r.spans.split(","))
        assert sum(r.counts) == len(list(filter(None, r.base.split(","))))


def test_personal_data_of_nothing(spark):
    nothing = spark.createDataFrame([], DOCS)
    assert weak_pii.scan(nothing).count() == 0
    clean = spark.createDataFrame([(1, "no data at all", "x", 1)], DOCS)
    assert [tuple(r) for r in weak_pii.scan(clean).collect()] == [(1, "", [0, 0, 0, 0], "")]
