import random

from pyspark.sql import functions as F

from pagemill.functions import text as tx

SPACES = [chr(i) for i in range(0x110000) if not 0xD800 <= i < 0xE000 and chr(i).isspace()]


def test_every_unicode_space_collapses(column):
    assert len(SPACES) == 29
    rows = [(f"{c}a{c}b {c}c{c}{c}d​e{c}",) for c in SPACES]
    got = column(rows, ["t"], tx.clean_text(F.col("t")))
    assert got == [" ".join(t.split()) for (t,) in rows]


def test_cleaning_is_stable_and_trims(column):
    rows = [("",), ("   ",), ("one",), (" a  b\n\nc ",), ("a b",)]
    assert column(rows, ["t"], tx.clean_text(F.col("t"))) == ["", "", "one", "a b c", "a b"]
    twice = column(rows, ["t"], tx.clean_text(tx.clean_text(F.col("t"))))
    assert twice == ["", "", "one", "a b c", "a b"]


def test_counts(column):
    rows = [("",), ("one",), ("one two three",), ("\U0001F600 é",)]
    assert column(rows, ["t"], tx.word_count(F.col("t"))) == [0, 1, 3, 2]
    assert column(rows, ["t"], tx.char_count(F.col("t"))) == [0, 3, 13, 3]
    assert column(rows, ["t"], tx.paragraph_count(F.col("t"))) == [0, 1, 1, 1]
    assert column([("a\n\nb\n\n \n\nc",), ("",), ("x",)], ["t"], tx.raw_paragraph_count(F.col("t"))) == [3, 0, 1]
    assert column([("a  b\tc",), ("",)], ["t"], tx.words(F.col("t"))) == [["a", "b", "c"], []]


def test_rounding_agrees_with_python(column):
    rng = random.Random(7)
    pairs = [(k, 200) for k in range(6000)] + [(k, 16) for k in range(300)] + [(k, 2000) for k in range(3000)]
    pairs += [(rng.randrange(50000), rng.randrange(1, 50000)) for _ in range(20000)]
    for digits in (2, 3):
        got = column(pairs, ["a", "b"], tx.py_round_ratio(F.col("a"), F.col("b"), digits))
        assert got == [round(a / b, digits) for a, b in pairs]


def test_percent_rounds_half_to_even(column):
    pairs = [(1, 8), (3, 8), (1, 200), (3, 200), (5, 200), (1, 3), (0, 5), (5, 5)]
    got = column(pairs, ["a", "b"], tx.percent(F.col("a"), F.col("b")))
    assert [int(v) for v in got] == [int(f"{a / b * 100:.0f}") for a, b in pairs]
