import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pagemill.operators import language as L

EN = "the weather in the north was cold and the people of the town stayed at home through the evening"
DE = "das wetter im norden war kalt und die leute der stadt blieben den ganzen abend lang zu hause"


@pytest.fixture(scope="module")
def profile(spark):
    rows = [("en", EN), ("en", EN + " with their friends"), ("de", DE), ("de", DE + " mit ihren freunden")]
    return L.learn_profile(spark.createDataFrame(rows, ["lang", "text"]))


def test_both_ways_agree(spark, profile):
    rows = [(0, "the people of the north stayed in the town for the cold evening and the weather"),
            (1, "die leute im norden blieben den abend zu hause und das wetter der stadt war kalt"),
            (2, "hi"), (3, "7" * 60), (4, "中文" * 30), (5, None), (6, "\U0001F600 " * 40 + EN)]
    docs = spark.createDataFrame(rows, "id long, body_text string")
    expected = {0: "en", 1: "de", 2: "unknown", 3: "unknown", 4: "unknown", 5: "unknown", 6: "en"}
    assert {r.id: r.language for r in L.with_language(docs, profile).collect()} == expected
    assert {r.id: r.language for r in L.detect_by_join(docs, "id", "body_text", profile).collect()} == expected


def test_features_of_a_text(spark):
    docs = spark.createDataFrame([(1, "Ab-ab")], ["id", "t"])
    got = {r.bucket: r.n for r in L.bucket_counts(docs, "id", "t").collect()}

    def bucket(gram):
        return sum(step * ord(c) for step, c in zip(L.STEPS, gram)) % L.BUCKETS
    assert got == {bucket(" ab"): 2, bucket("ab "): 2, bucket("b a"): 1}


def test_counts_do_not_depend_on_batches(spark):
    docs = spark.range(500).select(F.lit("en").alias("lang"), F.concat(F.lit(EN), "id").alias("text"))
    one = L.language_counts(docs.coalesce(1))
    many = L.language_counts(docs.repartition(7))
    assert sorted(one.collect()) == sorted(many.collect())


def test_counts_of_more_texts_are_added(spark):
    rows = [("en", EN), ("de", DE), (None, "of no language"), ("en", "some more words"), ("fr", "le temps")]
    texts = spark.createDataFrame(rows, "lang string, text string")
    parts = [L.language_counts(texts.filter(test)) for test in ("lang = 'en'", "lang <> 'en' or lang is null")]
    whole = L.learn_profile(texts)
    assert sorted(L.model_from_counts(L.merged_counts(*parts)).collect()) == sorted(whole.collect())
    assert {r.language for r in whole.select("language").distinct().collect()} == {"en", "de", "fr"}


def test_more_trigrams_than_any_vocabulary(spark):
    """40,000 characters of a large script make over 30,000 distinct trigrams; all of them are counted."""
    draw = random.Random(4)
    han = "".join(chr(draw.randrange(0x4E00, 0x9FA5)) for _ in range(40_000))
    hangul = "".join(chr(draw.randrange(0xAC00, 0xD7A3)) for _ in range(40_000))
    model = L.learn_profile(spark.createDataFrame([("zh", han), ("ko", hangul), ("en", EN)], ["lang", "text"]))
    sizes = {r["language"]: r["n"] for r in model.groupBy("language").agg(F.count("*").alias("n")).collect()}
    assert 20_000 < sizes["zh"] <= L.BUCKETS and 20_000 < sizes["ko"] <= L.BUCKETS
    counted = L.language_counts(spark.createDataFrame([("zh", han)], ["lang", "text"])).agg(F.sum("n")).first()[0]
    assert counted == 40_000
    docs = spark.createDataFrame([(0, han[100:300]), (1, hangul[700:900]), (2, EN)], "id long, body_text string")
    expected = {0: "zh", 1: "ko", 2: "en"}
    assert {r.id: r.language for r in L.with_language(docs, model).collect()} == expected
    assert {r.id: r.language for r in L.detect_by_join(docs, "id", "body_text", model).collect()} == expected


def test_model_joined_without_broadcast(spark, profile, monkeypatch):
    docs = spark.createDataFrame([(0, EN), (1, DE)], "id long, body_text string")
    monkeypatch.setattr(L, "BROADCAST_ROWS", 1)
    assert {r.id: r.language for r in L.detect_by_join(docs, "id", "body_text", profile).collect()} == {0: "en", 1: "de"}


def test_detection_keeps_texts_out_of_shuffles(spark, profile):
    docs = spark.range(3).select(F.col("id"), F.lit(EN).alias("body_text"))
    plan = L.with_language(docs, profile)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_texts_are_counted_in_slices(spark, monkeypatch):
    """Whatever fills a batch, only so many characters are taken apart at once; cuts lose and repeat nothing."""
    lines = ["abc" * 50, None, "x", "", "de" * 20, "f" * 97]
    found = list(L._slices(pa.array(lines)))
    assert all(sum(map(len, texts)) <= L.SLICE_CHARS for _, texts in found)
    monkeypatch.setattr(L, "SLICE_CHARS", 40)
    found = list(L._slices(pa.array(lines)))
    assert len(found) > 5 and all(sum(map(len, texts)) <= 40 for _, texts in found)
    grams = sorted((at, piece[i:i + 3]) for places, texts in found for at, piece in zip(places, texts) for i in range(len(piece) - 2))
    assert grams == sorted((at, line[i:i + 3]) for at, line in enumerate(lines) if line for i in range(len(line) - 2))


def test_counts_of_a_text_longer_than_a_slice(spark):
    docs = spark.createDataFrame([(1, "ab " * L.SLICE_CHARS)], ["id", "t"])
    got = {r.n for r in L.bucket_counts(docs, "id", "t").groupBy("bucket").agg(F.sum("n").alias("n")).collect()}
    rows = L.bucket_counts(docs, "id", "t").count()
    assert got == {L.SLICE_CHARS, L.SLICE_CHARS - 1} or got == {L.SLICE_CHARS}
    assert rows > 3


def test_every_trigram_has_its_own_weight(spark):
    """Two trigrams that share a bucket stay apart, and no number of trigrams is cut off."""
    def bucket(gram):
        return sum(step * ord(c) for step, c in zip(L.STEPS, gram)) % L.BUCKETS
    seen, pair = {}, None
    draw = random.Random(2)
    while pair is None:
        gram = "".join(chr(draw.randrange(0x4E00, 0x9FA5)) for _ in range(3))
        other = seen.setdefault(bucket(gram), gram)
        pair = (gram, other) if other != gram else None
    han = "".join(chr(draw.randrange(0x4E00, 0x9FA5)) for _ in range(90_000))
    model = L.learn_trigrams(spark.createDataFrame([("one", pair[0]), ("two", pair[1]), ("zh", han)], ["lang", "text"]))
    padded = " " + han + " "
    assert model.filter("language = 'zh'").count() == len({padded[i:i + 3] for i in range(90_000)}) > L.BUCKETS
    docs = spark.createDataFrame([(0, pair[0]), (1, pair[1])], "id long, body_text string")
    assert {(r.id, r.language) for r in L.language_scores(docs, "id", "body_text", model).collect()} == {(0, "one"), (1, "two")}
