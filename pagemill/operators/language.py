"""Language identification from character trigrams in a model of fixed size.

Trigrams are mapped by arithmetic to BUCKETS features. A model is a table (language, bucket, weight) with
BUCKETS rows a language at most, learned by a Spark job from counts of all trigrams of labelled text:
nothing is ranked, cut off or refused, and counts of more text can be added to those of earlier text. A text
belongs to the language whose weights for the text's trigrams add up highest. Weights are whole
numbers, so sums do not depend on row order. Where exact trigrams are asked for, a model has a row for each of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagemill.session import new_table_path, ship_package

UNKNOWN = "unknown"
MIN_CHARS = 50
SMOOTHING = 5e-5
WEIGHT_SCALE = 1_000_000
# Features of a trigram (a, b, c): (STEPS[0] * a + STEPS[1] * b + STEPS[2] * c) modulo a prime.
BUCKETS = 65_521
STEPS = (40_503, 30_011, 10_007)
# Characters of text that are taken apart at once: some 20 MB of arrays.
SLICE_CHARS = 500_000
BUCKET, TRIGRAM = "bucket", "trigram"
COUNTS = "language string, bucket int, n long"
MODEL = "language string, bucket int, weight long"
TRIGRAM_COUNTS = "language string, trigram long, n long"
TRIGRAM_MODEL = "language string, trigram long, weight long"
_POINT_BITS = 21
# Rows of a model that a join may broadcast: about fifteen languages, 50 MB.
BROADCAST_ROWS = 1_000_000

_SEPARATOR = r"[\x{10000}-\x{10FFFF}[^\p{L}\p{M}]]"


def letters(text: Column) -> Column:
    """Lower-cased letters of the basic plane; anything between them is one space."""
    run = rf"(?: {_SEPARATOR}|[{_SEPARATOR}&&[^ ]]){_SEPARATOR}*"
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(text), run, " ")), F.lit(" "))


def _buckets(text: str) -> np.ndarray:
    """The feature of every overlapping run of three code points."""
    points = np.frombuffer(text.encode("utf-32-le"), dtype="<u4").astype(np.int64)
    a, b, c = STEPS
    return (points[:-2] * a + points[1:-1] * b + points[2:] * c) % BUCKETS


def _trigrams(text: str) -> np.ndarray:
    """Every overlapping run of three code points, packed into one whole number each."""
    points = np.frombuffer(text.encode("utf-32-le"), dtype="<u4").astype(np.int64)
    return (points[:-2] << 2 * _POINT_BITS) | (points[1:-1] << _POINT_BITS) | points[2:]


def bucket_counts(texts: DataFrame, key: str, text: str) -> DataFrame:
    """(key, bucket, n), as :func:`_counts` gives them."""
    return _counts(texts, key, text, BUCKET)


def trigram_counts(texts: DataFrame, key: str, text: str) -> DataFrame:
    """(key, trigram, n), as :func:`_counts` gives them; different trigrams are different numbers."""
    return _counts(texts, key, text, TRIGRAM)


def _counts(texts: DataFrame, key: str, text: str, feature: str) -> DataFrame:
    """(key, feature, n), one row per key and feature of each slice of an Arrow batch.

    Counting inside the slice sends distinct features on, not one row per character; whoever needs
    totals per key still sums ``n``. A slice has SLICE_CHARS characters at most, so what a task holds does not
    depend on how long the texts are or how many fill a batch.
    """
    ship_package(texts.sparkSession)
    kind = texts.schema[key].dataType
    features, stored = (_trigrams, T.LongType()) if feature == TRIGRAM else (_buckets, T.IntegerType())
    width = pa.int64() if feature == TRIGRAM else pa.int32()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for places, lines in _slices(batch.column(1)):
                by_key: dict = {}
                for owner, at, line in zip(batch.column(0).take(pa.array(places)).to_pylist(), places, lines):
                    by_key.setdefault(owner, (at, []))[1].append(features(line))
                owners, names, sizes = [], [], []
                for at, parts in by_key.values():
                    found, n = np.unique(np.concatenate(parts), return_counts=True)
                    owners.append(np.full(len(found), at))
                    names.append(found)
                    sizes.append(n)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(np.concatenate(owners))),
                     pa.array(np.concatenate(names), width), pa.array(np.concatenate(sizes), pa.int64())],
                    names=[key, feature, "n"])

    schema = T.StructType([T.StructField(key, kind), T.StructField(feature, stored),
                           T.StructField("n", T.LongType())])
    return texts.select(key, letters(F.col(text)).alias("letters")).mapInArrow(count, schema)


def _slices(lines: pa.Array) -> Iterator[tuple[list[int], list[str]]]:
    """(places, texts) of SLICE_CHARS characters at most; a longer text goes into several, no trigram lost or repeated."""
    places, texts, room = [], [], SLICE_CHARS
    for at, value in enumerate(lines):
        line = value.as_py()
        for start in range(0, len(line or "") - 2, SLICE_CHARS - 2):
            piece = line[start:start + SLICE_CHARS]
            if len(piece) > room:
                yield places, texts
                places, texts, room = [], [], SLICE_CHARS
            places.append(at)
            texts.append(piece)
            room -= len(piece)
    if places:
        yield places, texts


def language_counts(labelled: DataFrame, text: str = "text", language: str = "lang", feature: str = BUCKET) -> DataFrame:
    """(language, bucket, n) over all labelled texts: BUCKETS rows a language at most, whatever the corpus.

    With ``feature`` TRIGRAM, (language, trigram, n): a row for every distinct trigram of a language.
    Texts without language teach nothing. Counts of two corpora are merged by :func:`merged_counts`.
    """
    known = labelled.filter(F.col(language).isNotNull())
    return (_counts(known, language, text, feature)
            .groupBy(F.col(language).alias("language"), feature).agg(F.sum("n").alias("n")))


def merged_counts(*counts: DataFrame) -> DataFrame:
    """The counts of all the corpora together, so that new texts need no second reading of the old ones."""
    whole = counts[0]
    for more in counts[1:]:
        whole = whole.unionByName(more)
    return whole.groupBy("language", _feature(whole)).agg(F.sum("n").alias("n"))


def _feature(table: DataFrame) -> str:
    """What the counts or weights of a table belong to."""
    return TRIGRAM if TRIGRAM in table.columns else BUCKET


def model_from_counts(counts: DataFrame) -> DataFrame:
    """The written model of :func:`language_counts`.

    It is used many times over, so it is stored; in buckets its size is fixed by the number of languages. The totals
    are one row a language, and so are far smaller than what they are joined to.
    """
    spark, path, feature = counts.sparkSession, new_table_path(counts.sparkSession, "language-counts"), _feature(counts)
    counts.write.parquet(path)
    stored = spark.read.schema(TRIGRAM_COUNTS if feature == TRIGRAM else COUNTS).parquet(path)
    totals = stored.groupBy("language").agg(F.sum("n").alias("total"))
    share = F.col("n").cast("double") / F.col("total").cast("double")
    weight = F.round(F.log(F.lit(1.0) + share / F.lit(SMOOTHING)) * F.lit(float(WEIGHT_SCALE)))
    path = new_table_path(spark, "language-model")
    (stored.join(totals, "language").select("language", feature, weight.cast("long").alias("weight"))
     .write.parquet(path))
    return spark.read.schema(TRIGRAM_MODEL if feature == TRIGRAM else MODEL).parquet(path)


def learn_profile(labelled: DataFrame, text: str = "text", language: str = "lang") -> DataFrame:
    """The model of every language in ``labelled``, from all trigrams of all its texts."""
    return model_from_counts(language_counts(labelled, text, language))


def learn_trigrams(labelled: DataFrame, text: str = "text", language: str = "lang") -> DataFrame:
    """The weight of every distinct trigram of every language, none merged with another and none left out."""
    return model_from_counts(language_counts(labelled, text, language, TRIGRAM))


def _joinable(model: DataFrame) -> DataFrame:
    """A model of few languages goes to every task; a larger one is joined like any table."""
    return F.broadcast(model) if model.count() <= BROADCAST_ROWS else model


def language_scores(docs: DataFrame, key: str, text: str, profile: DataFrame) -> DataFrame:
    """(key, language, score) by joining each text's features with the model, be it of buckets or of trigrams.

    The model is broadcast as long as it is small, so a feature that all texts share makes no hot key.
    """
    feature = _feature(profile)
    return (_counts(docs, key, text, feature).join(_joinable(profile), feature)
            .groupBy(key, "language").agg(F.sum(F.col("n") * F.col("weight")).alias("score")))


def detect_by_join(docs: DataFrame, key: str, text: str, profile: DataFrame) -> DataFrame:
    """(key, language) for every row, when only the key is needed further on."""
    long_enough = docs.filter(F.length(text) >= MIN_CHARS)
    best = (language_scores(long_enough, key, text, profile)
            .groupBy(key)
            .agg(F.min(F.struct((-F.col("score")).alias("s"), F.col("language").alias("l"))).alias("best")))
    return (docs.select(key).join(best, key, "left")
            .select(key, F.coalesce("best.l", F.lit(UNKNOWN)).alias("language")))


def _weights(profile: DataFrame) -> tuple[list[str], np.ndarray]:
    """The model as languages and a BUCKETS x languages matrix: 256 kB a language."""
    rows = profile.toPandas()
    names = sorted(rows["language"].unique())
    weights = np.zeros((BUCKETS, len(names)), np.int32)
    if names:
        weights[rows["bucket"], np.searchsorted(names, rows["language"])] = rows["weight"]
    return names, weights


def with_language(docs: DataFrame, profile: DataFrame, text: str = "body_text") -> DataFrame:
    """Add ``language`` to wide rows in place, so that their texts are never shuffled.

    The model travels to the tasks as a matrix of fixed height; the same sums as in
    :func:`language_scores` are then taken per text. Ties go to the first language by name.
    """
    spark = docs.sparkSession
    ship_package(spark)
    model = spark.sparkContext.broadcast(_weights(profile))

    @F.pandas_udf("string")
    def best_language(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        names, weights = model.value

        def best(line):
            if line is None or len(line) < 3 or not names:
                return UNKNOWN
            found, n = np.unique(_buckets(line), return_counts=True)
            scores = n @ weights[found].astype(np.int64)
            return names[int(scores.argmax())] if scores.any() else UNKNOWN

        for batch in batches:
            yield batch.map(best, na_action=None)

    scored = F.when(F.length(text) >= MIN_CHARS, letters(F.col(text)))
    return docs.withColumn("language", best_language(scored))
