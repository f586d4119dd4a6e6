"""Toxicity by a classifier chain.

The categories are predicted in a fixed order. Each is a logistic regression with few weights over the words
of a text and their beginnings; from the second on it also sees the log-odds of all earlier
categories. In training those are out-of-fold predictions, so a later model meets earlier
probabilities of the quality it will meet on new texts.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagemill.llm.arrow import lean, slices, span_hash, Words
from pagemill.llm.tables import without
from pagemill.session import ship_package

FEATURE_BITS = 18
BEGINNINGS = (4, 5, 6)    # bytes of a word's beginning that are features of their own
FEATURES = 1024           # of them, those that tell most about the label get a weight
TRAINING_ROWS = 5_000     # labelled rows that a model is fitted on, at most, chosen by hash
FOLDS = 3
PRECISION = 0.998         # of out-of-fold decisions at the chosen threshold
_SEED = 17


@dataclass
class Chain:
    """One weight vector a category; ``links[c]`` weighs the log-odds of the categories before c."""
    categories: list[str]
    weights: np.ndarray
    links: list[np.ndarray]
    bias: np.ndarray
    thresholds: np.ndarray


def features(words: Words, texts: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature) pairs, each once: hashed words and beginnings of words."""
    length = words.ends - words.starts
    keys = [(words.text << FEATURE_BITS) | (words.hashes >> np.uint64(64 - FEATURE_BITS)).astype(np.int64)]
    for n in BEGINNINGS:
        long = length > n
        starts = words.starts[long]
        h = span_hash(words.prefix, starts, starts + n) * np.uint64(2 * n + 1)
        keys.append((words.text[long] << FEATURE_BITS) | (h >> np.uint64(64 - FEATURE_BITS)).astype(np.int64))
    pairs = np.sort(np.concatenate(keys))
    pairs = pairs[np.append(True, pairs[1:] != pairs[:-1])] if len(pairs) else pairs
    return pairs >> FEATURE_BITS, pairs & ((1 << FEATURE_BITS) - 1)


def _log_odds(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _telling(row: np.ndarray, col: np.ndarray, y: np.ndarray, width: int) -> np.ndarray:
    """The FEATURES features whose presence depends most on the label, by the chi-squared statistic."""
    n, positive = len(y), y.sum()
    have = np.bincount(col, minlength=width).astype(float)
    both = np.bincount(col, weights=y[row], minlength=width)
    expected = have * positive / max(n, 1)
    spread = expected * (1 - positive / max(n, 1)) * (1 - have / max(n, 1))
    score = np.where((have >= 3) & (spread > 0), (both - expected) ** 2 / np.maximum(spread, 1e-9), 0.0)
    best = np.argsort(-score, kind="stable")[:FEATURES]
    return np.sort(best[score[best] > 0])


def _fit(row: np.ndarray, col: np.ndarray, y: np.ndarray, more: np.ndarray, width: int,
         rounds: int = 200, rate: float = 0.1, ridge: float = 1e-4) -> tuple[np.ndarray, np.ndarray, float]:
    """Logistic regression on the telling features by gradient steps with per-weight rates (Adam)."""
    n = len(y)
    telling = _telling(row, col, y, width)
    place = np.full(width, -1)
    place[telling] = np.arange(len(telling))
    used = place[col] >= 0
    row, col = row[used], place[col[used]]
    k, m = len(telling), more.shape[1]
    theta = np.zeros(k + m + 1)
    theta[-1] = _log_odds(np.array([(y.sum() + 0.5) / (n + 1)]))[0]
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, rounds + 1 if n else 1):
        z = np.bincount(row, weights=theta[:k][col], minlength=n) + more @ theta[k:k + m] + theta[-1]
        r = (_sigmoid(z) - y) / n
        slope = np.concatenate([np.bincount(col, weights=r[row], minlength=k), more.T @ r, [r.sum()]])
        slope[:-1] += ridge * theta[:-1]
        first = 0.9 * first + 0.1 * slope
        second = 0.99 * second + 0.01 * slope ** 2
        theta -= rate * (first / (1 - 0.9 ** t)) / (np.sqrt(second / (1 - 0.99 ** t)) + 1e-8)
    w = np.zeros(width)
    w[telling] = theta[:k]
    return w, theta[k:k + m], float(theta[-1])


def _threshold(p: np.ndarray, y: np.ndarray) -> float:
    """Smallest threshold, 0.1 at least, at which PRECISION of the decisions are right; 1 if none is."""
    order = np.argsort(-p, kind="stable")
    right = np.cumsum(y[order]) / np.arange(1, len(y) + 1)
    good = (right >= PRECISION) & (np.append(np.diff(p[order]) != 0, True)) if len(y) else np.zeros(0, bool)
    return max(0.1, float(p[order][np.flatnonzero(good)[-1]])) if good.any() else 1.0


def fit_chain(texts: Sequence[str], labels: dict[str, Sequence[int | None]]) -> Chain:
    """A chain over the categories in the order of ``labels``; null labels are left out of their category."""
    width = 1 << FEATURE_BITS
    rows, cols = [], []
    for first, upto, data, offsets in slices(pa.array(texts, pa.string()), lower=True):
        text, feature = features(Words(data, offsets), upto - first)
        rows.append((text + first).astype(np.int32))
        cols.append(feature.astype(np.int32))
    row = np.concatenate(rows or [np.zeros(0, np.int32)])
    col = np.concatenate(cols or [np.zeros(0, np.int32)])
    del rows, cols
    n, names = len(texts), list(labels)
    fold = np.random.default_rng(_SEED).permutation(n) % FOLDS
    weights, links, bias, thresholds = np.zeros((len(names), width), np.float32), [], [], []
    earlier = np.zeros((n, 0))
    for c, name in enumerate(names):
        y = np.array([np.nan if v is None else float(v > 0) for v in labels[name]])
        known = ~np.isnan(y)

        def fit(take: np.ndarray):
            place = (np.cumsum(take) - 1).astype(np.int32)
            mine = take[row]
            return _fit(place[row[mine]], col[mine], y[take], earlier[take], width)

        def scores(model) -> np.ndarray:
            w, v, b = model
            return np.bincount(row, weights=w[col], minlength=n)[:n] + earlier @ v + b

        out_of_fold = np.zeros(n)
        for k in range(FOLDS):
            out_of_fold[fold == k] = _sigmoid(scores(fit(known & (fold != k))))[fold == k]
        w, v, b = fit(known)
        weights[c] = w
        links.append(v)
        bias.append(b)
        thresholds.append(_threshold(out_of_fold[known], y[known]))
        earlier = np.column_stack([earlier, _log_odds(out_of_fold)])
    return Chain(names, weights, links, np.array(bias), np.array(thresholds))


def train(docs: DataFrame, labels: DataFrame, categories: Sequence[str] = ("quality", "toxic"), *,
          doc_id: str = "doc_id", text: str = "text") -> Chain:
    """A chain fitted on at most TRAINING_ROWS labelled rows, the same ones at every run.

    Rows without id or text, and labels without any value, are not used; several labels of one
    id count by their largest values.
    """
    marks = (labels.filter(F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).alias("id"))
             .agg(*[F.max(F.col(c).cast("int")).alias(f"y{i}") for i, c in enumerate(categories)])
             .filter(F.coalesce(*[F.col(f"y{i}") for i in range(len(categories))]).isNotNull())
             .orderBy(F.xxhash64(F.lit(_SEED), "id"), "id").limit(TRAINING_ROWS))
    rows = (docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).filter("text is not null")
            .join(F.broadcast(marks), "id")              # at most TRAINING_ROWS rows of numbers
            .orderBy(F.xxhash64(F.lit(_SEED), "id", "text"), "id").limit(TRAINING_ROWS))
    held = rows.collect()
    return fit_chain([r["text"] for r in held],
                     {c: [r[f"y{i}"] for r in held] for i, c in enumerate(categories)})


def with_probabilities(docs: DataFrame, chain: Chain, *, text: str = "text", into: str = "p_") -> DataFrame:
    """The rows with a probability ``into``<category> for each category, in place and in one pass.

    Every word of every text counts. A null, empty or wordless text has probability 0 in all
    categories; columns of the same names are replaced; repeated rows get equal values.
    """
    ship_package(docs.sparkSession)
    names = [f"{into}{c}" for c in chain.categories]
    docs = without(docs, *names)
    where = docs.columns.index(text)
    sent = docs.sparkSession.sparkContext.broadcast(chain)
    schema = T.StructType([*docs.schema.fields, *[T.StructField(n, T.DoubleType()) for n in names]])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            out = np.zeros((batch.num_rows, len(names)))
            for first, upto, data, offsets in slices(batch.column(where), lower=True):
                words = Words(data, offsets)
                row, feature = features(words, upto - first)
                n = upto - first
                odds = np.zeros((n, 0))
                for c in range(len(names)):
                    z = np.bincount(row, weights=model.weights[c][feature], minlength=n) + odds @ model.links[c] + model.bias[c]
                    p = _sigmoid(z)
                    odds = np.column_stack([odds, _log_odds(p)])
                    out[first:upto, c] = np.where(words.counts > 0, p, 0.0)
            yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, out.T.copy())],
                                             names=[*batch.schema.names, *names])

    return docs.mapInArrow(lean(scan), schema)


def is_toxic(chain: Chain, category: str = "toxic", into: str = "p_"):
    """Whether a row's probability reaches the threshold found in training."""
    return F.col(f"`{into}{category}`") >= F.lit(float(chain.thresholds[chain.categories.index(category)]))
