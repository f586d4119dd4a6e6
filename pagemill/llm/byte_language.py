"""Language of texts by a bidirectional gated recurrent network over bytes.

One network reads a text forwards, one backwards; at every byte both states together give a
distribution over the languages. The probabilities of all positions are pooled into those of the text.
Training is backpropagation through time in numpy.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagemill.llm.arrow import lean, slices
from pagemill.llm.tables import without, written
from pagemill.session import ship_package

STATE = 6                 # units of each direction
SEGMENT = 128             # bytes read from a fresh state; a text is as many segments as it needs
TEXTS_PER_LANGUAGE = 400  # texts that the network is trained on, about, chosen by hash
MOST_BROADCAST = 100_000  # languages whose counts travel to every task
STEPS, BATCH, RATE = 300, 256, 0.03
UNKNOWN = "und"
_RESET = -30.0            # both gates shut: the state after a padding byte is zero
_SEGMENTS_AT_ONCE = 4096


@dataclass
class Network:
    """Weights by direction: ``table`` (3H, 256) of the bytes, ``inner`` (3H, H) of the state, ``out`` (languages, 2H)."""
    languages: list[str]
    table: list[np.ndarray]
    inner: list[np.ndarray]
    out: np.ndarray
    bias: np.ndarray

    def arrays(self) -> list[np.ndarray]:
        return [*self.table, *self.inner, self.out, self.bias]


def fresh(languages: Sequence[str], seed: int = 5, dtype=np.float32) -> Network:
    draw = np.random.default_rng(seed)
    h = STATE
    table = [draw.normal(0, 0.5, (3 * h, 256)).astype(dtype) for _ in range(2)]
    for t in table:
        t[:2 * h, 0], t[2 * h:, 0] = _RESET, 0.0
    inner = [draw.normal(0, 1 / np.sqrt(h), (3 * h, h)).astype(dtype) for _ in range(2)]
    return Network(list(languages), table, inner, draw.normal(0, 0.5, (len(languages), 2 * h)).astype(dtype),
                   np.zeros((len(languages), 1), dtype))


def _run(table: np.ndarray, inner: np.ndarray, codes: np.ndarray, keep: bool):
    """States (steps, H, rows) over codes (steps, rows); with ``keep`` also what the way back needs.

    Gates are piecewise linear: r, z = clip((x + U s) / 4 + 1 / 2, 0, 1), n = tanh(x + r * (U s)),
    s' = n + z * (s - n).
    """
    h = inner.shape[1]
    steps, rows = codes.shape
    states = np.zeros((steps + 1, h, rows), table.dtype)
    scaled = np.vstack([0.25 * inner[:2 * h], inner[2 * h:]])
    table = np.vstack([0.25 * table[:2 * h] + table.dtype.type(0.5), table[2 * h:]])
    x, g = np.empty((3 * h, rows), table.dtype), np.empty((3 * h, rows), table.dtype)
    gates = np.empty((steps, 2 * h, rows), table.dtype) if keep else None
    fresh_state = np.empty((steps, h, rows), table.dtype) if keep else None
    recalled = np.empty((steps, h, rows), table.dtype) if keep else None
    for t in range(steps):
        s, new = states[t], states[t + 1]
        np.matmul(scaled, s, out=g)
        np.take(table, codes[t], axis=1, out=x, mode="clip")
        rz = g[:2 * h]
        rz += x[:2 * h]
        np.clip(rz, 0, 1, out=rz)
        n = g[2 * h:]
        if keep:
            gates[t], recalled[t] = rz, n
        n *= rz[:h]
        n += x[2 * h:]
        np.tanh(n, out=n)
        if keep:
            fresh_state[t] = n
        np.subtract(s, n, out=new)
        new *= rz[h:]
        new += n
    return states, (gates, fresh_state, recalled)


def _back(table, inner, codes, states, kept, slope):
    """Gradients of the weights from the slopes (steps, H, rows) of the states."""
    gates, fresh_state, recalled = kept
    h = inner.shape[1]
    d_table, d_inner = np.zeros_like(table), np.zeros_like(inner)
    carried = np.zeros_like(states[0])
    d_input = np.empty((len(codes), 3 * h, codes.shape[1]), table.dtype)
    for t in range(len(codes) - 1, -1, -1):
        d = slope[t] + carried
        r, z, n, s = gates[t][:h], gates[t][h:], fresh_state[t], states[t]
        d_n = d * (1 - z) * (1 - n * n)
        d_z = d * (s - n) * (0.25 * ((z > 0) & (z < 1)))
        d_r = d_n * recalled[t] * (0.25 * ((r > 0) & (r < 1)))
        d_pre = np.vstack([d_r, d_z, d_n])              # of x
        d_own = np.vstack([d_r, d_z, d_n * r])          # of U s
        d_inner += d_own @ s.T
        carried = d * z + inner.T @ d_own
        d_input[t] = d_pre
    flat = codes.ravel()
    for k in range(3 * h):
        d_table[k] = np.bincount(flat, weights=d_input[:, k].ravel(), minlength=256)
    return d_table, d_inner


def loss_and_slopes(net: Network, codes: np.ndarray, label: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean cross entropy over all positions that are not padding, and its gradient; codes (steps, rows)."""
    forward, kept_f = _run(net.table[0], net.inner[0], codes, True)
    backward, kept_b = _run(net.table[1], net.inner[1], codes[::-1], True)
    both = np.concatenate([forward[1:], backward[1:][::-1]], axis=1)
    logits = net.out @ both + net.bias
    logits -= logits.max(axis=1, keepdims=True)
    p = np.exp(logits)
    p /= p.sum(axis=1, keepdims=True)
    real = (codes != 0).astype(p.dtype)
    n = max(real.sum(), 1)
    of_label = np.take_along_axis(p, np.broadcast_to(label, codes.shape)[:, None, :], axis=1)[:, 0]
    loss = float(-(np.log(np.maximum(of_label, 1e-12)) * real).sum() / n)
    d = p.copy()
    np.put_along_axis(d, np.broadcast_to(label, codes.shape)[:, None, :], (of_label - 1)[:, None, :], axis=1)
    d *= real[:, None, :] / n
    d_out = np.einsum("tcb,thb->ch", d, both, optimize=True)
    d_both = net.out.T @ d
    h = STATE
    tf, uf = _back(net.table[0], net.inner[0], codes, forward, kept_f, d_both[:, :h])
    tb, ub = _back(net.table[1], net.inner[1], codes[::-1], backward, kept_b, d_both[::-1, h:])
    for t in (tf, tb):
        t[:, 0] = 0                                      # padding is not learned
    return loss, [tf, tb, uf, ub, d_out, d.sum(axis=(0, 2))[:, None]]


def train_network(texts: Sequence[str], languages: Sequence[str], steps: int = STEPS, seed: int = 5) -> Network:
    """A network for the languages given; every step sees equally many windows of each."""
    names = sorted(set(languages))
    net = fresh(names, seed)
    if len(names) < 2:
        return net
    draw = np.random.default_rng(seed)
    coded = [np.frombuffer(t.encode("utf-8"), np.uint8) for t in texts]
    of = [[i for i, l in enumerate(languages) if l == name and len(coded[i])] for name in names]
    first = [np.zeros_like(a) for a in net.arrays()]
    second = [np.zeros_like(a) for a in net.arrays()]
    for step in range(1, steps + 1):
        label = draw.integers(0, len(names), BATCH)
        codes = np.zeros((BATCH, SEGMENT), np.int64)
        for row, name in enumerate(label):
            if not of[name]:
                continue
            text = coded[of[name][draw.integers(len(of[name]))]]
            start = draw.integers(0, max(1, len(text) - SEGMENT // 2))
            window = text[start:start + SEGMENT]
            codes[row, :len(window)] = window
        _, slopes = loss_and_slopes(net, np.ascontiguousarray(codes.T), label)
        norm = np.sqrt(sum(float((g * g).sum()) for g in slopes))
        rate = RATE * 0.5 * (1 + np.cos(np.pi * step / steps))
        for a, g, m, v in zip(net.arrays(), slopes, first, second):
            g = g / max(norm, 1.0)
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            a -= (rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)).astype(a.dtype)
    return net


def _weights(net: Network, codes: np.ndarray) -> np.ndarray:
    """(steps, languages, rows): unscaled probabilities at every position of codes (steps, rows)."""
    forward, _ = _run(net.table[0], net.inner[0], codes, False)
    backward, _ = _run(net.table[1], net.inner[1], codes[::-1], False)
    p = np.matmul(net.out[:, :STATE], forward[1:])
    p += np.matmul(net.out[:, STATE:], backward[1:])[::-1]
    p += net.bias
    return np.exp(p, out=p)


def position_probabilities(net: Network, codes: np.ndarray) -> np.ndarray:
    """(steps, languages, rows): the distribution at every position of codes (steps, rows)."""
    p = _weights(net, codes)
    return p / p.sum(axis=1, keepdims=True)


def pooled(net: Network, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(texts, languages): mean of the probabilities at all bytes of each text; zero for an empty text."""
    length = np.diff(offsets)
    segments = -(-length // SEGMENT)
    first = np.append(0, np.cumsum(segments))
    grid = np.zeros(first[-1] * SEGMENT, np.uint8)
    for i in np.flatnonzero(length):
        grid[first[i] * SEGMENT:first[i] * SEGMENT + length[i]] = data[offsets[i]:offsets[i + 1]]
    grid = grid.reshape(-1, SEGMENT)
    text = np.repeat(np.arange(len(length)), segments)
    sums = np.zeros((len(length), len(net.languages)))
    for part in np.array_split(np.arange(len(text)), max(1, -(-len(text) // _SEGMENTS_AT_ONCE))):
        codes = grid[part].T.astype(np.intp, order="C")
        p = _weights(net, codes)
        share = (codes != 0) / p.sum(axis=1)
        np.add.at(sums, text[part], np.einsum("tcb,tb->bc", p, share.astype(p.dtype), optimize=False))
    total = sums.sum(axis=1, keepdims=True)
    return np.divide(sums, total, out=np.zeros_like(sums), where=total > 0)


def training_sample(docs: DataFrame, *, text: str, language: str) -> list:
    """About TEXTS_PER_LANGUAGE rows (text, language) of each language, the same ones at every run.

    Copies of a text come once; twice that number a language is never passed.
    """
    rows = docs.select(F.col(f"`{text}`").alias("text"), F.col(f"`{language}`").alias("language")).filter(
        "text is not null and text <> '' and language is not null")
    counts = written(rows.groupBy("language").agg(F.count("*").alias("n")), "languages")
    languages = counts.count()
    place = F.pmod(F.xxhash64("text", F.lit(11)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    chosen = rows.join(F.broadcast(counts) if languages <= MOST_BROADCAST else counts, "language").filter(
        place * F.col("n") < TEXTS_PER_LANGUAGE).select("text", "language").distinct()
    return chosen.orderBy("language", "text").limit(2 * TEXTS_PER_LANGUAGE * max(languages, 1)).collect()


def fit(docs: DataFrame, *, text: str = "text", language: str = "lang") -> Network:
    """A network trained on a bounded sample of the labelled rows of ``docs``."""
    held = training_sample(docs, text=text, language=language)
    return train_network([r["text"] for r in held], [r["language"] for r in held])


def with_language(docs: DataFrame, net: Network, *, text: str = "text", into: str = "lang_pred", score: str = "score") -> DataFrame:
    """The rows with their language and its pooled probability, in place and in one pass.

    Every byte of every text is read and labelled. A null text, and one without any letter, is UNKNOWN
    with score 0, and so are all if the network knows no language. Repeated rows get equal values;
    columns named like the results are replaced.
    """
    ship_package(docs.sparkSession)
    docs = without(docs, into, score)
    where = docs.columns.index(text)
    sent = docs.sparkSession.sparkContext.broadcast(net)
    schema = T.StructType([*docs.schema.fields, T.StructField(into, T.StringType()), T.StructField(score, T.DoubleType())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        names = np.array([*model.languages, UNKNOWN], object)
        for batch in batches:
            best, value = np.full(batch.num_rows, len(model.languages)), np.zeros(batch.num_rows)
            if model.languages:
                for first, upto, data, offsets in slices(batch.column(where), lower=False, limit=_SEGMENTS_AT_ONCE * SEGMENT * 4):
                    p = pooled(model, data, offsets)
                    best[first:upto] = np.where(p.sum(axis=1) > 0, p.argmax(axis=1), len(model.languages))
                    value[first:upto] = p.max(axis=1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(names[best], pa.string()), pa.array(np.minimum(value, 1.0))],
                names=[*batch.schema.names, into, score])

    lettered = F.coalesce(F.col(f"`{text}`").rlike(r"\p{L}"), F.lit(False))
    return docs.mapInArrow(lean(scan), schema).withColumns({
        into: F.when(lettered, F.col(f"`{into}`")).otherwise(F.lit(UNKNOWN)),
        score: F.when(lettered & (F.col(f"`{into}`") != UNKNOWN), F.col(f"`{score}`")).otherwise(F.lit(0.0))})
