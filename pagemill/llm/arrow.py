"""Whole texts of an Arrow batch as flat numpy arrays: bytes, words, rolling hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes of text handled at once; a longer text is a slice of its own.
SLICE_BYTES = 1 << 19
# Multipliers of the 64-bit hashes (odd, arbitrary).
STEP = 0x9E3779B97F4A7C15
STEP_INVERSE = pow(STEP, -1, 1 << 64)
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
# Arbitrary 64-bit value of each byte.
BYTE_VALUE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
# Words are runs of ASCII letters and digits and of all bytes beyond ASCII.
IS_WORD = np.array([chr(b).isalnum() or b >= 128 for b in range(256)])

_POWERS: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= _MIX1
    x ^= x >> np.uint64(27)
    x *= _MIX2
    x ^= x >> np.uint64(31)
    return x


def uniform(x: np.ndarray) -> np.ndarray:
    """Hashes as numbers in (0, 1)."""
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) * (1.0 / (1 << 53))


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """STEP**i (or its inverse) for i < n, modulo 2**64."""
    key = "inverse" if inverse else "step"
    held = _POWERS.get(key)
    if held is None or len(held) < n:
        held = np.full(max(n, SLICE_BYTES + 1), STEP_INVERSE if inverse else STEP, np.uint64)
        held[0] = 1
        np.multiply.accumulate(held, out=held)
        if n <= 2 * SLICE_BYTES:
            _POWERS[key] = held
    return held[:n]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """P with P[i] = sum of value(data[j]) * STEP**j over j < i."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_VALUE[data] * powers(len(data)), out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of data[start:end] for each pair, equal for equal bytes wherever they stand."""
    return mix((prefix[end] - prefix[start]) * powers(len(prefix), True)[start] + (end - start).astype(np.uint64))


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array; null counts as empty."""
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8)[ends[0]:ends[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, ends - ends[0]


def slices(texts: pa.Array, lower: bool, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets): whole texts, about ``limit`` bytes at once."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    row, begun = 0, 0
    while row < len(texts):
        upto = max(row + 1, int(np.searchsorted(ends, begun + limit, side="right")))
        part = texts.slice(row, upto - row)
        yield row, upto, *flat(pc.utf8_lower(part) if lower else part)
        row, begun = upto, int(ends[upto - 1])


class Words:
    """The words of a slice: byte positions, hashes, and the range of words of each text."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        inside = IS_WORD[data]
        before = np.zeros(len(data) + 1, bool)
        before[1:] = inside
        before[offsets] = False
        after = np.zeros(len(data) + 1, bool)
        after[:-1] = inside
        after[offsets] = False
        self.starts = np.flatnonzero(inside & ~before[:-1])
        self.ends = np.flatnonzero(inside & ~after[1:]) + 1
        self.prefix = prefix_hash(data)
        self.hashes = span_hash(self.prefix, self.starts, self.ends)
        self.bounds = np.searchsorted(self.starts, offsets)
        self.counts = np.diff(self.bounds)
        self.text = np.repeat(np.arange(len(self.counts)), self.counts)


def windows(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text) of every run of ``size`` words; a shorter text is one run of all its words."""
    n = len(words.hashes)
    weighted = np.zeros(n + 1, np.uint64)
    np.cumsum(words.hashes * powers(n), out=weighted[1:])
    end_of_text = words.bounds[1:][words.text] if n else np.zeros(0, np.int64)
    at = np.arange(n)
    begins = (at + size <= end_of_text) | (at == words.bounds[:-1][words.text] if n else np.zeros(0, bool))
    start = at[begins]
    end = np.minimum(start + size, end_of_text[begins])
    return span_hash(weighted, start, end), words.text[begins]


def occurrences(hashes: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text, hash) pairs with their counts, ordered by text and hash."""
    if not len(hashes):
        return text[:0], hashes[:0], np.zeros(0, np.int64)
    order = np.lexsort((hashes, text))
    text, hashes = text[order], hashes[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (hashes[1:] != hashes[:-1])
    first = np.flatnonzero(new)
    return text[first], hashes[first], np.diff(np.append(first, len(text)))


def lean(scan):
    """A function of Arrow batches that gives memory back when a task is done; workers live on."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from scan(batches)
        pa.default_memory_pool().release_unused()
    return run
