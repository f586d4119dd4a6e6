"""Personal data in texts, by weak supervision.

Base spans follow fixed patterns and always stand. Looser patterns bring further candidates: written-out
addresses, numbers without a country code, account and social security numbers, names, birth dates. Labelers
vote on every candidate: its form, its check digits, gazetteers, the words before it, what it is embedded in.
How often every combination of votes occurs is counted over all documents; expectation-maximisation
(one hidden class, labelers independent given it) turns the counts into the labelers' reliabilities and
each combination's probability. A logistic regression on the candidate's own shape and surroundings, which
sees no votes, is trained on these probabilities and decides about the candidates that are no base spans.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.llm.arrow import lean
from pagemill.llm.tables import written
from pagemill.session import ship_package

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "ssn", "birth", "name")
# Candidates the classifier is trained on, at most; the counts behind the reliabilities cover all.
TRAINING_SPANS = 20_000
FEATURES = 1 << 12
THRESHOLD = 0.5
_NEAR = 48               # characters around a candidate that labelers and features look at
_ROUNDS, _STEPS = 60, 300

# Gazetteers and context words.
FIRST_NAMES = frozenset(
    "alice anna anne antonio barbara carlos carmen charles christine claire daniel david elena elizabeth emma "
    "francisco friedrich george hans heinrich helga ingrid isabel james jean jennifer john jorge jose juan julia "
    "jürgen karl klaus laura linda louise lucia luis manuel maria marie martin mary matthias michael michel monika "
    "patricia paul peter philippe pierre robert sarah sofia stefan susan thomas ursula william wolfgang".split())
TOP_DOMAINS = frozenset("com org net edu gov info io de fr es it uk us eu ch at nl be pt br mx ca au jp cn in".split())
IBAN_LENGTHS = {"AT": 20, "BE": 16, "CH": 21, "DE": 22, "ES": 24, "FR": 27, "GB": 22, "IT": 27, "NL": 18, "PT": 25}
CONTEXT = {
    "email": "mail email e-mail contact reach write address correo kontakt courriel",
    "ip": "ip address host server login from client",
    "card": "card visa mastercard amex credit debit payment karte tarjeta carte",
    "phone": "phone tel telephone call mobile cell fax whatsapp telefon teléfono téléphone",
    "iban": "iban account bank konto cuenta compte transfer",
    "ssn": "ssn social security",
    "birth": "born birthday birth dob geboren nacido née né",
    "name": "mr mrs ms miss dr prof herr frau señor señora monsieur madame name named signed regards dear",
}
_CONTEXT = {kind: frozenset(words.split()) for kind, words in CONTEXT.items()}
# Words before a number that make it something else.
OTHER_NUMBERS = frozenset("version release figure fig table page chapter section order item isbn issn invoice serial "
                          "id ref part model build rfc line column total price usd eur".split())

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOTTED = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++)++")
_DIGITS = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOOSE = (
    ("email", re.compile(r"[A-Za-z0-9._%+-]{1,64}\x20?[\[(]\x20?at\x20?[\])]\x20?[A-Za-z0-9-]{1,63}"
                         r"(?:\x20?(?:\.|[\[(]\x20?dot\x20?[\])])\x20?[A-Za-z0-9-]{1,63}){1,4}")),
    ("phone", re.compile(r"(?<![0-9+])(?:\([0-9]{2,5}\)[\x20-]?|[0-9]{2,5}[\x20./-])[0-9]{2,4}[\x20.-][0-9]{2,4}(?:[\x20.-][0-9]{2,4})?(?![0-9])")),
    ("iban", re.compile(r"\b[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?\b")),
    ("ssn", re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")),
    ("birth", re.compile(r"(?<![0-9.])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}[./][0-9]{1,2}[./][0-9]{4})(?![0-9.])")),
    ("name", re.compile(r"\b(?:Mr|Mrs|Ms|Dr|Herr|Frau|Señor|Señora|Monsieur|Madame)\.?\x20(\w{2,20}(?:\x20\w{2,20})?)"
                        rf"|\b((?:{'|'.join(n.capitalize() for n in sorted(FIRST_NAMES))})\x20\w{{2,20}})\b")),
)
_WRITTEN_AT = re.compile(r"[\[(]\x20?at\x20?[\])]")
_WORD = re.compile(r"[^\W_]+(?:-[^\W_]+)*")


def luhn(digits: str) -> bool:
    doubled = (int(d) * 2 for d in digits[-2::-2])
    return (sum(map(int, digits[::-2])) + sum(d // 10 + d % 10 for d in doubled)) % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns, leftmost matches that do not overlap, ordered.

    Runs are delimited before they are judged, so the work grows with the text and not with its square.
    """
    found, free = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            found.append((start, 0, domain.end()))
            free = domain.end()
        else:
            free = max(free, at + 1)
        at = text.find("@", free)
    for run in _DOTTED.finditer(text):
        parts, at = run.group().split("."), run.start()
        for first in range(0, len(parts) - 3, 4):
            four = parts[first:first + 4]
            end = at + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                found.append((at, 1, end))
            at = end + 1
    for run in _DIGITS.finditer(text):
        if 12 <= len(digits := run.group().replace(" ", "").replace("-", "")) <= 19 and luhn(digits):
            found.append((run.start(), 2, run.end()))
    for run in _PHONE.finditer(text):
        if 9 <= sum(c.isdigit() for c in run.group()) <= 15:
            found.append((run.start(), 3, run.end()))
    return sorted(found)


def loose_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the looser patterns; kinds may overlap each other."""
    found = []
    for kind, pattern in _LOOSE:
        if kind == "email" and not _WRITTEN_AT.search(text):
            continue
        for match in pattern.finditer(text):
            group = next((g for g in range(1, pattern.groups + 1) if match.group(g)), 0)
            found.append((match.start(group), KINDS.index(kind), match.end(group)))
    return found


def _valid(kind: str, value: str) -> int:
    """Vote of check digits, number ranges and lengths."""
    digits = re.sub(r"\D", "", value)
    if kind == "card":
        return 1 if luhn(digits) and digits[:1] in "3456" else -1
    if kind == "phone":
        return 1 if 9 <= len(digits) <= 15 and len(set(digits)) > 2 else -1
    if kind == "ip":
        return 1 if 0 < int(value.split(".")[0]) < 240 and not re.search(r"(?:^|\.)0[0-9]", value) else -1
    if kind == "iban":
        tight = value.replace(" ", "")
        turned = "".join(str(int(c, 36)) for c in tight[4:] + tight[:4])
        return 1 if IBAN_LENGTHS.get(tight[:2], len(tight)) == len(tight) and int(turned) % 97 == 1 else -1
    if kind == "ssn":
        return -1 if digits[:3] in ("000", "666") or digits[0] == "9" or digits[3:5] == "00" or digits[5:] == "0000" else 1
    if kind == "birth":
        parts = sorted(map(int, re.split(r"[-./]", value)))
        return 1 if parts[0] >= 1 and parts[0] <= 12 and parts[1] <= 31 and 1900 <= parts[2] <= 2030 else -1
    return 0


def _listed(kind: str, value: str) -> int:
    """Vote of the gazetteers."""
    if kind == "email":
        return 1 if re.split(r"\W+", value.lower().rstrip(" ])"))[-1] in TOP_DOMAINS else -1
    if kind == "name":
        words = value.split()
        return 1 if words[0].lower() in FIRST_NAMES and all(w[0].isupper() for w in words) else -1
    if kind == "iban":
        return 1 if value[:2] in IBAN_LENGTHS else -1
    return 0


def votes(text: str, start: int, kind: int, end: int, base: bool) -> list[int]:
    """Votes, each -1, 0 or 1, of the labelers: form, validity, gazetteer, words for, words against, embedding."""
    name, value = KINDS[kind], text[start:end]
    before = [w.lower() for w in _WORD.findall(text[max(0, start - _NEAR):start])]
    outer = text[start - 1:start] + text[end:end + 1]
    return [
        1 if base else 0,
        _valid(name, value),
        _listed(name, value),
        1 if _CONTEXT[name].intersection(before[-5:]) else 0,
        -1 if OTHER_NUMBERS.intersection(before[-3:]) and name not in ("email", "name") else 0,
        -1 if any(c.isalnum() or c in "_=/" for c in outer) else 1,
    ]


LABELERS = 6


def features(text: str, start: int, kind: int, end: int) -> list[int]:
    """Hashed properties of a candidate: kind with shape, length, neighbouring words and characters."""
    value = text[start:end][:_NEAR]
    shape = re.sub(r"[^\W\d_]+", "a", re.sub(r"[0-9]", "9", value))
    before = _WORD.findall(text[max(0, start - _NEAR):start].lower())[-3:]
    after = _WORD.findall(text[end:end + _NEAR].lower())[:1]
    digits = sum(c.isdigit() for c in value)
    parts = [f"k{kind}", f"s{kind}:{shape}", f"d{kind}:{digits}", f"n{kind}:{(end - start) // 4}",
             f"l{kind}:{text[start - 1:start]}", f"r{kind}:{text[end:end + 1]}", f"a{kind}:{''.join(after)}",
             f"t{kind}:{value[-4:].lower() if KINDS[kind] == 'email' else ''}",
             f"i{kind}:{value[:4] if KINDS[kind] == 'name' else value[:2]}"]
    parts += [f"b{kind}:{word}" for word in before]
    return sorted({zlib.crc32(p.encode()) % FEATURES for p in parts})


def reliabilities(kinds: np.ndarray, patterns: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(posterior of every row, P(vote | class) as class x labeler x 3) from counted vote combinations.

    Every kind has its own share of true candidates; a labeler has the same reliability for all kinds, a
    vote of 0 being an answer like others. Starting point is the majority of votes.
    """
    total = patterns.sum(1)
    posterior = np.clip(0.5 + total / (2.0 * LABELERS + 2.0), 0.02, 0.98)
    hot = (patterns[:, :, None] == np.array([-1, 0, 1])).astype(float)
    table = np.zeros((2, LABELERS, 3))
    for _ in range(_ROUNDS):
        weights = np.stack([(1 - posterior) * counts, posterior * counts])
        table = np.einsum("cr,rlv->clv", weights, hot) + 1.0
        table /= table.sum(2, keepdims=True)
        share = np.full(len(KINDS), 0.5)
        for kind in np.unique(kinds):
            mine = kinds == kind
            share[kind] = (weights[1][mine].sum() + 1.0) / (counts[mine].sum() + 2.0)
        logs = np.einsum("clv,rlv->cr", np.log(table), hot)
        gap = logs[1] - logs[0] + np.log(share[kinds] / (1 - share[kinds]))
        posterior = 1.0 / (1.0 + np.exp(-np.clip(gap, -40, 40)))
    return posterior, table


def fit_regression(rows: list[list[int]], targets: np.ndarray) -> np.ndarray:
    """Weights (the last one is the constant) of a regression on sparse 0/1 features with soft targets."""
    weights = np.zeros(FEATURES + 1)
    if not rows:
        return weights
    sizes = np.array([len(r) for r in rows])
    flat, row = np.concatenate([np.array(r) for r in rows]), np.repeat(np.arange(len(rows)), sizes)
    squares = np.full(FEATURES + 1, 1e-8)
    for _ in range(_STEPS):
        score = np.bincount(row, weights[flat], len(rows)) + weights[-1]
        miss = 1.0 / (1.0 + np.exp(-np.clip(score, -30, 30))) - targets
        slope = np.append(np.bincount(flat, miss[row], FEATURES), miss.sum()) / len(rows)
        slope[:-1] += 1e-4 * weights[:-1]
        squares += slope * slope
        weights -= 0.3 * slope / np.sqrt(squares)
    return weights


@dataclass(frozen=True)
class Model:
    """What training found: regression weights, and for inspection the labelers' reliabilities."""
    weights: np.ndarray
    reliability: np.ndarray
    candidates: int


_CANDIDATE = "struct<start:long,kind:int,end:long,base:boolean,votes:array<int>,features:array<int>>"
_FOUND = f"doc_id long, base string, counts array<long>, spans array<{_CANDIDATE}>"
_ARROW_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64()), ("base", pa.bool_()),
                                   ("votes", pa.list_(pa.int32())), ("features", pa.list_(pa.int32()))]))


def listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def candidates(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Every row with its base spans, written as text, their counts, and all candidates with votes and features."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bases, counts, spans = [], [], []
            for text in batch.column(1):
                text = text.as_py() or ""
                base = base_spans(text)
                taken = sorted((s, e) for s, _, e in base)
                more = [c for c in loose_spans(text) if not _overlaps(taken, c[0], c[2])]
                bases.append(listed(base))
                counts.append([sum(k == kind for _, k, _ in base) for kind in range(len(BASE))])
                spans.append([{"start": s, "kind": k, "end": e, "base": b, "votes": votes(text, s, k, e, b), "features": features(text, s, k, e)}
                              for b, group in ((True, base), (False, more)) for s, k, e in group])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(bases, pa.string()), pa.array(counts, pa.list_(pa.int64())), pa.array(spans, _ARROW_SPANS)],
                names=["doc_id", "base", "counts", "spans"])

    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return rows.mapInArrow(lean(scan), _FOUND)


def _overlaps(taken: list[tuple[int, int]], start: int, end: int) -> bool:
    """Whether a span meets one of the sorted spans, which may overlap each other but are few at any place."""
    low, high = 0, len(taken)
    while low < high:
        middle = (low + high) // 2
        low, high = (middle + 1, high) if taken[middle][0] < end else (low, middle)
    return any(e > start for _, e in taken[max(0, low - 2 * len(BASE)):low])


def train(found: DataFrame) -> Model:
    """Reliabilities from the votes on all candidates, and the classifier from TRAINING_SPANS of them.

    The sample is thinned by a hash of place and features to about its bound, by the counted number of
    candidates, before it is ordered and cut; the order does not depend on the run.
    """
    each = found.select("doc_id", F.explode("spans").alias("s"))
    counted = each.groupBy("s.kind", "s.votes").agg(F.count("*").alias("n")).collect()
    number = sum(r["n"] for r in counted)
    if not number:
        return Model(np.zeros(FEATURES + 1), np.zeros((2, LABELERS, 3)), 0)
    kinds = np.array([r["kind"] for r in counted])
    patterns = np.array([r["votes"] for r in counted])
    posterior, table = reliabilities(kinds, patterns, np.array([r["n"] for r in counted], float))
    known = {(r["kind"], tuple(r["votes"])): p for r, p in zip(counted, posterior)}
    order = F.xxhash64("doc_id", "s.start", "s.kind", "s.end", "s.features")
    rate = min(1.0, 1.2 * TRAINING_SPANS / number)
    thinned = each.withColumn("order", order).filter(F.pmod("order", F.lit(1 << 20)) < int(rate * (1 << 20)) + 1)
    sample = thinned.orderBy("order").limit(TRAINING_SPANS).select("s.kind", "s.votes", "s.features").collect()
    targets = np.array([known[r["kind"], tuple(r["votes"])] for r in sample])
    return Model(fit_regression([r["features"] for r in sample], targets), table, number)


def _decided(found: DataFrame, model: Model) -> DataFrame:
    """(doc_id, counts, base, spans): candidates the classifier takes join the base spans."""
    weights = found.sparkSession.sparkContext.broadcast(model.weights)

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = weights.value
        for batch in batches:
            lines = []
            for spans in batch.column(3).to_pylist():
                chosen, more = [(s["start"], s["kind"], s["end"]) for s in spans if s["base"]], []
                for s in spans:
                    if not s["base"] and (held[s["features"]].sum() + held[-1]) >= np.log(THRESHOLD / (1 - THRESHOLD)):
                        more.append((s["start"], s["kind"], s["end"]))
                reach = -1
                for start, kind, end in sorted(more, key=lambda m: (m[0], -m[2], m[1])):
                    if start >= reach:
                        chosen.append((start, kind, end))
                        reach = end
                lines.append(listed(sorted(chosen)))
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(3)), pa.array(lines, pa.string())],
                                             names=["doc_id", "base", "counts", "spans"])

    return found.mapInArrow(lean(decide), "doc_id long, base string, counts array<long>, spans string")


def count_of(kind: str) -> Column:
    """Base spans of a kind."""
    return F.get("counts", F.lit(BASE.index(kind)))


def scan(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", model: Model | None = None) -> DataFrame:
    """(doc_id, base, counts, spans) of every row; spans are written as kind:start:end, joined by commas.

    ``base`` lists the base spans, ``counts`` their numbers in the order of BASE, ``spans`` all spans. Places
    are code points. An added span never meets a base span; of added ones that meet, the first, then the
    longest, then the earlier kind stands. Null and empty texts have none. Repeated rows and rows without
    id are rows of their own. Whole texts are scanned. An empty table gives an empty result. Columns
    other than the two named are not read. Without a model, one is trained on the same rows.
    """
    ship_package(docs.sparkSession)
    found = written(candidates(docs, doc_id, text), "pii-candidates")
    return _decided(found, train(found) if model is None else model)
