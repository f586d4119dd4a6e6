"""Prefix trie of conversations, screened by a count-min sketch of prefix digests.

Every conversation is rebuilt from turn digests; texts are read once and never shuffled. A prefix has a
fingerprint of 122 bits that extends turn by turn. All fingerprints go through a count-min sketch whose
cells say only "once" or "more often": a prefix with a cell that was met once has a single member, so its
node is written where the row lies. Only the prefixes that may be shared are shuffled and grouped exactly.

Subtree sums need no walk over the trie. The smallest member of a node stands for it, and stands for all
nodes further down its own path; so a conversation adds its leaf, its children and its saved words to the
nodes above, once it is known how deep its path belongs to a smaller conversation.

Conversations are sorted by ranges of (group, conversation, turn), so one of any length spreads over many
tasks; what a task must know of the rows before its own is one small state a task, folded on the driver.
"""

from __future__ import annotations

import hashlib
import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.llm.arrow import lean
from pagemill.llm.tables import written
from pagemill.session import shared_dir, ship_package

GROUP = 20               # conversations that share the beginning of the first of them
MOST_SHARED = 4          # a conversation takes fewer turns than this from the first one
SKETCH_ROWS = 2
# Cells a sketch row: eight a prefix, up to this many (16 MB in all). Beyond it more prefixes are
# grouped exactly; results stay the same.
LEAST_CELLS, MOST_CELLS = 1 << 15, 1 << 26
_BITMAP = 1 << 15        # bits of one bitmap_construct_agg
_ENDS_BITS = 12          # ids of 4,096 consecutive numbers are joined before they are hashed

PRIME = (1 << 61) - 1
_BASES = (0x15A4B7C92D3E6F81, 0x0C9E3779B97F4A7D)
_INVERSES = tuple(pow(b, -1, PRIME) for b in _BASES)

_REBUILT = ("conv_id long, depth long, f1 long, f2 long, p1 long, p2 long, words long, total long, last boolean")
_NO_ENDS = hashlib.sha256(b"").hexdigest()


def shared_turns(conv: int) -> int:
    """How many turns a conversation takes from the first one of its group."""
    return zlib.crc32(str(conv).encode()) % MOST_SHARED


def _digits(key: bytes) -> tuple[int, int]:
    """A turn as two numbers between 1 and PRIME - 1."""
    return (int.from_bytes(key[:8], "big") % (PRIME - 1) + 1, int.from_bytes(key[8:], "big") % (PRIME - 1) + 1)


def _empty_state() -> dict:
    return {"conv": None, "block": None, "n": 0, "sums": [0, 0], "words": 0, "head": [], "base": None, "base_head": []}


def _first(head: list, more: list) -> list:
    return (head + more)[:MOST_SHARED - 1]


def joined_state(before: dict, part: dict) -> dict:
    """State at the end of a partition, from the state before it and the partition's own ``part``."""
    after = dict(part["state"])
    if before["base"] is not None and after["base"] is None and before["base"] == after["block"]:
        after["base"], after["base_head"] = before["base"], before["base_head"]
    elif before["base"] is not None and before["base"] == after["base"]:
        after["base_head"] = _first(before["base_head"], after["base_head"])
    if before["conv"] == after["conv"] == part["first"]:
        after["sums"] = [(s + t * pow(b, before["n"], PRIME)) % PRIME for s, t, b in zip(before["sums"], after["sums"], _BASES)]
        after["n"] += before["n"]
        after["words"] += before["words"]
        after["head"] = _first(before["head"], after["head"])
    return after


def _summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What a partition leaves for the next one: its last conversation, and the beginning of the last group's first."""
    state, first, first_n, power = _empty_state(), None, 0, [1, 1]
    for batch in batches:
        for block, conv, key, words in zip(*(batch.column(i).to_pylist() for i in range(4))):
            first = conv if first is None else first
            first_n += conv == first
            if conv != state["conv"]:
                state.update(conv=conv, block=block, n=0, sums=[0, 0], words=0, head=[])
                power = [1, 1]
                if state["base"] != block:
                    state.update(base=block if conv == block else None, base_head=[])
            digits = _digits(key)
            for i in (0, 1):
                state["sums"][i] = (state["sums"][i] + digits[i] * power[i]) % PRIME
                power[i] = power[i] * _BASES[i] % PRIME
            if state["n"] < MOST_SHARED - 1:
                state["head"].append([*digits, words])
                if conv == block:
                    state["base_head"].append([*digits, words])
            state["n"] += 1
            state["words"] += words
    if first is not None:
        yield pa.RecordBatch.from_arrays(
            [pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([json.dumps({"first": first, "first_n": first_n, "state": state})])],
            names=["part", "summary"])


class _Rebuilder:
    """Rows of the rebuilt conversations, from own turns in order, begun after any state."""

    def __init__(self, state: dict, own_turns: int):
        self.conv, self.n, self.own_turns = state["conv"], state["n"], own_turns
        self.base, self.base_head = state["base"], list(state["base_head"])
        self.rows, self.pending = [], None
        if self.conv is not None:
            self.block = state["block"]
            self._open()
            skipped = state["head"][:min(self.h, self.n)]
            self.f = []
            for i, base in enumerate(_BASES):
                beginning = sum(t[i] * pow(base, k, PRIME) for k, t in enumerate(self.taken))
                own = state["sums"][i] - sum(t[i] * pow(base, k, PRIME) for k, t in enumerate(skipped))
                shift = pow(_INVERSES[i], self.h - len(self.taken), PRIME)
                self.f.append((beginning + (own * shift if self.n > self.h else 0)) % PRIME)
            self.depth = len(self.taken) + max(0, self.n - self.h)
            self.total = sum(t[2] for t in self.taken) + (state["words"] - sum(t[2] for t in skipped) if self.n > self.h else 0)
            self.power = [pow(base, self.depth, PRIME) for base in _BASES]

    def _open(self) -> None:
        own = self.conv == self.block
        self.h = 0 if own else shared_turns(self.conv)
        self.taken = [] if own or self.base != self.block else self.base_head[:self.h]

    def _step(self, d1: int, d2: int, words: int) -> None:
        above, f, power = self.f, [], self.power
        for i, d in enumerate((d1, d2)):
            f.append((above[i] + d * power[i]) % PRIME)
            power[i] = power[i] * _BASES[i] % PRIME
        self.f, self.depth, self.total = f, self.depth + 1, self.total + words
        self._push((self.conv, self.depth, *f, *above, words, self.total, False))

    def _push(self, row) -> None:
        if self.pending is not None:
            self.rows.append(self.pending)
        self.pending = row

    def _close(self, last: bool) -> None:
        if self.pending is not None:
            self.rows.append((*self.pending[:-1], last))
            self.pending = None

    def turn(self, block: int, conv: int, key: bytes, words: int) -> None:
        if conv != self.conv:
            self._close(True)
            self.conv, self.block, self.n = conv, block, 0
            if self.base != block:
                self.base, self.base_head = (block if conv == block else None), []
            self._open()
            self.f, self.power, self.depth, self.total = [0, 0], [1, 1], 0, 0
            self._push((conv, 0, 0, 0, None, None, 0, 0, False))
            for taken in self.taken:
                self._step(*taken)
        digits = _digits(key)
        if conv == block and self.n < MOST_SHARED - 1:
            self.base_head.append([*digits, words])
        self.n += 1
        if self.n > self.h:
            self._step(*digits, words)

    def end(self) -> None:
        """The last row here ends its conversation unless own turns beyond the skipped ones follow elsewhere."""
        if self.pending is not None:
            self._close(self.own_turns <= max(self.h, self.n))

    def batch(self) -> pa.RecordBatch:
        names = [c.split()[0] for c in _REBUILT.split(", ")]
        columns = list(zip(*self.rows)) if self.rows else [()] * len(names)
        self.rows = []
        return pa.RecordBatch.from_arrays(
            [pa.array(c, pa.bool_() if n == "last" else pa.int64()) for n, c in zip(names, columns)], names=names)


def _task_states(parts: dict[int, dict]) -> dict[int, tuple[dict, int]]:
    """For every partition the state before it, and all own turns of the conversation it ends in."""
    order, state, before, after = sorted(parts), _empty_state(), {}, {}
    for part in order:
        before[part] = state
        state = after[part] = joined_state(state, parts[part])
    found, later, following = {}, 0, None
    for part in reversed(order):
        conv = after[part]["conv"]
        if following is None or parts[following]["first"] != conv:
            later = 0
        else:
            later = parts[following]["first_n"] + (later if after[following]["conv"] == conv else 0)
        found[part] = (before[part], after[part]["n"] + later)
        following = part
    return found


def rebuilt(turns: DataFrame) -> DataFrame:
    """One row a prefix: conversation, depth, fingerprint, that of the prefix above, words of the last turn
    and of the whole prefix, and whether the conversation ends here. Depth 0 is the textless root.

    ``turns`` has (block, side, conv, turn, key, words); the first conversation of a block has side 0.
    """
    spark = turns.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    order = ("block", "side", "conv", F.asc_nulls_first("turn"), "key")
    # The partitions of the sorted rows are met twice and must be the same both times.
    ordered = (turns.repartitionByRange(*order).sortWithinPartitions(*order)
               .select("block", "conv", "key", "words").checkpoint())
    states = _task_states({r["part"]: json.loads(r["summary"]) for r in ordered.mapInArrow(
        lean(_summarise), "part int, summary string").collect()})

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        builder = None
        for batch in batches:
            if batch.num_rows and builder is None:
                builder = _Rebuilder(*states[TaskContext.get().partitionId()])
            for row in zip(*(batch.column(i).to_pylist() for i in range(4))):
                builder.turn(*row)
            if builder is not None:
                yield builder.batch()
        if builder is not None:
            builder.end()
            yield builder.batch()

    return written(ordered.mapInArrow(lean(rebuild), _REBUILT), "rebuilt-turns")


def _cells(f1: str, f2: str, width: int) -> list:
    return [F.pmod(F.xxhash64(f1, f2, F.lit(i)), F.lit(width)) + F.lit(i * width) for i in range(SKETCH_ROWS)]


def _screened(rows: DataFrame) -> DataFrame:
    """The rows with ``alone``, true where the sketch proves one member, and the same of the prefix above."""
    spark, width = rows.sparkSession, LEAST_CELLS
    number = rows.count()
    while width < MOST_CELLS and width < 8 * number:
        width *= 2
    met_again = (rows.filter("depth > 0").select(F.explode(F.array(*_cells("f1", "f2", width))).alias("cell"))
                 .groupBy("cell").agg(F.count("*").alias("n")).filter("n > 1"))
    # One bit a cell: SKETCH_ROWS * width bits come to the driver and travel to the tasks.
    maps = met_again.groupBy(F.call_function("div", F.col("cell"), F.lit(_BITMAP)).alias("at")).agg(
        F.bitmap_construct_agg(F.col("cell") % _BITMAP).alias("bits")).collect()
    bits = np.zeros((SKETCH_ROWS * width + _BITMAP) // 8, np.uint8)
    for row in maps:
        held = np.frombuffer(bytes(row["bits"]), np.uint8)
        bits[row["at"] * (_BITMAP // 8):][:len(held)] = held
    sketch = spark.sparkContext.broadcast(bits)
    kept = rows.columns

    def screen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        again = sketch.value
        for batch in batches:
            flags = []
            for begun in (len(kept), len(kept) + SKETCH_ROWS):
                alone = np.zeros(batch.num_rows, bool)
                for i in range(SKETCH_ROWS):
                    cell = batch.column(begun + i)
                    known = ~cell.is_null().to_numpy(zero_copy_only=False)
                    cell = cell.fill_null(0).to_numpy(zero_copy_only=False)
                    alone |= known & ((again[cell >> 3] >> (cell & 7).astype(np.uint8)) & 1 == 0)
                flags.append(pa.array(alone))
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(kept))), *flags],
                                             names=[*kept, "alone", "alone_above"])

    own = [F.when(F.col("depth") > 0, c).alias(f"own{i}") for i, c in enumerate(_cells("f1", "f2", width))]
    above = [F.when(F.col("depth") > 1, c).alias(f"above{i}") for i, c in enumerate(_cells("p1", "p2", width))]
    return written(rows.select(*kept, *own, *above).mapInArrow(lean(screen), f"{_REBUILT}, alone boolean, alone_above boolean"),
                   "screened-turns")


def _ends(shared: DataFrame) -> DataFrame:
    """(f1, f2, ends_sha256) of shared prefixes at which conversations end.

    Ids are joined in runs of neighbouring numbers; a node's runs then pass the hash one after the other,
    so that of any number of ids one task holds a batch.
    """
    pieces = (shared.filter("last").groupBy("f1", "f2", F.shiftright("conv_id", _ENDS_BITS).alias("run"))
              .agg(F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids")))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, sha = None, None
        for batch in batches:
            done = []
            for f1, f2, ids in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if (f1, f2) != node:
                    done += [(*node, sha.hexdigest())] if node else []
                    node, sha = (f1, f2), hashlib.sha256(ids.encode())
                else:
                    sha.update(f",{ids}".encode())
            yield _end_rows(done)
        if node:
            yield _end_rows([(*node, sha.hexdigest())])

    return (pieces.repartition("f1", "f2").sortWithinPartitions("f1", "f2", "run").select("f1", "f2", "ids")
            .mapInArrow(lean(digest), "f1 long, f2 long, ends_sha256 string"))


def _end_rows(done: list) -> pa.RecordBatch:
    f1, f2, sha = zip(*done) if done else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(f1, pa.int64()), pa.array(f2, pa.int64()), pa.array(sha, pa.string())],
                                      names=["f1", "f2", "ends_sha256"])


def prefix_trie(conversations: DataFrame, *, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                text: str = "text") -> DataFrame:
    """One row a node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256.

    Turns are ordered by ``turn``, null first, equal ones by the SHA-256 of length of the role, role and text;
    repeated rows are turns of their own. Null role and text count as empty, rows without conversation
    are no turns. Texts are read whole. An empty table has no nodes, also no root. Columns other than the
    four named are not read.
    """
    spark = conversations.sparkSession
    ship_package(spark)
    conv = F.col(f"`{conv_id}`").cast("long")
    who, said = F.coalesce(F.col(f"`{role}`"), F.lit("")), F.coalesce(F.col(f"`{text}`"), F.lit(""))
    digest = F.sha2(F.concat(F.length(who).cast("string"), F.lit(":"), who, said), 256)
    turns = conversations.filter(conv.isNotNull()).select(
        (conv - conv % GROUP).alias("block"), (conv % GROUP != 0).cast("int").alias("side"), conv.alias("conv"),
        F.col(f"`{turn}`").cast("long").alias("turn"), F.unhex(F.substring(digest, 1, 32)).alias("key"),
        F.regexp_count(said, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"))
    # Sorting by ranges looks at its rows twice; the texts are to be read once.
    rows = _screened(rebuilt(written(turns, "turn-digests")))
    smallest = rows.agg(F.min("conv_id").alias("m")).first()["m"]
    shared = rows.filter("NOT alone")
    nodes = shared.groupBy("f1", "f2").agg(
        F.min("conv_id").alias("low"), (F.count("*") == F.count_if("last")).alias("childless"))
    met = shared.filter("depth > 0 OR last").join(nodes, ["f1", "f2"])
    # How deep the path of a conversation belongs to smaller ones, to which above, and with how many words;
    # all three grow with the depth. A leaf counts for the smallest conversation that ends there.
    paths = written(
        met.groupBy("conv_id").agg(
            F.max(F.when(F.col("low") < F.col("conv_id"), F.col("depth"))).alias("foreign_depth"),
            F.max(F.when((F.col("low") < F.col("conv_id")) & (F.col("depth") > 0), F.col("low"))).alias("above"),
            F.max(F.when(F.col("low") < F.col("conv_id"), F.col("total"))).alias("foreign_total"),
            F.max(F.when(F.col("last") & (F.col("low") == F.col("conv_id")) & F.col("childless"), 1)).alias("leaf"))
        .unionByName(rows.filter("last AND alone").select("conv_id", F.lit(1).alias("leaf")), allowMissingColumns=True)
        .groupBy("conv_id").agg(
            F.coalesce(F.max("foreign_depth"), F.lit(0)).alias("foreign_depth"),
            F.coalesce(F.max("above"), F.lit(smallest)).cast("long").alias("above"),
            F.coalesce(F.max("foreign_total"), F.lit(0)).alias("foreign_total"),
            F.coalesce(F.max("leaf"), F.lit(0)).alias("leaf")), "paths")
    of_path = shared.join(paths, "conv_id")
    stands = F.col("foreign_depth") < F.col("depth")
    grouped = of_path.groupBy("f1", "f2").agg(
        F.min("conv_id").alias("conv_id"), F.min("depth").alias("depth"),
        F.max(F.when(stands, F.when(F.col("foreign_depth") == F.col("depth") - 1, F.col("above")).otherwise(F.col("conv_id"))))
        .alias("parent_conv_id"),
        F.count("*").alias("n_convs"),
        F.count_if(~F.col("last") & (F.col("foreign_depth") <= F.col("depth"))).alias("n_children"),
        F.sum("leaf").alias("n_leaves"),
        F.sum(F.greatest(F.lit(0), F.col("foreign_total") - F.col("total") + F.col("words"))).alias("saved_tokens"))
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    exact = grouped.join(_ends(shared), ["f1", "f2"], "left").withColumn(
        "ends_sha256", F.coalesce("ends_sha256", F.lit(_NO_ENDS))).select(names)

    def tail(parent):
        return (F.col("conv_id"), F.col("depth"), parent.alias("parent_conv_id"), F.lit(1).cast("long").alias("n_convs"),
                F.when(F.col("last"), 0).otherwise(1).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"),
                F.lit(0).cast("long").alias("saved_tokens"),
                F.when(F.col("last"), F.sha2(F.col("conv_id").cast("string"), 256)).otherwise(F.lit(_NO_ENDS)).alias("ends_sha256"))

    local = rows.filter("alone AND alone_above").select(*tail(F.col("conv_id")))
    parent = F.when(F.col("foreign_depth") == F.col("depth") - 1, F.col("above")).otherwise(F.col("conv_id"))
    first_alone = rows.filter("alone AND NOT alone_above").join(paths, "conv_id").select(*tail(parent))
    return exact.unionByName(local).unionByName(first_alone)
