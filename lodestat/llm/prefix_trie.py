"""Conversation prefix trie: double-array tries per prefix shard, upper nodes merged globally.

Conversations become sequences of turns (role, text). Equal sequences are folded first (a count and the smallest id), so
copies cost one row. Sequences are dealt to shards by their first turn; a first turn held by more than ``SHARD_SEQUENCES``
distinct sequences is split over several shards by a hash of the whole sequence. Each shard packs its trie into BASE and
CHECK arrays over dense turn ids local to the shard (a child of state s on label l is state BASE[s] + l, valid when
CHECK[BASE[s] + l] = s), walks every sequence through it and emits its states with their local counts. A node is named
by a 128-bit hash chain of its turns, so the states of one node in several shards (the upper nodes: the root, and
prefixes whose sequences were split) merge by a plain grouping: counts add, smallest ids take the minimum.

Subtree sums count every node once: a node belongs to the shard that holds its smallest member. A second walk of each
shard, children before parents, adds up what it owns below each of its nodes; the shards' partial sums of a node add up
to the whole subtree. Nothing but one shard (bounded) is ever in one task.

Edge cases: null role or text is the empty string; null turn orders first, ties of turn by role and text; a conversation
whose rebuilt form has no turn is a member of the root only; an empty table gives no nodes; repeated rows are turns each.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestat.llm.shared import written

# fixed values of the contract: the donor conversation and the number of its turns taken
DONOR_EVERY = 20
DONOR_TURNS = 4  # h = crc32(decimal id) mod 4
SPACES = r"[\x20\x09-\x0D]+"  # words are the runs between these

SHARD_SEQUENCES = 20_000  # distinct sequences with one first turn that a shard holds before the first turn is split

NODE = "k1 long, k2 long, depth long, p1 long, p2 long, n long, least long, words long, e1 long, e2 long, shard long"
PART = "k1 long, k2 long, sub_saved long, sub_leaves long"


def rebuilt(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): c's turns rebuilt from the first h turns of its donor c - c % 20 and its own turns after h."""
    rows = conversations.select(
        "conv_id", "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    order = W.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    rows = rows.withColumn("p", F.row_number().over(order) - 1)
    rows = rows.withColumn("words", F.size(F.filter(F.split("text", SPACES), lambda w: w != "")).cast("long"))
    convs = rows.select("conv_id").distinct().select(
        F.col("conv_id").alias("c"), (F.col("conv_id") - F.col("conv_id") % DONOR_EVERY).alias("donor"),
        (F.crc32(F.col("conv_id").cast("string").cast("binary")) % DONOR_TURNS).alias("h"),
    )
    turn = F.struct("role", "text", "words")
    donor = convs.join(rows, (rows.conv_id == convs.donor) & (rows.p < convs.h)).select("c", F.lit(0).alias("part"), "p", turn.alias("t"))
    own = convs.join(rows, (rows.conv_id == convs.c) & (rows.p >= convs.h)).select("c", F.lit(1).alias("part"), "p", turn.alias("t"))
    both = donor.unionByName(own).groupBy("c").agg(F.array_sort(F.collect_list(F.struct("part", "p", "t"))).alias("x"))
    seqs = convs.select("c").join(both, "c", "left")
    return seqs.select(F.col("c").alias("conv_id"), F.coalesce(F.transform("x", lambda e: e["t"]), F.array().cast("array<struct<role:string,text:string,words:bigint>>")).alias("turns"))


def _tid(turns: F.Column, seed: int) -> F.Column:
    return F.transform(turns, lambda t: F.xxhash64(F.lit(seed), t["role"], F.lit("\x00"), t["text"]))


def sequences(convs: DataFrame) -> DataFrame:
    """Distinct sequences: (s1, s2) hash, turn ids (a1, a2), words of each turn, count n, least member, shard."""
    keyed = convs.select("conv_id", "turns", F.xxhash64(F.lit(1), "turns").alias("s1"), F.xxhash64(F.lit(2), "turns").alias("s2"))
    seqs = keyed.groupBy("turns").agg(F.count("*").alias("n"), F.min("conv_id").alias("least"), F.first("s1").alias("s1"), F.first("s2").alias("s2"))
    seqs = seqs.select("s1", "s2", "n", "least", _tid(F.col("turns"), 3).alias("a1"), _tid(F.col("turns"), 4).alias("a2"), F.transform("turns", lambda t: t["words"]).alias("w"))
    seqs = seqs.withColumn("first", F.coalesce(F.get("a1", 0), F.lit(0)))
    per_first = seqs.groupBy("first").agg(F.count("*").alias("many"))
    salts = F.greatest(F.lit(1), F.ceil(F.col("many") / SHARD_SEQUENCES)).cast("long")
    seqs = seqs.join(per_first, "first").withColumn("shard", F.xxhash64("first", F.pmod(F.col("s1"), salts)))
    return seqs.drop("first", "many")


class DoubleArray:
    """A trie over sequences of dense labels 1..m, packed as BASE and CHECK arrays (state 0 is the root)."""

    def __init__(self, labels: list[np.ndarray]):
        order = sorted(range(len(labels)), key=lambda i: labels[i].tolist())
        self.base = np.zeros(16, np.int64)
        self.check = np.full(16, -1, np.int64)
        self.check[0] = 0
        free = 1
        frontier = [(0, order)]  # a state and the sequences (sorted) that pass through it
        depth = 0
        while frontier:
            following = []
            for state, members in frontier:
                longer = [i for i in members if len(labels[i]) > depth]
                if not longer:
                    continue
                kids: dict[int, list[int]] = {}
                for i in longer:
                    kids.setdefault(int(labels[i][depth]), []).append(i)
                keys = np.fromiter(kids, np.int64)
                b = max(1, free - int(keys.min()))
                while True:
                    self._room(b + int(keys.max()) + 1)
                    if (self.check[b + keys] < 0).all():
                        break
                    b += 1
                self.base[state] = b
                self.check[b + keys] = state
                while free < len(self.check) and self.check[free] >= 0:
                    free += 1
                following += [(b + k, kids[k]) for k in kids]
            frontier = following
            depth += 1

    def _room(self, size: int) -> None:
        if size > len(self.check):
            grow = max(size, 2 * len(self.check))
            self.base = np.concatenate([self.base, np.zeros(grow - len(self.base), np.int64)])
            self.check = np.concatenate([self.check, np.full(grow - len(self.check), -1, np.int64)])

    def walk(self, labels: np.ndarray) -> np.ndarray:
        """States from the root along ``labels`` (the root first)."""
        states = np.empty(len(labels) + 1, np.int64)
        s = states[0] = 0
        for j, label in enumerate(labels.tolist()):
            t = int(self.base[s]) + label
            if self.check[t] != s:
                raise KeyError("sequence not in the trie")
            s = states[j + 1] = t
        return states


def _first_pass(batches):
    """Per shard: the double array, every sequence walked, and each state with its local count and least member."""
    for shard in _shards(batches):
        yield _states(shard)


def _shards(batches):
    part, key = [], None
    for batch in batches:
        rows = batch.to_pylist()
        for r in rows:
            if r["shard"] != key and part:
                yield part
                part = []
            key = r["shard"]
            part.append(r)
    if part:
        yield part


_M = (1 << 64) - 1


def _chain(key: int, label: int, factor: int) -> int:
    """Name of a child node: the parent's name and the turn's id, scrambled (a signed 64-bit value)."""
    x = (key * factor + (label & _M) + 1) & _M
    x ^= x >> 30
    x = (x * 0xBF58476D1CE4E5B9) & _M
    x ^= x >> 27
    x = (x * 0x94D049BB133111EB) & _M
    x ^= x >> 31
    return x - (1 << 64) if x >> 63 else x


def _states(rows: list[dict]) -> pa.RecordBatch:
    dense: dict[tuple[int, int], int] = {}
    labels = [np.array([dense.setdefault(pair, len(dense) + 1) for pair in zip(r["a1"], r["a2"])], np.int64) for r in rows]
    trie = DoubleArray(labels)
    size = len(trie.check)
    n = np.zeros(size, np.int64)
    least = np.full(size, np.iinfo(np.int64).max, np.int64)
    depth = np.zeros(size, np.int64)
    parent = np.full(size, -1, np.int64)
    words = np.zeros(size, np.int64)
    k1 = np.zeros(size, np.int64)
    k2 = np.zeros(size, np.int64)
    e1 = np.zeros(size, np.int64)
    e2 = np.zeros(size, np.int64)
    ended = np.zeros(size, bool)
    seen = np.zeros(size, bool)
    for r, lab in zip(rows, labels):
        states = trie.walk(lab)
        n[states] += r["n"]
        least[states] = np.minimum(least[states], r["least"])
        seen[states] = True
        depth[states] = np.arange(len(states))
        parent[states[1:]] = states[:-1]
        if len(lab):
            words[states[1:]] = np.asarray(r["w"], np.int64)
            c1 = c2 = 0
            for s, a1, a2 in zip(states[1:].tolist(), r["a1"], r["a2"]):
                c1, c2 = _chain(c1, a1, 0x9E3779B97F4A7C15), _chain(c2, a2, 0xC2B2AE3D27D4EB4F)
                k1[s], k2[s] = c1, c2
        end = states[-1]
        e1[end], e2[end], ended[end] = r["s1"], r["s2"], True
    at = np.flatnonzero(seen)
    pk1 = np.where(parent[at] >= 0, k1[np.maximum(parent[at], 0)], 0)
    pk2 = np.where(parent[at] >= 0, k2[np.maximum(parent[at], 0)], 0)
    columns = {
        "k1": k1[at], "k2": k2[at], "depth": depth[at], "p1": pk1, "p2": pk2, "n": n[at], "least": least[at], "words": words[at],
        "e1": e1[at], "e2": e2[at], "shard": np.full(len(at), rows[0]["shard"], np.int64),
    }
    arrays = [pa.array(v, pa.int64()) for v in columns.values()]
    none = ~ended[at]
    arrays[8] = pa.array(columns["e1"], pa.int64(), mask=none)
    arrays[9] = pa.array(columns["e2"], pa.int64(), mask=none)
    arrays[3] = pa.array(pk1, pa.int64(), mask=depth[at] == 0)
    arrays[4] = pa.array(pk2, pa.int64(), mask=depth[at] == 0)
    return pa.RecordBatch.from_arrays(arrays, list(columns))


def _second_pass(batches):
    """Per shard, deepest first: each node's owned saved words and leaves, added up to its parent."""
    for shard in _shards(batches):
        acc_s: dict[tuple, int] = {}
        acc_l: dict[tuple, int] = {}
        out = {"k1": [], "k2": [], "sub_saved": [], "sub_leaves": []}
        for r in shard:  # sorted by depth, deepest first
            key = (r["k1"], r["k2"])
            s = acc_s.pop(key, 0) + (r["saved"] if r["owned"] else 0)
            leaves = acc_l.pop(key, 0) + (int(r["leaf"]) if r["owned"] else 0)
            if r["p1"] is not None:
                up = (r["p1"], r["p2"])
                acc_s[up] = acc_s.get(up, 0) + s
                acc_l[up] = acc_l.get(up, 0) + leaves
            for name, value in (("k1", r["k1"]), ("k2", r["k2"]), ("sub_saved", s), ("sub_leaves", leaves)):
                out[name].append(value)
        yield pa.RecordBatch.from_pydict(out, schema=pa.schema([(c, pa.int64()) for c in out]))


def _ends(convs: DataFrame) -> DataFrame:
    """(e1, e2, ends_sha256): per distinct sequence, the hash of its members' ids, ascending, comma-joined, streamed."""
    keyed = convs.select("conv_id", F.xxhash64(F.lit(1), "turns").alias("e1"), F.xxhash64(F.lit(2), "turns").alias("e2"))
    keyed = keyed.repartition("e1", "e2").sortWithinPartitions("e1", "e2", "conv_id")

    def run(batches):
        key, digest, first = None, None, True
        out = {"e1": [], "e2": [], "ends_sha256": []}
        for batch in batches:
            for a, b, c in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if (a, b) != key:
                    if key is not None:
                        out["e1"].append(key[0]), out["e2"].append(key[1]), out["ends_sha256"].append(digest.hexdigest())
                    key, digest, first = (a, b), hashlib.sha256(), True
                digest.update((b"" if first else b",") + str(c).encode())
                first = False
            if len(out["e1"]) >= 65_536:
                yield pa.RecordBatch.from_pydict(out)
                out = {k: [] for k in out}
        if key is not None:
            out["e1"].append(key[0]), out["e2"].append(key[1]), out["ends_sha256"].append(digest.hexdigest())
        yield pa.RecordBatch.from_pydict(out, schema=pa.schema([("e1", pa.int64()), ("e2", pa.int64()), ("ends_sha256", pa.string())]))

    return keyed.select("e1", "e2", "conv_id").mapInArrow(run, "e1 long, e2 long, ends_sha256 string")


EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


def trie(conversations: DataFrame) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    convs = written(rebuilt(conversations), "trie-convs")
    seqs = written(sequences(convs), "trie-sequences")
    local = seqs.repartition("shard").sortWithinPartitions("shard").mapInArrow(_first_pass, NODE)
    local = written(local, "trie-local")
    nodes = local.groupBy("k1", "k2").agg(
        F.sum("n").alias("n_convs"), F.min("least").alias("conv_id"), F.first("depth").alias("depth"), F.first("p1").alias("p1"),
        F.first("p2").alias("p2"), F.first("words").alias("words"), F.max("e1").alias("e1"), F.max("e2").alias("e2"),
    )
    children = nodes.filter(F.col("p1").isNotNull()).groupBy(F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(F.count("*").alias("n_children"))
    nodes = nodes.join(children, ["k1", "k2"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    nodes = written(nodes.withColumn("saved", (F.col("n_convs") - 1) * F.col("words")), "trie-nodes")
    facts = nodes.select("k1", "k2", F.col("conv_id").alias("owner"), "saved", (F.col("n_children") == 0).alias("leaf"))
    owned = local.join(facts, ["k1", "k2"]).select("shard", "k1", "k2", "p1", "p2", "depth", "saved", "leaf", (F.col("least") == F.col("owner")).alias("owned"))
    owned = owned.repartition("shard").sortWithinPartitions("shard", F.col("depth").desc())
    sums = owned.mapInArrow(_second_pass, PART).groupBy("k1", "k2").agg(F.sum("sub_saved").alias("saved_tokens"), F.sum("sub_leaves").alias("n_leaves"))
    parents = nodes.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    out = nodes.join(sums, ["k1", "k2"]).join(parents, ["p1", "p2"], "left").join(_ends(convs), ["e1", "e2"], "left")
    return out.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.col("n_leaves").cast("long").alias("n_leaves"),
        F.col("saved_tokens").cast("long").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(EMPTY_SHA256)).alias("ends_sha256"),
    )
