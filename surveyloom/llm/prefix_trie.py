"""Prefix trie of conversations in balanced parentheses, one sequence for each shard of paths.

Turns become 16-byte digests in their own rows; a sorted stream per
conversation chains them, so a node's key names the whole sequence above it.
Nodes are grouped by key, which gives members, smallest member and children.
What needs the shape of the trie (leaves and savings below a node) comes from
parentheses: the paths of nodes with two or more members, ordered and cut into
ranges; in a shard `findclose` delimits a subtree, the rank of leaf pairs counts
leaves, and cumulative weights give savings. A node whose subtree may reach into
the next shard lies on a shard's first or last path; these shared spines are
joined by one more sequence made of them alone.

A node with one member has one leaf below it and saves nothing, so private ends
of conversations never enter a path: they are counted at their last shared node.

Defined cases: rows without a conversation id take no part; null role or text is
empty; turns are ordered by number (null first), equal numbers by role and then
by digest of the text, and repeated rows are turns of their own. A group id
`c - c % 100` has the sign of c. An empty table has no nodes. Other columns are
not read. The path of shared turns of one conversation (16 bytes a turn) must
fit a task; texts never travel, and ids that end at one node pass as a stream.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import cut

SPAN, KEPT = 100, 6  # conversations that share a source; one more than the turns taken from it at most
BLOCK = 64  # parentheses in a block of the range min-max index
NODES = 50_000  # path elements in a shard, about
ROOT = b"\0" * 16


# ---- sequences -------------------------------------------------------------------
def turn_rows(df: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, at, digest, chars): every turn with its place in its conversation, from 1."""
    who, what = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    named = F.concat(F.octet_length(who).cast("string"), F.lit(":"), who, what)  # the length tells role and text apart
    slim = df.filter(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv"), F.col(turn).alias("turn"), who.alias("role"),
        F.substring(F.unhex(F.sha2(named.cast("binary"), 256)), 1, 16).alias("digest"), F.length(what).cast("long").alias("chars"))
    w = Window.partitionBy("conv").orderBy(F.asc_nulls_first("turn"), "role", "digest")
    return slim.withColumn("at", F.row_number().over(w)).select("conv", "at", "digest", "chars")


def rebuilt(turns: DataFrame) -> DataFrame:
    """(conv, part, at, digest, chars) in the rebuilt order: marker (part -1), turns of the source (0), own turns (1)."""
    h = F.pmod(F.crc32(F.col("conv").cast("string").cast("binary")), F.lit(KEPT)).cast("int")
    convs = turns.filter(F.col("at") == 1).select("conv", h.alias("h"), (F.col("conv") - F.col("conv") % SPAN).alias("source"))
    heads = turns.filter((F.col("at") < KEPT) & (F.col("conv") % SPAN == 0)).withColumnRenamed("conv", "source")
    taken = convs.join(heads, "source").filter(F.col("at") <= F.col("h")).select("conv", F.lit(0).alias("part"), "at", "digest", "chars")
    own = turns.withColumn("h", h).filter(F.col("at") > F.col("h")).select("conv", F.lit(1).alias("part"), "at", "digest", "chars")
    mark = convs.select("conv", F.lit(-1).alias("part"), F.lit(0).alias("at"), F.lit(None).cast("binary").alias("digest"), F.lit(0).cast("long").alias("chars"))
    return mark.union(taken).union(own)


STEP = "conv long, depth long, key binary, parent binary, chars long, last boolean"


def chained(batches):
    """One row for each turn and each root, in order: its key is a digest of the key above and the turn."""
    conv, key, depth, wait = None, ROOT, 0, None
    for batch in batches:
        out = []
        for c, digest, chars in zip(*(batch.column(x).to_pylist() for x in ("conv", "digest", "chars"))):
            if wait is not None:
                out.append((*wait, c != conv))
            if c != conv:
                conv, key, depth, wait = c, ROOT, 0, (c, 0, ROOT, None, 0)
            else:
                above, key, depth = key, hashlib.sha256(key + digest).digest()[:16], depth + 1
                wait = (c, depth, key, above, chars)
        if out:
            yield _batch(out)
    if wait is not None:
        yield _batch([(*wait, True)])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.bool_())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], ["conv", "depth", "key", "parent", "chars", "last"])


# ---- parentheses -----------------------------------------------------------------
class Parentheses:
    """A forest as a sequence of +1 and -1, with the least excess of each block; places count from 0."""

    def __init__(self, steps: np.ndarray):
        self.steps = steps
        self.excess = np.cumsum(steps, dtype=np.int64)
        self.least = np.minimum.reduceat(self.excess, np.arange(0, len(steps), BLOCK)) if len(steps) else self.excess
        opens = steps == 1
        self.paired = np.append(opens[:-1] & ~opens[1:], False) if len(steps) else opens
        self.opened = np.concatenate([[0], np.cumsum(opens)])  # openings before a place
        self.pairs = np.concatenate([[0], np.cumsum(self.paired)])  # leaf pairs that start before a place

    def findclose(self, at: np.ndarray) -> np.ndarray:
        """For each opening place the first later one where the excess falls below its own."""
        found = np.empty(len(at), dtype=np.int64)
        for start in range(0, len(at), 4096):
            found[start : start + 4096] = self._findclose(at[start : start + 4096])
        return found

    def _findclose(self, at: np.ndarray) -> np.ndarray:
        want, place, found = self.excess[at] - 1, at + 1, np.empty(len(at), dtype=np.int64)
        left = np.arange(len(at))
        while len(left):  # the rest of the place's block; if it stays above, the first later block that does not
            span = place[left, None] + np.arange(BLOCK)
            inside = (span // BLOCK == (place[left] // BLOCK)[:, None]) & (span < len(self.steps))
            low = inside & (self.excess[np.minimum(span, len(self.steps) - 1)] <= want[left, None])
            done = low.any(axis=1)
            found[left[done]] = place[left[done]] + low[done].argmax(axis=1)
            left = left[~done]
            for i in left:
                later = place[i] // BLOCK + 1
                place[i] = BLOCK * (later + int(np.argmax(self.least[later:] <= want[i])))
        return found


class Shard:
    """The parentheses of ordered paths; an element of a path is (key, weight, tails, childless).

    The private children of a node stand as one leaf pair behind its opening, worth `tails` leaves.
    """

    def __init__(self, paths: list[list[tuple]], outside: frozenset[bytes] | set[bytes] = frozenset()):
        """`outside`: keys whose own weight and leaves are counted elsewhere."""
        steps, weights, worths, at = [], [], [], []
        self.keys: list[bytes] = []
        above: list[bytes] = []
        for path in paths:
            same = 0
            while same < min(len(above), len(path)) and above[same] == path[same][0]:
                same += 1
            steps += [-1] * (len(above) - same)
            for key, weight, tails, childless in path[same:]:
                own = key not in outside
                self.keys.append(key)
                at.append(len(steps))
                steps.append(1)
                weights.append(weight if own else 0)
                worths.append(1 if own and childless else 0)
                if tails:
                    steps += [1, -1]
                    weights.append(0)
                    worths.append(tails if own else 0)
            above = [x[0] for x in path]
        steps += [-1] * len(above)
        tree, at = Parentheses(np.array(steps, dtype=np.int8)), np.array(at, dtype=np.int64)
        close = tree.findclose(at)
        worth = np.array(worths, dtype=np.int64)[tree.opened[:-1][tree.paired]]  # of each leaf pair in turn
        leaves, cost = (np.concatenate([[0], np.cumsum(x)]) for x in (worth, np.array(weights, dtype=np.int64)))
        self.leaves = leaves[tree.pairs[close]] - leaves[tree.pairs[at]]
        self.saved = cost[tree.opened[close]] - cost[tree.opened[at]]


ELEMENT = "struct<key: binary, weight: bigint, tails: bigint, childless: boolean>"
SHAPE = f"key binary, n_leaves long, saved long, spine array<{ELEMENT}>"


def _paths(batches) -> list[list[tuple]]:
    return [[(e["key"], e["weight"], e["tails"], e["childless"]) for e in p] for b in batches for p in b.column("path").to_pylist()]


def _shape(shard: Shard, spines: list[list[tuple]]):
    kind = pa.list_(pa.struct([("key", pa.binary()), ("weight", pa.int64()), ("tails", pa.int64()), ("childless", pa.bool_())]))
    names = ["key", "n_leaves", "saved", "spine"]
    n = len(shard.keys)
    yield pa.RecordBatch.from_arrays([pa.array(shard.keys, pa.binary()), pa.array(shard.leaves), pa.array(shard.saved), pa.nulls(n, kind)], names)
    if spines:
        told = [[dict(zip(("key", "weight", "tails", "childless"), e)) for e in p] for p in spines]
        m = len(spines)
        yield pa.RecordBatch.from_arrays([pa.nulls(m, pa.binary()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64()), pa.array(told, kind)], names)


def inside(batches):
    """Leaves and savings of a shard's nodes without what its first and last path own; and these two paths."""
    paths = _paths(batches)
    if paths:
        spines = [paths[0], paths[-1]]
        yield from _shape(Shard(paths, {e[0] for p in spines for e in p}), spines)


def along(batches):
    """What the nodes of all spines own, summed up the spines."""
    paths = _paths(batches)
    if paths:
        yield from _shape(Shard(paths), [])


def shape(steps: DataFrame, nodes: DataFrame) -> DataFrame:
    """(key, n_leaves, saved) of the nodes with two or more members. Starts jobs."""
    shared = nodes.filter(F.col("n_convs") > 1)
    tips = shared.filter(F.col("n_children") == F.col("tails")).select(F.col("conv_id").alias("conv"), F.col("depth").alias("end"))
    weight = ((F.col("n_convs") - 1) * F.col("chars")).alias("weight")
    element = shared.select("key", weight, "tails", (F.col("n_children") == 0).alias("childless"))
    on_path = steps.select("conv", "depth", "key").join(tips, "conv").filter(F.col("depth") <= F.col("end")).join(element, "key")
    gathered = on_path.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("depth", "key", "weight", "tails", "childless"))).alias("p"))
    paths = cut(gathered.select(F.transform("p", lambda e: F.struct(e.key.alias("key"), e.weight.alias("weight"), e.tails.alias("tails"), e.childless.alias("childless"))).alias("path")), "trie-paths")
    size = paths.agg(F.sum(F.size("path"))).first()[0] or 0
    ranged = paths.repartitionByRange(max(1, math.ceil(size / NODES)), "path").sortWithinPartitions("path")
    parts = cut(ranged.mapInArrow(inside, SHAPE), "trie-shards")
    spines = parts.filter(F.col("spine").isNotNull()).select(F.col("spine").alias("path")).distinct()
    joined = spines.repartition(1).sortWithinPartitions("path").mapInArrow(along, SHAPE)  # two paths for each shard
    every = parts.filter(F.col("key").isNotNull()).unionByName(joined)
    return every.groupBy("key").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved"))


# ---- who ends where --------------------------------------------------------------
def packed(batches):
    """Runs of ids of one node, in order, as (key, first id, decimal ids joined by commas)."""
    for batch in batches:
        keys, convs = batch.column("key").to_pylist(), batch.column("conv").to_pylist()
        starts = [i for i in range(len(keys)) if i == 0 or keys[i] != keys[i - 1] or i % 4096 == 0]
        runs = [",".join(map(str, convs[a:b])) for a, b in zip(starts, [*starts[1:], len(keys)])]
        yield pa.RecordBatch.from_arrays([pa.array([keys[a] for a in starts], pa.binary()), pa.array([convs[a] for a in starts], pa.int64()), pa.array(runs)], ["key", "first", "ids"])


def hashed(batches):
    """One digest for each key from its runs in order; only the running hash is held."""
    key, state = None, None
    for batch in batches:
        done = []
        for k, ids in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist()):
            if k == key:
                state.update(b"," + ids.encode())
                continue
            if key is not None:
                done.append((key, state.hexdigest()))
            key, state = k, hashlib.sha256(ids.encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.binary()), pa.array([d[1] for d in done])], ["key", "ends"])
    if key is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([state.hexdigest()])], ["key", "ends"])


def ends(steps: DataFrame) -> DataFrame:
    """(key, ends): SHA-256 of the ascending ids of the conversations that end at a node. A hot node's ids are packed in many tasks."""
    last = steps.filter("last").select("key", "conv").repartitionByRange("key", "conv").sortWithinPartitions("key", "conv")
    runs = last.mapInArrow(packed, "key binary, first long, ids string")
    return runs.repartition("key").sortWithinPartitions("key", "first").mapInArrow(hashed, "key binary, ends string")


# ---- the trie --------------------------------------------------------------------
def trie(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row for each distinct sequence of first turns of the rebuilt conversations. Starts jobs.

    (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256)
    """
    turns = cut(turn_rows(df, conv, turn, role, text), "turns")
    ordered = rebuilt(turns).repartition("conv").sortWithinPartitions("conv", "part", "at")
    steps = cut(ordered.mapInArrow(chained, STEP), "trie-steps")
    alone = steps.groupBy("key", "parent", "depth", "chars").agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv").alias("conv_id"))
    alone = cut(alone, "trie-keys")
    below = alone.filter(F.col("parent").isNotNull()).groupBy(F.col("parent").alias("key")).agg(
        F.count(F.lit(1)).alias("n_children"), F.count_if(F.col("n_convs") == 1).alias("tails"))
    zero = F.lit(0).cast("long")
    nodes = cut(alone.join(below, "key", "left").withColumns({"n_children": F.coalesce("n_children", zero), "tails": F.coalesce("tails", zero)}), "trie-nodes")
    up = nodes.filter(F.col("n_children") > 0).select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    out = nodes.join(shape(steps, nodes), "key", "left").join(ends(steps), "key", "left").join(up, "parent", "left")
    return out.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.coalesce("n_leaves", F.lit(1).cast("long")).alias("n_leaves"),
        F.coalesce("saved", zero).alias("saved_tokens"), F.coalesce("ends", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))
