"""Nearest neighbours by cosine: a vantage-point tree in each shard, searched by streams of queries.

On unit vectors the distance d = sqrt(2 - 2 cos) is a metric, so a subtree whose
distances from its vantage point lie in [low, high] holds nothing nearer to a
query at distance v than max(low - v, v - high). It is skipped when `factor`
times that bound exceeds the distance of the query's k-th neighbour so far:
factor 1 is exact, a larger one skips more and finds neighbours within that
factor of the right distances.

Vectors and queries meet in a shuffle by shard. A task holds one shard (about
SHARD_BYTES) and one block of queries; each shard sends k rows for each query.
Scores are sums in the order of the components, so they depend on nothing else.

Defined cases: null, empty and zero vectors, ones with a null or non-finite
component, and rows without an id take no part. Only vectors of one length are
compared. An id stands for one vector: of repeated ids the least vector in
array order. Equal scores go to the smaller id; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import cut

SHARD_BYTES = 4 << 20  # of a shard's vectors as doubles
LEAF, BLOCK = 256, 256  # vectors in a leaf, queries searched together
NEAR = 1e-7  # what rounding may add to a distance
NONE = np.iinfo(np.int64).max


def usable(vec: str | Column) -> Column:
    """Finite components, at least one of them not zero."""
    v = F.col(vec) if isinstance(vec, str) else vec
    bad = F.exists(v, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf")))
    return v.isNotNull() & F.exists(v, lambda c: c.cast("double") != 0.0) & ~bad


# ---- one shard -------------------------------------------------------------------
class Tree:
    """Vectors in tree order; a node halves its vectors by their distance from the one farthest from the first."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.raw, self.norm = _even(vectors)
        self.unit = self.raw / np.sqrt(self.norm)[:, None]
        order = np.arange(len(ids))
        self.nodes: list[tuple] = []  # (start, end, vantage, ((low, high, child), (low, high, child)) or None)
        todo = [(0, len(ids), None)]
        while todo:
            start, end, parent = todo.pop()
            here = len(self.nodes)
            if parent is not None:
                self.nodes[parent[0]][3][parent[1]][2] = here
            if end - start <= LEAF:
                self.nodes.append((start, end, None, None))
                continue
            own = order[start:end]
            first = _distance(self.unit[own] @ self.unit[own[0]])
            vantage = self.unit[own[int(first.argmax())]]
            away = _distance(self.unit[own] @ vantage)
            by = np.argsort(away, kind="stable")
            order[start:end], away = own[by], away[by]
            half = (end - start) // 2
            self.nodes.append((start, end, vantage, ([away[0], away[half - 1], -1], [away[half], away[-1], -1])))
            todo += [(start + half, end, (here, 1)), (start, start + half, (here, 0))]
        self.ids, self.raw, self.norm, self.unit = ids[order], self.raw[order], self.norm[order], self.unit[order]

    def search(self, ids: np.ndarray, vectors: np.ndarray, k: int, factor: float) -> tuple[np.ndarray, np.ndarray, int]:
        """(scores, ids) with k columns, best first, empty places -inf; and how many vectors were compared."""
        raw, norm = _even(vectors)
        unit, count = raw / np.sqrt(norm)[:, None], len(ids)
        best, who = np.full((count, k), -np.inf), np.full((count, k), NONE)
        todo, compared = [(0, np.arange(count), np.zeros(count))], 0
        while todo:
            node, active, bound = todo.pop()
            kth = best[active, -1]
            radius = np.where(np.isfinite(kth), _distance(kth), np.inf)
            active = active[bound * factor <= radius + NEAR]
            if not len(active):
                continue
            start, end, vantage, sides = self.nodes[node]
            if sides is None:
                compared += len(active) * (end - start)
                self._scan(start, end, active, ids, raw, norm, unit, best, who, k)
                continue
            v = _distance(unit[active] @ vantage)
            below = [(child, np.maximum(np.maximum(low - v, v - high), 0.0)) for low, high, child in sides]
            below.sort(key=lambda x: -x[1].mean())  # the nearer side is taken up first
            todo += [(child, active, b) for child, b in below]
        return best, who, compared

    def _scan(self, start, end, active, ids, raw, norm, unit, best, who, k):
        sims = unit[active] @ self.unit[start:end].T
        floor = best[active, -1]
        if end - start > k + 1:  # one of k + 1 may be the query itself
            floor = np.maximum(floor, np.partition(sims, end - start - k - 1, axis=1)[:, end - start - k - 1])
        q, c = np.nonzero(sims >= floor[:, None] - 1e-9)
        keep = ids[active[q]] != self.ids[start + c]
        q, c = active[q[keep]], start + c[keep]
        if not len(q):
            return
        score = _cosine(raw[q], norm[q], self.raw[c], self.norm[c])
        rows = np.unique(q)
        old = np.isfinite(best[rows])
        row = np.concatenate([np.broadcast_to(rows[:, None], old.shape)[old], q])
        score, ident = np.concatenate([best[rows][old], score]), np.concatenate([who[rows][old], self.ids[c]])
        by = np.lexsort((ident, -score, row))
        row, score, ident = row[by], score[by], ident[by]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        top = place < k
        best[row[top], place[top]], who[row[top], place[top]] = score[top], ident[top]


def _even(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each vector times a power of two, which changes no cosine but lets no square overflow; and the squared lengths."""
    raw = np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1))[1][:, None])
    return raw, _summed(raw, raw)


def _summed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    total = np.zeros(len(a))
    for i in range(a.shape[1]):
        total += a[:, i] * b[:, i]
    return total


def _cosine(a, na, b, nb) -> np.ndarray:
    return np.clip(_summed(a, b) / np.sqrt(na * nb), -1.0, 1.0)


def _distance(cos: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2.0 - 2.0 * cos, 0.0))


# ---- all shards ------------------------------------------------------------------
def index(df: DataFrame, ident: str, vec: str) -> DataFrame:
    """(id, vec, length, shards, shard) of the vectors that take part, written once. Starts jobs.

    Shards are cut by a hash of the id, so a group of like vectors makes none larger; their number follows the bytes.
    """
    slim = df.select(F.col(ident).alias("id"), F.col(vec).cast("array<double>").alias("vec"))
    one = slim.filter(F.col("id").isNotNull() & usable("vec")).groupBy("id").agg(F.min("vec").alias("vec"))
    rows = cut(one.withColumn("length", F.size("vec")), "vectors")
    return rows.join(_shards(rows), "length").withColumn("shard", F.pmod(F.xxhash64("id"), "shards"))


def _shards(rows: DataFrame) -> DataFrame:
    """(length, shards): one row for each length of vectors."""
    return rows.groupBy("length").agg(F.ceil(F.count(F.lit(1)) * F.col("length") * 8 / F.lit(SHARD_BYTES)).alias("shards"))


def neighbours(queries: DataFrame, indexed: DataFrame, k: int, factor: float = 1.0) -> DataFrame:
    """(query_id, rank, id, score): for each row of queries(id, vec) the k best of the index but rows of its own id.

    Ids of queries are distinct and not null. Starts a job that counts shards.
    """
    places = _shards(indexed.select("length"))
    parts = int(places.agg(F.sum("shards")).first()[0] or 1)
    asked = queries.filter(usable("vec")).select("id", F.col("vec").cast("array<double>").alias("vec"), F.size("vec").alias("length")).join(places, "length")
    asked = asked.select("length", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1)).alias("shard"), F.lit(1).alias("kind"), "id", "vec")
    points = indexed.select("length", F.col("shard").cast("long").alias("shard"), F.lit(0).alias("kind"), "id", "vec")
    stream = points.union(asked).repartition(parts, "length", "shard").sortWithinPartitions("length", "shard", "kind", "id")

    def search(batches):
        for q, who, score, _ in searched(batches, k, factor):
            yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(who), pa.array(score)], ["query_id", "id", "score"])

    near = stream.mapInArrow(search, "query_id long, id long, score double")
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return near.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).select("query_id", "rank", "id", "score")


def searched(batches: Iterator[pa.RecordBatch], k: int, factor: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
    """(query ids, found ids, scores, vectors compared) block by block, of rows sorted by length, shard and kind (0: indexed, 1: asked)."""
    here, ids, vectors, tree = None, [], [], None
    for batch in batches:
        length, shard, kind = (batch.column(c).to_numpy() for c in ("length", "shard", "kind"))
        turns = np.flatnonzero((np.diff(length) != 0) | (np.diff(shard) != 0) | (np.diff(kind) != 0)) + 1
        for start, end in zip([0, *turns], [*turns, batch.num_rows]):
            if start == end:
                continue
            if (length[start], shard[start]) != here:
                here, ids, vectors, tree = (length[start], shard[start]), [], [], None
            own = batch.column("id").slice(start, end - start).to_numpy()
            block = batch.column("vec").slice(start, end - start).flatten().to_numpy().reshape(end - start, -1)
            if kind[start] == 0:
                ids.append(own)
                vectors.append(block)
                continue
            if tree is None and ids:
                tree, ids, vectors = Tree(np.concatenate(ids), np.concatenate(vectors)), [], []
            for at in range(0, len(own) if tree is not None else 0, BLOCK):
                q = own[at : at + BLOCK]
                score, who, compared = tree.search(q, block[at : at + BLOCK], k, factor)
                real = np.isfinite(score)
                yield np.repeat(q, real.sum(axis=1)), who[real], score[real], compared
