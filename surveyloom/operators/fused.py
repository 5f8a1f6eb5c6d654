"""Reciprocal-rank fusion by score histograms, exact over the whole corpus without ranking it.

A first pass over the stored index scores every document for a block of
questions where it lies, adds the scores to histograms (one per question and
list, mergeable by sums) and keeps the best few of each list. A document's rank
is the number of documents in higher bins, which the histogram knows, and those
before it in its own bin, which a second pass counts for the candidates alone.
Neither vectors, postings nor texts are shuffled.

With the first n = 60 + 2k of either list the candidates are complete: whatever
is outside both scores below 2 / (60 + n + 1), the first k of a list above
1 / (60 + k). When only some documents are eligible that argument fails; then
the histograms, which count the eligible as well, bound what the k-th result
reaches and what any bin can reach, and one more pass fetches what lies between.
The number of jobs does not depend on the data.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import cut
from .dense import column_values, matrix, query_blocks, rounded, top
from .sparse import best

RRF_K = 60
HALF, ZERO = 512, 64  # bins of positive and of negative scores; bins of score 0, by id
BINS = 2 * HALF + ZERO + 1
CELLS, PAIRS = 1 << 19, 1 << 20  # scores, and products of weights, held at once
SAMPLE = 4096


class Questions:
    """A block of questions: vectors, and postings by term."""

    def __init__(self, block, query: str):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        self.keys, self.vectors = block.column(query).combine_chunks(), matrix(block.column("vec"))
        lists = block.column("terms").combine_chunks()
        sizes = np.asarray(pc.fill_null(pc.list_value_length(lists), 0), dtype=np.int64)
        coded = lists.flatten().dictionary_encode()
        code = coded.indices.to_numpy(zero_copy_only=False)
        order = np.argsort(code, kind="stable")
        self.terms: pa.Array = coded.dictionary
        self.start = np.concatenate([[0], np.cumsum(np.bincount(code, minlength=len(coded.dictionary)))]).astype(np.int64)
        self.who = np.repeat(np.arange(len(lists)), sizes)[order]
        self.weight = block.column("weights").combine_chunks().flatten().to_numpy(zero_copy_only=False)[order]

    def __len__(self) -> int:
        return len(self.keys)

    def scores(self, rows, digits: int | None):
        """(dense, sparse) of all questions against a slice of index rows."""
        import numpy as np
        import pyarrow.compute as pc

        dense = rounded(self.vectors @ matrix(rows.column("vec"), self.vectors.shape[1]).T, digits)
        lists, count = rows.column("terms"), rows.num_rows
        at = pc.index_in(lists.flatten(), value_set=self.terms)
        used = np.asarray(pc.is_valid(at), dtype=bool)
        sizes = np.asarray(pc.fill_null(pc.list_value_length(lists), 0), dtype=np.int64)
        row = np.repeat(np.arange(count), sizes)[used]
        weight = rows.column("weights").flatten().to_numpy(zero_copy_only=False)[used]
        at = at.drop_null().to_numpy(zero_copy_only=False)
        many = self.start[at + 1] - self.start[at]
        ends = np.cumsum(many)
        sums, a = np.zeros(len(self) * count), 0
        while a < len(many):  # a bounded number of products at a time
            b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + PAIRS, "right")))
            n = many[a:b]
            each = np.repeat(np.arange(a, b), n)
            place = self.start[at[each]] + np.arange(len(each)) - np.repeat(np.cumsum(n) - n, n)
            sums += np.bincount(self.who[place] * count + row[each], self.weight[place] * weight[each], minlength=len(sums))
            a = b
        return dense, rounded(sums.reshape(len(self), count), digits)


def bins(scores, ids, borders):
    """Bins in the order of (score falling, id): positive scores, zeros by the given borders of ids, negative scores."""
    import numpy as np

    s = np.clip(scores, -1.0, 1.0)
    out = np.where(s > 0, np.minimum((1.0 - s) * HALF, HALF - 1), HALF + ZERO - s * HALF).astype(np.int64)
    zero = scores == 0
    if zero.any():
        out[zero] = HALF + np.broadcast_to(np.searchsorted(borders, ids, "right"), scores.shape)[zero]
    return out


def _slices(batches, doc: str, count: int):
    """(rows, ids) in slices that keep a score matrix for `count` questions bounded."""
    step = max(1, CELLS // max(count, 1))
    for batch in batches:
        for at in range(0, batch.num_rows, step):
            rows = batch.slice(at, step)
            yield rows, column_values(rows.column(doc))


def _scanned(batches, asked: Questions, doc: str, borders, digits: int | None):
    """(rows, ids, eligible, scores of both lists, bins of both lists) slice by slice."""
    import numpy as np

    for rows, ids in _slices(batches, doc, len(asked)):
        both = asked.scores(rows, digits)
        able = np.asarray(column_values(rows.column("eligible")), dtype=bool)
        yield rows, ids, able, both, [bins(s, ids, borders) for s in both]


def _borders(index: DataFrame, doc: str):
    """At most ZERO - 1 ids that cut the corpus into about equal parts, from a sample; any borders give right ranks."""
    import numpy as np

    every = max(1, index.select(doc).count() // SAMPLE)
    some = index.select(doc).filter(F.pmod(F.xxhash64(doc), F.lit(every)) == 0).limit(4 * SAMPLE).toArrow()
    ids = np.sort(column_values(some.column(doc)))
    return ids[np.linspace(0, len(ids) - 1, ZERO + 1).astype(int)[1:-1]] if len(ids) else ids


class _Known:
    """What the merged histograms say of a block: documents above each bin, and bounds of fused scores."""

    def __init__(self, rows, count: int, k: int, n: int):
        import numpy as np

        held = np.zeros((2, count, BINS), dtype=np.int64)
        able = np.zeros_like(held)
        col = lambda c: rows.column(c).to_numpy()
        at = (col("_list"), col("_q"), col("_bin"))
        held[at], able[at] = col("_n"), col("_able")
        self.above = np.cumsum(held, axis=2) - held
        reach, total = np.cumsum(able, axis=2), held[0].sum(axis=1)
        # k eligible documents of a list lie no lower than this, whatever the other list says of them
        enough = reach >= k
        last = np.take_along_axis(np.cumsum(held, axis=2), enough.argmax(axis=2)[..., None], axis=2)[..., 0]
        sure = 1.0 / (RRF_K + last) + 1.0 / (RRF_K + total)
        self.floor = np.where(enough.any(axis=2), sure, 0.0).max(axis=0)
        # eligible documents outside the first n of both lists come after n of them in either
        nth = np.take_along_axis(self.above, (reach >= n).argmax(axis=2)[..., None], axis=2)[..., 0]
        unseen = (1.0 / (RRF_K + 1 + nth)).sum(axis=0)
        self.open = (reach[:, :, -1] > n).any(axis=0) & (unseen >= self.floor)

    def reach(self, places):
        """The most that documents of these bins can score: places[list] is (questions, documents)."""
        import numpy as np

        return sum(1.0 / (RRF_K + 1 + np.take_along_axis(self.above[i], p, axis=1)) for i, p in enumerate(places))


PLACES = "dense_score double, sparse_score double, dense_bin int, sparse_bin int"


def _rows_out(keys, query, doc, found, kind):
    """Candidate rows from (question, ids, both scores, both bins) pieces."""
    import numpy as np
    import pyarrow as pa

    if not found:
        return
    q, ids, d, s, bd, bs = (np.concatenate([f[i] for f in found]) for i in range(6))
    yield pa.RecordBatch.from_arrays(
        [keys.take(pa.array(q)), pa.array(ids, kind), pa.array(d), pa.array(s), pa.array(bd, pa.int32()), pa.array(bs, pa.int32())],
        [query, doc, "dense_score", "sparse_score", "dense_bin", "sparse_bin"])


def _first_pass(index, sent, borders, query, doc, types, n, digits):
    """Histogram rows (_list, _q, _bin, _n, _able) and, with _list -2 and -1, each task's n best eligible rows of the dense and the sparse list."""

    def scan(batches):
        import numpy as np
        import pyarrow as pa

        asked = sent.value
        held = np.zeros((2, 2, len(asked), BINS), dtype=np.int64)
        keep, kind = [[[] for _ in range(len(asked))] for _ in range(2)], None
        base = np.arange(len(asked))[:, None] * BINS
        for rows, ids, able, both, places in _scanned(batches, asked, doc, borders, digits):
            kind, may = rows.column(doc).type, np.flatnonzero(able)
            for i in range(2):
                for j, which in enumerate((slice(None), may)):
                    held[i, j] += np.bincount((base + places[i][:, which]).ravel(), minlength=len(asked) * BINS).reshape(len(asked), BINS)
                for q in range(len(asked)):
                    t = may[top(both[i][q, may], ids[may], n)]
                    keep[i][q].append((np.full(len(t), q), ids[t], both[0][q, t], both[1][q, t], places[0][q, t], places[1][q, t]))
                    if len(keep[i][q]) > 8:
                        keep[i][q] = [_best_of(keep[i][q], i, n)]
        if kind is None:
            return
        names = ["_list", "_q", "_bin", "_n", "_able", query, doc, "dense_score", "sparse_score", "dense_bin", "sparse_bin"]
        lists, q, b = np.nonzero(held[:, 0])
        nothing = [pa.nulls(len(q), t) for t in (asked.keys.type, kind, pa.float64(), pa.float64(), pa.int32(), pa.int32())]
        yield pa.RecordBatch.from_arrays([
            pa.array(lists, pa.int32()), pa.array(q, pa.int32()), pa.array(b, pa.int32()), pa.array(held[lists, 0, q, b]), pa.array(held[lists, 1, q, b]), *nothing], names)
        for i in range(2):
            for out in _rows_out(asked.keys, query, doc, [_best_of(p, i, n) for p in keep[i] if p], kind):
                m = out.num_rows
                yield pa.RecordBatch.from_arrays([pa.array(np.full(m, i - 2), pa.int32()), pa.nulls(m, pa.int32()), pa.nulls(m, pa.int32()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64()), *out.columns], names)

    return index.mapInArrow(scan, f"_list int, _q int, _bin int, _n long, _able long, {types}, {PLACES}")


def _best_of(pieces, which: int, n: int):
    """The n best of candidate pieces by one list."""
    import numpy as np

    all_ = [np.concatenate([p[i] for p in pieces]) for i in range(6)]
    t = top(all_[2 + which], all_[1], n)
    return tuple(a[t] for a in all_)


def _fetch(index, sent, known, borders, query, doc, types, digits):
    """Eligible rows of the open questions whose bins can reach what the k-th result reaches."""

    def scan(batches):
        import numpy as np

        asked, facts = sent.value, known.value
        for rows, ids, able, both, places in _scanned(batches, asked, doc, borders, digits):
            q, d = np.nonzero(facts.open[:, None] & able[None, :] & (facts.reach(places) >= facts.floor[:, None]))
            if len(q):
                yield from _rows_out(asked.keys, query, doc, [(q, ids[d], both[0][q, d], both[1][q, d], places[0][q, d], places[1][q, d])], rows.column(doc).type)

    return index.mapInArrow(scan, f"{types}, {PLACES}")


class Ahead:
    """Counts, for the candidates of one question in one list, the documents before each in its own bin.

    A candidate's key says where it stands by (score falling, id); a document is
    before all candidates from the first key that is not below its own. Bins
    follow the same order, so those of earlier bins are taken off at the end.
    """

    def __init__(self, names, values, at):
        import numpy as np

        self.ids, self.values, self.at = np.unique(names), np.unique(-values), at
        keys = np.searchsorted(self.values, -values) * (len(self.ids) + 1) + np.searchsorted(self.ids, names)
        order = np.argsort(keys)
        self.keys, self.place = keys[order], np.argsort(order)
        self.before, self.inside = np.zeros(len(keys) + 1, dtype=np.int64), np.zeros(BINS, dtype=np.int64)
        self.hot = np.zeros(BINS, dtype=bool)
        self.hot[at] = True

    def see(self, scores, ids, places) -> None:
        import numpy as np

        d = np.flatnonzero(self.hot[places])
        if not len(d):
            return
        p = np.searchsorted(self.values, -scores[d])
        ties = self.values[np.minimum(p, len(self.values) - 1)] == -scores[d]
        own = p * (len(self.ids) + 1) + np.where(ties, np.searchsorted(self.ids, ids[d], "right"), 0)
        self.before += np.bincount(np.searchsorted(self.keys, own), minlength=len(self.before))
        self.inside += np.bincount(places[d], minlength=BINS)

    def counts(self):
        import numpy as np

        return np.cumsum(self.before)[self.place] - (np.cumsum(self.inside) - self.inside)[self.at]


def _second_pass(index, sent, wanted, borders, query, doc, types, digits):
    """(query, doc, _list, _ahead): documents before a candidate in its own bin, counted in each task."""

    def scan(batches):
        import numpy as np
        import pyarrow as pa

        asked, by_question, kind = sent.value, wanted.value, None
        ahead = [[Ahead(names, values[i], at[i]) for names, values, at in by_question] for i in range(2)]
        for rows, ids, _, both, places in _scanned(batches, asked, doc, borders, digits):
            kind = rows.column(doc).type
            for i in range(2):
                for q, counted in enumerate(ahead[i]):
                    counted.see(both[i][q], ids, places[i][q])
        if kind is None:
            return
        for i in range(2):
            for q, counted in enumerate(ahead[i]):
                n = counted.counts()
                some = np.flatnonzero(n)
                if len(some):
                    yield pa.RecordBatch.from_arrays([
                        asked.keys.take(pa.array(np.full(len(some), q))), pa.array(by_question[q][0][some], kind), pa.array(np.full(len(some), i), pa.int32()), pa.array(n[some])],
                        [query, doc, "_list", "_ahead"])

    return index.mapInArrow(scan, f"{types}, _list int, _ahead long")


def _by_question(table, keys, query: str, doc: str):
    """Per question of the block: candidate ids, their two scores and two bins."""
    import numpy as np
    import pyarrow.compute as pc

    q = pc.index_in(table.column(query).combine_chunks(), value_set=keys).to_numpy()
    ids, scores, at = column_values(table.column(doc)), [table.column(c).to_numpy() for c in ("dense_score", "sparse_score")], [table.column(c).to_numpy() for c in ("dense_bin", "sparse_bin")]
    order = np.argsort(q, kind="stable")
    edges = np.searchsorted(q[order], np.arange(len(keys) + 1))
    parts = [order[a:b] for a, b in zip(edges, edges[1:])]
    return [(ids[p], [s[p] for s in scores], [b[p] for b in at]) for p in parts]


CANDIDATES = 1 << 20  # that are counted in one pass


def fused_top_k(
    queries: DataFrame, index: DataFrame, query: str, doc: str, k: int, eligible: Column | None = None, digits: int | None = None,
) -> DataFrame:
    """(query, doc, dense_score, sparse_score, dense_rank, sparse_rank, score, rank). Starts jobs for each block of questions.

    queries(query, vec, terms, weights), index(doc, vec, terms, weights), ids
    distinct. `eligible` restricts what may be returned but not what is ranked.
    """
    corpus = index.withColumn("eligible", F.lit(True) if eligible is None else F.coalesce(eligible, F.lit(False))).select(doc, "vec", "terms", "weights", "eligible")
    spark, kinds = corpus.sparkSession, dict(corpus.dtypes)
    types = f"`{query}` {dict(queries.dtypes)[query]}, `{doc}` {kinds[doc]}"
    n, borders, out = RRF_K + 2 * k, _borders(corpus, doc), []
    size = F.size("vec") * 8 + F.size("terms") * 24
    for block in query_blocks(queries.select(query, "vec", "terms", "weights"), query, size):
        asked = Questions(block, query)
        sent = spark.sparkContext.broadcast(asked)
        first = cut(_first_pass(corpus, sent, borders, query, doc, types, n, digits), "histograms")
        merged = first.filter(F.col("_list") >= 0).groupBy("_list", "_q", "_bin").agg(F.sum("_n").alias("_n"), F.sum("_able").alias("_able"))
        facts = _Known(merged.toArrow(), len(asked), k, n)  # questions of a block x bins
        by = F.when(F.col("_list") == -2, F.col("dense_score")).otherwise(F.col("sparse_score"))
        w = Window.partitionBy(query, "_list").orderBy(F.desc("_by"), doc)
        listed = first.filter(F.col("_list") < 0).withColumn("_by", by).withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= n)
        near = listed.select(query, doc, "dense_score", "sparse_score", "dense_bin", "sparse_bin")
        if eligible is not None and facts.open.any():
            near = near.unionByName(_fetch(corpus, sent, spark.sparkContext.broadcast(facts), borders, query, doc, types, digits))
        out.append(_ranked(corpus, near.dropDuplicates([query, doc]), asked, sent, facts, borders, query, doc, types, digits))
    empty = f"{types}, dense_score double, sparse_score double, dense_rank long, sparse_rank long"
    fused = out[0] if out else spark.createDataFrame([], empty)
    for more in out[1:]:
        fused = fused.unionByName(more)
    fused = fused.withColumn("score", F.lit(1.0) / (F.lit(RRF_K) + F.col("dense_rank")) + F.lit(1.0) / (F.lit(RRF_K) + F.col("sparse_rank")))
    return best(fused, query, doc, k)


def _ranked(corpus, near, asked, sent, facts, borders, query, doc, types, digits):
    """Candidates with exact ranks: higher bins from the histograms, the own bin from a pass for each CANDIDATES of them."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    spark, rows = corpus.sparkSession, None
    found, schema = cut(near, "candidates"), f"{types}, dense_score double, sparse_score double, _d long, _s long"
    parts = max(1, math.ceil(found.count() / CANDIDATES))
    for i in range(parts):
        table = (found if parts == 1 else found.filter(F.pmod(F.xxhash64(query, doc), F.lit(parts)) == i)).toArrow().combine_chunks()
        wanted = spark.sparkContext.broadcast(_by_question(table, asked.keys, query, doc))
        q = np.asarray(pc.index_in(table.column(query), value_set=asked.keys).combine_chunks() if table.num_rows else [], dtype=np.int64)
        above = [pa.array(facts.above[j][q, table.column(c).to_numpy()] + 1) for j, c in enumerate(("dense_bin", "sparse_bin"))]
        placed = pa.table([*table.columns[:4], *above], names=[query, doc, "dense_score", "sparse_score", "_d", "_s"])
        none = F.lit(None).cast("double")
        ahead = _second_pass(corpus, sent, wanted, borders, query, doc, types, digits).select(
            query, doc, none.alias("dense_score"), none.alias("sparse_score"),
            *[F.when(F.col("_list") == j, F.col("_ahead")).otherwise(0).alias(c) for j, c in enumerate(("_d", "_s"))])
        both = spark.createDataFrame(placed, schema).unionByName(ahead)
        rows = both if rows is None else rows.unionByName(both)
    return rows.groupBy(query, doc).agg(
        F.max("dense_score").alias("dense_score"), F.max("sparse_score").alias("sparse_score"), F.sum("_d").alias("dense_rank"), F.sum("_s").alias("sparse_rank"))
