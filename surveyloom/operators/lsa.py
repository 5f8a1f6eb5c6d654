"""Latent semantic vectors: truncated SVD of the TF-IDF rows by a randomized range finder.

The range of the terms x dimensions side is found from random vectors by passes
over the rows: each task multiplies its rows with the current basis and sends
the sums back per term. A tall-skinny QR of the projected documents (one
triangle per task, merged in a tree) gives the singular vectors in that basis.
Only matrices of max_features x dimensions, which the model is anyway, meet in
one place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import cut
from .terms import Terms, fit_vocabulary, text_weights

OVERSAMPLE, PASSES = 32, 6
MERGED = 16  # triangles that one task of the tree merges
CELLS = 1 << 18  # products held at once, few enough for a core's cache


def _postings(batch):
    """(row, term, weight) of a batch of rows, and how many terms each row has."""
    import numpy as np
    import pyarrow.compute as pc

    sizes = np.asarray(pc.fill_null(pc.list_value_length(batch.column("terms")), 0), dtype=np.int64)
    at = batch.column("terms").flatten().to_numpy(zero_copy_only=False)
    return np.repeat(np.arange(len(sizes)), sizes), at, batch.column("weights").flatten().to_numpy(zero_copy_only=False), sizes


def _projected(batch, basis):
    """The batch's rows times the basis, a row, or a bounded part of a very long one, at a time."""
    import numpy as np

    _, at, weight, sizes = _postings(batch)
    out, weight, ends = np.zeros((len(sizes), basis.shape[1]), dtype=basis.dtype), weight.astype(basis.dtype), np.cumsum(sizes)
    step = max(1, CELLS // basis.shape[1])
    for i in np.flatnonzero(sizes):
        for c in range(ends[i] - sizes[i], ends[i], step):
            d = min(c + step, ends[i])
            out[i] += weight[c:d] @ basis[at[c:d]]
    return out


def _triangle(parts):
    import numpy as np

    return np.linalg.qr(np.vstack(parts), mode="r")


def _multiplied(rows: DataFrame, sent, size: int):
    """A'(A Z) in single precision: sums over the rows, sent back per term and added where terms meet.

    Each task sends as much as a model, so there are a few for each core, whatever the rows.
    """
    import numpy as np

    def spread(batches):
        import pyarrow as pa

        basis = sent.value
        total = seen = None
        for batch in batches:
            if total is None:
                total, seen = np.zeros(basis.shape, dtype=np.float32), np.zeros(len(basis), dtype=bool)
            y = _projected(batch, basis)
            row, at, weight, _ = _postings(batch)
            order = np.argsort(at, kind="stable")
            row, at, weight = row[order], at[order], weight[order].astype(basis.dtype)
            step = max(1, CELLS // basis.shape[1])
            for a in range(0, len(at), step):
                part = at[a : a + step]
                starts = np.flatnonzero(np.concatenate([[True], np.diff(part) != 0]))
                total[part[starts]] += np.add.reduceat(weight[a : a + step, None] * y[row[a : a + step]], starts)
                seen[part] = True
        if total is not None:
            used = np.flatnonzero(seen)
            for a in range(0, len(used), 4096):
                u = used[a : a + 4096]
                data = np.ascontiguousarray(total[u])
                yield pa.RecordBatch.from_arrays([pa.array(u, pa.int32()), pa.array([r.tobytes() for r in data], pa.binary())], ["term", "sums"])

    def add(batches):
        import pyarrow as pa

        now, total = None, None
        for batch in batches:
            done = []
            for term, sums in zip(batch.column("term").to_pylist(), batch.column("sums")):
                values = np.frombuffer(sums.as_buffer(), dtype=np.float32)
                if term == now:
                    total = total + values
                else:
                    if now is not None:
                        done.append((now, total.tobytes()))
                    now, total = term, values
            if done:
                yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.int32()), pa.array([d[1] for d in done], pa.binary())], ["term", "sums"])
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["term", "sums"])

    few = rows.coalesce(2 * rows.sparkSession.sparkContext.defaultParallelism)
    parts = few.mapInArrow(spread, "term int, sums binary").repartition("term").sortWithinPartitions("term")
    out = np.zeros((size, sent.value.shape[1]))
    for batch in parts.mapInArrow(add, "term int, sums binary").toArrow().to_batches():  # at most one row for each term of the vocabulary
        for term, sums in zip(batch.column("term").to_pylist(), batch.column("sums")):
            out[term] = np.frombuffer(sums.as_buffer(), dtype=np.float32)
    return out


def _tall_qr(rows: DataFrame, sent):
    """R of the QR decomposition of A Z: one triangle per task, merged MERGED at a time until one is left."""
    import numpy as np

    def first(batches):
        import pyarrow as pa

        r = None
        for batch in batches:
            y = _projected(batch, sent.value)
            r = _triangle([y] if r is None else [r, y])
        if r is not None:
            yield pa.RecordBatch.from_arrays([pa.array([r.astype(np.float64).tobytes()], pa.binary())], ["r"])

    def merge(batches):
        import pyarrow as pa

        r = None
        for batch in batches:
            for b in batch.column("r"):
                part = np.frombuffer(b.as_buffer()).reshape(-1, width)
                r = _triangle([part] if r is None else [r, part])
        if r is not None:
            yield pa.RecordBatch.from_arrays([pa.array([r.tobytes()], pa.binary())], ["r"])

    width = sent.value.shape[1]
    level = cut(rows.mapInArrow(first, "r binary"), "triangles")
    while (count := level.count()) > MERGED:
        level = cut(level.repartition(-(-count // MERGED)).mapInArrow(merge, "r binary"), "triangles")
    return _triangle([np.frombuffer(r.r).reshape(-1, width) for r in level.collect()])


class LsaModel:
    """A bounded vocabulary, and the right singular vectors (terms x dimensions) of the corpus.

    Vectors are unique only up to sign and rotation; compare cosines.
    """

    def __init__(self, vocab: DataFrame, v, stop: Sequence[str]):
        self.vocab, self.v, self.stop = vocab, v, list(stop)

    @classmethod
    def fit(cls, docs: DataFrame, key: str, text: str, dimensions: int = 256, stop: Sequence[str] = (),
            max_features: int = 50_000) -> LsaModel:
        """Starts jobs: PASSES passes over the weighted rows, which are written once."""
        vocab = cut(fit_vocabulary(docs, key, text, stop, max_features), "vocabulary")
        return cls.of_rows(text_weights(docs, key, text, stop, Terms.of(vocab)), vocab, dimensions, stop)

    @classmethod
    def of_rows(cls, rows: DataFrame, vocab: DataFrame, dimensions: int, stop: Sequence[str]) -> LsaModel:
        """The model of weighted rows. Starts jobs."""
        import numpy as np

        every = cut(rows.select("terms", "weights"), "weighted-rows")
        spark, size, n = every.sparkSession, vocab.count(), every.count()
        rows = every.filter(F.size("terms") > 0)
        k = max(1, min(dimensions, n - 1, size - 1))
        width = max(1, min(k + OVERSAMPLE, n, size))
        if not size or rows.isEmpty():
            return cls(vocab, np.zeros((size, dimensions)), stop)
        basis = np.linalg.qr(np.random.default_rng(11).standard_normal((size, width)))[0]
        for _ in range(PASSES):
            sent = spark.sparkContext.broadcast(basis.astype(np.float32))
            basis = np.linalg.qr(_multiplied(rows, sent, size))[0]
            sent.destroy()
        sent = spark.sparkContext.broadcast(basis)
        turn = np.linalg.svd(_tall_qr(rows, sent))[2]
        sent.destroy()
        return cls(vocab, basis @ turn[:k].T, stop)

    def save(self, path: str) -> None:
        """Vocabulary, one row of the matrix per position, and the stop words."""
        import pyarrow as pa

        spark, base = self.vocab.sparkSession, path.rstrip("/")
        self.vocab.write.mode("overwrite").parquet(f"{base}/vocabulary")
        size, width = self.v.shape
        lists = pa.FixedSizeListArray.from_arrays(pa.array(self.v.ravel()), width).cast(pa.list_(pa.float64()))
        table = pa.table({"position": pa.array(range(size), pa.int32()), "components": lists})
        spark.createDataFrame(table).write.mode("overwrite").parquet(f"{base}/components")
        spark.createDataFrame([(w,) for w in self.stop], "word string").write.mode("overwrite").parquet(f"{base}/stop")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> LsaModel:
        import numpy as np

        base = path.rstrip("/")
        table = spark.read.parquet(f"{base}/components").orderBy("position").toArrow().combine_chunks()
        flat = table.column("components").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        stop = [r.word for r in spark.read.parquet(f"{base}/stop").collect()]
        return cls(spark.read.parquet(f"{base}/vocabulary"), flat.reshape(table.num_rows, -1) if table.num_rows else np.zeros((0, 1)), stop)

    def embed(self, docs: DataFrame, key: str, text: str) -> DataFrame:
        """(key, vec): unit vectors of the documents in the model's space; zeros where no term is known."""
        return self.embed_rows(text_weights(docs, key, text, self.stop, Terms.of(self.vocab)), key)

    def embed_rows(self, rows: DataFrame, key: str) -> DataFrame:
        """(key, vec) of weighted rows in the model's vocabulary."""
        sent = rows.sparkSession.sparkContext.broadcast(self.v)

        def project(batches):
            import numpy as np
            import pyarrow as pa

            for batch in batches:
                out = _projected(batch, sent.value)
                length = np.linalg.norm(out, axis=1, keepdims=True)
                unit = np.divide(out, length, out=np.zeros_like(out), where=length > 0).astype(np.float32)
                offsets = pa.array(np.arange(len(unit) + 1) * unit.shape[1], pa.int32())
                yield pa.RecordBatch.from_arrays([batch.column(key), pa.ListArray.from_arrays(offsets, pa.array(unit.ravel()))], [key, "vec"])

        return rows.select(key, "terms", "weights").mapInArrow(project, f"`{key}` {dict(rows.dtypes)[key]}, vec array<float>")
