"""Whitening of embeddings: spectral divide and conquer by polar decompositions, then one broadcast matrix.

Entries become integers, so counts, sums and deviations are exact. The
covariance is gathered in one pass over the distinct vectors; its eigenvectors
come from QDWH polar factors of the shifted matrix: (U + I) / 2 projects on the
eigenvalues above the shift, and each side is split again until it is one
component. Only matrices of the vectors' length squared leave the executors.

Defined cases: a null vector, one with a null or non-finite entry and an empty
one are left out; so are vectors whose length is not the most frequent one
(ties: the greater). Entries beyond +-2**34 count as that bound. Components
without variance do not exist, so constant data have no rows, as has an empty
table. Null ids and repeated rows are kept as they are.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.tables import cut

SCALE, SHIFT, BOUND = 64, 1_000_000, 2.0**40
EPS = float(np.finfo(float).eps)
LONG = 2**63


# ---- the matrix ------------------------------------------------------------------
def polar(a: np.ndarray) -> np.ndarray:
    """Orthogonal polar factor of a symmetric matrix by the QR form of dynamically weighted Halley steps."""
    size = len(a)
    x, eye = a / np.linalg.norm(a), np.eye(size)
    try:  # a lower bound of the smallest singular value
        least = 0.9 / np.linalg.norm(np.linalg.inv(x))
    except np.linalg.LinAlgError:
        least = EPS
    least = min(max(least, EPS), 1.0)
    for _ in range(40):
        root = np.cbrt(4 * (1 - least**2) / least**4)
        g = np.sqrt(1 + root)
        wa = g + 0.5 * np.sqrt(max(8 - 4 * root + 8 * (2 - least**2) / (least**2 * g), 0.0))
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        q = np.linalg.qr(np.vstack([np.sqrt(wc) * x, eye]))[0]
        after = wb / wc * x + (wa - wb / wc) / np.sqrt(wc) * (q[:size] @ q[size:].T)
        after = (after + after.T) / 2
        least = min(least * (wa + wb * least**2) / (1 + wc * least**2), 1.0)
        moved, x = np.linalg.norm(after - x), after
        if moved <= (5 * EPS) ** (1 / 3) and 1 - least <= 10 * EPS:
            break
    return x


def _bases(a: np.ndarray, shift: float, rng: np.random.Generator):
    """Orthonormal bases of the invariant subspaces above and below the shift, or None if one of them is empty."""
    size = len(a)
    up = (polar(a - shift * np.eye(size)) + np.eye(size)) / 2
    k = int(round(np.trace(up)))
    if not 0 < k < size:
        return None
    down = np.eye(size) - up
    high, low = rng.standard_normal((size, k)), rng.standard_normal((size, size - k))
    for _ in range(3):
        high, low = np.linalg.qr(up @ high)[0], np.linalg.qr(down @ low)[0]
    both = np.linalg.qr(np.hstack([high, low]))[0]
    return both[:, :k], both[:, k:]


def eigen(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues falling, unit eigenvectors in columns) of a symmetric matrix, by recursive splitting."""
    scale, rng = max(float(np.linalg.norm(a)), np.finfo(float).tiny), np.random.default_rng(7)
    values, vectors, todo = [], [], [(a, np.eye(len(a)))]
    while todo:
        m, basis = todo.pop()
        size, mean = len(m), float(np.trace(m)) / len(m)
        spread = np.linalg.norm(m - mean * np.eye(size))
        if size == 1 or spread <= 2 * EPS * scale:  # one component, or one eigenvalue for all of the subspace
            values += [float(x) for x in np.diag(m)]
            vectors.append(basis)
            continue
        diagonal, best = np.sort(np.diag(m)), None
        # a shift that lies on an eigenvalue leaves a residual, so the next one is tried
        shifts = [float(np.median(diagonal)), mean, *(mean + f * spread / size for f in (0.1, -0.1, 0.37, -0.37, 0.7, -0.7, 0.03, -0.03))]
        for shift in shifts:
            parts = _bases(m, shift, rng)
            if parts is None:
                continue
            off = float(np.linalg.norm(parts[1].T @ m @ parts[0]))
            if best is None or off < best[0]:
                best = (off, parts)
            if off <= 10 * EPS * scale:
                break
        if best is None:
            raise np.linalg.LinAlgError("no shift separates the spectrum")
        for part in best[1]:
            inner = part.T @ m @ part
            todo.append(((inner + inner.T) / 2, basis @ part))
    values, vectors = np.array(values), np.hstack(vectors)
    order = np.argsort(-values, kind="stable")
    return values[order], vectors[:, order]


# ---- rows ----------------------------------------------------------------------
def usable(vec: str | Column) -> Column:
    v = F.col(vec) if isinstance(vec, str) else vec
    bad = F.exists(v, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf")))
    return v.isNotNull() & (F.size(v) > 0) & ~bad


def scaled(vec: str) -> Column:
    """floor(64 c) + 1000000 of every entry, as long."""
    def one(c):
        return F.floor(F.greatest(F.least(c.cast("double") * SCALE, F.lit(BOUND)), F.lit(-BOUND))) + F.lit(SHIFT)

    return F.transform(vec, one)


def rows_of(df: DataFrame, ident: str, vec: str) -> DataFrame:
    """(id, x) of the rows that take part. Starts a job that counts the lengths."""
    good = df.filter(usable(vec)).select(F.col(ident).alias("id"), scaled(vec).alias("x"))
    length = good.groupBy(F.size("x").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return good.filter(F.size("x") == F.lit(0 if length is None else length["n"]))


def _block(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, size)


def deviations(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S exactly: 64-bit where that holds all values, else Python integers."""
    most = max(int(np.abs(x).max(initial=0)) * n, max(map(abs, sums)))
    if most < 2**62:
        return x * n - np.array(sums, dtype=np.int64)
    return x.astype(object) * n - np.array(sums, dtype=object)


def _squares(d: np.ndarray) -> list[int | None]:
    """Exact sums of squares; null beyond what a long holds."""
    if d.dtype != object and float(np.abs(d).max(initial=0)) ** 2 * d.shape[1] < 2.0**62:
        return (d * d).sum(axis=1).tolist()
    whole = (d.astype(object) ** 2).sum(axis=1)
    return [int(v) if v < LONG else None for v in whole]


@dataclass
class Whitening:
    """What the fit list determines; it is as large as a vector's length times the components."""

    n: int
    sums: list[int]
    values: np.ndarray  # eigenvalues of the components
    vectors: np.ndarray  # length x components
    trace: float
    identity_error: float | None = None

    def project(self, d: np.ndarray) -> np.ndarray:
        return (d.astype(np.float64) / self.n) @ self.vectors / np.sqrt(self.values)


def _products(fit: DataFrame, size: int, to_rows) -> dict[tuple[int, int], float]:
    """Sums over the fit list of the products of what `to_rows` makes of a block; (i, -1) holds plain sums."""

    def partial(batches):
        total = plain = None
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                y = to_rows(_block(batch.column("x").slice(at, 4096), size))
                total, plain = (y.T @ y, y.sum(axis=0)) if total is None else (total + y.T @ y, plain + y.sum(axis=0))
        if total is not None:
            i, j = np.triu_indices(len(total))
            k = np.arange(len(total))
            yield pa.RecordBatch.from_arrays([
                pa.array(np.concatenate([i, k]), pa.int32()), pa.array(np.concatenate([j, np.full(len(k), -1)]), pa.int32()),
                pa.array(np.concatenate([total[i, j], plain]), pa.float64())], ["i", "j", "v"])

    summed = fit.select("x").mapInArrow(partial, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v"))
    return {(r.i, r.j): r.v for r in summed.collect()}  # (length of a vector) squared, whatever the rows


def _symmetric(cells: dict[tuple[int, int], float], size: int) -> np.ndarray:
    m = np.zeros((size, size))
    for (i, j), v in cells.items():
        if j >= 0:
            m[i, j] = m[j, i] = v
    return m


def fit(rows: DataFrame, components: int = 16) -> Whitening | None:
    """The model of `rows_of`'s rows, each distinct vector counted once; None without rows. Starts jobs.

    The distinct vectors are written once and read by three passes: sums,
    products of centred rows, and the check of the whitened covariance.
    """
    listed = cut(rows.select("x").distinct(), "fit-list")

    def totals(batches):
        n, sums = 0, None
        for batch in batches:
            if batch.num_rows:
                s = _block(batch.column("x"), len(batch.column("x")[0])).sum(axis=0).tolist()
                n, sums = n + batch.num_rows, s if sums is None else [a + b for a, b in zip(sums, s)]
        if sums is not None:
            yield pa.RecordBatch.from_arrays([
                pa.array([-1, *range(len(sums))], pa.int32()), pa.array([Decimal(v) for v in (n, *sums)], pa.decimal128(38, 0))], ["i", "s"])

    found = {r.i: int(r.s) for r in listed.mapInArrow(totals, "i int, s decimal(38,0)").groupBy("i").agg(F.sum("s").cast("decimal(38,0)").alias("s")).collect()}
    if not found:
        return None
    n = found.pop(-1)
    sums = [found[i] for i in range(len(found))]
    size = len(sums)
    v = _symmetric(_products(listed, size, lambda x: deviations(x, n, sums).astype(np.float64) / n), size) / n
    values, vectors = eigen(v)
    real = np.flatnonzero(values > size * EPS * max(values[0], 0.0))[:components]
    model = Whitening(n, sums, values[real], vectors[:, real], float(np.trace(v)))
    if len(real):
        cells = _products(listed, size, lambda x: model.project(deviations(x, n, sums)))
        mean = np.array([cells[(i, -1)] for i in range(len(real))]) / n
        cov = _symmetric(cells, len(real)) / n - np.outer(mean, mean)
        model.identity_error = float(np.abs(cov - np.eye(len(real))).max())
    return model


OUT = "component int, n long, deviation long, whitened double, explained double, identity_error double"


def transform(rows: DataFrame, model: Whitening | None) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error): one row for each row and component."""
    kind = dict(rows.dtypes)["id"]
    if model is None or not len(model.values):
        return rows.sparkSession.createDataFrame([], f"id {kind}, {OUT}")
    sent = rows.sparkSession.sparkContext.broadcast(model)

    def apply(batches):
        m = sent.value
        k, size = len(m.values), len(m.sums)
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                d = deviations(_block(part.column("x"), size), m.n, m.sums)
                each = np.repeat(np.arange(part.num_rows), k)
                yield pa.RecordBatch.from_arrays([
                    part.column("id").take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), part.num_rows)),
                    pa.array(np.full(len(each), m.n)), pa.array(_squares(d), pa.int64()).take(pa.array(each)),
                    pa.array(m.project(d).ravel()), pa.array(np.tile(m.values / m.trace, part.num_rows)),
                    pa.array(np.full(len(each), m.identity_error))],
                    ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.select("id", "x").mapInArrow(apply, f"id {kind}, {OUT}")


def whitened(df: DataFrame, ident: str, vec: str, components: int = 16) -> DataFrame:
    """Fits on the table and whitens all its rows. Starts jobs."""
    rows = rows_of(df, ident, vec)
    return transform(rows, fit(rows, components)).withColumnRenamed("id", ident)
