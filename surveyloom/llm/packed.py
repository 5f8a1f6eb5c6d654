"""Sorted 64-bit keys as compact blobs: a shuffle of numbers costs bytes, not rows.

Keys are dealt to ranges by their top bits. Each task sends one blob per range
and batch: differences of sorted keys, split into byte planes and compressed,
with values beside them. Ranges grow in number with the shuffle partitions.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .words import U, give_back

BLOB = "part int, blob binary"


def ranges(spark: SparkSession) -> int:
    """Number of key ranges: a power of two of at least the shuffle partitions."""
    return 1 << (int(spark.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length()


def pack(keys: np.ndarray, *values: np.ndarray) -> bytes:
    """One blob of sorted 64-bit keys and equally long arrays."""
    steps = np.diff(keys, prepend=U(0))
    planes = np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes()
    body = planes + b"".join(np.ascontiguousarray(v).tobytes() for v in values)
    return len(keys).to_bytes(4, "little") + len(body).to_bytes(8, "little") + pa.compress(body, "zstd", asbytes=True)


def unpack(blob: bytes, *kinds: type) -> list[np.ndarray]:
    n, size = int.from_bytes(blob[:4], "little"), int.from_bytes(blob[4:12], "little")
    body = pa.decompress(blob[12:], size, "zstd", asbytes=True)
    steps = np.ascontiguousarray(np.frombuffer(body, np.uint8, 8 * n).reshape(8, n).T).reshape(-1).view(U)
    out, at = [np.cumsum(steps, dtype=U)], 8 * n
    for kind in kinds:
        out.append(np.frombuffer(body, kind, n, at))
        at += n * np.dtype(kind).itemsize
    return out


def dealt(keys: np.ndarray, parts: int, *values: np.ndarray) -> pa.RecordBatch:
    """Rows (part, blob) of keys in any order."""
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], [v[order] for v in values]
    part = (keys >> U(64 - (parts.bit_length() - 1))).astype(np.int64) if parts > 1 else np.zeros(len(keys), np.int64)
    cuts = np.searchsorted(part, np.arange(parts + 1))
    own = [p for p in range(parts) if cuts[p] < cuts[p + 1]]
    blobs = [pack(keys[cuts[p] : cuts[p + 1]], *(v[cuts[p] : cuts[p + 1]] for v in values)) for p in own]
    return pa.RecordBatch.from_arrays([pa.array(own, pa.int32()), pa.array(blobs, pa.binary())], ["part", "blob"])


def gathered(table: pa.Table, *kinds: type) -> list[np.ndarray]:
    """The keys of all blobs of a range, sorted, with their values."""
    found = [unpack(b.as_py(), *kinds) for b in table.column("blob")]
    arrays = [np.concatenate([f[i] for f in found]) for i in range(1 + len(kinds))]
    del found
    order = np.argsort(arrays[0], kind="stable")
    return [a[order] for a in arrays]


def in_ranges(blobs: DataFrame, work, schema: str) -> DataFrame:
    """`work(table)` of each range's blobs; a range is a bounded share of the keys."""

    def run(table: pa.Table) -> pa.Table:
        out = work(table)
        give_back()
        return out

    return blobs.groupBy("part").applyInArrow(run, schema)


def groups(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, size) of runs of equal sorted keys."""
    if len(keys) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    start = np.concatenate(([0], np.flatnonzero(keys[1:] != keys[:-1]) + 1))
    return start, np.diff(np.append(start, len(keys)))
