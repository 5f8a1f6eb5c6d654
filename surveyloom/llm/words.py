"""Words of Arrow text columns as NumPy arrays: whole texts, many documents at a time.

A word is a maximal run of bytes that the separator table does not mark. UTF-8
keeps ASCII separators out of longer characters, so bytes are enough. Hashes
are 64-bit polynomials over the bytes, finished by a mixing step; they do not
depend on the machine, the batch or the position. A polynomial modulo 2**64
says little of long structured words (two Thue-Morse words of 1,024 letters are
equal to it for every base), so words over LONG bytes are named by BLAKE2b.
"""

from __future__ import annotations

import ctypes
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
SLICE_BYTES = 1 << 20  # documents are taken together up to this many bytes; a longer one alone

SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
# Everything in ASCII that is neither letter nor digit.
PUNCTUATED = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

LONG = 64  # bytes of a word
BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_POWERS: dict[int, np.ndarray] = {}
_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library


def powers(base: int, n: int) -> np.ndarray:
    """base**0 … base**(n-1) modulo 2**64, kept for the next call."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        grown = np.full(max(n, SLICE_BYTES + 1), base, U)
        grown[0] = 1
        have = _POWERS[base] = np.multiply.accumulate(grown)
    return have[:n]


def inverse(base: int) -> int:
    return pow(base, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every bit over all 64 (a bijection)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def range_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = BASE) -> np.ndarray:
    """A hash of each values[start:end], the same wherever the range lies."""
    total = np.zeros(len(values) + 1, U)
    np.cumsum(values * powers(base, len(values)), out=total[1:], dtype=U)
    return mix((total[ends] - total[starts]) * powers(inverse(base), len(values) + 1)[starts] + (ends - starts).astype(U))


@dataclass
class Words:
    """Words of the rows [row, row + rows) of a batch; `of[i]:of[i+1]` are the words of its i-th row."""

    row: int
    rows: int
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    of: np.ndarray
    bounds: np.ndarray  # byte offsets of the rows in data

    def hashes(self, lower: bool = False) -> np.ndarray:
        data = LOWER[self.data] if lower else self.data
        out = range_hash(data.astype(U), self.starts, self.ends)
        for i in np.flatnonzero(self.ends - self.starts > LONG):
            out[i] = int.from_bytes(hashlib.blake2b(data[self.starts[i] : self.ends[i]], digest_size=8).digest(), "little")
        return out

    def counts(self) -> np.ndarray:
        return np.diff(self.of)

    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(self.rows), self.counts())


def give_back() -> None:
    """Returns freed memory to the system: Python workers live on after their tasks."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


def text_array(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """One string array without nulls (null: empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column.cast(pa.string()), "")


def pieces(texts: pa.Array, separators: np.ndarray = SPACES) -> Iterator[Words]:
    """Consecutive slices of a text array, each with its words."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64) if len(texts) else np.zeros(1, np.int64)
    raw = texts.buffers()[2] if len(texts) else None
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + SLICE_BYTES, "right")) - 1)
        own = data[offsets[at] : offsets[to]]
        bounds = offsets[at : to + 1] - offsets[at]
        inside = ~separators[own]
        edge = np.zeros(len(own) + 1, bool)
        edge[bounds] = True
        before = np.concatenate(([False], inside[:-1])) if len(own) else inside
        after = np.concatenate((inside[1:], [False])) if len(own) else inside
        starts = np.flatnonzero(inside & (~before | edge[:-1]))
        ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
        yield Words(at, to - at, own, starts, ends, np.searchsorted(starts, bounds), bounds)
        at = to
    give_back()


def windows(hashes: np.ndarray, of: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of `size` words inside one row, and the index of each run's first word."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, U), np.zeros(0, np.int64)
    last = np.repeat(of[1:], np.diff(of))  # end of the row each word belongs to
    first = np.flatnonzero(np.arange(n) + size <= last[:n])
    return range_hash(hashes, first, first + size), first
