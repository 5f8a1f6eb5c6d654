"""Byte-level BPE: encoding by corpus-level merge replay, and decoding.

Texts are cut by the pre-token pattern. The distinct pre-tokens of an Arrow
batch form one small corpus of byte sequences, linked to their neighbours. An
inverted index from merge rank to the positions of its token pairs is worked
off in rank order: all places of a merge are replaced together, and only the
pairs that touch a replaced place are looked up and indexed again. The ids of
every pre-token are kept by each Python worker for later batches, in a table
of bounded size.

A text's ids are those of its pre-tokens one after another. Null counts as
empty; empty texts have no ids. No special tokens are recognized.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import give_back, text_array

KEPT_WORDS = 100_000  # pre-tokens in each of the two generations a Python worker remembers
CORPUS_CHARS = 4_000_000  # texts whose new pre-tokens are merged together


class Ranks:
    """A rank file: token bytes by id, ids by token bytes, and the merge of each pair of ids."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            pairs = [line.split() for line in f.read().splitlines() if line]
        self.id_of = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.token = [b""] * (max(self.id_of.values()) + 1)
        for token, rank in self.id_of.items():
            self.token[rank] = token
        self.single = np.array([self.id_of[bytes([b])] for b in range(256)], np.int64)
        self.size = len(self.token)
        # Every split of a token into two tokens is a pair that merges into it.
        keys, to = [], []
        for token, rank in self.id_of.items():
            for cut in range(1, len(token)):
                left, right = self.id_of.get(token[:cut]), self.id_of.get(token[cut:])
                if left is not None and right is not None:
                    keys.append(left * self.size + right)
                    to.append(rank)
        order = np.argsort(np.array(keys, np.int64))
        self.keys, self.to = np.array(keys, np.int64)[order], np.array(to, np.int64)[order]

    def merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Id of left+right, -1 where there is none."""
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.to[at], -1)


def replay(words: list[bytes], ranks: Ranks) -> list[np.ndarray]:
    """The ids of each word, all merges applied in rank order over all words at once."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    of = np.concatenate(([0], np.cumsum(sizes)))
    n = int(of[-1])
    symbol = np.append(ranks.single[np.frombuffer(b"".join(words), np.uint8)], -1)
    following, before = np.arange(1, n + 2), np.arange(-1, n)
    following[of[1:][sizes > 0] - 1] = n  # position n stands for "none"
    before[of[:-1][sizes > 0]] = n
    alive = np.ones(n + 1, bool)
    alive[n] = False
    stamp, turn = np.zeros(n + 1, np.int64), np.arange(n + 1)
    index: dict[int, list[np.ndarray]] = {}
    heap: list[int] = []

    def add(at: np.ndarray) -> None:
        at = at[following[at] < n]
        rank = ranks.merged(symbol[at], symbol[following[at]])
        some = rank >= 0
        at, rank = at[some], rank[some]
        if len(at) == 0:
            return
        order = np.argsort(rank, kind="stable")
        at, rank = at[order], rank[order]
        low = np.concatenate(([0], np.flatnonzero(rank[1:] != rank[:-1]) + 1))
        high = [*low[1:].tolist(), len(at)]
        for r, i, j in zip(rank[low].tolist(), low.tolist(), high, strict=True):
            if r not in index:
                index[r] = []
                heapq.heappush(heap, r)
            index[r].append(at[i:j])

    add(np.arange(n))
    while heap:
        rank = heapq.heappop(heap)
        at = index.pop(rank)
        at = at[0] if len(at) == 1 else np.concatenate(at)
        right = following[at]
        at = at[alive[at] & (right < n)]
        at = at[ranks.merged(symbol[at], symbol[following[at]]) == rank]
        if len(at) == 0:
            continue
        stamp[at] = turn[: len(at)]
        at = at[stamp[at] == turn[: len(at)]]  # each place once
        if (symbol[at] == symbol[following[at]]).any():  # only then can pairs overlap
            at = _leftmost(np.sort(at), following)
        right = following[at]
        symbol[at] = rank
        alive[right] = False
        after = following[right]
        following[at] = after
        inner = after < n
        before[after[inner]] = at[inner]
        left = before[at]
        add(np.concatenate((at, left[left < n])))
    kept = np.flatnonzero(alive)
    ids = symbol[kept]
    return np.split(ids, np.searchsorted(kept, of[1:-1])) if len(words) else []


def _leftmost(at: np.ndarray, following: np.ndarray) -> np.ndarray:
    """Of places whose pairs overlap in a chain, every other one from the left."""
    taken, blocked = [], -1
    for p in at.tolist():
        if p == blocked:
            blocked = -1
        else:
            taken.append(p)
            blocked = following[p]
    return np.array(taken, np.int64)


class Known(dict):
    """Encoded pre-tokens. A word asked for the first time stands for itself and is noted in `new`.

    Two generations bound the memory: at KEPT_WORDS the older one goes, and
    words still in use move on from it when they are asked for.
    """

    def __init__(self):
        super().__init__()
        self.old: dict = {}
        self.new: list[str] = []

    def __missing__(self, word: str):
        value = self.old.get(word)
        if value is None:
            self.new.append(word)
            value = word
        self[word] = value
        return value

    def age(self) -> None:
        if len(self) > KEPT_WORDS:
            self.old = dict(self)
            self.clear()


_WORKER: dict[str, tuple[Ranks, Known]] = {}


def _kept(path: str) -> tuple[Ranks, Known]:
    if path not in _WORKER:
        _WORKER.clear()
        _WORKER[path] = (Ranks(path), Known())
    return _WORKER[path]


def encode_texts(texts: list[str], path: str, split) -> Iterator[bytes]:
    """Little-endian unsigned 32-bit ids of each text."""
    ranks, known = _kept(path)
    get, at = known.__getitem__, 0
    while at < len(texts):
        known.age()
        found, to, size = [], at, 0
        while to < len(texts) and (to == at or size + len(texts[to]) <= CORPUS_CHARS):
            found.append(list(map(get, split(texts[to]))))
            size += len(texts[to])
            to += 1
        for word, ids in zip(known.new, replay([w.encode() for w in known.new], ranks), strict=True):
            known[word] = ids.astype("<u4").tobytes()
        any_new, known.new = bool(known.new), []
        for codes in found:
            yield b"".join([c if type(c) is bytes else known[c] for c in codes] if any_new else codes)
        at = to
    give_back()


def decode_ids(ids: bytes, path: str) -> bytes:
    """The bytes that ids stand for."""
    token = _kept(path)[0].token
    return b"".join([token[i] for i in np.frombuffer(ids, "<u4").tolist()])


def with_ids(df: DataFrame, text: str, path: str, pattern: str, ids: str = "ids") -> DataFrame:
    """`df` with a binary column of the text's ids (unsigned 32-bit, little-endian)."""
    return _mapped(df, text, path, pattern, {ids: ("binary", lambda encoded, _: encoded)})


def with_decoded(df: DataFrame, ids: str, path: str, decoded: str = "decoded") -> DataFrame:
    """`df` with the bytes that a binary column of ids stands for; null ids count as none."""
    schema = f"{decoded} binary"

    def run(batches):
        for batch in batches:
            values = [decode_ids(v or b"", path) for v in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(values, pa.binary())], [*batch.schema.names, decoded])

    _fresh(df, [decoded])
    return df.mapInArrow(run, _schema(df, schema))


def digests(df: DataFrame, key: str, text: str, path: str, pattern: str) -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256): ids and decoded bytes are hashed where they are made."""
    out = {
        "n_tokens": ("long", lambda encoded, _: len(encoded) // 4),
        "ids_sha256": ("string", lambda encoded, _: hashlib.sha256(encoded).hexdigest()),
        "decoded_sha256": ("string", lambda encoded, _: hashlib.sha256(decode_ids(encoded, path)).hexdigest()),
    }
    # The row's other columns don't travel to Python.
    slim = df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    return _mapped(slim, "text", path, pattern, out).drop("text").withColumnRenamed("key", key)


def with_round_trip(df: DataFrame, text: str, path: str, pattern: str) -> DataFrame:
    """`df` with n_tokens, ids (as with_ids) and whether they decode to the text, all in one pass."""
    out = {
        "n_tokens": ("long", lambda encoded, _: len(encoded) // 4),
        "ids": ("binary", lambda encoded, _: encoded),
        "round_trip": ("boolean", lambda encoded, body: decode_ids(encoded, path) == body.encode()),
    }
    return _mapped(df, text, path, pattern, out)


ROWS = 2_000  # texts of a batch that are taken together, so that few results wait in memory
_TYPES = {"boolean": pa.bool_(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary()}


def _fresh(df: DataFrame, names: list[str]) -> None:
    if clash := {c.lower() for c in df.columns} & {n.lower() for n in names}:
        raise ValueError(f"columns already present: {sorted(clash)}")


def _schema(df: DataFrame, more: str):
    from pyspark.sql.types import StructType

    return StructType([*df.schema.fields, *StructType.fromDDL(more).fields])


def _mapped(df: DataFrame, text: str, path: str, pattern: str, out: dict) -> DataFrame:
    _fresh(df, list(out))

    def run(batches):
        import regex

        split = regex.compile(pattern).findall
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                texts = text_array(batch.column(text)).to_pylist()
                made = {name: [] for name in out}
                for body, encoded in zip(texts, encode_texts(texts, path, split), strict=True):
                    for name, (_, value) in out.items():
                        made[name].append(value(encoded, body))
                arrays = [pa.array(made[name], _TYPES[kind]) for name, (kind, _) in out.items()]
                yield pa.RecordBatch.from_arrays([*batch.columns, *arrays], [*batch.schema.names, *out])

    return df.mapInArrow(run, _schema(df, ", ".join(f"{n} {k}" for n, (k, _) in out.items())))
