"""Substring de-duplication: words inside windows that occur more than once in the corpus.

A window is `length` consecutive words of one text. Every window has an anchor,
the smallest-hashed run of `gram` words in it, so equal windows have equal
anchors; consecutive windows with the same anchor are a passage. Passages meet
by anchor, in ranges of keys:

* equal passages found twice are repeated as a whole. Those of one batch are
  settled where they lie and send a single row, so copies, however many, add
  one row per batch;
* different passages with the same anchor are a reference shard: a suffix
  automaton over their words, weighted by how often each passage occurs. Every
  passage is streamed through it; at each word the matching statistic leads to
  the state of its last `length` words, whose weight says whether they start
  anywhere else. What is repeated is removed, which is the maximal spans of
  `length` words and more.

Shards go to the passages that share their anchor instead of being broadcast,
since the reference is the corpus itself and has no size bound. An anchor in
more than `HOT` passages (the edges of a very common passage) is no shard: its
windows are keyed one by one by their own words. Which anchors those are is held in a
filter of fixed size that affects no result.

Windows are judged on the input. Null texts have no words. Copies of a text
count as occurrences of their own; verdicts are kept per text.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.tables import cut
from .packed import BLOB, dealt, gathered, groups, in_ranges, ranges, unpack
from .words import U, Words, mix, pieces, range_hash, text_array

LENGTH, GRAM = 35, 8
HOT = 1_000
FILTER_BITS = 24  # 2 MB


def _text_key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


class Passages:
    """Passages of a slice: key, content, row, first window, number of windows."""

    def __init__(self, words: Words, length: int, gram: int, hot: np.ndarray | None):
        h = words.hashes()
        n, span = len(h), length - gram + 1
        count = max(n - length + 1, 0)
        last = np.repeat(words.of[1:], np.diff(words.of))
        s = np.flatnonzero(np.arange(count) + length <= last[:count])
        self.h = h
        if len(s) == 0:
            self.key = self.content = np.zeros(0, U)
            self.row = self.start = self.n = np.zeros(0, np.int64)
            return
        grams = range_hash(h, np.arange(n - gram + 1), np.arange(gram, n + 1))
        low, at, width = grams, np.arange(len(grams)), 1
        while width * 2 <= span:  # smallest of twice as many, the left one of equals
            low, at = _less(low[:-width], at[:-width], low[width:], at[width:])
            width *= 2
        if width < span:
            low, at = _less(low[: count], at[: count], low[span - width : span - width + count], at[span - width : span - width + count])
        anchor = at[s]
        row = np.searchsorted(words.of, s, "right") - 1
        new = np.ones(len(s), bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])
        start = np.flatnonzero(new)
        size = np.diff(np.append(start, len(s)))
        key = mix(grams[anchor[start]] + U(gram))
        if hot is not None:
            bit = key >> U(64 - FILTER_BITS)
            wide = ((hot[bit >> U(6)] >> (bit & U(63))) & U(1)) == 1
            if wide.any():  # one passage per window, keyed by the window
                alone = np.repeat(wide, size)
                start = np.flatnonzero(new | alone)
                size = np.diff(np.append(start, len(s)))
                key = mix(grams[anchor[start]] + U(gram))
                own = np.flatnonzero(alone[start])
                key[own] = mix(range_hash(h, s[start[own]], s[start[own]] + length))
        self.row, self.start, self.n, self.key = row[start], s[start] - words.of[row[start]], size, key
        self.content = range_hash(h, s[start], s[start] + size + length - 1)


def _less(a, at_a, b, at_b):
    right = b < a
    return np.where(right, b, a), np.where(right, at_b, at_a)


def hot_anchors(docs: DataFrame, text: str, length: int, gram: int, limit: int = HOT) -> np.ndarray:
    """Filter bits of the anchors of more than `limit` passages; each range sends its fixed share of the bits."""
    parts = min(ranges(docs.sparkSession), 1 << (FILTER_BITS - 6))

    def count(batches):
        for batch in batches:
            keys = [Passages(w, length, gram, None).key for w in pieces(text_array(batch.column("text")))]
            keys, n = np.unique(np.concatenate([np.zeros(0, U), *keys]), return_counts=True)
            yield dealt(keys, parts, n.astype(np.uint32))

    def merge(table: pa.Table) -> pa.Table:
        keys, n = gathered(table, np.uint32)
        start, _ = groups(keys)
        hot = keys[start][np.add.reduceat(n.astype(np.int64), start) > limit] if len(start) else keys
        bits = np.zeros((1 << (FILTER_BITS - 6)) // parts, U)
        bit = hot >> U(64 - FILTER_BITS)
        np.bitwise_or.at(bits, (bit >> U(6)) % U(len(bits)), U(1) << (bit & U(63)))
        return pa.table({"part": table.column("part")[:1], "bits": pa.array([bits.tobytes()], pa.binary())})

    rows = in_ranges(docs.select(F.col(text).cast("string").alias("text")).mapInArrow(count, BLOB), merge, "part int, bits binary").collect()
    share = (1 << (FILTER_BITS - 6)) // parts
    out = np.zeros(1 << (FILTER_BITS - 6), U)
    for r in rows:
        out[r["part"] * share : (r["part"] + 1) * share] = np.frombuffer(r["bits"], U)
    return out


VERDICT, REQUEST = 0, 1
_OUT = "kind int, part int, blob binary"


def _tagged(kind: int, batch: pa.RecordBatch) -> pa.Table:
    return pa.table({"kind": pa.array([kind] * batch.num_rows, pa.int32()), "part": batch.column("part"), "blob": batch.column("blob")})


def _all(n: np.ndarray) -> np.ndarray:
    return ((U(1) << n.astype(U)) - U(1)).astype(np.uint32)


def _once(own: np.ndarray, parts: int, start: np.ndarray, n: np.ndarray) -> tuple:
    """Whole passages of texts, each place of a text once: copies of a text say the same."""
    order = np.lexsort((start, own))
    own, start, n = own[order], start[order], n[order]
    new = np.ones(len(own), bool)
    new[1:] = (own[1:] != own[:-1]) | (start[1:] != start[:-1])
    return own[new], parts, start[new], _all(n[new])


def meetings(docs: DataFrame, text: str, hot: np.ndarray, length: int, gram: int) -> DataFrame:
    """(kind, part, blob): verdicts (text, first window, windows that repeat) and requests for passages to be compared."""
    parts, shared = ranges(docs.sparkSession), docs.sparkSession.sparkContext.broadcast(hot)

    def run(batches):
        table = shared.value
        for batch in batches:
            texts, found = batch.column("text_key").to_numpy().view(U), []
            for w in pieces(text_array(batch.column("text"))):
                p = Passages(w, length, gram, table)
                found.append((p.key, p.content, texts[w.row + p.row], p.start.astype(np.uint32), p.n.astype(np.uint32)))
            if not found:
                continue
            key, content, own, start, n = (np.concatenate(a) for a in zip(*found, strict=True))
            order = np.lexsort((content, key))
            key, content, own, start, n = key[order], content[order], own[order], start[order], n[order]
            first = np.ones(len(key), bool)
            first[1:] = (key[1:] != key[:-1]) | (content[1:] != content[:-1])
            at = np.flatnonzero(first)
            times = np.diff(np.append(at, len(key)))
            again = np.repeat(times > 1, times)  # settled here: an equal passage lies in this batch
            yield dealt(key[at], parts, content[at], own[at], start[at], n[at], np.minimum(times, 2).astype(np.uint8))
            here = dealt(*_once(own[again], parts, start[again], n[again]))
            yield pa.RecordBatch.from_arrays([pa.array(-1 - here.column("part").to_numpy(), pa.int32()), here.column("blob")], ["part", "blob"])

    def merge(table: pa.Table) -> pa.Table:
        if table.column("part")[0].as_py() < 0:  # verdicts on their way to their texts
            return pa.table({"kind": pa.array([VERDICT] * table.num_rows, pa.int32()), "part": pa.array([-1 - p.as_py() for p in table.column("part")], pa.int32()), "blob": table.column("blob")})
        key, content, own, start, n, times = gathered(table, U, U, np.uint32, np.uint32, np.uint8)
        order = np.lexsort((content, key))
        key, content, own, start, n, times = (a[order] for a in (key, content, own, start, n, times))
        low, size = groups(key)
        weight = np.add.reduceat(times.astype(np.int64), low) if len(low) else np.zeros(0, np.int64)
        first = np.ones(len(key), bool)
        first[1:] = (key[1:] != key[:-1]) | (content[1:] != content[:-1])
        at = np.flatnonzero(first)
        held = np.diff(np.append(at, len(key)))
        known = np.add.reduceat(times.astype(np.int64), at) if len(at) else np.zeros(0, np.int64)
        settled = np.repeat(known > 1, held)
        distinct = np.add.reduceat(first.astype(np.int64), low) if len(low) else np.zeros(0, np.int64)
        compared = first & np.repeat((weight > 1) & (distinct > 1), size)
        times_all = np.repeat(np.minimum(known, 2), held)
        verdict = dealt(*_once(own[settled], parts, start[settled], n[settled]))
        request = dealt(own[compared], parts, start[compared], n[compared], key[compared], times_all[compared].astype(np.uint8))
        return pa.concat_tables([_tagged(VERDICT, verdict), _tagged(REQUEST, request)])

    slim = docs.select(_text_key(F.col(text)).alias("text_key"), F.col(text).cast("string").alias("text"))
    return in_ranges(slim.mapInArrow(run, BLOB), merge, _OUT)


def _by_text(blobs: DataFrame, kinds: list[type], schema: str, types: list[pa.DataType]) -> DataFrame:
    """One row per text from blobs keyed by text; the values as arrays, each start once."""

    def merge(table: pa.Table) -> pa.Table:
        key, *values = gathered(table, *kinds)
        order = np.lexsort((values[0], key))
        key, values = key[order], [v[order] for v in values]
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (values[0][1:] != values[0][:-1])
        key, values = key[new], [v[new] for v in values]
        low, size = groups(key)
        offsets = pa.array(np.append(low, len(key)) if len(low) else [0], pa.int32())
        arrays = [pa.ListArray.from_arrays(offsets, pa.array(v.astype(t.to_pandas_dtype(), copy=False) if v.dtype != U else v.view(np.int64), t)) for v, t in zip(values, types, strict=True)]
        names = [c.split()[0] for c in schema.split(", ")]
        return pa.table([pa.array(key[low].view(np.int64)), *arrays], names=["text_key", *names])

    return in_ranges(blobs, merge, f"text_key long, {schema}")


class Automaton:
    """Suffix automaton of several word sequences; a state's weight counts the occurrences of its words."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link, self.size, self.weight = [-1], [0], [0]

    def _state(self, size: int, link: int, follow: dict) -> int:
        self.next.append(follow)
        self.size.append(size)
        self.link.append(link)
        self.weight.append(0)
        return len(self.size) - 1

    def add(self, words: list, weight: int) -> None:
        follow, link, size, last = self.next, self.link, self.size, 0
        for w in words:
            q = follow[last].get(w)
            if q is not None and size[q] == size[last] + 1:
                last = q
            else:
                p = last
                new = self._state(size[last] + 1, 0, {}) if q is None else -1
                while q is None and p >= 0:
                    follow[p][w] = new
                    p = link[p]
                    q = follow[p].get(w) if p >= 0 else None
                if p < 0:
                    last = new
                else:
                    if size[q] != size[p] + 1:
                        twin = self._state(size[p] + 1, link[q], dict(follow[q]))
                        link[q] = twin
                        while p >= 0 and follow[p].get(w) == q:
                            follow[p][w] = twin
                            p = link[p]
                        q = twin
                    if new >= 0:
                        link[new] = q
                        last = new
                    else:
                        last = q
            self.weight[last] += weight

    def settle(self) -> None:
        """Passes weights from longer words to their suffixes."""
        for v in sorted(range(1, len(self.size)), key=self.size.__getitem__, reverse=True):
            if self.link[v] > 0:
                self.weight[self.link[v]] += self.weight[v]

    def repeated(self, words: list, length: int) -> int:
        """Bit i: the `length` words from i on occur at least twice."""
        follow, link, size, state, mask = self.next, self.link, self.size, 0, 0
        for i, w in enumerate(words):
            state = follow[state][w]  # every streamed passage is part of the reference, so it matches on
            while size[link[state]] >= length:
                state = link[state]
            if i >= length - 1 and self.weight[state] > 1:
                mask |= 1 << (i - length + 1)
        return mask


def compared(docs: DataFrame, text: str, requests: DataFrame, length: int) -> DataFrame:
    """(kind, part, blob): verdicts on the requested passages, from the automaton of their anchor."""
    parts = ranges(docs.sparkSession)
    wanted = cut(_by_text(requests, [np.uint32, np.uint32, U, np.uint8], "starts array<int>, sizes array<int>, keys array<long>, times array<int>", [pa.int32(), pa.int32(), pa.int64(), pa.int32()]), "requested-passages")
    rows = docs.select(_text_key(F.col(text)).alias("text_key"), F.col(text).cast("string").alias("text")).join(wanted, "text_key")

    def run(batches):
        for batch in batches:
            seen, key, own, start, n, times, body = set(), [], [], [], [], [], []
            lists = [batch.column(c) for c in ("starts", "sizes", "keys", "times")]
            texts = batch.column("text_key").to_numpy().view(U)
            for w in pieces(text_array(batch.column("text"))):
                h = w.hashes()
                for r in range(w.rows):
                    at = w.row + r
                    if texts[at] in seen:
                        continue
                    seen.add(texts[at])
                    s, m, k, t = (c[at].values.to_numpy(zero_copy_only=False) for c in lists)
                    key.append(k.view(U))
                    own.append(np.full(len(s), texts[at], U))
                    start.append(s.astype(np.uint32))
                    n.append(m.astype(np.uint32))
                    times.append(t.astype(np.uint8))
                    body += [h[w.of[r] + a : w.of[r] + a + b + length - 1] for a, b in zip(s.tolist(), m.tolist(), strict=True)]
            if not key:
                continue
            key, own, start, n, times = (np.concatenate(a) for a in (key, own, start, n, times))
            order = np.argsort(key, kind="stable")
            key = key[order]
            part = (key >> U(64 - (parts.bit_length() - 1))).astype(np.int64) if parts > 1 else np.zeros(len(key), np.int64)
            cuts = np.searchsorted(part, np.arange(parts + 1))
            for p in range(parts):
                if cuts[p] < cuts[p + 1]:
                    own_rows = order[cuts[p] : cuts[p + 1]]
                    blob = dealt(key[cuts[p] : cuts[p + 1]], 1, own[own_rows], start[own_rows], n[own_rows], times[own_rows]).column("blob")
                    flat = np.concatenate([body[i] for i in own_rows])
                    yield pa.RecordBatch.from_arrays([pa.array([p], pa.int32()), blob, pa.array([flat.tobytes()], pa.binary())], ["part", "blob", "words"])

    def merge(table: pa.Table) -> pa.Table:
        shards: dict[int, dict] = {}
        for blob, flat in zip(table.column("blob"), table.column("words"), strict=True):
            key, own, start, n, times = unpack(blob.as_py(), U, np.uint32, np.uint32, np.uint8)
            words, at = np.frombuffer(flat.as_buffer(), U), 0
            for k, o, s, m, t in zip(key.tolist(), own.tolist(), start.tolist(), n.tolist(), times.tolist(), strict=True):
                shards.setdefault(k, {})[(o, s)] = (words[at : at + m + length - 1], t)
                at += m + length - 1
        out_text, out_start, out_mask = [], [], []
        while shards:
            _, shard = shards.popitem()
            automaton, listed = Automaton(), [(place, words.tolist(), t) for place, (words, t) in shard.items()]
            for _, words, t in listed:
                automaton.add(words, t)
            automaton.settle()
            for (o, s), words, t in listed:
                if t == 1 and (mask := automaton.repeated(words, length)):
                    out_text.append(o)
                    out_start.append(s)
                    out_mask.append(mask)
        return _tagged(VERDICT, dealt(np.array(out_text, U), parts, np.array(out_start, np.uint32), np.array(out_mask, np.uint32)))

    return in_ranges(rows.mapInArrow(run, "part int, blob binary, words binary"), merge, _OUT)


def repeated_windows(docs: DataFrame, text: str, length: int = LENGTH, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """(text_key, starts, masks): from word starts[i] on, bit j of masks[i] marks a repeated window at starts[i] + j."""
    if not 0 <= length - gram < 32:
        raise ValueError("a passage holds at most 32 windows: gram must lie within 31 words of length")
    found = cut(meetings(docs, text, hot_anchors(docs, text, length, gram, hot), length, gram), "passages")
    more = cut(compared(docs, text, found.filter(F.col("kind") == REQUEST).select("part", "blob"), length), "compared-passages")
    verdicts = found.filter(F.col("kind") == VERDICT).select("part", "blob").union(more.select("part", "blob"))
    return cut(_by_text(verdicts, [np.uint32, np.uint32], "starts array<int>, masks array<long>", [pa.int32(), pa.int64()]), "repeated-windows")


def _cover(words: int, starts: np.ndarray, masks: np.ndarray, length: int) -> np.ndarray:
    """Which of the words lie in a marked window."""
    steps = np.zeros(words + 1, np.int64)
    bit = (masks[:, None] >> np.arange(32)) & 1
    at = (starts.astype(np.int64)[:, None] + np.arange(32))[bit == 1]
    np.add.at(steps, at, 1)
    np.add.at(steps, at + length, -1)
    return np.cumsum(steps[:-1]) > 0


def without_repeats(docs: DataFrame, keep_columns: list[str], text: str, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(keep_columns, n_words, n_removed, kept): the kept words of every row, joined by one space."""
    return _applied(docs, keep_columns, text, length, gram, HOT, [("kept", "string", pa.string(), lambda kept: kept.decode())])


def digests(docs: DataFrame, key: str, text: str, length: int = LENGTH, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """(key, n_words, n_removed, kept_sha256) of every row."""
    return _applied(docs, [key], text, length, gram, hot, [("kept_sha256", "string", pa.string(), lambda kept: hashlib.sha256(kept).hexdigest())])


def _applied(docs: DataFrame, keep_columns: list[str], text: str, length: int, gram: int, hot: int, out: list) -> DataFrame:
    marked = repeated_windows(docs, text, length, gram, hot).select(F.col("text_key").alias("_text_key"), F.col("starts").alias("_starts"), F.col("masks").alias("_masks"))
    rows = docs.select(*keep_columns, F.col(text).cast("string").alias("_text"), _text_key(F.col(text)).alias("_text_key")).join(marked, "_text_key", "left").drop("_text_key")
    names = ["n_words", "n_removed", *(o[0] for o in out)]
    schema = ", ".join(f"`{c}` {k}" for c, k in docs.select(*keep_columns).dtypes) + ", n_words long, n_removed long, " + ", ".join(f"{o[0]} {o[1]}" for o in out)

    def run(batches):
        for batch in batches:
            total, gone, values = [], [], [[] for _ in out]
            starts, masks = batch.column("_starts"), batch.column("_masks")
            for i, body in enumerate(text_array(batch.column("_text"))):
                words = body.as_py().encode().split()  # at the ASCII white space that separates words
                total.append(len(words))
                if starts[i].is_valid:
                    cover = _cover(len(words), starts[i].values.to_numpy(zero_copy_only=False), masks[i].values.to_numpy(zero_copy_only=False), length)
                    words = [w for w, c in zip(words, cover.tolist(), strict=True) if not c]
                gone.append(total[-1] - len(words))
                kept = b" ".join(words)
                for made, (_, _, _, value) in zip(values, out, strict=True):
                    made.append(value(kept))
            arrays = [pa.array(total, pa.int64()), pa.array(gone, pa.int64()), *(pa.array(v, o[2]) for v, o in zip(values, out, strict=True))]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep_columns), *arrays], [*keep_columns, *names])

    return rows.mapInArrow(run, schema)
