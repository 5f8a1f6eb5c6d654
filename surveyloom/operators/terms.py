"""Term counts, vocabulary and TF-IDF rows of texts that never leave their row.

The JVM lowers a text; a task cuts a slice of texts into words, stems and
filters each distinct word once, and counts single words and neighbouring pairs
as integers. Strings are made once per distinct term. A bounded vocabulary is
found in two passes: counts of hashed buckets bound the count of every term, so
that only terms that can be among the most frequent are counted by name. It is
broadcast, so weights and unit lengths are found inside the row as well.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import SUFFIXES
from ..sources.tables import cut, first_rows

COUNTED = "terms array<string>, n array<long>"
TOKENS = 1 << 19  # postings that a task works on at once
TEXT_BYTES = 1 << 21  # of texts that a task cuts at once
HELD = 1 << 24  # bytes of distinct terms and their counts that a task holds
BUCKETS = 1 << 21  # of each of the two hashes that bound counts
CHUNK = 1 << 16  # buckets in a row of the shuffle

# The words and stems of `functions.text.tokens`, for RE2.
BETWEEN = r"[^\p{L}\p{N}_]+"
SUFFIXED = rf"^([^\p{{N}}]{{3,}}?)(?:{'|'.join(SUFFIXES)})$"


def _sliced(batches, column: str, length: str = "list_value_length", most: int | None = None):
    """Slices of batches with about `most` entries (TOKENS) of a column's lists or texts; a longer row stands alone."""
    import numpy as np
    import pyarrow.compute as pc

    most = TOKENS if most is None else most
    for batch in batches:
        ends = np.cumsum(np.asarray(pc.fill_null(getattr(pc, length)(batch.column(column)), 0), dtype=np.int64))
        at = 0
        while at < batch.num_rows:
            end = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, "right")))
            yield batch.slice(at, end - at)
            at = end


def _words(batches, stop: Sequence[str]):
    """(batch, names, row, code): slices of batches with `_text`, their distinct words, and the row and word of every token in order."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    for batch in _sliced(batches, "_text", "binary_length", TEXT_BYTES):
        lists = pc.split_pattern_regex(batch.column("_text"), BETWEEN)
        sizes = np.asarray(pc.fill_null(pc.list_value_length(lists), 0), dtype=np.int64)
        coded = lists.flatten().dictionary_encode()
        stems = pc.replace_substring_regex(coded.dictionary, SUFFIXED, r"\1").dictionary_encode()
        names = stems.dictionary
        kept = ~np.asarray(pc.is_in(names, pa.array(["", *stop], names.type)), dtype=bool)
        number = np.where(kept, np.cumsum(kept) - 1, -1)
        code = number[stems.indices.to_numpy(zero_copy_only=False)][coded.indices.to_numpy(zero_copy_only=False)]
        used = code >= 0
        yield batch, names.filter(pa.array(kept)), np.repeat(np.arange(batch.num_rows), sizes)[used], code[used]


def _found(row, code, size: int, rows: int, may=None):
    """(row, term, n) of the words and neighbouring pairs that `may` lets pass, ascending.

    A word's term is its code, the pair (a, b) is size + a * size + b.
    """
    import numpy as np

    beside = np.flatnonzero(row[:-1] == row[1:])
    first, second = code[beside], code[beside + 1]
    who, every = np.concatenate([row, row[beside]]), np.concatenate([code, size + first * size + second])
    if may is not None:
        able = np.concatenate([may[0][code], may[1](first, second)])
        who, every = who[able], every[able]
    # one sort by (row, term); terms are renumbered first where the product would not fit
    kinds, span = None, size + size * size
    if span * (rows + 1) >= 2**63:
        kinds, every = np.unique(every, return_inverse=True)
        span = max(len(kinds), 1)
    found, n = np.unique(who * span + every, return_counts=True)
    term = found % span
    return found // span, term if kinds is None else kinds[term], n


def _strings(names, term):
    """The strings of term numbers."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    size = max(len(names), 1)
    single = term < size
    pair = term[~single] - size
    words = names.take(pa.array(term[single]))
    pairs = pc.binary_join_element_wise(names.take(pa.array(pair // size)), names.take(pa.array(pair % size)), " ")
    place = np.empty(len(term), dtype=np.int64)
    place[single], place[~single] = np.arange(single.sum()), single.sum() + np.arange((~single).sum())
    return pa.concat_arrays([words, pairs.cast(words.type)]).take(pa.array(place))


def _counts(batches, key: str, stop: Sequence[str]):
    """Batches (key, terms, n) from batches (key, _text)."""
    import numpy as np
    import pyarrow as pa

    for batch, names, row, code in _words(batches, stop):
        at, term, n = _found(row, code, max(len(names), 1), batch.num_rows)
        offsets = pa.array(np.concatenate([[0], np.cumsum(np.bincount(at, minlength=batch.num_rows))]), pa.int32())
        yield pa.RecordBatch.from_arrays([
            batch.column(key), pa.ListArray.from_arrays(offsets, _strings(names, term)), pa.ListArray.from_arrays(offsets, pa.array(n, pa.int64()))],
            [key, "terms", "n"])


def _tokens(docs: DataFrame, key: str, text: str) -> tuple[DataFrame, str]:
    rows = docs.select(F.col(key).alias(key), F.lower(F.col(text)).alias("_text"))
    return rows, f"`{key}` {dict(rows.dtypes)[key]}"


def counted(docs: DataFrame, key: str, text: str, stop: Sequence[str] = ()) -> DataFrame:
    """(key, terms, n): one row for each row of `docs`, with its distinct terms and how often they occur; nulls have none."""
    (rows, kind), words = _tokens(docs, key, text), list(stop)
    return rows.mapInArrow(lambda batches: _counts(batches, key, words), f"{kind}, {COUNTED}")


def term_counts(docs: DataFrame, key: str, text: str, stop: Sequence[str] = (), vocab: DataFrame | None = None) -> DataFrame:
    """(key, term, n), one row for each row of `docs` and distinct term. With a vocabulary only its terms stay."""
    each = counted(docs, key, text, stop).select(key, F.inline(F.arrays_zip(F.col("terms").alias("term"), "n")))
    return each if vocab is None else each.join(vocab.select("term"), "term", "left_semi").select(key, "term", "n")


def _held(tables):
    """Tables (term, n, df) summed over as many as HELD bytes allow."""
    import pyarrow as pa

    held, size = [], 0

    def merged():
        t = pa.concat_tables(held).group_by("term").aggregate([("n", "sum"), ("df", "sum")])
        return t.select(["term", "n_sum", "df_sum"]).rename_columns(["term", "n", "df"])

    for table in tables:
        held.append(table)
        size += table.nbytes
        if size > 2 * HELD:
            held = [merged()]
            size = held[0].nbytes
            if size > HELD:
                yield from held[0].to_batches(max_chunksize=100_000)
                held, size = [], 0
        pa.default_memory_pool().release_unused()
    if held:
        yield from merged().to_batches(max_chunksize=100_000)


def _sums(batches):
    """(term, n, df) of batches (terms, n)."""
    import numpy as np
    import pyarrow as pa

    def tables():
        for batch in _sliced(batches, "terms"):
            coded = batch.column("terms").flatten().dictionary_encode()
            code, n = coded.indices.to_numpy(zero_copy_only=False), batch.column("n").flatten().to_numpy(zero_copy_only=False)
            total = np.bincount(code, n, minlength=len(coded.dictionary)).astype(np.int64)  # exact below 2**53
            yield pa.table({"term": coded.dictionary, "n": total, "df": np.bincount(code, minlength=len(total))})

    return _held(tables())


def _text_sums(batches, stop: Sequence[str], able=None):
    """(term, n, df) of batches with `_text`; with `able` of the terms whose two buckets are."""
    import numpy as np
    import pyarrow as pa

    def tables():
        for batch, names, row, code in _words(batches, stop):
            may = None
            if able is not None:
                own = _hashes(names)
                may = (_able(own, able), lambda a, b, own=own: _able(_pair_hashes(own[a], own[b]), able))
            _, term, n = _found(row, code, max(len(names), 1), batch.num_rows, may)
            kinds, at = np.unique(term, return_inverse=True)
            total = np.bincount(at, n, minlength=len(kinds)).astype(np.int64)
            yield pa.table({"term": _strings(names, kinds), "n": total, "df": np.bincount(at, minlength=len(kinds))})

    return _held(tables())


def _mixed(x):
    import numpy as np

    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    return x ^ (x >> np.uint64(32))


def _hashes(names):
    """64 bits of each word, the same in every process."""
    import numpy as np
    import pandas as pd

    return _mixed(pd.util.hash_array(names.to_numpy(zero_copy_only=False), categorize=False)) if len(names) else np.zeros(0, dtype=np.uint64)


def _pair_hashes(a, b):
    import numpy as np

    return _mixed(a * np.uint64(0x9E3779B97F4A7C15) + b * np.uint64(0xC2B2AE3D27D4EB4F))


def _places(hashes):
    """A hash's bucket in either row."""
    import numpy as np

    return [(hashes >> np.uint64(shift) & np.uint64(BUCKETS - 1)).astype(np.int64) for shift in (0, 32)]


def _able(hashes, able):
    return able[0][(places := _places(hashes))[0]] & able[1][places[1]]


def _bucket_counts(rows: DataFrame, stop: Sequence[str]):
    """Occurrences of terms by bucket, 2 x BUCKETS: no term occurs more often than either of its buckets says."""
    import numpy as np
    import pyarrow as pa

    def count(batches):
        total = np.zeros((2, BUCKETS), dtype=np.int64)
        for _, names, row, code in _words(batches, stop):
            own, beside = _hashes(names), np.flatnonzero(row[:-1] == row[1:])
            for hashes in (own[code], _pair_hashes(own[code[beside]], own[code[beside + 1]])):
                for i, at in enumerate(_places(hashes)):
                    total[i] += np.bincount(at, minlength=BUCKETS)
        flat = total.ravel()
        for a in range(0, len(flat), CHUNK):
            part = flat[a : a + CHUNK]
            if part.any():
                small = part.astype(np.min_scalar_type(int(part.max())))
                yield pa.RecordBatch.from_arrays([pa.array([a], pa.int32()), pa.array([small.dtype.str], pa.string()), pa.array([small.tobytes()], pa.binary())], ["at", "kind", "n"])

    def add(batches):
        sums = {}
        for batch in batches:
            for at, kind, n in zip(batch.column("at").to_pylist(), batch.column("kind").to_pylist(), batch.column("n")):
                sums[at] = sums.get(at, 0) + np.frombuffer(n.as_buffer(), dtype=kind).astype(np.int64)
        for at, n in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([n.tobytes()], pa.binary())], ["at", "n"])

    total = np.zeros(2 * BUCKETS, dtype=np.int64)
    merged = rows.mapInArrow(count, "at int, kind string, n binary").repartition("at").mapInArrow(add, "at int, n binary")
    for batch in merged.toArrow().to_batches():  # as many rows as there are chunks
        for at, n in zip(batch.column("at").to_pylist(), batch.column("n")):
            part = np.frombuffer(n.as_buffer(), dtype=np.int64)
            total[at : at + len(part)] = part
    return total.reshape(2, BUCKETS)


SUMS = "term string, n long, df long"


def _per_term(parts: DataFrame) -> DataFrame:
    return parts.groupBy("term").agg(F.sum("n").alias("corpus_count"), F.sum("df").alias("df"))


def corpus_counts(rows: DataFrame) -> DataFrame:
    """(term, corpus_count, df) of rows from `counted`; a task sums its rows before the shuffle."""
    return _per_term(rows.select("terms", "n").mapInArrow(_sums, SUMS))


def text_counts(docs: DataFrame, key: str, text: str, stop: Sequence[str] = ()) -> DataFrame:
    """`corpus_counts` of texts in one step."""
    (rows, _), words = _tokens(docs, key, text), list(stop)
    return _per_term(rows.select("_text").mapInArrow(lambda batches: _text_sums(batches, words), SUMS))


def frequent_counts(docs: DataFrame, key: str, text: str, stop: Sequence[str], n: int) -> DataFrame:
    """Rows of `text_counts`, stored, with all of the n most frequent terms among them and few others. Starts jobs.

    Terms with a bucket below a bound are not counted by name. The bound holds
    if the n-th term counted reaches it; else that term's count is a bound that does.
    """
    import numpy as np

    (rows, _), words = _tokens(docs, key, text), list(stop)
    if 2 * n >= BUCKETS:
        return cut(text_counts(docs, key, text, words), "per-term")
    buckets = _bucket_counts(rows.select("_text"), words)
    least = max(1, int(np.partition(buckets[0], BUCKETS - 2 * n)[BUCKETS - 2 * n])) if n > 0 else 2**62
    while True:
        sent = docs.sparkSession.sparkContext.broadcast(buckets >= least)
        per_term = cut(_per_term(rows.select("_text").mapInArrow(lambda batches, sent=sent: _text_sums(batches, words, sent.value), SUMS)), "per-term")
        last = nth_count(per_term, n)
        if n <= 0 or least <= 1 or (last is not None and last[0] >= least):
            return per_term
        least = 1 if last is None else last[0]


def nth_count(per_term: DataFrame, n: int) -> tuple[int, int] | None:
    """The n-th largest corpus_count and how many terms have more; None where there are fewer terms. Starts jobs.

    Histograms of the counts, the first by powers of two and each further one
    4,096 times finer, lead to it.
    """
    def histogram(slot: Column, low: int, high: int) -> dict[int, int]:
        inside = per_term.filter((F.col("corpus_count") >= low) & (F.col("corpus_count") < high))
        return {int(r.slot): r.n for r in inside.groupBy(slot.alias("slot")).agg(F.count(F.lit(1)).alias("n")).collect()}

    def reached(bins: dict[int, int], above: int) -> tuple[int, int] | None:
        for slot in sorted(bins, reverse=True):
            if above + bins[slot] >= n:
                return slot, above
            above += bins[slot]
        return None

    found = reached(histogram(F.length(F.bin("corpus_count")) - 1, 1, 2**62), 0) if n > 0 else None
    if found is None:
        return None
    low, above = 2 ** found[0], found[1]
    width = low
    while width > 1:
        step = max(1, width >> 12)
        slot, above = reached(histogram(F.expr(f"(corpus_count - {low}L) div {step}L"), low, low + width), above)
        low, width = low + slot * step, step
    return low, above


def most_frequent(per_term: DataFrame, n: int) -> DataFrame:
    """The n terms of the largest corpus_count, ties by term; without sorting the others. Starts jobs.

    Only the terms of exactly the n-th count are ordered, by ranges.
    """
    last = nth_count(per_term, n)
    if last is None:
        return per_term if n > 0 else per_term.limit(0)
    low, above = last
    more = per_term.filter(F.col("corpus_count") > low)
    return more.unionByName(first_rows(per_term.filter(F.col("corpus_count") == low), "term", n - above))


def vocabulary(per_term: DataFrame, n_docs: Column, max_features: int | None = None) -> DataFrame:
    """(term, corpus_count, df, idf): all terms, or the `max_features` most frequent of the corpus, ties by term.

    With a limit `per_term` is read several times, so it should be a stored table; jobs start.
    """
    idf = F.log((F.lit(1.0) + n_docs) / (F.lit(1.0) + F.col("df"))) + F.lit(1.0)
    kept = per_term if max_features is None else most_frequent(per_term, max_features)
    return kept.withColumn("idf", idf)


def fit_vocabulary(docs: DataFrame, key: str, text: str, stop: Sequence[str] = (), max_features: int | None = None) -> DataFrame:
    per_term = text_counts(docs, key, text, stop) if max_features is None else frequent_counts(docs, key, text, stop, max_features)
    return vocabulary(per_term, docs.agg(F.count(F.lit(1))).scalar(), max_features)


def tfidf(counts: DataFrame, vocab: DataFrame, key: str) -> DataFrame:
    """(key, term, weight) of exploded counts: sublinear tf x idf, unit length per key. For vocabularies without a bound."""
    raw = counts.join(vocab.select("term", "idf"), "term").select(key, "term", ((F.lit(1.0) + F.log("n")) * F.col("idf")).alias("_w"))
    length = F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(Window.partitionBy(key)))
    return raw.select(key, "term", (F.col("_w") / length).alias("weight"))


@dataclass
class Terms:
    """A bounded vocabulary as it is broadcast: terms in order, so a term's position is its number."""

    strings: object  # pyarrow strings
    idf: object
    count: object

    def __len__(self) -> int:
        return len(self.idf)

    @classmethod
    def of(cls, vocab: DataFrame) -> Terms:
        """Collects a vocabulary that `max_features` bounds."""
        rows = vocab.select("term", "idf", "corpus_count").orderBy("term").toArrow().combine_chunks()
        take = lambda c: rows.column(c).combine_chunks()
        return cls(take("term"), take("idf").to_numpy(zero_copy_only=False), take("corpus_count").to_numpy(zero_copy_only=False))

    def lookup(self):
        """(words, single, keys, pair): every word of a term, its own term or -1, and keys of pairs of words with their terms, ascending."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        space = pc.find_substring(self.strings, " ").to_numpy(zero_copy_only=False)
        alone, both = np.flatnonzero(space < 0), np.flatnonzero(space >= 0)
        own, halves = self.strings.take(pa.array(alone)), pc.split_pattern(self.strings.take(pa.array(both)), " ").flatten()
        coded = pa.concat_arrays([own, halves]).dictionary_encode()
        code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        single = np.full(len(coded.dictionary), -1)
        single[code[: len(alone)]] = alone
        keys = code[len(alone) :: 2] * len(single) + code[len(alone) + 1 :: 2]
        order = np.argsort(keys)
        return coded.dictionary, single, keys[order], both[order]


def _weighed(batch, key: str, known: Terms, row, at, n):
    """A batch (key, terms, weights, lead) of (row, position, n), ascending."""
    import numpy as np
    import pyarrow as pa

    w = (1.0 + np.log(n)) * known.idf[at]
    w /= np.sqrt(np.bincount(row, w * w, minlength=batch.num_rows))[row]
    counts = np.bincount(row, minlength=batch.num_rows)
    offsets = np.concatenate([[0], np.cumsum(counts)])
    lead = np.full(batch.num_rows, -1, dtype=np.int64)
    by = np.lexsort((at, -known.count[at], row))
    lead[counts > 0] = at[by][offsets[:-1][counts > 0]]
    ends = pa.array(offsets, pa.int32())
    return pa.RecordBatch.from_arrays([
        batch.column(key), pa.ListArray.from_arrays(ends, pa.array(at, pa.int32())), pa.ListArray.from_arrays(ends, pa.array(w)), pa.array(lead)],
        [key, "terms", "weights", "lead"])


def _weights(batches, key: str, known: Terms):
    """Batches (key, terms, weights, lead) from batches (key, terms, n)."""
    import numpy as np
    import pyarrow.compute as pc

    for batch in _sliced(batches, "terms"):
        lists = batch.column("terms")
        at = pc.index_in(lists.flatten(), value_set=known.strings)
        used = np.asarray(pc.is_valid(at))
        sizes = np.asarray(pc.fill_null(pc.list_value_length(lists), 0), dtype=np.int64)
        row = np.repeat(np.arange(batch.num_rows), sizes)[used]
        at = at.drop_null().to_numpy(zero_copy_only=False)
        n = batch.column("n").flatten().to_numpy(zero_copy_only=False)[used]
        order = np.lexsort((at, row))
        yield _weighed(batch, key, known, row[order], at[order], n[order])


def _text_weights(batches, key: str, stop: Sequence[str], known: Terms):
    """Batches (key, terms, weights, lead) from batches (key, _text), without a string of a pair."""
    import numpy as np
    import pyarrow.compute as pc

    words, single, keys, pair = known.lookup()
    size = max(len(known), 1)
    for batch, names, row, code in _words(batches, stop):
        word = pc.fill_null(pc.index_in(names, value_set=words.cast(names.type)), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        used = word >= 0
        own = np.full(len(names), -1)
        own[used] = single[word[used]]
        beside = np.flatnonzero((row[:-1] == row[1:]) & used[code[:-1]] & used[code[1:]])
        wanted = word[code[beside]] * len(words) + word[code[beside + 1]]
        place = np.searchsorted(keys, wanted)
        hit = np.flatnonzero(keys[np.minimum(place, len(keys) - 1)] == wanted) if len(keys) else np.zeros(0, dtype=np.int64)
        alone = np.flatnonzero(own[code] >= 0)
        found, n = np.unique(np.concatenate([row[alone] * size + own[code[alone]], row[beside[hit]] * size + pair[place[hit]]]), return_counts=True)
        yield _weighed(batch, key, known, found // size, found % size, n)


WEIGHTS = "terms array<int>, weights array<double>, lead long"


def weighted(rows: DataFrame, key: str, vocab: Terms) -> DataFrame:
    """(key, terms, weights, lead) of rows from `counted`: positions ascending, unit length, and the row's commonest term."""
    sent = rows.sparkSession.sparkContext.broadcast(vocab)
    return rows.select(key, "terms", "n").mapInArrow(lambda batches: _weights(batches, key, sent.value), f"`{key}` {dict(rows.dtypes)[key]}, {WEIGHTS}")


def text_weights(docs: DataFrame, key: str, text: str, stop: Sequence[str], vocab: Terms) -> DataFrame:
    """`weighted` of texts in one step."""
    (rows, kind), words = _tokens(docs, key, text), list(stop)
    sent = rows.sparkSession.sparkContext.broadcast(vocab)
    return rows.mapInArrow(lambda batches: _text_weights(batches, key, words, sent.value), f"{kind}, {WEIGHTS}")
