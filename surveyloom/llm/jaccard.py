"""N-gram Jaccard join with token-combination prefixes, exact, and its classes of linked documents.

A document's tokens are its distinct runs of `size` words (lower-cased in
ASCII), or its whole word sequence when it has fewer. Two documents link when
100 * common >= percent * union. Tokens are ordered by classes of rising
frequency, by hash inside each class. A set of n tokens shares at least `need(n)` of them with
any partner, so at most n - need(n) of its tokens can be missing there, and a
prefix that still gives a shared signature after losing that many is enough:

* a rare token is a signature of its own;
* a frequent token counts only together with another one of its group: groups
  split the frequent tokens by hash, in proportion to the set's size, and the
  prefix is extended by one token for every group it opens. Signatures are the
  pairs of a group, so their number stays linear in the size of the set. Sets
  of similar size must use the same groups, so each uses those of its own size
  band and of the next.

Documents with equal sets are one set. Signatures are sorted in ranges of keys;
the distinct member lists they leave are few, since copies share most of them.
Every member is first verified against the centre of its list. In groups of
copies that links everything, and only lists that still hold sets of different
components are compared by sketches (across components, block by block). Verification drops pairs whose parity sketches differ in
too many bits, which no link can, and compares the others on whole sets.

Null and blank texts have empty sets and no links. Rows with equal ids are
separate rows; a class is named by the smallest id in it, null only if all are.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.tables import cut
from .components import components
from .packed import BLOB, dealt, gathered, groups, in_ranges, ranges
from .words import U, mix, pieces, text_array, windows

SIZE, PERCENT = 5, 75
FREQUENT = 4  # a token in more rows than this is frequent, doubled until its filter has room
LEVELS = ((1, 26), (16, 23), (256, 20))  # classes of frequent tokens: times FREQUENT, and bits of their filter
SETS_BITS = 24  # 2 MB filter of the texts whose sets are verified


def need(n: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Tokens that a set of n shares with any partner, at least."""
    return -(-(n * percent) // 100)


def token_sets(texts: pa.Array, size: int = SIZE):
    """Per slice: (first row, tokens, bounds of rows): each row's distinct token hashes, sorted."""
    for words in pieces(texts):
        h = words.hashes(lower=True)
        tokens, first = windows(h, words.of, size)
        row = np.searchsorted(words.of, first, "right") - 1
        short = np.flatnonzero((words.counts() > 0) & (words.counts() < size))
        if len(short):
            whole = [windows(h[words.of[r] : words.of[r + 1]], np.array([0, words.of[r + 1] - words.of[r]]), int(words.of[r + 1] - words.of[r]))[0] for r in short]
            tokens, row = np.concatenate((tokens, *whole)), np.concatenate((row, short))
        order = np.lexsort((tokens, row))
        tokens, row = tokens[order], row[order]
        new = np.ones(len(tokens), bool)
        new[1:] = (tokens[1:] != tokens[:-1]) | (row[1:] != row[:-1])
        tokens, row = tokens[new], row[new]
        yield words.row, tokens, np.searchsorted(row, np.arange(words.rows + 1))


def set_keys(tokens: np.ndarray, of: np.ndarray) -> np.ndarray:
    """A 64-bit name of each row's set."""
    total = np.concatenate((np.zeros(1, U), np.cumsum(mix(tokens), dtype=U)))
    n = np.diff(of).astype(U)
    return mix(total[of[1:]] - total[of[:-1]] + n * U(0x9E3779B97F4A7C15))


def sketches(tokens: np.ndarray, of: np.ndarray) -> list[bytes]:
    """Each row's parity bits: two or more per token, a power of two; sets that differ in k tokens differ in k bits at most."""
    n = np.diff(of)
    width = np.maximum(64, 2 ** np.ceil(np.log2(np.maximum(2 * n, 1))).astype(np.int64))
    at = np.concatenate(([0], np.cumsum(width)))
    row = np.repeat(np.arange(len(n)), n)
    odd = np.bincount(at[row] + (tokens & (width[row] - 1).astype(U)).astype(np.int64), minlength=at[-1]).astype(np.uint8) & 1
    flat = np.packbits(odd, bitorder="little").tobytes()
    return [flat[a // 8 : b // 8] for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]


def _folded(sketch: bytes, size: int) -> int:
    bits, have = int.from_bytes(sketch, "little"), 8 * len(sketch)
    while have > size:
        have //= 2
        bits = (bits >> have) ^ (bits & ((1 << have) - 1))
    return bits


def may_link(na: int, nb: int, a: bytes, b: bytes, percent: int = PERCENT) -> bool:
    """False only for sets that cannot link: their sizes or their sketches differ too much."""
    common = -(-percent * (na + nb) // (100 + percent))
    size = 8 * min(len(a), len(b))
    return common <= min(na, nb) and (_folded(a, size) ^ _folded(b, size)).bit_count() <= na + nb - 2 * common


def _text_key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


def described(docs: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """(id, text_key, n_shingles, set, sketch) of every row."""

    def run(batches):
        for batch in batches:
            n, keys, bits = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], []
            for _, tokens, of in token_sets(text_array(batch.column("text")), size):
                n.append(np.diff(of))
                keys.append(set_keys(tokens, of).view(np.int64))
                bits += sketches(tokens, of)
            arrays = [pa.array(np.concatenate(n), pa.int64()), pa.array(np.concatenate(keys)), pa.array(bits, pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("text_key"), *arrays], ["id", "text_key", "n_shingles", "set", "sketch"])

    slim = docs.select(F.col(key).alias("id"), _text_key(F.col(text)).alias("text_key"), F.col(text).cast("string").alias("text"))
    return slim.mapInArrow(run, f"id {dict(slim.dtypes)['id']}, text_key long, n_shingles long, set long, sketch binary")


def frequent_tokens(docs: DataFrame, text: str, size: int, frequent: int = FREQUENT) -> list[np.ndarray]:
    """For each class of LEVELS, filter bits of the tokens that more rows than its limit hold; counted over all rows.

    A limit (a power of two) is doubled until a sixteenth of the filter's bits
    suffices: that many keys reach the driver. Any filters give the same links.
    """
    parts, least = ranges(docs.sparkSession), frequent * LEVELS[0][0]

    def count(batches):
        for batch in batches:
            held = [t >> U(24) << U(24) for _, t, _ in token_sets(text_array(batch.column("text")), size)]
            keys, n = np.unique(np.concatenate(held), return_counts=True) if held else (np.zeros(0, U), np.zeros(0))
            yield dealt(keys, parts, n.astype(np.uint32))

    def merge(table: pa.Table) -> pa.Table:
        keys, n = gathered(table, np.uint32)
        start, _ = groups(keys)
        total = np.add.reduceat(n.astype(np.int64), start) if len(start) else np.zeros(0, np.int64)
        often = total > least
        return pa.table({"h": pa.array(keys[start][often].view(np.int64)), "n": pa.array(total[often])})

    found = cut(in_ranges(docs.select(F.col(text).cast("string").alias("text")).mapInArrow(count, BLOB), merge, "h long, n long"), "frequent-tokens")
    above = {r["level"]: r["count"] for r in found.groupBy(F.floor(F.log2(F.col("n") - 1)).alias("level")).count().collect()}
    filters = []
    for times, width in LEVELS:
        limit = frequent * times
        while sum(c for level, c in above.items() if level >= int(np.log2(limit))) > 1 << (width - 4):
            limit *= 2
        keys = found.filter(F.col("n") > limit).select("h").toArrow().column("h").to_numpy().view(U)
        bits = np.zeros(1 << (width - 6), U)
        bit = mix(keys) >> U(64 - width)
        np.bitwise_or.at(bits, (bit >> U(6)).astype(np.int64), U(1) << (bit & U(63)))
        filters.append(bits)
    return filters


def classes_of(tokens: np.ndarray, filters: list[np.ndarray]) -> np.ndarray:
    """0 for a rare token, else the number of filters that hold it from the first on."""
    key = mix(tokens >> U(24) << U(24))
    level, still = np.zeros(len(tokens), np.int64), np.ones(len(tokens), bool)
    for bits in filters:
        bit = key >> U(64 - (len(bits).bit_length() + 5))
        still &= (bits[(bit >> U(6)).astype(np.int64)] >> (bit & U(63))) & U(1) == 1
        level += still
    return level


def pair_signatures(tokens: np.ndarray, n: int, lost: int, percent: int) -> np.ndarray:
    """Signatures of frequent tokens (in their order) of a set of n tokens from which `lost` of them may be missing."""
    out = []
    band = int(np.floor(np.log(n) / np.log(100 / percent) + 1e-9))
    for scheme in (band, band + 1):
        least = (100 / percent) ** (scheme - 1)
        count = max(1, int(least / 8))  # groups of this scheme; any set of the scheme has tokens to spare for them
        group = (mix(tokens + U(scheme)) % U(count)).astype(np.int64)
        opens = np.zeros(len(tokens), bool)
        opens[np.unique(group, return_index=True)[1]] = True
        reached = np.flatnonzero(np.cumsum(~opens) >= lost + 1)
        end = reached[0] + 1 if len(reached) else len(tokens)
        order = np.argsort(group[:end], kind="stable")
        g, t = group[order], tokens[order]
        for step in range(1, end):
            same = g[step:] == g[:-step]
            if not same.any():
                break
            out.append(mix(mix(t[:-step][same] + U(scheme)) + t[step:][same]))
    return np.concatenate(out) if out else np.zeros(0, U)


def signatures(tokens: np.ndarray, of: np.ndarray, filters: list[np.ndarray], percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """(signature, row) of a slice's sets."""
    n = np.diff(of)
    row = np.repeat(np.arange(len(n)), n)
    lost = n - need(n, percent)
    level = classes_of(tokens, filters)
    often = level > 0
    rare = np.concatenate(([0], np.cumsum(~often)))
    rank = rare[:-1] - rare[of[row]]  # rare tokens of the row before this one
    use = ~often & (rank <= lost[row])
    keys, rows = [mix(tokens[use])], [row[use]]
    u = rare[of[1:]] - rare[of[:-1]]
    for r in np.flatnonzero((u <= lost) & (n > u)):
        own, rank = tokens[of[r] : of[r + 1]], level[of[r] : of[r + 1]]
        ordered = own[np.argsort(rank, kind="stable")][int(u[r]) :]
        made = pair_signatures(ordered, int(n[r]), int(lost[r] - u[r]), percent)
        keys.append(made)
        rows.append(np.full(len(made), r))
    return np.concatenate(keys), np.concatenate(rows)


def member_lists(docs: DataFrame, text: str, filters: list[np.ndarray], size: int, percent: int) -> DataFrame:
    """(members): the distinct lists of two or more sets that share a signature, each sorted."""
    spark = docs.sparkSession
    parts, shared = ranges(spark), spark.sparkContext.broadcast(filters)

    def run(batches):
        table = shared.value
        for batch in batches:
            keys, sets = [np.zeros(0, U)], [np.zeros(0, U)]
            for _, tokens, of in token_sets(text_array(batch.column("text")), size):
                k, row = signatures(tokens, of, table, percent)
                keys.append(k)
                sets.append(set_keys(tokens, of)[row])
            yield dealt(np.concatenate(keys), parts, np.concatenate(sets))

    def merge(table: pa.Table) -> pa.Table:
        keys, sets = gathered(table, U)
        order = np.lexsort((sets, keys))
        keys, sets = keys[order], sets[order]
        new = np.ones(len(keys), bool)
        new[1:] = (keys[1:] != keys[:-1]) | (sets[1:] != sets[:-1])  # copies are one set
        keys, sets = keys[new], sets[new]
        start, n = groups(keys)
        total = np.concatenate((np.zeros(1, U), np.cumsum(mix(sets), dtype=U)))
        name = mix(total[start + n] - total[start] + n.astype(U))
        _, first = np.unique(np.where(n > 1, name, U(0)), return_index=True)
        first = first[n[first] > 1]
        lists = [sets[start[i] : start[i] + n[i]].view(np.int64) for i in first]
        return pa.table({"name": pa.array(name[first].view(np.int64)), "members": pa.array(lists, pa.list_(pa.int64()))})

    blobs = docs.select(F.col(text).cast("string").alias("text")).mapInArrow(run, BLOB)
    return in_ranges(blobs, merge, "name long, members array<long>").dropDuplicates(["name"])


def verified(docs: DataFrame, text: str, pairs: DataFrame, sets: DataFrame, size: int, percent: int) -> DataFrame:
    """(a, b) of the pairs of sets that link: sketches drop pairs that cannot, the others are compared token by token."""
    spark = docs.sparkSession
    pairs = cut(_sketched(cut(pairs, "set-pairs"), sets, percent), "likely-pairs")
    wanted = cut(pairs.select(F.explode(F.array("a", "b")).alias("set")).distinct().join(sets.select("set", "text_key"), "set").select("text_key"), "wanted-texts")
    shared = spark.sparkContext.broadcast(_text_filter(wanted))

    def run(batches):
        table = shared.value
        for batch in batches:
            key = batch.column("text_key").to_numpy().view(U)
            bit = key >> U(64 - SETS_BITS)
            hit = np.flatnonzero((table[bit >> U(6)] >> (bit & U(63))) & U(1) == 1)
            names, blobs = [], []
            for _, tokens, of in token_sets(text_array(batch.column("text").take(pa.array(hit))), size):
                names.append(set_keys(tokens, of).view(np.int64))
                blobs += [tokens[of[i] : of[i + 1]].tobytes() for i in range(len(of) - 1)]
            yield pa.RecordBatch.from_arrays([batch.column("text_key").take(pa.array(hit)), pa.array(np.concatenate(names) if names else [], pa.int64()), pa.array(blobs, pa.binary())], ["text_key", "set", "tokens"])

    slim = docs.select(_text_key(F.col(text)).alias("text_key"), F.col(text).cast("string").alias("text"))
    # One text stands for all of its copies and for other texts with the same set.
    held = slim.mapInArrow(run, "text_key long, set long, tokens binary").join(wanted, "text_key", "left_semi").dropDuplicates(["set"]).drop("text_key")
    held = cut(held, "wanted-sets")
    both = pairs.join(held.select(F.col("set").alias("a"), F.col("tokens").alias("ta")), "a").join(held.select(F.col("set").alias("b"), F.col("tokens").alias("tb")), "b")

    def compare(batches):
        for batch in batches:
            link = np.zeros(batch.num_rows, bool)
            for i, (ta, tb) in enumerate(zip(batch.column("ta"), batch.column("tb"), strict=True)):
                x, y = np.frombuffer(ta.as_buffer(), U), np.frombuffer(tb.as_buffer(), U)
                if min(len(x), len(y)) * 100 >= percent * max(len(x), len(y)):
                    merged = np.sort(np.concatenate((x, y)), kind="stable")
                    common = int(np.count_nonzero(merged[1:] == merged[:-1]))
                    link[i] = 100 * common >= percent * (len(x) + len(y) - common)
            kept = pa.array(np.flatnonzero(link))
            yield pa.RecordBatch.from_arrays([batch.column("a").take(kept), batch.column("b").take(kept)], ["a", "b"])

    return both.select("a", "b", "ta", "tb").mapInArrow(compare, "a long, b long")


def _sketched(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose sketches allow a link."""
    side = lambda c: sets.select(F.col("set").alias(c), F.struct("n_shingles", "sketch").alias(f"s{c}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")

    def run(batches):
        for batch in batches:
            a, b = batch.column("sa").to_pylist(), batch.column("sb").to_pylist()
            kept = [i for i, (x, y) in enumerate(zip(a, b, strict=True)) if may_link(x["n_shingles"], y["n_shingles"], x["sketch"], y["sketch"], percent)]
            index = pa.array(kept, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("a").take(index), batch.column("b").take(index)], ["a", "b"])

    return both.select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long")


def _text_filter(keys: DataFrame) -> np.ndarray:
    """Filter of text keys: at most 2**SETS_BITS / 64 rows of 64 bits reach the driver."""
    bit = F.shiftrightunsigned(F.col("text_key"), 64 - SETS_BITS)
    rows = keys.select(bit.alias("bit")).groupBy(F.shiftright("bit", 6).alias("at")).agg(F.expr("bit_or(shiftleft(1L, cast(bit % 64 as int)))").alias("bits")).toArrow()
    out = np.zeros(1 << (SETS_BITS - 6), U)
    out[rows.column("at").to_numpy()] = rows.column("bits").to_numpy().view(U)
    return out


def links(docs: DataFrame, text: str, rows: DataFrame, size: int = SIZE, percent: int = PERCENT, frequent: int = FREQUENT) -> DataFrame:
    """(a, b): verified links between sets that connect everything that links; `rows` are described() rows."""
    sets = cut(rows.filter("n_shingles > 0").groupBy("set").agg(F.min("text_key").alias("text_key"), F.first("n_shingles").alias("n_shingles"), F.first("sketch").alias("sketch")), "sets")
    lists = cut(member_lists(docs, text, frequent_tokens(docs, text, size, frequent), size, percent), "member-lists")
    members = lists.select("name", F.explode("members").alias("node"))
    # Of a list the set with most lists is the centre: an original meets its copies in more places than they each other.
    degree = cut(members.groupBy("node").agg(F.count(F.lit(1)).alias("n")), "set-degrees")
    counted = members.join(degree, "node")
    centre = counted.groupBy("name").agg(F.max(F.struct("n", "node")).alias("top"), F.count(F.lit(1)).alias("m")).select("name", "m", F.col("top.node").alias("centre"))
    placed = cut(members.join(centre, "name"), "list-members")
    star = placed.filter(F.col("node") != F.col("centre")).select(F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b")).distinct()
    star = cut(star, "centre-pairs")
    first = cut(verified(docs, text, star, sets, size, percent), "first-links")
    # Lists whose members are not all connected yet meet across components.
    known = cut(components(first), "first-components")
    labelled = placed.join(known, "node", "left").withColumn("component", F.coalesce("component", "node"))
    labelled = cut(labelled, "labelled-members")
    open_lists = labelled.groupBy("name").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low < high").select("name")
    left = labelled.join(open_lists, "name").join(sets.select(F.col("set").alias("node"), "n_shingles", "sketch"), "node")
    more = cut(_across(left, percent), "set-pairs").distinct().join(star, ["a", "b"], "left_anti")
    return first.union(verified(docs, text, more, sets, size, percent))


BLOCK = 4_096  # members of a list that are compared together
PLACED = 200_000  # rows of a centre's lists that are compared in one place


def _across(members: DataFrame, percent: int) -> DataFrame:
    """(a, b): likely pairs of different components in each list, from (name, m, centre, node, component, n_shingles, sketch).

    Lists are cut into blocks and every two blocks of a list meet; only likely
    pairs are made. Lists of one centre share most of their pairs, so they are
    compared together, up to PLACED rows.
    """
    blocks = F.ceil(F.col("m") / BLOCK).cast("int")
    parts = ranges(members.sparkSession)
    own = members.select("name", "node", "component", "n_shingles", "sketch", "centre", F.pmod(F.xxhash64("node"), blocks).cast("int").alias("block"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
    met = own.select("*", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    rows = members.groupBy("centre").agg(F.ceil(F.count(F.lit(1)) / PLACED).alias("places"))
    spread = F.pmod(F.xxhash64("name", "i", "j"), F.col("places"))
    dealt_out = met.join(rows, "centre").withColumn("part", F.pmod(F.xxhash64("centre", spread), F.lit(parts)).cast("int")).drop("places", "centre")

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("name", "ascending"), ("i", "ascending"), ("j", "ascending"), ("n_shingles", "ascending"), ("node", "ascending")])
        name, i, j, block, node, component, n = (table.column(c).to_numpy() for c in ("name", "i", "j", "block", "node", "component", "n_shingles"))
        sketch = table.column("sketch").to_pylist()
        new = np.ones(len(name), bool)
        new[1:] = (name[1:] != name[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])
        start = np.flatnonzero(new)
        a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for low, high in zip(start.tolist(), [*start[1:].tolist(), len(name)], strict=True):
            side = None if i[low] == j[low] else block[low:high]
            x, y = likely(component[low:high], n[low:high], sketch[low:high], side, percent)
            a.append(node[low + x])
            b.append(node[low + y])
        a, b = np.concatenate(a), np.concatenate(b)
        pairs = np.unique(np.stack((np.minimum(a, b), np.maximum(a, b)), axis=1), axis=0)
        return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})

    return dealt_out.groupBy("part").applyInArrow(run, "a long, b long")


def likely(component: np.ndarray, n: np.ndarray, sketch: list[bytes], side: np.ndarray | None, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of different components (and sides) that sizes and sketches allow; rows are in order of n."""
    width = np.array([len(s) for s in sketch])
    folded: dict[int, tuple[int, np.ndarray]] = {}  # of the rows from the first one of a width on, at that width
    for w in np.unique(width).tolist():
        first = int(np.searchsorted(width, w))
        rows = []
        for s in sketch[first:]:
            bits = np.frombuffer(s, U)
            while len(bits) * 8 > w:
                bits = bits[: len(bits) // 2] ^ bits[len(bits) // 2 :]
            rows.append(bits)
        folded[w] = (first, np.stack(rows))
    out_a, out_b = [], []
    last = np.searchsorted(n, (100 * n) // percent, "right")
    for i in range(len(n) - 1):
        if last[i] <= i + 1:
            continue
        j = slice(i + 1, int(last[i]))
        first, table = folded[int(width[i])]
        common = -(-percent * (n[i] + n[j]) // (100 + percent))
        far = np.bitwise_count(table[i + 1 - first : last[i] - first] ^ table[i - first]).sum(axis=1)
        fit = (component[j] != component[i]) & (common <= n[i]) & (far <= n[i] + n[j] - 2 * common)
        if side is not None:
            fit &= side[j] != side[i]
        found = np.flatnonzero(fit) + i + 1
        out_a.append(np.full(len(found), i))
        out_b.append(found)
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *out_a]), np.concatenate([none, *out_b])


def classes(docs: DataFrame, key: str, text: str, size: int = SIZE, percent: int = PERCENT, frequent: int = FREQUENT) -> DataFrame:
    """(id, text_key, n_shingles, set, component, component_id) of every row of docs.

    Empty sets have no component and their own id; classes that repeat an id may share a component_id.
    """
    rows = cut(described(docs, key, text, size), "document-sets")
    nodes = cut(components(links(docs, text, rows, size, percent, frequent)), "components").select(F.col("node").alias("set"), "component")
    named = rows.filter("n_shingles > 0").groupBy("set").agg(F.min("id").alias("id")).join(nodes, "set", "left").withColumn("component", F.coalesce("component", "set"))
    named = cut(named, "named-sets")
    least = named.groupBy("component").agg(F.min("id").alias("component_id"))
    known = cut(named.join(least, "component").select(F.col("set").alias("_set"), "component", "component_id"), "set-components")
    linked = rows.drop("sketch").join(known, (F.col("set") == F.col("_set")) & (F.col("n_shingles") > 0), "left").drop("_set")
    return linked.withColumn("component_id", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("id")))


def one_of_each(docs: DataFrame, key: str, text: str, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """The rows of docs, all columns, without those linked to a row of smaller id.

    Of a class the rows with its smallest id and, among them, the smallest
    text hash stay; rows with empty sets all stay, null ids come last.
    """
    found = classes(docs, key, text, size, percent).filter("n_shingles > 0")
    best = found.groupBy("component").agg(F.min(F.struct(F.col("id").isNull().alias("last"), "id", "text_key")).alias("best"))
    keep = cut(best.select(F.col("best.id").alias("_id"), F.col("best.text_key").alias("_text_key")).distinct(), "kept-documents")
    # Whole rows travel as one struct, so no column can clash with another.
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col(key).alias("id"), _text_key(F.col(text)).alias("text_key"), F.coalesce(F.col(text), F.lit("")).rlike(r"[^\x20\x09-\x0D]").alias("worded"))
    joined = rows.join(keep, F.col("id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_text_key")), "left")
    return joined.filter(~F.col("worded") | F.col("_text_key").isNotNull()).select("row.*")
