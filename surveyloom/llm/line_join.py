"""Line de-duplication by an exact set-similarity join. JVM expressions only.

A line's tokens are its distinct words (runs without white space, lower-cased).
A line is removed when an earlier line, in this or another document, has the
same tokens or a Jaccard similarity of at least `threshold` to them; lines
without a word stay, as do those of fewer than `min_words` distinct words where
a caller asks for more than one. Earlier is by (id, line number), null ids last;
rows with the same id are at the same place and keep their lines.

1. Words are counted in a table of fixed size over all lines; a token is its
   64-bit hash with the size class of its count on top, so sorting tokens
   orders them by rarity. White space is made plain in the text before, so no
   pattern is needed to cut words. The classes reach the tasks from a stored table of
   one row, as the value of a scalar subquery.
2. Lines with equal tokens are one set, named by its first place. Only the
   prefix of a set (what a partner must share with it) goes on, with 64 parity
   bits: sets that differ in k tokens differ in k of the bits at most.
3. Prefix tokens meet by key under length, positional and parity filters.
   Whether a set goes is a question of existence, so each set is first compared
   with the first member of its tokens' groups; in groups of near copies that
   settles almost all, and only sets still open meet all earlier members.
4. Candidates are verified on whole lines, cut again from their documents;
   a filter of fixed size names the documents first, then the lines.

Tables written on the way are deleted when the result is stored.
"""

from __future__ import annotations

import operator
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import cut, delete_cut

THRESHOLD = 0.9
MIN_WORDS = 1
COUNT_BITS = 20  # counters of the word table
CHUNK_BITS = 10  # array entries put in order together
FILTER_BITS = 24  # of the filter of lines to verify
CLASS_BITS = 57  # below: hash; above: class of the count
OTHER_SPACE = "\t\x0b\x0c\r"  # besides blanks and line ends


def plain(text: Column) -> Column:
    """Lower-cased, with blanks for other white space than line ends: splitting at one character needs no pattern."""
    odd = reduce(operator.or_, [F.contains(text, F.lit(c)) for c in OTHER_SPACE])
    return F.lower(F.when(odd, F.regexp_replace(text, f"[{OTHER_SPACE}]", " ")).otherwise(text))


def word_hashes(line: Column) -> Column:
    """64-bit hashes of the distinct words of a plain line."""
    return F.array_remove(F.array_distinct(F.transform(F.split(line, " "), lambda w: F.xxhash64(w))), F.xxhash64(F.lit("")))


def in_one_row(table: DataFrame, bits: int, name: str) -> DataFrame:
    """One row with the values of a table (slot, value) as an array; the table has every slot below 2**bits once."""
    chunks = table.groupBy(F.shiftright("slot", CHUNK_BITS).alias("chunk")).agg(F.array_sort(F.collect_list(F.struct("slot", "value"))).getField("value").alias("values"))
    return chunks.agg(F.flatten(F.array_sort(F.collect_list(F.struct("chunk", "values"))).getField("values")).alias(name))


def word_classes(docs: DataFrame, text: str) -> DataFrame:
    """One row, `classes`: for each counter its class (1 to 60, twice the logarithm of the count), as what turns a hash into a token."""
    words = docs.select(F.explode(F.split(F.concat_ws(" ", F.split(plain(F.col(text).cast("string")), "\n")), " ")).alias("w"))
    counts = words.groupBy(F.shiftrightunsigned(F.xxhash64("w"), 64 - COUNT_BITS).alias("slot")).agg(F.count(F.lit(1)).alias("n"))
    every = docs.sparkSession.range(1 << COUNT_BITS).select(F.col("id").alias("slot"), F.lit(1).cast("long").alias("n"))
    size = F.least(F.lit(60), 1 + F.floor(2 * F.log2("n")))
    # The bits of the hash above the class are those of the slot, so one XOR puts the class in their place.
    change = F.shiftleft(size.cast("long").bitwiseXOR(F.shiftright("slot", COUNT_BITS + CLASS_BITS - 64)), CLASS_BITS)
    return in_one_row(counts.union(every).groupBy("slot").agg(F.max("n").alias("n")).select("slot", change.alias("value")), COUNT_BITS, "classes")


def line_filter(lines: DataFrame) -> DataFrame:
    """One row, `bits`: 2**FILTER_BITS bits, those of the (id, text_hash, no) of `lines` set, and with -1 for `no` those of their texts; a full filter lets more through."""
    at = _filter_slot(F.col("id"), F.col("text_hash"), F.col("no"))
    both = lines.select("id", "text_hash", F.explode(F.array(F.col("no"), F.lit(-1))).alias("no"))
    words = both.select(F.shiftright(at, 6).alias("slot"), _bit(at).alias("bit")).groupBy("slot").agg(F.bit_or("bit").alias("value"))
    every = lines.sparkSession.range(1 << (FILTER_BITS - 6)).select(F.col("id").alias("slot"), F.lit(0).cast("long").alias("value"))
    return in_one_row(words.union(every).groupBy("slot").agg(F.bit_or("value").alias("value")), FILTER_BITS - 6, "bits")


def _filter_slot(id_: Column, text_hash: Column, no: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(id_, text_hash, no), 64 - FILTER_BITS)


def _in_filter(bits: Column, no: Column) -> Column:
    at = _filter_slot(F.col("id"), F.col("text_hash"), no)
    return F.get(bits, F.shiftright(at, 6).cast("int")).bitwiseAND(_bit(at)) != 0


def token_set(line: Column, classes: Column) -> Column:
    """The tokens of a plain line, rarest first."""

    def token(h: Column) -> Column:
        # No slot is null; saying so lets the tokens be sorted as plain numbers.
        return h.bitwiseXOR(F.coalesce(classes[F.shiftrightunsigned(h, 64 - COUNT_BITS)], F.lit(0).cast("long")))

    return F.sort_array(F.transform(word_hashes(line), token))


def parity(tokens: Column) -> Column:
    """Bit b: whether an odd number of the tokens have b in their lowest six bits."""
    return F.aggregate(tokens, F.lit(0).cast("long"), lambda acc, t: acc.bitwiseXOR(_bit(t)))


def _bit(token: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), token.bitwiseAND(F.lit(63)).cast("int"))


def _lines(docs: DataFrame, key: str, text: str, bits: Column | None = None) -> DataFrame:
    """(id, text_hash, no, line) of every line, which is plain; with a filter, of the texts that pass it."""
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    texts = docs.select(F.col(key).alias("id"), F.xxhash64(body).alias("text_hash"), body.alias("body"))
    if bits is not None:
        texts = texts.filter(_in_filter(bits, F.lit(-1)))
    return texts.select("id", "text_hash", F.posexplode(F.split(plain(F.col("body")), "\n", -1)).alias("no", "line"))


def removed_lines(docs: DataFrame, key: str, text: str, threshold: float = THRESHOLD, min_words: int = MIN_WORDS) -> DataFrame:
    """(id, text_hash, numbers), stored: the numbers of the lines to remove, for the texts that lose any."""
    kept: list[DataFrame] = []

    def held(df: DataFrame, name: str) -> DataFrame:
        kept.append(cut(df, name))
        return kept[-1]

    classes = held(word_classes(docs, text), "word-classes")
    tokens = _lines(docs, key, text).select("*", classes.scalar().alias("classes")).select("id", "text_hash", "no", token_set(F.col("line"), F.col("classes")).alias("tokens"))
    n = F.size("tokens")
    least = threshold / (1 - threshold) - 1e-9  # one token more or less takes a smaller set below the threshold: only equal sets match it
    prefix = F.when(n >= least, F.slice("tokens", 1, n - F.ceil(n * threshold).cast("int") + 1))
    # Lines without a word go after the table is written: a filter before it would cut every line twice.
    sized = held(tokens.select("id", "text_hash", "no", F.xxhash64("tokens").alias("set"), n.alias("n"), F.when(n >= least, parity(F.col("tokens"))).alias("bits"), prefix.alias("prefix")), "line-prefixes").filter(F.col("n") >= min_words)
    place = F.struct(F.col("id").isNull().alias("last"), F.col("id"), F.col("no"), F.col("text_hash"))
    sets = held(
        sized.groupBy("set").agg(F.min(place).alias("place"), F.count(F.lit(1)).alias("lines"), F.first(F.struct("n", "bits", "prefix")).alias("of")).select("set", "place", "lines", "of.*"),
        "line-sets",
    )

    def rows(of: DataFrame, open_: Column) -> DataFrame:
        """A row per prefix token; the lowest bit of `size` says whether the set is still open."""
        size = F.col("n") * 2 + open_.cast("int")
        return of.filter(F.col("n") >= least).select("set", F.col("place.id").alias("id"), F.col("place.no").alias("no"), size.alias("size"), "bits", F.posexplode("prefix").alias("at", "token"))

    def at(of: str) -> Column:
        return F.struct(F.col(f"{of}.id").isNull(), F.col(f"{of}.id"), F.col(f"{of}.no"))

    def near(a: str, b: str) -> Column:
        """Order, length, positional and parity filter for a pair at its first shared token; b must be open."""
        an, bn, aat, bat = F.shiftright(f"{a}.size", 1), F.shiftright(f"{b}.size", 1), F.col(f"{a}.at"), F.col(f"{b}.at")
        common = F.ceil((an + bn) * (threshold / (1 + threshold)) - 1e-9)
        still = bn * F.col(f"{b}.size").bitwiseAND(F.lit(1))  # 0 for sets that are settled
        return (F.least(an, still) >= common) & (at(a) < at(b)) & (1 + F.least(an - aat - 1, bn - bat - 1) >= common) & (F.bit_count(F.col(f"{a}.bits").bitwiseXOR(F.col(f"{b}.bits"))) <= an + bn - 2 * common)

    # Narrow rows are dealt out first, so what the window compares is put together behind the shuffle.
    dealt = rows(sets, F.lit(True)).repartition("token")
    first = F.min(F.struct(F.col("id").isNull().alias("last"), "id", "no", "set", "size", "at", "bits")).over(Window.partitionBy("token"))
    stars = dealt.select(F.struct(*dealt.columns).alias("own"), first.alias("first")).filter(near("first", "own"))
    settled = held(verified(docs, key, text, stars.select(F.col("first.set").alias("a"), F.col("own.set").alias("b")).distinct(), sets, threshold, held), "settled-lines")
    # Sets still open meet every earlier member of their groups. Both sides are the same rows, so one exchange serves them.
    both = rows(sets.join(settled.select(F.col("b").alias("set"), F.lit(True).alias("done")), "set", "left"), F.col("done").isNull())
    pairs = both.alias("e").join(both.alias("o"), (F.col("e.token") == F.col("o.token")) & near("e", "o"))
    rest = held(verified(docs, key, text, pairs.select(F.col("e.set").alias("a"), F.col("o.set").alias("b")).distinct(), sets, threshold, held), "settled-lines")
    gone = settled.union(rest).select(F.col("b").alias("set")).distinct().withColumn("all", F.lit(True))

    # Of a set that goes all lines go; of others all but those at the first place.
    matter = held(sets.join(gone, "set", "left").filter((F.col("lines") > 1) | F.col("all")).select("set", "place", F.coalesce("all", F.lit(False)).alias("all")), "repeated-sets")
    same = F.col("id").eqNullSafe(F.col("place.id")) & (F.col("no") == F.col("place.no"))
    out = sized.select("id", "text_hash", "no", "set").join(matter, "set").filter(F.col("all") | ~same)
    result = cut(out.groupBy("id", "text_hash").agg(F.sort_array(F.collect_set("no")).alias("numbers")), "removed-lines")
    for table in kept:
        delete_cut(table)
    return result


def verified(docs: DataFrame, key: str, text: str, pairs: DataFrame, sets: DataFrame, threshold: float, held: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """(b) of the pairs (a, b) of sets whose Jaccard similarity is at least `threshold`."""
    pairs = held(pairs, "line-pairs")
    need = pairs.select(F.explode(F.array("a", "b")).alias("set")).distinct().join(sets.select("set", "place"), "set")
    wanted = held(need.select("set", "place.id", "place.text_hash", "place.no"), "wanted-lines")
    bits = held(line_filter(wanted), "line-filter")
    # Only texts that pass the filter are cut again, and only lines that pass it move to meet their keys.
    lines = _lines(docs, key, text, bits.scalar()).filter(_in_filter(bits.scalar(), F.col("no")))
    asked = wanted.select("set", F.col("id").alias("_id"), F.col("text_hash").alias("_hash"), F.col("no").alias("_no"))
    found = lines.join(asked, F.col("id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")) & (F.col("no") == F.col("_no")))
    words = held(found.select("set", word_hashes(F.col("line")).alias("words")).dropDuplicates(["set"]), "wanted-sets")
    both = pairs.join(words.select(F.col("set").alias("a"), F.col("words").alias("wa")), "a").join(words.select(F.col("set").alias("b"), F.col("words").alias("wb")), "b")
    common = F.size(F.array_intersect("wa", "wb"))
    return both.select("b", common.alias("c"), (F.size("wa") + F.size("wb")).alias("sum")).filter(F.col("c") >= threshold * (F.col("sum") - F.col("c")) - 1e-9).select("b").distinct()


def removals(docs: DataFrame, key: str, text: str, threshold: float = THRESHOLD, min_words: int = MIN_WORDS) -> DataFrame:
    """(key, n_lines, n_removed, removed) of every row: the numbers of the removed lines from 0 on, ascending."""
    gone = removed_lines(docs, key, text, threshold, min_words).select(F.col("id").alias("_id"), F.col("text_hash").alias("_hash"), F.col("numbers").alias("removed"))
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(F.col(key).alias("id"), F.xxhash64(body).alias("text_hash"), (F.octet_length(body) - F.octet_length(F.replace(body, F.lit("\n"), F.lit(""))) + 1).cast("long").alias("n_lines"))
    joined = rows.join(gone, F.col("id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")), "left")
    return joined.select(F.col("id").alias(key), "n_lines", F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_removed"), F.coalesce("removed", F.array().cast("array<int>")).alias("removed"))


def without_lines(docs: DataFrame, key: str, text: str, threshold: float = THRESHOLD, min_words: int = MIN_WORDS, removed: str | None = None) -> DataFrame:
    """All rows and columns of docs, `text` without its removed lines; `removed` names a column for their number.

    Null texts stay null; a text may end up empty.
    """
    gone = removed_lines(docs, key, text, threshold, min_words).select(F.col("id").alias("_id"), F.col("text_hash").alias("_hash"), F.col("numbers").alias("_numbers"))
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    # Whole rows travel as one struct, so no column can clash with another.
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col(key).alias("id"), F.col(text).alias("text"), F.xxhash64(body).alias("text_hash"))
    joined = rows.join(gone, F.col("id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")), "left")
    kept = F.array_join(F.filter(F.split("text", "\n", -1), lambda line, no: ~F.array_contains("_numbers", no)), "\n")
    now = F.when(F.col("_numbers").isNull(), F.col("text")).otherwise(kept)
    columns = [now.alias(c) if c == text else F.col("row").getField(c).alias(c) for c in docs.columns]
    return joined.select(*columns, *([F.coalesce(F.size("_numbers"), F.lit(0)).cast("long").alias(removed)] if removed else []))
