"""Benchmark decontamination by greedy string tiling.

Words are runs of letters and digits, lower-cased. A tile is a run of at least
`min_match` words that a document and a benchmark item share; the longest
unmarked match is marked first, then the next, without overlaps on either side,
so passages count in any order. A document is contaminated when the tiles of
one item cover at least `coverage` of the item's words. Items of fewer than
`min_match` words have no tile and are never reported.

1. Windows of `min_match` words of all items set bits of a filter of fixed size.
2. Documents stream past it; only windows that hit go on, keyed by the SHA-256
   of the text, so copies of a text collapse before they are joined.
3. Seeds: a text can only reach the coverage of an item if it has one of all
   but (coverage * words / min_match - 1) of the item's windows; the windows
   that most items share are the ones left out, so phrases common to many
   items make no candidates.
4. Texts and items that share a seed are tiled from their window hits.

Null counts as an empty text. Equal items are one, named by the smallest id;
items without id are left out. Tied items: highest coverage, then smallest id.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import cut
from .words import PUNCTUATED, U, pieces, text_array, windows

MIN_MATCH = 5
COVERAGE = 0.5
FILTER_BITS = 24  # 2 MB, whatever the benchmark; a full filter only lets more windows through


def _text_key(text: Column) -> Column:
    return F.sha2(F.coalesce(text.cast("string"), F.lit("")), 256)


def _windows(column: pa.Array, size: int):
    """(row of the batch, words, window hashes, first words) of each text."""
    for words in pieces(pc.utf8_lower(text_array(column)), PUNCTUATED):
        hashes, first = windows(words.hashes(), words.of, size)
        bounds = np.searchsorted(first, words.of)
        for i in range(words.rows):
            own = slice(bounds[i], bounds[i + 1])
            yield words.row + i, int(words.of[i + 1] - words.of[i]), hashes[own], first[own] - words.of[i]


def item_windows(items: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """(item, n_words, h): every window hash of each distinct item, in order."""

    def run(batches):
        for batch in batches:
            rows = [(i, n, h.view(np.int64)) for i, n, h, _ in _windows(batch.column("text"), size) if len(h)]
            kept = pa.array([r[0] for r in rows], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("item").take(kept), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.list_(pa.int64()))], ["item", "n_words", "h"]
            )

    slim = items.select(F.col(key).cast("long").alias("item"), F.col(text).cast("string").alias("text")).filter(F.col("item").isNotNull())
    return slim.mapInArrow(run, "item long, n_words int, h array<long>").groupBy("h", "n_words").agg(F.min("item").alias("item"))


def window_filter(item_rows: DataFrame) -> np.ndarray:
    """Bits of all item windows: at most 2**FILTER_BITS / 64 rows reach the driver, each 64 bits."""
    bit = F.shiftrightunsigned(F.col("w"), 64 - FILTER_BITS)
    rows = item_rows.select(F.explode("h").alias("w")).select(bit.alias("bit"))
    words = rows.groupBy(F.shiftright("bit", 6).alias("at")).agg(F.expr("bit_or(shiftleft(1L, cast(bit % 64 as int)))").alias("bits"))
    out = np.zeros(1 << (FILTER_BITS - 6), U)
    for row in words.collect():
        out[row["at"]] = np.int64(row["bits"]).view(U)
    return out


def window_hits(docs: DataFrame, text: str, bits: np.ndarray, size: int) -> DataFrame:
    """(text_key, pos, h) of the texts with windows that pass the filter."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches):
        table = shared.value
        for batch in batches:
            rows = []
            for i, _, h, first in _windows(batch.column("text"), size):
                bit = h >> U(64 - FILTER_BITS)
                hit = (table[bit >> U(6)] >> (bit & U(63))) & U(1) == 1
                if hit.any():
                    rows.append((i, first[hit].astype(np.int32), h[hit].view(np.int64)))
            kept = pa.array([r[0] for r in rows], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("text_key").take(kept), pa.array([r[1] for r in rows], pa.list_(pa.int32())), pa.array([r[2] for r in rows], pa.list_(pa.int64()))], ["text_key", "pos", "h"]
            )

    slim = docs.select(_text_key(F.col(text)).alias("text_key"), F.col(text).cast("string").alias("text"))
    hits = slim.mapInArrow(run, "text_key string, pos array<int>, h array<long>")
    return hits.groupBy("text_key").agg(F.first("pos").alias("pos"), F.first("h").alias("h"))


def tiles(pos: np.ndarray, h: np.ndarray, item: np.ndarray, size: int) -> list[tuple[int, int, int]]:
    """(first word in the text, first word in the item, words) of the greedy tiling, longest first."""
    order = np.argsort(item, kind="stable")
    low, high = np.searchsorted(item[order], h, "left"), np.searchsorted(item[order], h, "right")
    n = high - low
    d = np.repeat(pos.astype(np.int64), n)
    i = order[np.repeat(low - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())] if n.sum() else np.zeros(0, np.int64)
    # Matching windows that follow each other on a diagonal are one match.
    by = np.lexsort((d, d - i))
    d, i = d[by], i[by]
    new = np.ones(len(d), bool)
    new[1:] = (d[1:] - i[1:] != d[:-1] - i[:-1]) | (d[1:] != d[:-1] + 1)
    start = np.flatnonzero(new)
    length = np.diff(np.append(start, len(d))) + size - 1
    queue = [(-int(k), int(a), int(b)) for k, a, b in zip(length, d[start], i[start], strict=True)]
    heapq.heapify(queue)
    in_doc, in_item, out = set(), set(), []
    while queue:
        k, a, b = heapq.heappop(queue)
        free = [a + j not in in_doc and b + j not in in_item for j in range(-k)]
        if all(free):
            in_doc.update(range(a, a - k))
            in_item.update(range(b, b - k))
            out.append((a, b, -k))
            continue
        run = 0
        for j, ok in enumerate([*free, False]):  # what is still unmarked competes again
            if ok:
                run += 1
            else:
                if run >= size:
                    heapq.heappush(queue, (-run, a + j - run, b + j - run))
                run = 0
    return out


def contaminated_texts(docs: DataFrame, text: str, items: DataFrame, item_key: str, item_text: str, min_match: int = MIN_MATCH, coverage: float = COVERAGE) -> DataFrame:
    """(text_key, item_id, coverage, n_tiles, tiles) of every text and item at or above the coverage.

    `tiles` are (first word in the text, first word in the item, words).
    """
    known = cut(item_windows(items, item_key, item_text, min_match), "benchmark-windows")
    hits = cut(window_hits(docs, text, window_filter(known), min_match), "window-hits")

    each = known.select("item", "n_words", F.size("h").alias("n"), F.explode(F.array_distinct("h")).alias("w"))
    spread = each.groupBy("w").agg(F.count(F.lit(1)).alias("items"))
    rank = F.row_number().over(Window.partitionBy("item").orderBy("items", "w"))
    distinct = F.count(F.lit(1)).over(Window.partitionBy("item"))
    # Repeated windows of an item can be one match each, so the bound counts places, then distinct windows.
    spare = F.ceil(F.col("n_words") * coverage / min_match) - 1 - (F.col("n") - distinct)
    seeds = each.join(spread, "w").select("item", "w", rank.alias("rank"), F.greatest(distinct - spare, F.lit(1)).alias("keep")).filter("rank <= keep").select("item", "w")

    found = hits.select("text_key", F.explode(F.array_distinct("h")).alias("w"))
    pairs = cut(found.join(seeds, "w").select("text_key", "item").distinct(), "seed-pairs")
    both = pairs.join(hits, "text_key").join(known.select("item", "n_words", F.col("h").alias("item_h")), "item")

    def run(batches):
        for batch in batches:
            made = []
            for r in range(batch.num_rows):
                arrays = [batch.column(c)[r].values.to_numpy(zero_copy_only=False) for c in ("pos", "h", "item_h")]
                marked = tiles(*arrays, min_match)
                made.append((sum(t[2] for t in marked) / batch.column("n_words")[r].as_py(), len(marked), [dict(zip(("text", "item", "words"), t, strict=True)) for t in marked]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("text_key"), batch.column("item"), pa.array([m[0] for m in made], pa.float64()), pa.array([m[1] for m in made], pa.int32()),
                 pa.array([m[2] for m in made], pa.list_(pa.struct([("text", pa.int32()), ("item", pa.int32()), ("words", pa.int32())])))],
                ["text_key", "item_id", "coverage", "n_tiles", "tiles"],
            )

    tiled = both.mapInArrow(run, "text_key string, item_id long, coverage double, n_tiles int, tiles array<struct<text:int,item:int,words:int>>")
    return tiled.filter(F.col("coverage") >= coverage)


def contamination(docs: DataFrame, keep_columns: list[str], text: str, items: DataFrame, item_key: str, item_text: str, min_match: int = MIN_MATCH, coverage: float = COVERAGE) -> DataFrame:
    """(keep_columns, contaminated, item_id, coverage, n_tiles, n_items) of every row; item_id is the best covered item or null."""
    best = F.max_by(F.struct("item_id", "coverage", "n_tiles"), F.struct("coverage", -F.col("item_id")))
    texts = contaminated_texts(docs, text, items, item_key, item_text, min_match, coverage).groupBy("text_key").agg(best.alias("best"), F.count(F.lit(1)).alias("n_items"))
    # A written table has a known size, from which Spark chooses how to join.
    known = cut(texts.select(F.col("text_key").alias("_text_key"), F.col("best").alias("_best"), F.col("n_items").alias("_n_items")), "contaminated-texts")
    rows = docs.select(F.struct(*keep_columns).alias("row"), _text_key(F.col(text)).alias("_text_key")).join(known, "_text_key", "left")
    return rows.select(
        "row.*", F.col("_best").isNotNull().alias("contaminated"), F.col("_best.item_id").alias("item_id"), F.col("_best.coverage").alias("coverage"),
        F.col("_best.n_tiles").alias("n_tiles"), F.coalesce("_n_items", F.lit(0).cast("long")).alias("n_items"),
    )


def clean(docs: DataFrame, text: str, items: DataFrame, item_key: str, item_text: str, min_match: int = MIN_MATCH, coverage: float = COVERAGE) -> DataFrame:
    """The rows of docs, all columns, whose text is not contaminated."""
    texts = contaminated_texts(docs, text, items, item_key, item_text, min_match, coverage)
    known = cut(texts.select(F.col("text_key").alias("_text_key")).distinct(), "contaminated-texts")
    rows = docs.select(F.struct(*docs.columns).alias("row"), _text_key(F.col(text)).alias("_text_key"))
    return rows.join(known, "_text_key", "left_anti").select("row.*")


