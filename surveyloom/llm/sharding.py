"""Shards on a consistent-hash ring with virtual nodes and bounded loads.

Every shard owns many points of a ring; a row belongs to the arc its key falls
on and goes to the owner of the next point clockwise. A shard takes no more
than its capacity: what overflows continues clockwise to the next owner with
room. Capacities sum to the number of rows times (1 + slack), so no shard is
above its bound and, without slack, counts differ by one at most. Adding a
shard moves rows onto its arcs, and besides only what overflows elsewhere.

Work per row is JVM-side. Alike rows (same id, size and checksum) are counted
first, so a copied row, however frequent, meets the shuffle as one counted row
per task. Rows are ranked inside small cells of the ring; only the counts of
cells (places x cells, a product of parameters) reach the driver, where the
walk around the ring is worked out.
"""

from __future__ import annotations

import bisect
import hashlib

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import cut

SLOTS = 1 << 14  # places on the ring
CHUNK = 10_000  # copies of one row that one task unrolls


def ring(shards: int, points: int, seed: int = 7) -> list[tuple[int, int]]:
    """(place, shard) of all virtual nodes in clockwise order."""
    digest = lambda shard, k: hashlib.sha256(f"{seed}/{shard}/{k}".encode()).digest()
    return sorted((int.from_bytes(digest(s, k)[:8], "big") % SLOTS, s) for s in range(shards) for k in range(points))


def capacities(rows: int, shards: int, slack: float) -> list[int]:
    """What each shard may take; without slack they sum to `rows` and differ by one at most."""
    if slack > 0:
        return [-(-int(rows * (1 + slack) + 1) // shards)] * shards
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def walk(nodes: list[tuple[int, int]], counts: list[int], room: list[int]) -> list[tuple[int, int, int, int, int]]:
    """(arc, from, to, shard, first slot): which of an arc's ranked rows go where.

    Owners are served first, in ring order; overflow then continues clockwise
    from its arc to the next node whose shard has room.
    """
    room, filled, out, waiting = list(room), [0] * len(room), [], []

    def take(arc: int, low: int, n: int, shard: int) -> int:
        got = min(n, room[shard])
        if got:
            out.append((arc, low, low + got, shard, filled[shard]))
            room[shard] -= got
            filled[shard] += got
        return got

    for arc, n in enumerate(counts):
        got = take(arc, 0, n, nodes[arc][1])
        if got < n:
            waiting.append((arc, got, n - got))
    for arc, low, n in waiting:
        step = 1
        while n:
            got = take(arc, low, n, nodes[(arc + step) % len(nodes)][1])
            low, n, step = low + got, n - got, step + 1
    return out


def ring_shards(df: DataFrame, key: str, text: str, shards: int = 8, points: int = 128, cells: int = 8, slack: float = 0.0) -> DataFrame:
    """(key, size, text_crc32, arc, shard, slot) of every row of `df`.

    `size` is the UTF-8 length of the text plus 1, `text_crc32` its unsigned
    checksum; a null text counts as empty and a null key has its own place on
    the ring. Alike rows may lie in different shards. `slot` numbers the rows
    of a shard from 0 without gaps. An empty table gives no rows. Other columns
    are ignored.
    """
    spark, nodes = df.sparkSession, ring(shards, points)
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    place = F.pmod(F.xxhash64(F.lit("ring"), F.coalesce(F.col("key").cast("string"), F.lit("null"))), F.lit(SLOTS)).cast("int")
    sub = F.pmod(F.xxhash64(F.lit("cell"), "size", "text_crc32"), F.lit(cells)).cast("int")
    alike = (
        df.select(F.col(key).alias("key"), (F.octet_length(body) + 1).cast("long").alias("size"), F.crc32(body).alias("text_crc32"))
        .groupBy("key", "size", "text_crc32")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    rows = cut(alike.select("*", place.alias("place"), sub.alias("sub")), "ring-rows")

    found = rows.groupBy("place", "sub").agg(F.sum("n").alias("n")).collect()  # at most SLOTS x cells rows
    places, start, counts = [p for p, _ in nodes], [], [0] * len(nodes)
    for p, s, n in sorted((r["place"], r["sub"], r["n"]) for r in found):
        arc = bisect.bisect_left(places, p) % len(nodes)  # a node covers the arc that ends at it
        start.append((p, s, arc, counts[arc]))
        counts[arc] += n
    segments = walk(nodes, counts, capacities(sum(counts), shards, slack))

    cell = F.broadcast(spark.createDataFrame(pd.DataFrame(start, columns=["place", "sub", "arc", "before"]), "place int, sub int, arc int, before long"))
    parts = F.broadcast(spark.createDataFrame(segments, "arc int, low long, high long, shard int, slot0 long"))
    order = Window.partitionBy("place", "sub").orderBy(F.col("key").asc_nulls_first(), "size", "text_crc32")
    ranked = rows.join(cell, ["place", "sub"]).withColumn(
        "rank", F.col("before") + F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")
    )
    # Counted rows are unrolled in two steps, so that one very frequent row is dealt over tasks.
    chunk = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / CHUNK)))
    dealt = ranked.select("*", chunk.alias("chunk")).repartition("place", "sub", "rank", "chunk")
    first = F.col("chunk") * CHUNK
    copy = F.explode(F.sequence(first, F.least(first + (CHUNK - 1), F.col("n") - 1)))
    single = dealt.select("key", "size", "text_crc32", "arc", "rank", copy.alias("copy")).withColumn("at", F.col("rank") + F.col("copy"))
    here = single.join(parts, "arc").filter((F.col("at") >= F.col("low")) & (F.col("at") < F.col("high")))
    return here.select(F.col("key").alias(key), "size", "text_crc32", "arc", "shard", (F.col("slot0") + F.col("at") - F.col("low")).alias("slot"))
