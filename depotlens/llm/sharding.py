"""Shards by a consistent-hash ring with virtual nodes and bounded loads, in DataFrame functions only.

Every shard has ``vnodes`` points on a ring of 2^60 places; a row belongs to the first point at or after the
hash of its ``doc_id``. A shard takes at most its share of the rows, (1 + slack) times the mean; rows that
overflow a full shard continue clockwise to the next points until a shard has room. With ``slack`` 0 the
shares are the mean rounded down or up and add up to the number of rows, so counts are at most one apart;
with slack, adding a shard moves little more than the rows that the new shard takes.

Where rows go depends on how many stand before each point, not on which: rows are counted per arc of the
ring (``shards * vnodes * SPLIT`` counts at any input size), the overflow is settled on the counts, and every
row finds its shard by its rank within its part of an arc. Parts are split by content, so a doc_id shared by
many rows does not land in one task.

A null text counts as empty, a null doc_id is hashed as such, repeated rows are rows, an empty table gives no
rows, other columns are left out.
"""

from __future__ import annotations

import bisect
import hashlib
import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from depotlens.llm.literals import literal_table
from depotlens.session import materialize

RING_BITS, CELL_BITS, SPLIT = 60, 12, 16


def _hash(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def ring(shards: int, vnodes: int) -> list[tuple[int, int]]:
    """(place, shard) of all points, clockwise. A shard's points do not depend on the number of shards."""
    return sorted((_hash(f"shard {s} point {v}"), s) for s in range(shards) for v in range(vnodes))


def arc_of(key: Column, points: list[tuple[int, int]]) -> Column:
    """The index of the first point at or after the key's place, found within the key's cell of the ring."""
    place = F.conv(F.substring(F.md5(key), 1, RING_BITS // 4), 16, 10).cast("long")
    places = [p for p, _ in points]
    width = 1 << (RING_BITS - CELL_BITS)
    first = [bisect.bisect_left(places, c * width) for c in range((1 << CELL_BITS) + 1)]
    cell = F.shiftright(place, RING_BITS - CELL_BITS).cast("int")
    # Both tables are constants of the plan, one literal each.
    inner = F.from_json(F.lit(json.dumps([places[a:b] for a, b in zip(first, first[1:])])), "array<array<bigint>>")
    before = F.from_json(F.lit(json.dumps(first[:-1])), "array<int>")
    behind = F.size(F.filter(F.get(inner, cell), lambda p: p < place))
    return F.pmod(F.get(before, cell) + behind, F.lit(len(points))).cast("int")


def settle(counts: list[int], owner: list[int], room: list[int]) -> list[list[tuple[int, int, int, int]]]:
    """Per arc the segments (first rank, end rank, shard, first slot) of its rows.

    Arcs first offer their rows to the points they end in; what a full shard turns away moves on, one
    point at a time, in the order of the ring.
    """
    taken = [0] * len(room)
    segments: list[list[tuple[int, int, int, int]]] = [[] for _ in counts]
    placed = [0] * len(counts)
    waiting = [a for a, n in enumerate(counts) if n]
    for step in range(len(owner)):
        left = []
        for a in waiting:
            shard = owner[(a + step) % len(owner)]
            n = min(counts[a] - placed[a], room[shard] - taken[shard])
            if n:
                segments[a].append((placed[a], placed[a] + n, shard, taken[shard]))
                placed[a] += n
                taken[shard] += n
            if placed[a] < counts[a]:
                left.append(a)
        waiting = left
        if not waiting:
            break
    return segments


def shares(rows: int, shards: int, slack: float) -> list[int]:
    """The most rows that each shard takes."""
    if slack:
        return [max(-(-rows // shards), int((1 + slack) * rows / shards))] * shards
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def assign_shards(docs: DataFrame, shards: int = 8, vnodes: int = 128, slack: float = 0.0) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) of all rows; slots run from 0 without gaps in each shard."""
    points = ring(shards, vnodes)
    data = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    rows = docs.select(F.col("doc_id").cast("long"), (F.octet_length(data) + 1).cast("long").alias("size"), F.crc32(data).alias("text_crc32"))
    part = F.pmod(F.xxhash64("doc_id", "size", "text_crc32"), F.lit(SPLIT)).cast("int")
    arc = arc_of(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), points)
    rows = materialize(rows.withColumn("_cell", arc * SPLIT + part), "shard-rows")

    counts = [0] * (len(points) * SPLIT)
    for row in rows.groupBy("_cell").count().collect():  # bounded: one row per cell of the ring
        counts[row["_cell"]] = row["count"]
    arcs = [sum(counts[a * SPLIT : (a + 1) * SPLIT]) for a in range(len(points))]
    segments = settle(arcs, [s for _, s in points], shares(sum(arcs), shards, slack))
    cells = []
    for a, parts in enumerate(segments):
        begin = 0
        for c in range(a * SPLIT, (a + 1) * SPLIT):
            for lo, hi, shard, slot in parts:
                low, high = max(lo, begin), min(hi, begin + counts[c])
                if low < high:
                    cells.append({"_cell": c, "lo": low - begin, "hi": high - begin, "shard": shard, "slot": slot + low - lo})
            begin += counts[c]

    rank = F.row_number().over(Window.partitionBy("_cell").orderBy("doc_id", "text_crc32", "size")) - 1
    table = literal_table(docs.sparkSession, cells, "_cell int, lo long, hi long, shard int, slot long")
    found = rows.withColumn("rank", rank).join(F.broadcast(table), "_cell").where("rank >= lo and rank < hi")
    return found.select("doc_id", "size", "text_crc32", "shard", (F.col("slot") + F.col("rank") - F.col("lo")).alias("slot"))
