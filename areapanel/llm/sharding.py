"""Sharding: a consistent-hash ring with virtual nodes and bounded loads."""

from __future__ import annotations

import bisect
import hashlib
from collections import deque

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SHARDS = 16
POINTS = 128
"""Virtual nodes of each shard. shards * points bounds what the driver sees: one count per arc."""

SPAN = 1 << 32


def ring(shards: int = SHARDS, points: int = POINTS) -> list[tuple[int, int]]:
    """(position, shard) of every virtual node, clockwise. A shard's nodes do not depend on the others."""
    placed = {}
    for shard in range(shards):
        for node in range(points):
            at = int.from_bytes(hashlib.md5(f"shard {shard} node {node}".encode()).digest()[:4], "big")
            placed.setdefault(at, shard)
    return sorted(placed.items())


def position(doc_id: Column) -> Column:
    """Where a key stands on the ring."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long")


def arc_of(at: Column, nodes: list[tuple[int, int]]) -> Column:
    """Number of the first virtual node at or after a position; past the last one comes the first.

    Spark's bucket search: ``width_bucket`` needs even steps, so positions are cut into even cells
    first and a cell's few nodes are counted.
    """
    places = [p for p, _ in nodes]
    cells = 1 << max(1, (len(nodes) - 1).bit_length() + 1)
    width = SPAN // cells
    before = [bisect.bisect_left(places, c * width) for c in range(cells)]
    inside = [places[before[c] : bisect.bisect_left(places, (c + 1) * width)] for c in range(cells)]
    cell = F.floor(at / width).cast("int") + 1
    first = F.element_at(F.array(*[F.lit(b) for b in before]), cell)
    own = F.element_at(F.from_json(F.lit(str(inside)), "array<array<bigint>>"), cell)
    return ((first + F.size(F.filter(own, lambda p: p < at))) % len(nodes)).cast("int")


def allot(counts: dict[int, int], nodes: list[tuple[int, int]], room: list[int]) -> list[tuple[int, int, int, int, int]]:
    """Pieces (arc, first rank, end rank, shard, first slot): each arc's keys in its shard while there is room.

    What a full shard cannot take waits and goes on clockwise, oldest first, to the next virtual node
    whose shard has room. Two rounds place everything when the room is enough. It works on one count
    per arc, and makes at most one more piece for each time a shard fills up or a wait ends.
    """
    filled = [0] * len(room)
    waiting: deque[tuple[int, int, int]] = deque()
    pieces = []

    def put(arc: int, first: int, end: int, shard: int) -> int:
        taken = min(end - first, room[shard] - filled[shard])
        if taken > 0:
            pieces.append((arc, first, first + taken, shard, filled[shard]))
            filled[shard] += taken
        return first + max(0, taken)

    for turn in range(2):
        for arc, (_, shard) in enumerate(nodes):
            if turn == 0 and counts.get(arc):
                rest = put(arc, 0, counts[arc], shard)
                if rest < counts[arc]:
                    waiting.append((arc, rest, counts[arc]))
            while waiting and filled[shard] < room[shard]:
                source, first, end = waiting.popleft()
                rest = put(source, first, end, shard)
                if rest < end:
                    waiting.appendleft((source, rest, end))
    if waiting:
        raise ValueError("the shards have less room than there are rows")
    return pieces


def room_for(rows: int, shards: int, slack: float) -> list[int]:
    """Rows each shard may hold. Without slack the room is exactly the rows, so counts differ by one at most."""
    even = [rows // shards + (1 if s < rows % shards else 0) for s in range(shards)]
    return [n + int(n * slack) for n in even]


def shard_rows(keys: DataFrame, shards: int = SHARDS, points: int = POINTS, slack: float = 0.0) -> DataFrame:
    """``keys`` (doc_id and any narrow columns) with shard and slot, slots gapless from 0 in each shard.

    A key belongs to the next virtual node clockwise; rows of an arc are ranked by position, id and
    the other columns, and ranks beyond a full shard's room continue clockwise. Ranking shuffles by
    arc, a 1 / (shards * points) share of the rows each, and no wide column takes part. Keys without
    id stand together at one place, repeated rows are told apart by rank only. ``slack`` lets
    shards exceed the even share, so that fewer keys move; 0 gives equal counts.
    """
    nodes = ring(shards, points)
    placed = keys.withColumn("_at", position(F.col("doc_id"))).withColumn("_arc", arc_of(F.col("_at"), nodes))
    counts = {r["_arc"]: r["count"] for r in placed.groupBy("_arc").count().collect()}
    pieces = allot(counts, nodes, room_for(sum(counts.values()), shards, slack))
    spark = keys.sparkSession
    by_arc: dict[int, list] = {}
    for arc, first, end, shard, slot in pieces:
        by_arc.setdefault(arc, []).append((first, end, shard, slot))
    kind = "_piece_arc int, _pieces array<struct<first:bigint,end:bigint,shard:int,slot:bigint>>"
    table = spark.createDataFrame(sorted(by_arc.items()), kind)
    order = ["_at", *[f"`{c}`" for c in keys.columns]]
    ranked = placed.withColumn("_rank", (F.row_number().over(W.partitionBy("_arc").orderBy(*order)) - 1).cast("long"))
    # At most two entries per virtual node: the size is fixed by shards and points.
    found = ranked.join(F.broadcast(table), F.col("_arc") == F.col("_piece_arc"), "left").withColumn(
        "_piece", F.filter("_pieces", lambda p: (p["first"] <= F.col("_rank")) & (F.col("_rank") < p["end"]))[0]
    )
    return found.select(
        *[F.col(f"`{c}`") for c in keys.columns],
        F.col("_piece.shard").alias("shard"),
        (F.col("_piece.slot") + F.col("_rank") - F.col("_piece.first")).alias("slot"),
    )


def sharding(docs: DataFrame, shards: int = SHARDS, points: int = POINTS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of every document, by the ``rows`` law.

    A null text has size 1 and the checksum of no bytes; an empty table gives no rows; other columns
    are ignored.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    keys = docs.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).cast("long").alias("text_crc32")
    )
    return shard_rows(keys, shards, points).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def shard_documents(docs: DataFrame, shards: int = SHARDS, points: int = POINTS) -> DataFrame:
    """``docs`` with shard and slot; rows of one id and text share their slots in the order of a hash of all columns.

    Columns of these two names are replaced. The narrow keys are ranked and joined back by id, checksum and the occurrence among equal keys.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    given = [F.col(f"`{c}`") for c in docs.columns]
    keyed = docs.select(
        F.struct(*given).alias("row"), F.xxhash64(*given).alias("all"), F.col("doc_id").alias("doc_id"), F.xxhash64(text).alias("mark")
    )
    same = W.partitionBy("doc_id", "mark")
    placed = shard_rows(keyed.select("doc_id", "mark"), shards, points)
    left = keyed.withColumn("nth", F.row_number().over(same.orderBy("all")))
    right = placed.withColumn("nth", F.row_number().over(same.orderBy("shard", "slot"))).select(
        F.col("doc_id").alias("k_id"), F.col("mark").alias("k_mark"), F.col("nth").alias("k_nth"), "shard", "slot"
    )
    met = left.join(
        right, F.col("doc_id").eqNullSafe(F.col("k_id")) & (F.col("mark") == F.col("k_mark")) & (F.col("nth") == F.col("k_nth"))
    )
    clash = {"shard", "slot"} & {c.lower() for c in docs.columns}
    if clash:
        met = met.withColumn("row", F.col("row").dropFields(*[c for c in docs.columns if c.lower() in clash]))
    return met.select("row.*", "shard", "slot")
