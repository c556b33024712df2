"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

The ring has `SLOTS` places. Every shard has `points` virtual nodes on it, which
depend on the shard's number alone, so a further shard moves none of them. A row
starts at the place of its key's hash and goes to the first shard clockwise that
is not full.

Rows join in a fixed order: by cell, that is by a band of their hash and then by
place, and within a cell by hash, key, size and checksum. So a plan for the
cells, whose number does not depend on the data, settles everything: rows are
counted per cell, the driver fills the shards cell by cell, and a row follows
from its cell and its rank there. A cell is divided only where a shard fills up
within it. Ranking shuffles narrow rows by cell; rows that repeat a key are in
one cell.

With `slack` 0 the loads are as even as they can be: counts differ by one at
most. With more, a shard takes up to (1 + slack) times its share, and fewer rows
move when shards are added.

Null keys are placed like a key of their own. Null texts have no bytes. Repeated
rows are placed one by one and may lie in different shards. No rows give none.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

SLOTS = 1 << 13
BANDS = 1 << 3
POINTS = 64


def clockwise(shards: int, points: int = POINTS) -> tuple[np.ndarray, list[list[int]]]:
    """For each place, the number of the first virtual node at or after it; for each node, all shards from there on."""
    nodes = sorted((xxhash.xxh64_intdigest(f"{shard}:{point}"), shard) for shard in range(shards) for point in range(points))
    owner = [shard for _, shard in nodes]
    orders = [list(dict.fromkeys(owner[i:] + owner[:i])) for i in range(len(nodes))]
    place = np.array([h for h, _ in nodes], np.uint64) >> np.uint64(64 - int(math.log2(SLOTS)))
    first = np.searchsorted(place, np.arange(SLOTS, dtype=np.uint64))
    return first % len(nodes), orders


def capacities(rows: int, shards: int, slack: float) -> list[int]:
    """How many rows each shard may take."""
    if slack:
        return [math.ceil((1 + slack) * rows / shards)] * shards
    return [rows // shards + (shard < rows % shards) for shard in range(shards)]


def fill(counts: list[tuple[int, int]], shards: int, points: int = POINTS, slack: float = 0.0) -> list[tuple]:
    """Pieces (cell, begin, end, shard, slot) of all cells, from the rows in each: the ranks begin to end - 1 of the
    cell go to the shard, where the first of them has the number slot."""
    first, orders = clockwise(shards, points)
    room = capacities(sum(n for _, n in counts), shards, slack)
    load = [0] * shards
    pieces = []
    for cell, n in sorted(counts):
        begin = 0
        for shard in orders[first[cell % SLOTS]]:
            take = min(n - begin, room[shard] - load[shard])
            if take > 0:
                pieces.append((cell, begin, begin + take, shard, load[shard]))
                load[shard] += take
                begin += take
            if begin == n:
                break
    return pieces


def place(rows: DataFrame, key: str, tie: list[str], shards: int, points: int = POINTS, slack: float = 0.0,
          shard: str = "shard", slot: str = "slot") -> DataFrame:
    """Add to each row its shard and its number there, gapless from 0. `tie` orders rows of one key."""
    rows = rows.withColumn("_hash", F.xxhash64(key))
    rows = rows.withColumn("_cell", (
        F.shiftrightunsigned("_hash", 64 - int(math.log2(SLOTS)))
        + SLOTS * F.pmod(F.xxhash64("_hash", *tie), F.lit(BANDS))).cast("int"))
    counts = [tuple(r) for r in rows.groupBy("_cell").count().collect()]  # at most SLOTS * BANDS rows
    pieces = pd.DataFrame(fill(counts, shards, points, slack), columns=["_cell", "_begin", "_end", "_shard", "_slot"])
    plan = rows.sparkSession.createDataFrame(
        pieces.astype("int64"), "_cell bigint, _begin bigint, _end bigint, _shard bigint, _slot bigint")
    in_cell = Window.partitionBy("_cell").orderBy("_hash", key, *tie)
    ranked = rows.withColumn("_rank", F.row_number().over(in_cell).cast("long") - 1)
    piece = (ranked["_cell"] == plan["_cell"]) & (ranked["_rank"] >= plan["_begin"]) & (ranked["_rank"] < plan["_end"])
    return ranked.join(F.broadcast(plan), piece).select(
        *[ranked[c] for c in rows.columns if c not in ("_hash", "_cell")],
        F.col("_shard").cast("int").alias(shard), (F.col("_slot") + F.col("_rank") - F.col("_begin")).alias(slot))


def shard_documents(docs: DataFrame, shards: int, doc_id: str = "doc_id", text: str = "text", points: int = POINTS,
                    slack: float = 0.0) -> DataFrame:
    """Rows (doc_id, size, text_crc32, shard, slot): sizes are UTF-8 bytes and one more, the checksum is unsigned."""
    whole = F.coalesce(text, F.lit(""))
    rows = docs.select(F.col(doc_id).alias("doc_id"), (F.octet_length(whole) + 1).cast("long").alias("size"),
                       F.crc32(whole.cast("binary")).alias("text_crc32"))
    return place(rows, "doc_id", ["size", "text_crc32"], shards, points, slack)
