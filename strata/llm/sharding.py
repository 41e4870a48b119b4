"""Sharding by Karmarkar-Karp differencing: shards of near equal bytes, groups never divided.

A group is all rows of one text. Its bytes are summed before the shuffle, so a text that a third of
all rows share is one row by then. Differencing is sequential and works on a bounded number of items:
each group above a ``FINE``-th of a shard by itself, of which there are at most shards * FINE, and the
rest pooled by a hash of their text in ``POOLS`` bundles, each a group for the differencing. Only
these few sums reach the driver and only the few shard numbers go back, whatever the size of the data.

Defined results: a null text weighs 1 byte and is a group apart from the empty text. Repeated rows
are in one group. An empty table has no shards. Slots go by id, then by content.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.skew import number_rows
from strata.session import stored

FINE = 64
POOLS = 4096


def differencing(sizes: list[int], parts: int) -> list[int]:
    """The part of each item, by largest differencing.

    A partial solution has a load for each part, in descending order, and the items that make it up.
    The two with the largest spread between greatest and least load are joined until one is left:
    the greatest load of one with the least of the other, and so on.
    """
    if not sizes:
        return []
    heap = [(-size, i, [size] + [0] * (parts - 1), [[i]] + [[] for _ in range(parts - 1)]) for i, size in enumerate(sizes)]
    heapq.heapify(heap)
    while len(heap) > 1:
        _, tie, loads, items = heapq.heappop(heap)
        _, _, others, more = heapq.heappop(heap)
        joined = sorted(
            ((a + b, x + y) for a, b, x, y in zip(loads, reversed(others), items, reversed(more), strict=True)),
            key=lambda part: (-part[0], part[1][:1]),
        )
        loads, items = [load for load, _ in joined], [held for _, held in joined]
        heapq.heappush(heap, (loads[-1] - loads[0], tie, loads, items))
    part_of = [0] * len(sizes)
    for part, held in enumerate(heap[0][3]):
        for i in held:
            part_of[i] = part
    return part_of


def shard(
    docs: DataFrame, shards: int = 16, id: str = "doc_id", text: str = "text", fine: int = FINE, pools: int = POOLS
) -> DataFrame:
    """One row per row of ``docs``: its id, size (bytes + 1), text_crc32, shard, and slot in the shard from 0."""
    spark = docs.sparkSession
    data = F.coalesce(F.col(text).cast("binary"), F.lit(b""))
    rows = stored(docs.select(
        F.col(id).alias("doc_id"),
        (F.octet_length(data) + 1).cast("long").alias("size"),
        F.crc32(data).alias("text_crc32"),
        F.unhex(F.when(F.col(text).isNull(), "").otherwise(F.sha2(data, 256))).alias("group"),
    ), "shard-rows")
    groups = stored(rows.groupBy("group").agg(F.sum("size").alias("bytes")), "shard-groups")
    pool = F.pmod(F.xxhash64("group"), F.lit(pools)).cast("int")
    total = groups.agg(F.sum("bytes")).first()[0] or 0
    alone = F.col("bytes") * (shards * fine) > F.lit(total)
    large = groups.where(alone).select("group", "bytes").orderBy("group").collect()
    bundles = groups.where(~alone).groupBy(pool.alias("pool")).agg(F.sum("bytes").alias("bytes")).orderBy("pool").collect()
    part_of = differencing([r["bytes"] for r in [*large, *bundles]], shards)
    own = spark.createDataFrame(
        [(r["group"], k) for r, k in zip(large, part_of[: len(large)], strict=True)], "large binary, own_shard int")
    pooled = spark.createDataFrame(
        [(r["pool"], k) for r, k in zip(bundles, part_of[len(large) :], strict=True)], "pool int, pool_shard int")
    placed = (
        rows.withColumn("pool", pool)
        .join(F.broadcast(own), F.col("group") == F.col("large"), "left")
        .join(F.broadcast(pooled), "pool", "left")
        .select("doc_id", "size", "text_crc32", F.coalesce("own_shard", "pool_shard").alias("shard"))
    )
    numbered = number_rows(placed, ["shard", "doc_id", "text_crc32", "size"], "place", 0)
    first = numbered.groupBy("shard").agg(F.min("place").alias("first"))
    return numbered.join(F.broadcast(first), "shard").select(
        F.col("doc_id").alias(id), "size", "text_crc32", "shard", (F.col("place") - F.col("first")).alias("slot")
    )
