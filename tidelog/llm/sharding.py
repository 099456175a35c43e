"""Shards of nearly equal bytes by Karmarkar-Karp differencing.

Documents with equal texts are one group that stays together. Groups too large to be evened out by
others are items of their own, all others are bundled by a hash into a fixed number of items per
shard, so that the differencing has a bounded number of items whatever the size of the table.
Each item starts as a partial partition with all its bytes in one place. The two partial
partitions of largest spread are combined, the largest sums of one with the smallest of the other,
until one is left.
"""

from __future__ import annotations

import heapq

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.common import stored, utf8

BUNDLES = 256  # bundles of small groups per shard
LARGE = 64  # a group of over 1 / LARGE of a shard's bytes is an item of its own
CHUNK = 2000  # rows of a shard that one task numbers, about


def partition(sizes: list[int], shards: int) -> np.ndarray:
    """The shard of each item."""
    place = np.zeros(len(sizes), np.int64)
    if not len(sizes):
        return place
    # A node: sums by falling size, and for a combined one its parts and their orders.
    nodes: list[tuple] = []
    heap: list[tuple[int, int]] = []

    def add(sums: np.ndarray, *made) -> None:
        heapq.heappush(heap, (int(sums[-1] - sums[0]), len(nodes)))
        nodes.append((sums, *made))

    for size in sizes:
        sums = np.zeros(shards, np.int64)
        sums[0] = size
        add(sums)
    while len(heap) > 1:
        (_, a), (_, b) = heapq.heappop(heap), heapq.heappop(heap)
        sums = nodes[a][0] + nodes[b][0][::-1]
        order = np.argsort(-sums, kind="stable")
        add(sums[order], a, b, order, shards - 1 - order)
    down = [(len(nodes) - 1, np.arange(shards))]
    while down:
        at, shard_of = down.pop()
        if len(nodes[at]) == 1:
            place[at] = shard_of[0]
            continue
        _, a, b, order_a, order_b = nodes[at]
        for part, order in ((a, order_a), (b, order_b)):
            own = np.empty(shards, np.int64)
            own[order] = shard_of
            down.append((part, own))
    return place


def assign(docs: DataFrame, shards: int = 40, id: str = "doc_id", text: str = "text",
           overhead: int = 16) -> DataFrame:
    """Put every document into a shard so that the shards' bytes are nearly equal.

    Returns one row per document: the id, size (UTF-8 bytes of the text and `overhead`), text_crc32,
    law ("bytes"), shard, slot (its place in the shard, gapless from 0) and grown_shard (null: this
    law moves rows when a shard is added). Equal texts share a shard; a null text is of no bytes and
    groups with the empty ones. Repeated rows are placed each. A group larger than a fair share
    makes its shard as large as itself. Other columns are not read.
    """
    body = utf8(text)
    rows = stored(docs.select(F.col(id).alias("id"), (F.length(body) + F.lit(overhead)).cast("long").alias("size"),
                              F.crc32(body).alias("text_crc32"), F.xxhash64(body).alias("g")), "sizes")
    groups = stored(rows.groupBy("g").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")), "groups")
    total, count = groups.agg(F.sum("bytes"), F.sum("n")).first()
    large = F.col("bytes") * F.lit(LARGE * shards) >= F.lit(total or 0)
    item = F.when(large, F.col("g")).otherwise(F.pmod(F.xxhash64("g", F.lit(1)), F.lit(BUNDLES * shards)))
    named = groups.select("g", "bytes", large.alias("large"), item.alias("item"))
    # At most (LARGE + BUNDLES) * shards rows.
    items = named.groupBy("large", "item").agg(F.sum("bytes").alias("bytes")).orderBy(
        F.desc("bytes"), "large", "item").collect()
    place = partition([r["bytes"] for r in items], shards)
    spark = docs.sparkSession
    places = spark.createDataFrame(
        [(r["large"], r["item"], int(p)) for r, p in zip(items, place)], "large boolean, item long, shard int")
    shard_of = stored(named.join(F.broadcast(places), ["large", "item"]).select("g", "shard"), "group-shards")
    put = rows.join(shard_of, "g")
    chunks = max(1, (count or 0) // (CHUNK * shards))
    put = stored(put.withColumn("chunk", F.pmod(F.xxhash64("id", "text_crc32"), F.lit(chunks))), "placed")
    before = Window.partitionBy("shard").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    sizes = put.groupBy("shard", "chunk").agg(F.count("*").alias("n"))
    sizes = stored(sizes.select("shard", "chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")),
                   "chunks")
    inside = Window.partitionBy("shard", "chunk").orderBy("id", "text_crc32")
    ranked = put.withColumn("nth", F.row_number().over(inside)).join(sizes, ["shard", "chunk"])
    return ranked.select(
        F.col("id").alias(id), "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("before") + F.col("nth") - 1).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
