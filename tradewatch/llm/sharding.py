"""Shards of nearly equal bytes by Karmarkar-Karp differencing.

Documents of equal text stay together, so the unit is the group. Differencing starts with one
partial partition per item, its weight in one part and nothing in the others, and repeatedly
combines the two partial partitions of largest spread, the largest part of one with the smallest of
the other, until one is left; undoing the combinations tells the shard of every item.

Groups heavier than a 1 / (shards * FINENESS) part of all bytes are items of their own, of which
there can be no more than shards * FINENESS. The lighter ones are bundled by hash into as many
bundles, each an item. So differencing sees at most 2 * shards * FINENESS weights, whatever the
corpus, and both tables of results are small enough to broadcast by construction; a corpus with
fewer groups than that is differenced group by group. A group above the mean stays alone in its
shard; the rest is balanced among the others.

Defined results: a null text weighs and groups like an empty one; null ids and repeated rows are
placed like all others; slots are gapless from 0 in every shard, by hash bucket, then id.
"""

from __future__ import annotations

import heapq

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewatch.llm.scratch import settle

SHARDS = 40
OVERHEAD = 16  # bytes that every row costs besides its text
FINENESS = 512
SLOT_ROWS = 20_000  # rows that a task numbers, on average


def difference(weights: np.ndarray, parts: int) -> np.ndarray:
    """The part, 0 to parts - 1, of each item; part 0 is the heaviest. Ties keep item order."""
    n = len(weights)
    if not n:
        return np.zeros(0, np.int64)
    sums: dict[int, np.ndarray] = {}
    heap = []
    for item, weight in enumerate(weights):
        vector = np.zeros(parts, np.int64)
        vector[0] = weight
        sums[item] = vector
        heap.append((-int(weight), item))
    if parts == 1:
        return np.zeros(n, np.int64)
    heapq.heapify(heap)
    made: list[tuple[int, int, np.ndarray]] = []  # left, right, order of their parts in the sum
    while len(heap) > 1:
        _, left = heapq.heappop(heap)
        _, right = heapq.heappop(heap)
        # Both are kept in falling order; one is turned round.
        total = sums.pop(left) + sums.pop(right)[::-1]
        order = np.argsort(-total, kind="stable")
        node = n + len(made)
        made.append((left, right, order))
        total = total[order]
        sums[node] = total
        heapq.heappush(heap, (int(total[-1] - total[0]), node))
    label = {heap[0][1]: np.arange(parts)}
    for node in range(n + len(made) - 1, n - 1, -1):
        left, right, order = made[node - n]
        mine = np.empty(parts, np.int64)
        mine[order] = label.pop(node)
        label[left], label[right] = mine, mine[::-1]
    return np.array([label[item][0] for item in range(n)])


def group_key(text: str = "text") -> Column:
    """Digest that equal texts share; null counts as empty."""
    return F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")), 256))


def shard(docs: DataFrame, shards: int = SHARDS, fineness: int = FINENESS) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = settle(
        docs.select(
            "doc_id",
            (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
            F.crc32(text).alias("text_crc32"),
            group_key().alias("key"),
        )
    )
    groups = settle(rows.groupBy("key").agg(F.sum("size").alias("weight")))
    total = groups.agg(F.sum("weight")).first()[0] or 0
    bundles = shards * fineness
    heavy = F.col("weight") * bundles > total
    bundle = F.pmod(F.xxhash64("key"), F.lit(bundles)).cast("int")
    light = groups.filter(~heavy).groupBy(bundle.alias("bundle")).agg(F.sum("weight").alias("weight"))
    # Both lists have at most `bundles` rows.
    large = groups.filter(heavy).orderBy(F.desc("weight"), "key").toArrow().to_pylist()
    small = sorted(light.toArrow().to_pylist(), key=lambda r: r["bundle"])
    weights = np.array([r["weight"] for r in [*large, *small]], np.int64)
    part = difference(weights, shards).tolist()
    spark = docs.sparkSession
    of_key = spark.createDataFrame(
        [(bytes(r["key"]), p) for r, p in zip(large, part, strict=False)],
        T.StructType([T.StructField("key", T.BinaryType()), T.StructField("by_key", T.IntegerType())]),
    )
    of_bundle = spark.createDataFrame(
        [(r["bundle"], p) for r, p in zip(small, part[len(large) :], strict=True)],
        "bundle int, by_bundle int",
    )
    placed = (
        rows.withColumn("bundle", bundle)
        .join(F.broadcast(of_key), "key", "left")
        .join(F.broadcast(of_bundle), "bundle", "left")
        .select(
            "doc_id", "size", "text_crc32", F.coalesce("by_key", "by_bundle").alias("shard")
        )
    )
    return with_slots(placed, rows.count(), shards)


def with_slots(rows: DataFrame, count: int, shards: int, slot_rows: int = SLOT_ROWS) -> DataFrame:
    """Number the rows of each shard from 0 without bringing a shard into one task."""
    buckets = max(1, -(-count // (shards * slot_rows)))
    dealt = rows.withColumn(
        "bucket", F.pmod(F.xxhash64("doc_id", "size", "text_crc32"), F.lit(buckets)).cast("int")
    )
    sizes = dealt.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")
    )
    within = Window.partitionBy("shard", "bucket").orderBy("doc_id", "text_crc32", "size")
    return (
        dealt.withColumn("place", F.row_number().over(within) - 1)
        .join(starts, ["shard", "bucket"])
        .withColumn("slot", F.col("start") + F.col("place"))
        .select("doc_id", "size", "text_crc32", "shard", "slot")
    )
