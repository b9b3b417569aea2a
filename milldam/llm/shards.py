"""Sharding: longest processing time first, with groups that must stay together.

Rows with equal text form a group. Groups, largest first, go to the least loaded shard through a heap. The driver gets
how many groups there are of each size, never the groups: groups of one size are alike, so a size's groups are dealt as
the heap deals them, so many to each shard, and a group's rank among those of its size says which shard it is in. There
are at most sqrt(2 * bytes) different sizes, as they sum up to no more than all bytes.

Groups with 1/HEAVY of all bytes or rows (2 * HEAVY of them at most) are joined to their rows by a broadcast, so that
no task gets a large group's rows; the others by their key.

Defined results: null texts form a group of their own with one byte each; groups of one size are ranked by a hash of
their key; an empty table gives an empty table; repeated rows get slots of their own; whole texts count, whatever their
length; other columns pass through, and columns named `shard` or `slot` are replaced.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import durable, table

HEAVY = 16384
#: Sizes that are broadcast with their deals; more are joined by a shuffle.
SIZES = 200_000
#: Groups that are ranked together, about.
RANKED = 20_000
#: Groups of one size that are dealt one by one; more are dealt at once.
SINGLY = 64


def dealt(sizes: Iterable[tuple[int, int]], shards: int) -> list[tuple[int, list[int]]]:
    """(size, number of groups) -> (size, how many of its groups the shards up to each one get), by longest processing time first."""
    loads, out = [0] * shards, []
    for size, count in sorted(sizes, reverse=True):
        got = [0] * shards
        if size <= 0:
            got[loads.index(min(loads))] = count
        elif count <= SINGLY:
            heap = [(load, i) for i, load in enumerate(loads)]
            heapq.heapify(heap)
            for _ in range(count):
                load, i = heap[0]
                got[i] += 1
                heapq.heapreplace(heap, (load + size, i))
        else:  # the heap takes the lowest of all loads + k * size, one after another: those below a level, and some at it
            below = lambda level: [max(0, -((load - level) // size)) for load in loads]
            low, high = min(loads), max(loads) + size * (count + 1)
            while high - low > 1:
                middle = (low + high) // 2
                low, high = (middle, high) if sum(below(middle)) <= count else (low, middle)
            got = below(low)
            left = count - sum(got)
            for i, load in enumerate(loads):
                if left and load + got[i] * size == low:
                    got[i] += 1
                    left -= 1
        loads = [load + n * size for load, n in zip(loads, got, strict=True)]
        out.append((size, [sum(got[: i + 1]) for i in range(shards)]))
    return out


def ranked(groups: DataFrame) -> DataFrame:
    """(_shard_group, _shard_bytes, ..) with `_shard_rank` among the groups of its size, from 0: ranked in buckets, which begin where those before them end."""
    buckets = max(16, groups.count() // RANKED)
    cut = groups.withColumn("_shard_bucket", F.pmod(F.xxhash64("_shard_group"), F.lit(buckets)))
    sizes = cut.groupBy("_shard_bytes", "_shard_bucket").agg(F.count("*").alias("_shard_n"))
    before = Window.partitionBy("_shard_bytes").orderBy("_shard_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_shard_bytes", "_shard_bucket", F.coalesce(F.sum("_shard_n").over(before), F.lit(0)).alias("_shard_start"))
    place = F.row_number().over(Window.partitionBy("_shard_bytes", "_shard_bucket").orderBy("_shard_group"))
    within = cut.withColumn("_shard_place", place).join(starts, ["_shard_bytes", "_shard_bucket"])
    return within.withColumn("_shard_rank", F.col("_shard_start") + F.col("_shard_place") - 1).drop("_shard_bucket", "_shard_start", "_shard_place")


def assign(df: DataFrame, shards: int, group: Column, size: Column, heavy: int = HEAVY, sizes: int = SIZES) -> DataFrame:
    """Adds `shard`, the same for all rows of a group. df is read several times: give a written table."""
    spark = df.sparkSession
    keyed = df.withColumn("_shard_group", F.struct(group.alias("key")))  # a struct, as null is a group too
    groups = durable(keyed.groupBy("_shard_group").agg(F.sum(size).alias("_shard_bytes"), F.count("*").alias("_shard_rows")))
    histogram = groups.groupBy("_shard_bytes").count().toPandas()  # sqrt(2 * bytes) rows at most
    deals = dealt(zip(histogram["_shard_bytes"].tolist(), histogram["count"].tolist(), strict=True), shards)
    schema = "_shard_bytes long, _shard_upto array<long>"
    listed = spark.createDataFrame(deals, schema)
    by_size = ranked(groups).join(F.broadcast(listed) if len(deals) <= sizes else listed, "_shard_bytes")
    placed = durable(by_size.select("_shard_group", "_shard_bytes", "_shard_rows", F.size(F.filter("_shard_upto", lambda n: n <= F.col("_shard_rank"))).alias("shard")))
    total, rows = groups.agg(F.coalesce(F.sum("_shard_bytes"), F.lit(0)), F.coalesce(F.sum("_shard_rows"), F.lit(0))).first()
    large = (F.col("_shard_bytes") * heavy >= F.lit(total)) | (F.col("_shard_rows") * heavy >= F.lit(rows))
    few, many = F.broadcast(placed.where(large).select("_shard_group", "shard")), placed.where(~large).select("_shard_group", "shard")
    bare = keyed.drop("shard")
    return bare.join(few, "_shard_group").unionByName(bare.join(few, "_shard_group", "left_anti").join(many, "_shard_group")).drop("_shard_group")


def number(df: DataFrame, *order: str) -> DataFrame:
    """Adds `slot`, from 0 without gaps in each shard. The rows of each partition are numbered by themselves, and begin where
    those of the partitions before them end. df must be a written table: its partitions are read twice."""
    cut = df.drop("slot").withColumn("_slot_part", F.shiftright(F.monotonically_increasing_id(), 33))
    sizes = cut.groupBy("shard", "_slot_part").agg(F.count("*").alias("_slot_n"))
    before = Window.partitionBy("shard").orderBy("_slot_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("shard", "_slot_part", F.coalesce(F.sum("_slot_n").over(before), F.lit(0)).alias("_slot_start"))
    within = cut.withColumn("_slot_row", F.row_number().over(Window.partitionBy("shard", "_slot_part").orderBy(*order)))
    return within.join(starts, ["shard", "_slot_part"]).withColumn("slot", (F.col("_slot_start") + F.col("_slot_row") - 1).cast("long")).drop("_slot_part", "_slot_row", "_slot_start")


def op4_sharding(spark: SparkSession, sf_dir: str, shards: int = 8) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    slim = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.when(F.col("text").isNull(), F.lit("null")).otherwise(F.sha2("text", 256)).alias("text_group"),
    )
    slim = durable(slim)
    placed = durable(assign(slim, shards, F.col("text_group"), F.col("size")))
    return number(placed, "doc_id", "text_group").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
