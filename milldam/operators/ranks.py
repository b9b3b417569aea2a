"""Exact ranks at any size: rows are sorted into ranges by sampled bounds, as many as their size asks for, and a range begins where the ones
before it end. No group is gathered; equal values are split by a second key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from milldam.durable import durable


def ranged(df: DataFrame, *keys) -> DataFrame:
    """Adds `_range`, rising with the keys; written, so that it stays what it is. The planner sets the number of ranges by their size."""
    return durable(df.repartitionByRange(*keys).withColumn("_range", F.spark_partition_id()))


def started(rows: DataFrame, groups: list[str], total) -> DataFrame:
    """(groups, _range, _start): what the ranges before hold in all. There are as many rows as ranges and groups in them."""
    before = Window.partitionBy(*groups, F.lit(0)).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy(*groups, "_range").agg(total.alias("_m"))
    return sums.select(*groups, "_range", F.coalesce(F.sum("_m").over(before), F.lit(0)).alias("_start"))


def _placed(rows: DataFrame, starts: DataFrame, groups: list[str]) -> DataFrame:
    same = F.col("r._range") == F.col("s._range")
    for g in groups:
        same &= F.col(f"r.{g}").eqNullSafe(F.col(f"s.{g}"))
    return rows.alias("r").join(starts.alias("s"), same).select("r.*", "s._start")


def numbered_by(df: DataFrame, order: str, groups: tuple[str, ...] = ()) -> DataFrame:
    """Adds `_place`, from 0 in the order of a column (in each group); ties by a digest of the whole row."""
    rows = ranged(df.withColumn("_tie", F.xxhash64(*df.columns)), *groups, order, "_tie")
    within = F.row_number().over(Window.partitionBy(*groups, "_range").orderBy(order, "_tie")) - 1
    starts = started(rows, list(groups), F.count("*"))
    return _placed(rows.withColumn("_in", within), starts, list(groups)).withColumn("_place", F.col("_start") + F.col("_in")).drop("_range", "_tie", "_in", "_start")


def running_counts(df: DataFrame, group: list[str], value: str) -> DataFrame:
    """(group, value, _n, _upto): distinct values with their number and that of all up to them, in each group."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*group, value).agg(F.count("*").alias("_n"))
    rows = ranged(counts, *group, value)
    within = rows.withColumn("_in", F.sum("_n").over(Window.partitionBy(*group, "_range").orderBy(value)))
    return _placed(within, started(rows, group, F.sum("_n")), group).withColumn("_upto", F.col("_start") + F.col("_in")).drop("_range", "_in", "_start")
