"""Connected components of a graph given as a table of edges, by alternating star contraction.

Large-star links each node's larger neighbours to the smallest node that it sees, small-star links the
node and its smaller neighbours to it. The edges turn into stars in a logarithmic number of rounds, as a
rule; all rounds are aggregates, windows and joins, their results are written to the checkpoint folder, and the
driver sees a few counts only. Whether all are stars is seen from the nodes' degrees, without another round.

A window holds the edges of one node, so nodes of up to HUB edges go that way. Where a node has more, the minima are
aggregated first, which needs no node in one task, and joined to the edges from a written table, so that the adaptive planner
can split a node's edges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import compact

#: Edges of a node that one task may see together.
HUB = 1 << 20


def _rows(*pairs) -> F.Column:
    """Several rows (u, v) for one."""
    return F.inline(F.array(*[F.struct(u.alias("u"), v.alias("v")) for u, v in pairs]))


def _degrees(down: DataFrame) -> tuple[int, int]:
    """Of edges (u, v) that lead down: nodes that keep them from being stars, and the most edges of a node."""
    one, no = F.lit(1), F.lit(0)
    ends = down.select(F.inline(F.array(F.struct(F.col("u").alias("x"), one.alias("up"), no.alias("below")), F.struct(F.col("v").alias("x"), no.alias("up"), one.alias("below")))))
    nodes = ends.groupBy("x").agg(F.sum("up").alias("up"), F.sum("below").alias("below"))
    odd = F.when((F.col("up") > 1) | (F.col("up") > 0) & (F.col("below") > 0), 1)
    return tuple(nodes.agg(F.count(odd), F.coalesce(F.max(F.col("up") + F.col("below")), F.lit(0))).first())


def _beside(down: DataFrame) -> DataFrame:
    """One round by windows."""
    at_u, at_v = F.struct(F.col("u").alias("x"), F.col("v").alias("o"), F.lit(True).alias("up")), F.struct(F.col("v").alias("x"), F.col("u").alias("o"), F.lit(False).alias("up"))
    ends = down.select(F.inline(F.array(at_u, at_v))).withColumn("low", F.min(F.when(F.col("up"), F.col("o"))).over(Window.partitionBy("x")))
    large = ends.where(~F.col("up")).select(F.col("o").alias("u"), F.coalesce("low", "x").alias("v"))
    small = large.withColumn("low", F.min("v").over(Window.partitionBy("u")))
    return small.select(_rows((F.col("u"), F.col("low")), (F.col("v"), F.col("low"))))


def _apart(down: DataFrame) -> DataFrame:
    """The same by aggregates and joins."""
    low, _ = compact(down.groupBy("u").agg(F.min("v").alias("low")))
    large, _ = compact(down.join(low.withColumnRenamed("u", "v"), "v", "left").select("u", F.coalesce("low", "v").alias("v")))
    least, _ = compact(large.groupBy("u").agg(F.min("v").alias("low")))
    return large.join(least, "u").select(_rows((F.col("u"), F.col("low")), (F.col("v"), F.col("low"))))


def components(edges: DataFrame, hub: int = HUB) -> DataFrame:
    """edges (u, v), longs -> (u, root): every node that has an edge, with the smallest node of its component."""
    down, _ = compact(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u != v").distinct())
    while True:
        odd, most = _degrees(down)
        if not odd:
            return down.select("u", F.col("v").alias("root")).union(down.select(F.col("v").alias("u"), F.col("v").alias("root")).distinct())
        down, _ = compact((_beside if most <= hub else _apart)(down).where("u != v").distinct())
