"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of edges (a, b): root is the smallest node of its component.

    Each round links all neighbours of a node to the smallest one, first the larger neighbours, then the smaller; a path
    of n nodes takes about log n rounds. Rounds are written to the shared folder. Loops count as nodes of their own.
    """
    pairs = edges.select("a", "b").filter("a is not null and b is not null")
    state = written(pairs.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    loops = state.filter("u = v").select("u")
    proper = state.filter("u <> v")
    mark = _mark(proper)
    while mark[0]:
        both = proper.unionByName(proper.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        large = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        low2 = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low2, "u").select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e"))
        proper = written(small.select(F.col("e.v").alias("u"), F.col("e.m").alias("v")).filter("u <> v").distinct())
        now = _mark(proper)
        if now == mark:
            break
        mark = now
    tree = proper.select(F.col("u").alias("node"), F.col("v").alias("root"))
    tops = proper.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("root"))
    inside = tree.unionByName(tops)
    alone = loops.select(F.col("u").alias("node"), F.col("u").alias("root")).join(inside.select("node"), "node", "left_anti")
    return inside.unionByName(alone)


def _mark(edges: DataFrame) -> tuple:
    """A count and an order-free hash of the edges; equal marks of two rounds mean that nothing moved."""
    h = F.xxhash64("u", "v")
    return tuple(edges.agg(F.count("*"), F.coalesce(F.sum(F.pmod(h, F.lit(1 << 40))), F.lit(0)), F.coalesce(F.bit_xor(h), F.lit(0))).first())
