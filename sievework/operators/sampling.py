"""Deterministic samples: rows are ranked by a hash of seed and id, so a rerun and another partitioning agree."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fixed_share(df: DataFrame, per_cent: float, seed: int, id_column: str, *by: str) -> DataFrame:
    """max(1, round half even(n * per_cent / 100)) rows of each group, those with the smallest hashes.

    The kth smallest hash of a group comes from counts over hash ranges and a ranking inside one range, so no group is ever
    ranked in one task.
    """
    from pyspark.sql import Window

    h = F.pmod(F.xxhash64(F.lit(seed), id_column), F.lit(1 << 40))
    ranged = df.withColumn("_h", h).withColumn("_r", F.floor(F.col("_h") / F.lit(1 << 26)))
    keys = list(by)
    counts = ranged.groupBy(*keys, "_r").agg(F.count("*").alias("_c"))
    group = Window.partitionBy(*keys)
    upto = group.orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select(*keys, "_r", F.coalesce(F.sum("_c").over(upto), F.lit(0)).alias("_before"), F.greatest(F.lit(1), F.bround(F.sum("_c").over(group) * F.lit(per_cent) / 100)).alias("_k"))
    on = keys + ["_r"]
    placed = ranged.join(bases, on) if not keys else ranged.join(bases, [ranged[k].eqNullSafe(bases[k]) for k in on]).select(ranged["*"], bases["_before"], bases["_k"])
    rank = F.row_number().over(Window.partitionBy(*keys, "_r").orderBy("_h", id_column))
    return placed.withColumn("_n", rank + F.col("_before")).filter(F.col("_n") <= F.col("_k")).drop("_h", "_r", "_n", "_before", "_k")


def bernoulli(df: DataFrame, p: float, seed: int, id_column: str) -> DataFrame:
    """Each row by itself with probability p."""
    return df.filter(F.pmod(F.xxhash64(F.lit(seed), id_column), F.lit(1_000_000)) < F.lit(p * 1e6))
