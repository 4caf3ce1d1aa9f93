"""Findings: rules as columns, first-seen lookups, summaries, gates and run comparison."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KIND = "array<struct<level:string,item:string,detail:string>>"


def rule(level: str | Column, item: str, when: Column, detail: Column | str = "") -> Column:
    """A finding where the condition holds, else NULL."""
    one = F.struct(
        (F.lit(level) if isinstance(level, str) else level).alias("level"), F.lit(item).alias("item"),
        (F.lit(detail) if isinstance(detail, str) else detail.cast("string")).alias("detail"),
    )
    return F.when(F.coalesce(when, F.lit(False)), one)


def collect(*rules: Column) -> Column:
    return F.filter(F.array(*rules), lambda r: r.isNotNull())


def exploded(records: DataFrame, column: str = "findings", keys: tuple[str, ...] = ("file", "pos", "rid")) -> DataFrame:
    """One row for each finding of each record."""
    return records.select(*keys, F.inline(column))


def first_seen(df: DataFrame, key: Column, name: Column, *order: str) -> DataFrame:
    """df with seen_before: the name of the first row with the key, NULL for that first row and for NULL keys.

    The first of each key comes from an aggregate with partial sums, so a key that holds a large part of all rows costs each
    task one row; the join back splits where it is skewed.
    """
    keyed = df.withColumn("_key", key).withColumn("_order", F.struct(*order))
    firsts = keyed.filter(F.col("_key").isNotNull()).groupBy("_key").agg(F.min(F.struct(F.col("_order"), name.alias("_name"))).alias("_first"))
    joined = keyed.join(firsts, "_key", "left")
    again = F.when(F.col("_first._order") < F.col("_order"), F.col("_first._name"))
    return joined.withColumn("seen_before", again).drop("_key", "_order", "_first")


def histogram(df: DataFrame, *order: str, **dims: Column) -> DataFrame:
    """(dim, key, cnt) of several dimensions in one pass; with columns of an order also first, the place where a key comes first."""
    pairs = F.inline(F.array(*[F.struct(F.lit(d).alias("dim"), c.cast("string").alias("key")) for d, c in dims.items()]))
    counted = [F.count("*").alias("cnt")]
    if not order:
        return df.select(pairs).groupBy("dim", "key").agg(*counted)
    return df.select(F.struct(*order).alias("_at"), pairs).groupBy("dim", "key").agg(*counted, F.min("_at").alias("first"))


def top_of(hist: DataFrame) -> DataFrame:
    """(dim, key, cnt, total): the largest entry of each dimension in one pass, ties to the key that came first, or where the histogram
    has no order to the smaller key (NULL last)."""
    tie = F.col("first") if "first" in hist.columns else F.struct(F.col("key").isNull(), "key")
    best = hist.groupBy("dim").agg(F.min_by(F.struct("key", "cnt"), F.struct((-F.col("cnt")).alias("n"), tie.alias("tie"))).alias("best"), F.sum("cnt").alias("total"))
    return best.select("dim", "best.key", "best.cnt", "total")


def item_summary(findings: DataFrame) -> DataFrame:
    """(item, cnt, level, samples): exact counts, ERROR before WARN, five sample ids."""
    level = F.when(F.max((F.col("level") == "ERROR").cast("int")) == 1, "ERROR").otherwise("WARN")
    ranked = findings.withColumn("_n", F.row_number().over(Window.partitionBy("item", F.pmod(F.xxhash64("rid"), F.lit(64))).orderBy("rid")))
    samples = ranked.filter("_n <= 5").groupBy("item").agg(F.slice(F.array_sort(F.collect_set("rid")), 1, 5).alias("samples"))
    return findings.groupBy("item").agg(F.count("*").alias("cnt"), level.alias("level")).join(samples, "item", "left")


def ratio_gate(name: str, part: Column, whole: Column, limit: float, *, at_least: bool = False, inclusive: bool = False, bad: str = "ERROR", some: str | None = None) -> Column:
    """A gate row: the percentage of part in whole against a limit. some: the level of a share within the limit but not 0."""
    value = part.cast("double") / F.greatest(whole, F.lit(1)) * 100
    over = value < limit if at_least else value >= limit if inclusive else value > limit
    level = F.when(over, bad)
    if some:
        level = level.when(part > 0, some)
    return F.struct(F.lit(name).alias("gate"), level.otherwise("PASS").alias("level"), value.alias("value"), F.lit(float(limit)).alias("threshold"), part.cast("long").alias("numer"), whole.cast("long").alias("denom"))


def any_gate(name: str, part: Column, bad: str = "ERROR") -> Column:
    return F.struct(F.lit(name).alias("gate"), F.when(part > 0, bad).otherwise("PASS").alias("level"), part.cast("double").alias("value"), F.lit(0.0).alias("threshold"), part.cast("long").alias("numer"), F.lit(None).cast("long").alias("denom"))


def gates(stats: DataFrame, *rows: Column) -> DataFrame:
    return stats.select(F.inline(F.array(*rows)))


def compare_runs(before: DataFrame, now: DataFrame) -> DataFrame:
    """(rid, item, state): resolved, open or added, by (rid, item)."""
    old, new = (x.select("rid", "item").distinct() for x in (before, now))
    state = lambda df, s: df.withColumn("state", F.lit(s))
    gone, kept, added = old.join(new, ["rid", "item"], "left_anti"), old.join(new, ["rid", "item"], "left_semi"), new.join(old, ["rid", "item"], "left_anti")
    return state(gone, "resolved").unionByName(state(kept, "open")).unionByName(state(added, "added"))


def completion(compared: DataFrame) -> DataFrame:
    """(resolved, open, added, rate): rate is resolved over resolved and open."""
    n = lambda s: F.count_if(F.col("state") == s)
    return compared.agg(n("resolved").alias("resolved"), n("open").alias("open"), n("added").alias("added")).withColumn("rate", F.col("resolved") / F.greatest(F.col("resolved") + F.col("open"), F.lit(1)))


def passed(findings: DataFrame, gate_rows: DataFrame | None = None) -> bool:
    """Exit status: no ERROR among findings, nor among gates where they count."""
    clean = findings.filter("level = 'ERROR'").isEmpty()
    return clean and (gate_rows is None or gate_rows.filter("level = 'ERROR'").isEmpty())
