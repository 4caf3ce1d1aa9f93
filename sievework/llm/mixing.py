"""Mixing sources to target weights, with DataFrame functions only.

Words are counted for each source; the targets share all words by weight, held at MAX_RATE times the source's own
words, with the excess reshared by weight until no source is above. A source's rate is target / size. Each document
is taken floor(rate) times, and once more if a number in [0, 1) hashed from the seed and its id is below the fraction.

Defined results: NULL texts have size 0. Sources rank by code point, NULL last; NULL is a source of its own. A source
without words has target 0 and its documents are not taken. Repeated rows share their fate; rows without a doc_id are drawn by a
digest of their text. Empty and very long texts count whole. An empty table stays empty. Other columns are not read, and
mixed() returns them as they are. Sources are ranked in one task, which holds a row for each source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievework.llm.common import columns_of, sized, written

MAX_RATE = 3
#: The weights of sources in their order, repeating.
WEIGHTS = (1, 2, 3)
SEED = "mix-1"
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def draw_key(doc_id: Column, text: Column) -> Column:
    """What a row is drawn by: its id, or a digest of its text where it has none."""
    return F.coalesce(doc_id.cast("string"), F.concat(F.lit("text:"), F.md5(F.coalesce(text, F.lit("")).cast("binary"))))


def hashed_unit(key: Column, seed: str = SEED) -> Column:
    """A number in [0, 1): the first 13 hexadecimal digits of md5(seed:key) over 2^52."""
    digest = F.md5(F.concat(F.lit(seed + ":"), key).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_rate: int = MAX_RATE) -> DataFrame:
    """(source, source_size, target) from rows of (source, size).

    The resharing ends at one water level: target = min(max_rate * size, level * weight) with all targets adding up to
    all words. Sources in the order of size / weight are held one after another, so the level follows from running sums
    over the table of sources, which has a row for each source.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    everything = Window.partitionBy()
    place = F.row_number().over(Window.orderBy(F.col("source").isNull(), F.col("source")))
    ranked = by_source.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), F.pmod(place - 1, F.lit(len(weights))) + 1).cast("long"))
    order = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").isNull(), F.col("source")).rowsBetween(Window.unboundedPreceding, -1)
    running = ranked.select(
        "*",
        F.sum("source_size").over(everything).alias("words"),
        F.sum("weight").over(everything).alias("weights"),
        F.coalesce(F.sum("source_size").over(order), F.lit(0)).alias("held_words"),
        F.coalesce(F.sum("weight").over(order), F.lit(0)).alias("held_weight"),
    )
    # If all before this source are held at their limits: the level that shares the rest.
    level = (F.col("words") - max_rate * F.col("held_words")) / (F.col("weights") - F.col("held_weight")).cast("double")
    found = running.withColumn("level", level).withColumn("free", F.col("level") * F.col("weight") <= max_rate * F.col("source_size"))
    first = F.min(F.when(F.col("free"), F.struct("held_weight", "level"))).over(everything)
    target = F.least(F.col("water.level") * F.col("weight"), (max_rate * F.col("source_size")).cast("double"))
    return found.withColumn("water", first).select("source", "source_size", F.coalesce(target, F.lit(0.0)).alias("target"))


def _with_targets(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """rows (with source, size, _key) and the columns source_size, target, copies."""
    few = sized(written(targets).withColumnRenamed("source", "_source"))
    joined = rows.join(few, rows["source"].eqNullSafe(few["_source"])).drop("_source")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    copies = F.floor("_rate") + (hashed_unit(F.col("_key")) < F.col("_rate") - F.floor("_rate")).cast("long")
    return joined.withColumn("_rate", rate).withColumn("copies", copies).drop("_rate")


def mix_report(docs: DataFrame) -> DataFrame:
    """(doc_id, size, source_size, target, copies, taken) of every row."""
    rows = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), draw_key(F.col("doc_id"), F.col("text")).alias("_key"))
    return _with_targets(rows, source_targets(rows)).select("doc_id", "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken"))


def mixed(docs: DataFrame) -> DataFrame:
    """The mix itself: rows of docs, all columns, each as often as it is taken."""
    rows = docs.select(F.struct(*columns_of(docs)).alias("_row"), "source", word_count(F.col("text")).alias("size"), draw_key(F.col("doc_id"), F.col("text")).alias("_key"))
    targets = source_targets(docs.select("source", word_count(F.col("text")).alias("size")))
    taken = _with_targets(rows, targets).filter("copies > 0")
    return taken.select("_row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("_copy")).select("_row.*")


ORACLE = r"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
r AS (SELECT *, [1, 2, 3][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight FROM s),
c AS (SELECT *, sum(source_size) OVER () AS words, sum(weight) OVER () AS weights,
  coalesce(sum(source_size) OVER o, 0) AS held_words, coalesce(sum(weight) OVER o, 0) AS held_weight
  FROM r WINDOW o AS (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT *, (words - 3 * held_words)::DOUBLE / (weights - held_weight)::DOUBLE AS level FROM c),
w AS (SELECT *, (SELECT arg_min(level, held_weight) FROM l WHERE level * weight <= 3 * source_size) AS water FROM l),
t AS (SELECT source, source_size, coalesce(least(water * weight, (3 * source_size)::DOUBLE), 0.0) AS target FROM w),
j AS (SELECT d.doc_id, d.size, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS rate,
  CAST('0x' || substr(md5('mix-1:' || coalesce(d.doc_id::VARCHAR, 'text:' || md5(d.text))), 1, 13) AS BIGINT) / 4503599627370496.0::DOUBLE AS unit
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, (floor(rate) + CASE WHEN unit < rate - floor(rate) THEN 1 ELSE 0 END)::BIGINT AS copies,
  (size * (floor(rate) + CASE WHEN unit < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken FROM j
"""
