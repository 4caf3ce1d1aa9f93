"""The three kinds of corpora: which text of a record counts for deduplication, and which documents take part."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.functions.text import dedup_normal
from sievework.sources.records import text_at

#: Normalised characters that a document needs to take part.
MIN_CHARS = 200


def _said(turn: Column) -> Column:
    said = lambda k: F.coalesce(F.try_variant_get(turn, f"$.{k}", "string"), F.lit(""))
    return F.concat(said("question"), F.lit("\n"), said("answer"))


def _blog() -> Column:
    return F.coalesce(text_at("$.content"), F.lit(""))


def _qa() -> Column:
    """All turns that are objects, each a question and its answer."""
    turns = F.coalesce(F.try_variant_get("v", "$.message", "array<variant>"), F.array().cast("array<variant>"))
    objects = F.filter(turns, lambda t: F.startswith(F.coalesce(F.schema_of_variant(t), F.lit("VOID")), F.lit("OBJECT")))
    return F.array_join(F.transform(objects, _said), "\n")


def _commit() -> Column:
    return F.concat_ws("\n", *[F.coalesce(text_at(f"$.meta.{k}"), F.lit("")) for k in ("commit_message", "vulnerable_code", "fixed_code", "unified_diff")])


EXTRACTORS = {"blog": _blog, "qa": _qa, "commit": _commit}


def collected(read: DataFrame, kind: str) -> DataFrame:
    """(file, pos, id, norm, state) of every line but blank ones: kept, skipped_empty, skipped_short or parse_err; read: parsed()."""
    d = read.filter("status <> 'blank'").select("file", "pos", "status", F.coalesce(text_at("$.id"), F.lit("?")).alias("id"), dedup_normal(EXTRACTORS[kind]()).alias("norm"))
    n = F.length("norm")
    state = F.when(F.col("status") == "bad", "parse_err").when(n == 0, "skipped_empty").when(n < MIN_CHARS, "skipped_short").otherwise("kept")
    return d.withColumn("state", state).drop("status")


def collection_counts(found: DataFrame) -> DataFrame:
    """One row: kept, skipped_empty, skipped_short, parse_err, files."""
    n = lambda s: F.count_if(F.col("state") == s).alias(s)
    return found.agg(n("kept"), n("skipped_empty"), n("skipped_short"), n("parse_err"), F.countDistinct("file").alias("files"))


def documents_of(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(id, norm) of the kept documents, numbered by place, for neardup.deduplicate; and (id, file, rid) to name them in a report."""
    kept = found.filter("state = 'kept'")
    return kept.select(F.col("pos").alias("id"), "norm"), kept.select(F.col("pos").alias("id"), "file", F.col("id").alias("rid"))


def group_summary(groups: DataFrame) -> DataFrame:
    """One row over duplicate groups: groups, near_groups (no equal texts inside), exact_pairs, n_affected, saveable."""
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return groups.agg(
        F.count("*").alias("groups"), F.count_if(F.col("exact_in") == 0).alias("near_groups"), total("exact_in").alias("exact_pairs"), total("members").alias("n_affected"), total("saveable").alias("saveable")
    )


def preview(norm: Column, chars: int = 80) -> Column:
    """The beginning of a text, with an ellipsis where there is more."""
    return F.when(F.length(norm) > chars, F.concat(F.left(norm, F.lit(chars)), F.lit("…"))).otherwise(norm)


def named_members(members: DataFrame, names: DataFrame, docs: DataFrame) -> DataFrame:
    """(root, place, id, file, rid, chars, copy_of, jaccard, preview) of neardup.group_members, by documents_of's names and texts."""
    shown = docs.select("id", preview(F.col("norm")).alias("preview"))
    return members.join(names, "id").join(shown, "id").select("root", "place", "id", "file", "rid", "chars", "copy_of", "jaccard", "preview")


def largest_groups(groups: DataFrame, most: int) -> DataFrame:
    """The `most` largest of the groups, by members, saved characters and root."""
    return groups.orderBy(F.desc("members"), F.desc("saveable"), "root").limit(most)
