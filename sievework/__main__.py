"""Command line: ``python -m sievework {blog,commit,qa,dup} PATH... --out FOLDER``. Exit status 1 where an ERROR stands.

Findings, gates, histograms and the report's lines go to Parquet below the folder, a report to report.md and report.html. ``--prev`` takes the
findings of an earlier run (its folder), or a Markdown report, of which only the rows it shows can be compared.
"""

from __future__ import annotations

import argparse
import datetime
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.operators import findings as O
from sievework.operators import neardup, sampling
from sievework.plans import blog, commit, deep, dimensions, qa
from sievework.sources import corpora, records, report

#: Of a folder, the files that are delivered data: names that are taken and, among them, those that are left out; fixed values.
SOURCES = {"blog": ("blog_data_*.jsonl", ()), "commit": ("*.jsonl", ("rejected.jsonl",))}


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="sievework", description="Quality checks of text corpora.")
    p.add_argument("kind", choices=("blog", "commit", "qa", "dup"))
    p.add_argument("paths", nargs="+", help="JSONL files and folders")
    p.add_argument("--out", required=True)
    p.add_argument("--record-kind", choices=tuple(corpora.EXTRACTORS), default="blog", help="dup: what the records are")
    p.add_argument("--threshold", type=float, default=0.6, help="dup: least similarity")
    p.add_argument("--ngram", type=int, default=5)
    p.add_argument("--margin", type=float, default=0.2, help="dup: how far below the threshold an estimate may lie; 0 tries all")
    p.add_argument("--sample", type=float, default=0, help="per cent of each file; 0 takes all")
    p.add_argument("--seed", type=int, default=2026)
    p.add_argument("--prev", help="an earlier run's folder or Markdown report")
    p.add_argument("--no-near-dup", action="store_true")
    p.add_argument("--no-verify", action="store_true", help="commit: leave the diff proof out")
    p.add_argument("--exempt-multi-turn", action=argparse.BooleanOptionalAction, default=True)
    p.add_argument("--exempt-intranet-ip", action=argparse.BooleanOptionalAction, default=False)
    p.add_argument("--fail-on-warn", action="store_true", help="qa: the deep rules count as errors")
    p.add_argument("--data-class", choices=deep.CLASSES, default="forum", help="qa: what kind of dialogues the deep rules expect")
    p.add_argument("--recount", metavar="FILE", help="qa: ranked byte merges, by which a share of the records has its tokens counted again; the file lies on every executor")
    p.add_argument("--recount-share", type=float, default=0.05)
    p.add_argument("--declared", default="o200k", help="qa: the tokenizer whose records are counted again")
    p.add_argument("--as-of", default=datetime.date.today().isoformat())
    return p.parse_args(argv)


def checked_parts(read: DataFrame, a: argparse.Namespace) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Findings, gates, histograms and report lines of a corpus."""
    near = lambda texts: None if a.no_near_dup else neardup.near_pair_count(texts)
    if a.kind == "blog":
        c = blog.check(read, a.as_of)
        stat, hist = blog.stats(c), blog.histograms(c)
        return O.exploded(c), blog.gate_rows(stat, hist, near(blog.near_texts(c))), hist, dimensions.report_rows(stat, hist, dimensions.BLOG)
    if a.kind == "commit":
        c = commit.check(read, not a.no_verify)
        stat = commit.stats(c, int(a.as_of[:4]))
        hist = commit.histograms(c)
        return O.exploded(c), commit.gate_rows(stat, hist).unionByName(commit.info_rows(stat)), hist, dimensions.report_rows(stat, hist, dimensions.COMMIT)
    c = qa.check(read, a.exempt_intranet_ip, around=True)
    more = O.exploded(deep.check(read, a.data_class, "ERROR" if a.fail_on_warn else "WARN"))
    if a.recount:
        more = more.unionByName(deep.recount_findings(read, deep.encoding_counter(a.recount), a.recount_share, a.seed, a.declared))
    stat = qa.stats(c)
    gates = qa.gate_rows(stat, qa.histograms(c), qa.mixed_files(c).count(), near(qa.near_texts(c)), a.exempt_multi_turn).unionByName(qa.info_rows(stat)).unionByName(qa.time_rows(c))
    hist = qa.histograms(c)
    return O.exploded(c).unionByName(more), gates, hist, dimensions.report_rows(stat, hist, dimensions.QA)


def earlier(spark: SparkSession, place: str) -> DataFrame:
    """(rid, item) of an earlier run."""
    if place.endswith(".md"):
        return report.previous_findings(spark.read.text(place))
    return spark.read.parquet(f"{place}/findings").select("rid", "item")


def save(spark: SparkSession, text: str, path: str) -> None:
    """A report beside the Parquet tables, in whichever file system holds them."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(target, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def run(spark: SparkSession, a: argparse.Namespace) -> int:
    glob, skip = SOURCES.get(a.kind, ("*.jsonl", ()))
    read = records.parsed(records.read_lines(spark, a.paths, glob, skip, bare_cr=a.kind != "dup"))
    if a.sample > 0:
        read = sampling.fixed_share(read, a.sample, a.seed, "pos", "file")
    if a.kind == "dup":
        records.require_utf8(read)
        found = neardup.kept(corpora.collected(read, a.record_kind))
        docs, names = corpora.documents_of(found)
        made = neardup.duplicate_groups(docs, a.threshold, a.ngram, a.margin)
        made.metrics().write.mode("overwrite").parquet(f"{a.out}/groups")
        corpora.named_members(made.members(), names, docs).write.mode("overwrite").parquet(f"{a.out}/members")
        groups, members = (spark.read.parquet(f"{a.out}/{x}") for x in ("groups", "members"))
        cells = lambda df: [[str(x) for x in r] for r in df.collect()]
        counts, total = corpora.collection_counts(found), corpora.group_summary(groups)
        parts = [("Documents", counts.columns, cells(counts)), ("Groups", total.columns, cells(total)), *report.group_tables(groups, members)]
        failed = not groups.isEmpty()
        neardup.dropped(spark)
    else:
        found, gates, hist, dims = checked_parts(read, a)
        marks = records.bom_files(spark, a.paths, glob)
        files = records.file_findings(read, marks).select("file", F.col("line_no").alias("pos"), "rid", "level", "item", "detail")
        for name, df in (("findings", found.unionByName(files)), ("gates", gates), ("histograms", hist), ("dimensions", dims)):
            df.write.mode("overwrite").parquet(f"{a.out}/{name}")
        found, gates, hist, dims = (spark.read.parquet(f"{a.out}/{x}") for x in ("findings", "gates", "histograms", "dimensions"))
        parts = [*report.dimension_tables(dims), *report.tables(found, gates, hist)]
        if a.prev:
            done = O.completion(O.compare_runs(earlier(spark, a.prev), found))
            parts.append(("Since the earlier run", done.columns, [[str(x) for x in r] for r in done.collect()]))
        failed = not O.passed(found, gates)
    save(spark, report.markdown(a.kind, parts), f"{a.out}/report.md")
    save(spark, report.page(a.kind, parts), f"{a.out}/report.html")
    return int(failed)


if __name__ == "__main__":
    sys.exit(run(SparkSession.builder.getOrCreate(), arguments()))
