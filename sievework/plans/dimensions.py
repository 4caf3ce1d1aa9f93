"""A report's lines by dimension: what is counted, of how much, and when a line is an ERROR or WARN.

Lines are data: each names its numerator as an expression over a corpus' one row of counters (`stats`) and over `kinds` and
`held`, how many different values a histogram's dimension has and how many records hold one. Distinct counts come from the
histograms, which are grouped by value already, so the records aren't expanded for them. Lines are evaluated in one projection.
Defined results: an empty corpus has all lines with 0; a dimension without any value counts 0.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.functions import patterns as P
from sievework.operators.neardup import kept
from sievework.plans import blog, commit
from sievework.plans.rule_queries import AS_OF, article_records, commit_records

#: The mark of a value that a record doesn't give.
UNKNOWN = "?"


class Line(NamedTuple):
    """level: what the line becomes where the share of numer in total, in per cent, is above limit, or below it with least."""

    section: str
    name: str
    numer: str
    level: str = "PASS"
    limit: float = 0.0
    least: bool = False


BLOG = (
    Line("completeness", "records", "total"),
    Line("completeness", "text_empty", "empty", "ERROR"),
    Line("completeness", "text_short", "short", "WARN"),
    Line("completeness", "fields_missing", "missing", "ERROR"),
    Line("completeness", "text_cut", "truncated", "ERROR"),
    Line("completeness", "images_lost", "blob_images + linked_images", "ERROR"),
    Line("format", "structure", "structure", "ERROR"),
    Line("format", "open_fence", "open_fence", "ERROR"),
    Line("format", "url_duplicates", "url_dup", "ERROR", P.MAX_DUP),
    Line("format", "body_duplicates", "body_dup", "ERROR", P.MAX_DUP),
    Line("format", "privacy", "privacy", "ERROR"),
    Line("source", "authority", "authority", "ERROR", P.MIN_AUTHORITY, True),
    Line("source", "platforms", "kinds['platform']"),
    Line("knowledge", "original", "original"),
    Line("knowledge", "cve_listed", "cve_listed"),
    Line("knowledge", "not_technical", "nontech", "ERROR", P.MAX_NONTECH),
    Line("knowledge", "outdated", "outdated"),
    Line("knowledge", "languages", "kinds['language']"),
    Line("knowledge", "categories", "kinds['category']"),
)
COMMIT = (
    Line("completeness", "records", "total"),
    Line("completeness", "structure", "structure", "ERROR"),
    Line("completeness", "fields_missing", "missing", "ERROR"),
    Line("completeness", "code_incomplete", "total - all_code", "ERROR"),
    Line("completeness", "whole_files", "complete"),
    Line("completeness", "cve_valid", "cve_valid"),
    Line("completeness", "diff_inconsistent", "inconsistent", "ERROR"),
    Line("completeness", "diff_duplicates", "diff_dup", "ERROR"),
    Line("format", "label_language", "label_language", "ERROR"),
    Line("format", "code_polluted", "polluted", "ERROR"),
    Line("format", "diff_lines", "diff_lines"),
    Line("source", "owners", "kinds['owner']"),
    Line("source", "no_license", "no_license", "ERROR"),
    Line("knowledge", "cwe_kinds", "kinds['cwe']"),
    Line("knowledge", "cwe_labelled", "held['cwe']"),
    Line("knowledge", "cvss_scored", "scored"),
    Line("knowledge", "vulnerability_kinds", "kinds['vulnerability']"),
    Line("knowledge", "severities", "kinds['severity']"),
    Line("knowledge", "languages", "kinds['language']"),
)
QA = (
    Line("completeness", "records", "total"),
    Line("completeness", "multi_turn", "multi_turn"),
    Line("completeness", "two_turns", "two_turns", "WARN"),
    Line("code", "blocks", "blocks"),
    Line("code", "unbalanced_blocks", "bad_blocks", "WARN"),
    Line("code", "records_with_bad_code", "bad_code", "WARN"),
    Line("source", "source_missing", "source_missing", "ERROR"),
    Line("source", "several_sources", "source_multi"),
    Line("source", "answering_model", "source_model"),
    Line("source", "low_model", "low_model", "ERROR"),
    Line("source", "synthetic_question", "synthetic_question", "WARN"),
    Line("source", "public_data_set", "public_data_set", "WARN"),
    Line("source", "hidden_span", "hidden_span", "ERROR"),
    Line("duplicates", "same_message", "message_duplicate", "ERROR"),
    Line("duplicates", "same_question", "same_question"),
    Line("privacy", "privacy", "privacy", "WARN"),
    Line("knowledge", "languages", "kinds['language']"),
    Line("knowledge", "domains", "kinds['domain']"),
)
LINES = {"blog": BLOG, "commit": COMMIT, "qa": QA}


def distinct_values(hist: DataFrame) -> DataFrame:
    """One row (kinds, held) of maps by dimension: values other than UNKNOWN and NULL, and the records that hold one."""
    by = hist.filter(F.col("key").isNotNull() & (F.col("key") != UNKNOWN)).groupBy("dim").agg(F.count("*").alias("kinds"), F.sum("cnt").alias("held"))
    entries = lambda c: F.map_from_entries(F.collect_list(F.struct("dim", c))).alias(c)
    return by.agg(entries("kinds"), entries("held"))


def report_rows(stat: DataFrame, hist: DataFrame, lines: tuple[Line, ...]) -> DataFrame:
    """(place, section, name, level, numer, denom): a row a line in the lines' order."""

    def row(place: int, line: Line) -> Column:
        numer = F.coalesce(F.expr(line.numer), F.lit(0)).cast("long")
        share = numer / F.greatest(F.col("total"), F.lit(1)) * 100
        bad = share < line.limit if line.least else share > line.limit
        return F.struct(
            F.lit(place).alias("place"), F.lit(line.section).alias("section"), F.lit(line.name).alias("name"),
            F.when(bad, line.level).otherwise("PASS").alias("level"), numer.alias("numer"), F.col("total").cast("long").alias("denom"),
        )

    both = stat.crossJoin(F.broadcast(distinct_values(hist)))
    return both.select(F.inline(F.array(*[row(i, x) for i, x in enumerate(lines, 1)])))


def article_report(spark, sf_dir):
    """The lines of documents as articles."""
    c = blog.check(article_records(spark, sf_dir), AS_OF)
    return report_rows(blog.stats(c), blog.histograms(c), BLOG)


def commit_report(spark, sf_dir):
    """The lines of documents as fix commits."""
    c = kept(commit.counted(commit.check(commit_records(spark, sf_dir))))
    return report_rows(commit.stats(c, int(AS_OF[:4])), commit.histograms(c), COMMIT)


QUERIES = {"article_report": article_report, "commit_report": commit_report}


def _oracle(lines: tuple[Line, ...], counted: str, **numer: str) -> str:
    """Union of the lines; numer: SQL of each line's count over the row `s`, 0 where it isn't named."""
    one = []
    for place, x in enumerate(lines, 1):
        n = f"({numer.get(x.name, '0')})"
        sign = "<" if x.least else ">"
        level = f"CASE WHEN {n}::DOUBLE / greatest(total, 1) * 100 {sign} {x.limit} THEN '{x.level}' ELSE 'PASS' END"
        one.append(f"SELECT {place}::INT AS place, '{x.section}' AS section, '{x.name}' AS name, {level} AS level, {n}::BIGINT AS numer, total AS denom FROM s")
    return f"WITH {counted} " + " UNION ALL ".join(one)


_BARE = r"regexp_replace(regexp_replace(coalesce(text, ''), '^\s+', ''), '\s+$', '')"
_EMAILS = r"list_filter(regexp_extract_all(coalesce(text, ''), '[a-zA-Z0-9._%+-]+@[a-zA-Z0-9-]+(?:\.[a-zA-Z0-9-]+)+'), lambda e: lower(split_part(e, '@', 2)) NOT IN ('example.com', 'example.org', 'example.net', 'test.com') AND NOT regexp_matches(e, '^x+@x+\.') AND NOT regexp_matches(e, '(?i)@((example|test|sample|localhost)[a-z0-9-]*\.[a-z.]+|[a-z0-9-]+\.localhost)(\.[a-z]+)*$') AND NOT regexp_matches(split_part(e, '@', 1), '^([xX*]+|[._+-]{1,3})$'))"
ORACLE_SQL = {
    "article_report": _oracle(
        BLOG,
        rf"""d AS (SELECT doc_id, lang, source, text, {_BARE} AS bare, {_EMAILS} AS emails FROM documents),
s AS (SELECT count(*) AS total, count(*) FILTER (bare = '') AS empty, count(*) FILTER (length(bare) < {P.MIN_CHARS}) AS short, count(*) FILTER (text IS NULL) AS absent,
  count(*) FILTER (len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '^\s*```'))) % 2 = 1) AS fences, count(*) FILTER (bare <> '') - count(DISTINCT nullif(bare, '')) AS bodies,
  count(*) FILTER (len(emails) > 0) AS privacy, count(DISTINCT lang) AS langs, count(DISTINCT source) AS sources FROM d)""",
        records="total", text_empty="empty", text_short="short", structure="absent", open_fence="fences", body_duplicates="bodies", privacy="privacy", platforms="sources",
        original="total", languages="langs", categories="CASE WHEN total > 0 THEN 1 ELSE 0 END",
    ),
    "commit_report": _oracle(
        COMMIT,
        # A diff has three lines of head, one of its hunk, one taken out, one put in, and the unchanged ones: the text's parts and the last.
        r"""d AS (SELECT lang, source, text, CASE WHEN lang = 'fr' THEN 1 ELSE 0 END AS wrong, md5(text) AS body, len(string_split(text, '. ')) + 7 AS n FROM documents WHERE text IS NOT NULL),
s AS (SELECT count(*) AS total, sum(wrong) AS wrong, sum(n) AS diff_lines, count(*) - count(DISTINCT body) AS dup, count(DISTINCT lang) AS langs, count(DISTINCT source) AS sources, least(count(*), 1) AS any FROM d)""",
        records="total", fields_missing="total", cve_valid="total", whole_files="total", diff_inconsistent="wrong", diff_duplicates="dup", diff_lines="diff_lines", owners="sources",
        no_license="total", cvss_scored="total", severities='"any"', languages="langs",
    ),
}
