import pytest
from pyspark.sql import functions as F

from sievework.operators import findings as O
from sievework.plans import dimensions as D
from sievework.plans import qa, rule_queries
from sievework.sources import report


@pytest.mark.parametrize("name", list(D.QUERIES))
def test_report_matches_its_oracle(same_rows, name):
    same_rows(D.QUERIES[name], D.ORACLE_SQL[name])


def test_levels_limits_and_distinct_counts(spark):
    lines = (
        D.Line("a", "any", "bad", "ERROR"), D.Line("a", "at_limit", "bad", "WARN", 25.0), D.Line("a", "over", "bad", "WARN", 24.9), D.Line("b", "too_few", "bad", "ERROR", 26.0, True),
        D.Line("b", "kinds", "kinds['k']"), D.Line("b", "held", "held['k']"), D.Line("b", "none", "kinds['other']"), D.Line("b", "null", "void", "ERROR"),
    )
    stat = spark.sql("SELECT 4L AS total, 1L AS bad, CAST(NULL AS LONG) AS void")
    hist = O.histogram(spark.createDataFrame([("x",), ("x",), ("y",), ("?",), (None,)], "k string"), k=F.col("k"))
    got = {r.name: (r.level, r.numer) for r in D.report_rows(stat, hist, lines).collect()}
    assert got == {"any": ("ERROR", 1), "at_limit": ("PASS", 1), "over": ("WARN", 1), "too_few": ("ERROR", 1), "kinds": ("PASS", 2), "held": ("PASS", 3), "none": ("PASS", 0), "null": ("PASS", 0)}


def test_lines_of_an_empty_corpus_and_both_sinks(spark):
    c = qa.check(rule_queries.qa_records(spark, "/root/testdata/sf0.001").limit(0))
    rows = D.report_rows(qa.stats(c), qa.histograms(c), D.QA)
    parts = report.dimension_tables(rows)
    assert [title for title, _, _ in parts] == ["Completeness", "Code", "Source", "Duplicates", "Privacy", "Knowledge"]
    assert sum(len(r) for _, _, r in parts) == len(D.QA) and all(cell[2] == "0" for _, _, r in parts for cell in r)
    assert "| unbalanced_blocks | PASS | 0 | 0 | 0.00 |" in report.markdown("qa", parts)
    assert "<td>unbalanced_blocks</td>" in report.page("qa", parts)
