"""Documents dressed as commits: texts whose prose reads like parts of a mail or a diff."""

import pytest

from sievework.plans import dimensions, rule_queries

TEXTS = [
    ("Begin here. From edeaeaed the thing is. End", "en"), ("From 0badcafe on. Date: never. Subject: [PATCH] none", "en"), ("--- a. +++ b. diff --git c\nFrom: me", "fr"),
    ("Begin here. From edeaeaed the thing is. End", "de"), ("", "en"), (None, "en"), ("   .  . x\r\n ", None), ('"quoted" \\ 中文 \U0001f600. \t. ', "es"), ("line\n\nline. ", "en"),
]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("commits")
    rows = [(i, text, lang, None if i == 4 else f"src{i % 2}") for i, (text, lang) in enumerate(TEXTS)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(f"{path}/documents.parquet")
    return str(path)


def test_prose_like_a_mail_head_pollutes_no_commit(spark, folder):
    import duckdb

    got = sorted(tuple(r) for r in dimensions.commit_report(spark, folder).collect())
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet/*.parquet'")
    assert got == sorted(con.execute(dimensions.ORACLE_SQL["commit_report"]).fetchall())
    assert {r.item for r in rule_queries.commit_findings(spark, folder).collect()}.isdisjoint({"code_polluted", "pii_email"})


def test_counted_commits_hold_no_text_and_keep_the_order_of_findings(spark, folder):
    from sievework.plans import commit

    checked = commit.check(rule_queries.commit_records(spark, folder))
    assert not {"v", "before", "after", "diff", "message", "text", "proof"} & set(commit.counted(checked).columns)
    found = checked.filter("rid = '3'").first().findings
    assert [tuple(r)[2] for r in found if r.item == "diff_duplicate"] == ["0"]
    items = [r.item for r in found]
    assert items.index("required_meta") < items.index("diff_duplicate") < (items + ["thin_context"]).index("thin_context")
