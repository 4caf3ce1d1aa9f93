import json

import pytest
from pyspark.sql import functions as F

from sievework.functions import code, pii, text
from sievework.operators import diff, findings, neardup, sampling
from sievework.plans import blog, catalog, commit, qa
from sievework.sources import records


def value(spark, expr, *cells):
    return spark.createDataFrame([tuple(cells)], [f"c{i}" for i in range(len(cells))]).select(expr.alias("x")).first()["x"]


def load(spark, tmp_path, rows, name="a.jsonl"):
    (tmp_path / name).write_text("\n".join(r if isinstance(r, str) else json.dumps(r, ensure_ascii=False) for r in rows) + "\n", encoding="utf-8")
    return records.parsed(records.read_lines(spark, str(tmp_path)))


def items(checked):
    return {r.rid: sorted({f.item for f in r.findings}) for r in checked.select("rid", "findings").collect()}


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_oracle(same_rows, name):
    same_rows(catalog.QUERIES[name], catalog.ORACLE_SQL[name])


def test_every_query_runs(spark):
    for name, q in catalog.QUERIES.items():
        assert q(spark, "/root/testdata/sf0.001").count() >= 0, name


META = {"title": "t", "url": "https://a.example/1", "source_platform": "FreeBuf", "author_or_org": "o", "publish_time": "2024-05-01", "content_category": "web", "is_original": True, "primary_languages": ["c"], "related_cves": "CVE-2024-1111"}


def test_blog_rules(spark, tmp_path):
    body = "word " * 60
    long = lambda **m: {"id": "x", "content": body, "meta": {**META, **m}}
    rows = [
        {**long(), "id": "ok", "content": body + "CVE-2024-1111"},
        {**long(url="u2"), "id": "poc", "content": body + "\n完整poc："},
        {**long(url="u3", related_cves=None), "id": "cve", "content": body + "如下 cve-2023-22222 http://8.130.5.6/x http://127.0.0.1/ 192.168.3.4 a.b@corp.cn"},
        {**long(url="u4"), "id": "fence", "content": body + "1\n````\n```\n````\n```c\nint x;"},
        {**long(url="u2", is_original=False, publish_time="2001-01-01"), "id": "dup", "content": body + "2 ![x](blob:http://l/1) ![y](https://e.com/a.png)"},
        {**long(url="u6"), "id": "short", "content": "优惠券可多次使用"},
        {**long(url="u7"), "id": "ad", "content": body + "\n扫码关注 我们\n## 代码实现"},
        {"id": "bad", "content": body + "9", "extra": 1, "meta": {}},
        "not json",
        "",
        "[1]",
    ]
    parsed = load(spark, tmp_path, rows)
    assert {r.status: r["count"] for r in parsed.groupBy("status").count().collect()} == {"ok": 8, "bad": 1, "blank": 1, "not_object": 1}
    checked = blog.check(parsed, "2026-09-01").cache()
    got = items(checked)
    assert got["ok"] == []
    assert got["poc"] == ["poc_truncated"]
    assert got["cve"] == ["cve_unlisted", "live_ip_link", "privacy", "private_ip"]
    assert got["fence"] == ["open_fence"]
    assert got["dup"] == ["blob_image", "linked_image", "outdated", "translation_source", "url_duplicate"]
    assert got["short"] == ["too_short"]
    assert got["ad"] == ["empty_section", "not_technical"]
    assert got["bad"] == ["required_meta", "structure"]
    stat, hist = blog.stats(checked), blog.histograms(checked)
    gates = {r.gate: r.level for r in blog.gate_rows(stat, hist).collect()}
    assert gates["near_dup"] == "SKIP" and gates["truncated"] == "ERROR" and gates["authority"] == "ERROR" and "one_platform" in gates
    found = findings.exploded(checked)
    assert not findings.passed(found) and findings.item_summary(found).filter("item = 'required_meta'").first().level == "ERROR"


DIFF = "diff --git a/src/m.c b/src/m.c\nindex 1..2\n--- a/src/m.c\n+++ b/src/m.c\n@@ -1,5 +1,5 @@\n a\n-b\n+B\n c\n d\n e\n"


def test_diff_algebra():
    hunks = diff.parse(DIFF)[0].hunks
    assert diff.apply(list("abcde"), hunks) == (list("aBcde"), "")
    assert diff.apply(list("xabcde"), hunks)[0] is None
    assert diff.consistency("\na\nb\nc\nd\ne\n", "a\nB\nc\nd\ne", DIFF, "m.c") == (True, "consistent")
    assert diff.consistency("a", "b", DIFF, "other.c")[0] is False
    new = "diff --git a/n b/n\nnew file mode 100644\n@@ -0,0 +1,2 @@\n+x\n+y\n"
    assert diff.consistency(" ", "x\ny", new, "n") == (True, "new file")
    two = DIFF + "@@ -5,1 +5,2 @@\n e\n+f\n\\ No newline at end of file\n"
    assert diff.apply(list("abcde"), diff.parse(two)[0].hunks)[0] == list("aBcdef")


def test_commit_rules(spark, tmp_path):
    meta = {k: "v" for k in ("project_name", "project_owner", "programming_language", "vulnerability_type", "cvss_vector", "fix_commit_hash", "fix_pattern", "vulnerability_cause", "license")}
    meta |= {"cve_id": "CVE-2025-1234", "cwe_classification": ["CWE-79"], "cwe_id": "cwe-79", "severity": "HIGH", "cvss_score": 7.4, "commit_message": "Fix it", "complete_code_fetched": True, "primary_file": "src/m.c"}
    meta |= {"vulnerable_code": "a\nb\nc\nd\ne", "fixed_code": "a\nB\nc\nd\ne", "unified_diff": DIFF}
    other = DIFF.replace("+B", "+C")
    rows = [
        {"id": "ok", "text": "x", "meta": meta},
        {"id": "dup", "text": "x", "meta": meta},
        {"id": "bad", "text": "CVE-2020-1111 CVE-2020-2222\nStatus: REJECTED", "meta": {**meta, "severity": "LOW", "cwe_id": "CWE-1", "cve_id": "CVE-22-1", "unified_diff": other, "commit_message": "Revert me joe@corp.cn"}},
        {"id": "doc", "text": "", "meta": {**meta, "primary_file": "README.md", "unified_diff": "From 0123456789 Mon Sep 17\n" + DIFF.replace("-b", "-// q").replace("+B", "+// r"), "fixed_code": "From: x\n(New file)\nxxxxxxxxxxxx", "complete_code_fetched": False}},
    ]
    checked = commit.check(load(spark, tmp_path, rows)).cache()
    got = items(checked)
    assert got["ok"] == ["thin_context"]
    assert got["dup"] == ["diff_duplicate", "thin_context"]
    assert got["bad"] == ["cve_format", "cve_status", "cwe_mismatch", "diff_inconsistent", "pii_email", "revert_first_line", "several_cves", "severity_mismatch", "thin_context"]
    assert {"code_note_missing", "code_polluted", "diff_mail_header", "new_file_mark", "primary_is_document", "trivial_diff", "no_logic_change", "x_mask", "code_short"} <= set(got["doc"])
    stat = commit.stats(checked, 2026)
    row = stat.first()
    assert (row.consistent, row.inconsistent, row.unverified, row.recent) == (2, 1, 1, 3)
    gates = {r.gate: r.level for r in commit.gate_rows(stat, commit.histograms(checked)).collect()}
    assert gates["inconsistent"] == "ERROR" and gates["one_language"] == "ERROR" and gates["thin_context"] == "WARN"


def test_qa_rules(spark, tmp_path):
    md = {"primary_language": "C", "token_count": 30, "type": "general_code_qa_dict", "question_time": "2024-01-01T00:00:00", "answer_time": "2024-01-02T00:00:00", "question_tokens": 10, "answer_tokens": 20, "tokenizer": "tiktoken/o200k_base"}
    base = {"message": [{"question": "how?", "answer": "so."}], "source": "forum", "domain": ["c"], "cleaning_status": {"deduplicated": True, "denoised": True, "format_normalized": True}, "metadata": md}
    turn = lambda q, a: {"message": [{"question": q, "answer": a}]}
    rows = [
        {"id": "QA_2026_ok", **base},
        {"id": "QA_2026_dup", **base},
        {"id": "x", **base, **turn("q1", " "), "domain": "c / d", "source": "a/gpt-3.5", "metadata": {**md, "answer_time": "2023", "tokenizer": "?", "token_count": 31, "type": "z"}},
        {"id": "QA_2026_pii", **base, **turn("mail zhang@163.com or call 13912345678 now", "pay by card 4539 1488 0343 6467 ok 192.168.7.7, qq: 542278416")},
        {"id": "QA_2026_safe", **base, **turn("nodejs@4.x-slim `a.b@corp.cn` ```\nq@corp.cn\n``` $13912345678$", "192.168.1.1 Enter CC No. (4111111111111111) <span style={{opacity: 0.5}}>x</span>")},
        {"id": "QA_2026_code", **base, **turn("作为一个AI <span style=\"opacity:0\">x</span>", "```c\nint f( {\n  return 1;\n}\n```\nuse CodeAlpaca rows ![a](https://e.com/x.png)")},
        {"id": "QA_2026_turn", **base, "message": [{"question": "only"}, 3, {"question": "q", "answer": "a"}], "cleaning_status": {"denoised": False}},
    ]
    checked = qa.check(load(spark, tmp_path, rows)).cache()
    got = items(checked)
    assert got["QA_2026_ok"] == [] and got["QA_2026_dup"] == ["message_duplicate"]
    assert got["x"] == ["answer_empty", "domain_not_array", "id_prefix", "low_model", "time_inverted", "token_count", "tokenizer_unknown", "type_value"]
    assert got["QA_2026_pii"] == ["privacy", "private_ip", "social_account"]
    assert got["QA_2026_safe"] == []
    assert got["QA_2026_code"] == ["hidden_span", "media", "public_data_set", "synthetic_question"]
    assert got["QA_2026_turn"] == ["cleaning_unfinished", "status_missing", "turn_malformed"]
    detail = {f.item: f.detail for r in checked.filter("rid = 'QA_2026_pii'").collect() for f in r.findings}
    assert detail["privacy"] == "email xxxxxx@163.com; phone 139XXXXXX78; bank_card 4539XXXXXXXX6467"
    assert detail["social_account"] == "qq: 542xxxx16"
    row = qa.stats(checked).first()
    assert (row.total, row.multi_turn, row.bad_blocks, row.message_duplicate) == (7, 1, 1, 1)
    gates = {r.gate: r.level for r in qa.gate_rows(qa.stats(checked), qa.histograms(checked), qa.mixed_files(checked).count()).collect()}
    assert gates["message_duplicate"] == "ERROR" and gates["mixed_files"] == "WARN" and gates["multi_turn"] == "PASS"


def test_functions(spark):
    c = F.col("c0")
    assert value(spark, text.matches(c, r"\d+", 2), "a😀12b3") == [("12", 2, "a😀", "b3"), ("3", 5, "2b", "")]
    assert value(spark, text.matches(c, "z"), "abc") == []
    assert value(spark, text.char_ngrams(c, 5, True), "abc") == ["abc"] and value(spark, text.char_ngrams(c, 5, False), "abc") == []
    assert value(spark, text.estimated_tokens(c), "中文abcdefg") == 3
    assert value(spark, text.escape_html(c), '<a href="x">&') == "&lt;a href=&quot;x&quot;&gt;&amp;"
    for ip in ("127.0.0.1", "169.254.169.254", "10.1.2.3", "8.8.1.1", "1.2.3.4", "192.0.2.1", "203.0.113.9", "300.1.1.1"):
        assert value(spark, pii.excluded_ip(c), ip), ip
    assert not value(spark, pii.excluded_ip(c), "93.184.216.34")
    assert value(spark, pii.mask(F.lit("id_card"), c), "110105199001011234") == "110105XXXXXXXX1234"
    assert value(spark, pii.mask_ip(c), "192.168.1.250") == "192.168.x.x"
    assert not value(spark, pii.real_email(c), "xxx.xxxxxx@a.com") and value(spark, pii.real_email(c), "zhang@163.com")
    assert code.skeleton("a('x)') // (\n/* ( */ b(\"{\")") == "a() \n b()"
    assert code.skeleton("fn f<'a, P>(x: &'a str) { 'x' }", "rust").count("'") == 0
    assert "[" in code.skeleton("$pool->getItem('foo', ['ns1]);")
    assert not code.unbalanced("c", "for (i = 0; ; i++) {") and code.unbalanced("c", "int f( {\n}\n") and not code.unbalanced("python", "((")
    assert code.skeleton("see http://x (a)").count("(") == 1


def test_bom_and_lines(spark, tmp_path):
    (tmp_path / "b.jsonl").write_bytes(b'\xef\xbb\xbf{"id": 1}\r\n{"id": "a\xe2\x80\xa8b"}\n\n')
    lines = records.read_lines(spark, str(tmp_path))
    assert records.parsed(lines).orderBy("pos").select("status").rdd.map(lambda r: r[0]).collect() == ["ok", "ok", "blank"]
    assert [r.bom for r in records.bom_files(spark, str(tmp_path)).collect()] == [True]
    assert records.line_counts(lines).first().lines == 3


def test_samples(spark):
    df = spark.range(1000).withColumn("g", F.col("id") % 3)
    a = sampling.fixed_share(df, 10, 7, "id", "g")
    assert sorted(r["count"] for r in a.groupBy("g").count().collect()) == [33, 33, 33]
    assert {r.id for r in a.collect()} == {r.id for r in sampling.fixed_share(df.repartition(9), 10, 7, "id", "g").collect()}
    assert sampling.fixed_share(df.filter("id < 3"), 1, 7, "id").count() == 1
    assert 40 < sampling.bernoulli(df, 0.1, 3, "id").count() < 170


def test_near_duplicates_and_comparison(spark):
    import random

    rng = random.Random(8)
    base = "".join(rng.choice("abcdefghij") for _ in range(400))
    docs = spark.createDataFrame([(1, base), (2, base), (3, base[:350] + "zzzz" + base[354:]), (4, base[::-1]), (5, "short")], "id long, norm string")
    groups = neardup.deduplicate(docs).collect()
    assert len(groups) == 1 and (groups[0].members, groups[0].exact_in, groups[0].max_j, groups[0].saveable) == (3, 1, 1.0, 800)
    chain = spark.createDataFrame([(i, i + 1) for i in range(30)] + [(100, 101)], "i long, j long")
    assert {r.node: r.root for r in neardup.clusters(chain).collect()} == {**{i: 0 for i in range(31)}, 100: 100, 101: 100}
    old = spark.createDataFrame([("a", "x"), ("b", "y")], "rid string, item string")
    new = spark.createDataFrame([("b", "y"), ("c", "z")], "rid string, item string")
    done = findings.completion(findings.compare_runs(old, new)).first()
    assert (done.resolved, done.open, done.added, done.rate) == (1, 1, 1, 0.5)


def test_report_and_stream(spark, tmp_path):
    from sievework.sources import report
    from sievework.streaming.rules import stream_findings

    (tmp_path / "in").mkdir()
    parsed = load(spark, tmp_path / "in", [{"id": "a|<b>", "content": "short", "meta": META}, {"id": "c", "content": "x", "meta": {}}])
    checked = blog.check(parsed, "2026-09-01").cache()
    found = findings.exploded(checked).cache()
    parts = report.tables(found, blog.gate_rows(blog.stats(checked), blog.histograms(checked)), blog.histograms(checked))
    text_report = report.markdown("R", parts)
    assert "a\\|<b>" in text_report and "a|&lt;b&gt;" in report.page("R", parts)
    (tmp_path / "prev.md").write_text(text_report)
    prev = report.previous_findings(spark.read.text(str(tmp_path / "prev.md")))
    assert prev.filter("rid = 'c'").count() == found.filter("rid = 'c'").select("item").distinct().count()
    q = stream_findings(spark, str(tmp_path / "in"), lambda b: blog.check(b, "2026-09-01"), str(tmp_path / "out"), str(tmp_path / "ck"))
    q.awaitTermination(60)
    assert spark.read.parquet(str(tmp_path / "out")).count() == found.count()


def test_deep_rules(spark, tmp_path):
    from sievework.plans import deep

    plain = "Sort all numbers first and then add the largest ones together until done."
    rec = lambda i, q, a, **m: {"id": i, "message": [{"question": q, "answer": a}], "metadata": {"primary_language": "Python", "tokenizer": "tiktoken/o200k_base", "question_tokens": 2, "answer_tokens": 3, **m}}
    rows = [
        rec("ok", "how", "```py\nprint(1)\n```"),
        rec("prose", "how", plain),
        rec("flagged", "how", plain, has_code=True),
        rec("label", "how", "/* ```java\nx\n``` */\n```cpp\nint x;\n```", primary_language="Rust"),
        rec("family", "how", "```cpp\nint x;\n```", primary_language="c"),
        rec("bare", "how", "package main\nfunc main() { }", primary_language="java"),
        rec("odd", "how", "unknown tongue here", primary_language="text"),
        rec("json", "how", "```json\n{}\n```", primary_language="JSON"),
        rec("cut", "1 <= n < 105", "```py\nprint(1)\n```\n```py\nprint("),
        rec("power", "-231 <= x <= 231 - 1", "```python3\nx = 1\n```"),
        rec("template", "q", "此处撰写解题思路\n```py\nx\n```"),
        rec("title", "q", "Sum\n题解", primary_language=""),
        rec("robot", "q", "```py\nx\n```", author="by GPT-generated bot"),
        {"id": "none", "message": None, "metadata": None},
    ]
    parsed = load(spark, tmp_path, rows)
    got = items(deep.check(parsed, "code"))
    assert got == {
        "ok": [], "prose": ["deep_language", "deep_no_code"], "flagged": [], "label": ["deep_language"], "family": [], "bare": ["deep_language"], "odd": [], "json": ["deep_language"],
        "cut": ["deep_cut_answer", "deep_flat_power"], "power": ["deep_flat_power"], "template": ["deep_template"], "title": ["deep_template"], "robot": ["deep_ai_author"], "none": [],
    }
    forum = items(deep.check(parsed))
    assert {k for k, v in forum.items() if v} == {"template", "title", "robot"}
    again = {r.rid: (r.question_recount, r.answer_recount) for r in deep.token_recount(parsed, lambda: lambda t: len(t.split()), 1.0).collect()}
    assert "ok" in again and again["prose"] == (1, 13) and "none" not in again
    same = load(spark, tmp_path, [rec("s", "a b", "c d e")])
    assert deep.token_recount(same.filter("v is not null"), lambda: lambda t: len(t.split()), 1.0).filter("rid = 's'").count() == 0
    count = deep.encoding_counter("/opt/tokenizers/byte_bpe_50k.tiktoken")()
    assert count("") == 0 and 0 < count("hello world again") <= 17
