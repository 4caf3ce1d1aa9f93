import json

import pytest

from sievework import __main__ as command
from sievework.sources import corpora, records

META = {"title": "t", "url": "https://a.example/1", "source_platform": "FreeBuf", "author_or_org": "o", "publish_time": "2024-05-01", "content_category": "web", "is_original": True, "primary_languages": ["c"], "related_cves": None}


def write(path, rows, start=""):
    path.write_text(start + "\n".join(r if isinstance(r, str) else json.dumps(r) for r in rows) + "\n", encoding="utf-8")


def test_articles_end_with_a_report_and_a_status(spark, tmp_path):
    (tmp_path / "in").mkdir()
    good = [{"id": str(i), "content": f"word{i} " * 60, "meta": {**META, "url": f"u{i}", "primary_languages": [f"l{i}"]}} for i in range(4)]
    write(tmp_path / "in" / "blog_data_a.jsonl", [*good, {"id": "bad", "content": "short", "meta": {}}, "no json"], "﻿")
    first, second = str(tmp_path / "one"), str(tmp_path / "two")
    assert command.run(spark, command.arguments(["blog", str(tmp_path / "in"), "--out", first, "--as-of", "2026-09-01"])) == 1
    found = {(r.rid, r.item) for r in spark.read.parquet(first + "/findings").collect()}
    assert found == {("bad", "required_meta"), ("bad", "too_short"), ("?", "json_parse"), ("?", "byte_order_mark")}
    write(tmp_path / "in" / "blog_data_a.jsonl", good)
    command.run(spark, command.arguments(["blog", str(tmp_path / "in"), "--out", second, "--as-of", "2026-09-01", "--prev", first, "--no-near-dup"]))
    report = (tmp_path / "two" / "report.md").read_text()
    assert "Since the earlier run" in report and "| 4 | 0 | 0 | 1.0 |" in report and (tmp_path / "two" / "report.html").exists()


def test_duplicates_of_dialogues(spark, tmp_path):
    text = "how do rare grams of two dialogues meet in one list " * 6
    rows = [{"id": f"QA_2026_{i}", "message": [{"question": text + ("!" if i == 1 else ""), "answer": "yes"}]} for i in range(3)] + [{"id": "s", "message": []}, {"id": "t", "message": [{"question": "q"}]}, "{"]
    write(tmp_path / "q.jsonl", rows)
    out = str(tmp_path / "out")
    assert command.run(spark, command.arguments(["dup", str(tmp_path / "q.jsonl"), "--out", out, "--record-kind", "qa"])) == 1
    group = spark.read.parquet(out + "/groups").collect()
    assert [(g.members, g.exact_in) for g in group] == [(3, 1)]
    found = corpora.collected(records.parsed(records.read_lines(spark, str(tmp_path / "q.jsonl"))), "qa")
    assert tuple(corpora.collection_counts(found).first()) == (3, 1, 1, 1, 1)
    with pytest.raises(SystemExit):
        command.arguments(["other", "x", "--out", "y"])


def test_line_ends(spark, tmp_path):
    (tmp_path / "a.jsonl").write_bytes(b'{"id": 1}\r{"id": 2}\r\n{"id": 3}\n')
    lines = lambda **k: [r.line for r in records.numbered(records.read_lines(spark, str(tmp_path), **k)).orderBy("line_no").collect()]
    assert lines(bare_cr=True) == ['{"id": 1}', '{"id": 2}', '{"id": 3}'] and len(lines()) == 2


def test_lines_that_are_no_utf8(spark, tmp_path):
    good, bad = b'{"id": "1", "content": "caf\xc3\xa9"}\n', b'{"id": "2", "content": "caf\xe9"}\n'
    (tmp_path / "a.jsonl").write_bytes(good + bad + b"\n" + good + b"\xff{\n")
    (tmp_path / "b.jsonl").write_bytes(b"\xef\xbb\xbf" + good.rstrip())
    (tmp_path / "c.jsonl").write_bytes(good.replace(b"\n", b"\r\n") + good)
    read = records.parsed(records.read_lines(spark, str(tmp_path)))
    assert sorted((r.file[-7:], r.status) for r in read.collect()) == [("a.jsonl", s) for s in ("blank", "not_utf8", "not_utf8", "ok", "ok")] + [("b.jsonl", "ok"), ("c.jsonl", "ok"), ("c.jsonl", "ok")]
    marks = {r.file[-7:]: r.bom for r in records.bom_files(spark, str(tmp_path)).collect()}
    assert marks == {"a.jsonl": False, "b.jsonl": True, "c.jsonl": False}
    found = {(r.file[-7:], r.line_no, r.item) for r in records.file_findings(read, records.bom_files(spark, str(tmp_path))).collect()}
    assert found == {("a.jsonl", 2, "not_utf8"), ("a.jsonl", 5, "not_utf8"), ("b.jsonl", 1, "byte_order_mark")}
    with pytest.raises(ValueError, match=r"a\.jsonl \(2 lines\)"):
        records.require_utf8(read)
    records.require_utf8(read.filter("file not like '%a.jsonl'"))
    with pytest.raises(ValueError):
        command.run(spark, command.arguments(["dup", str(tmp_path), "--out", str(tmp_path / "out")]))


def test_folders_leave_out_what_is_not_delivered(spark, tmp_path):
    for name in ("a.jsonl", "rejected.jsonl", "blog_data_1.jsonl"):
        (tmp_path / name).write_text('{"id": "x"}\n')
    seen = lambda kind: sorted(r.file.rsplit("/", 1)[1] for r in records.read_lines(spark, str(tmp_path), *command.SOURCES.get(kind, ("*.jsonl", ()))).collect())
    assert seen("blog") == ["blog_data_1.jsonl"] and seen("commit") == ["a.jsonl", "blog_data_1.jsonl"] and seen("qa") == ["a.jsonl", "blog_data_1.jsonl", "rejected.jsonl"]


def test_members_of_groups_reach_the_report(spark, tmp_path):
    text = "members of a group are named with their file and their beginning " * 5
    write(tmp_path / "x.jsonl", [{"id": f"n{i}", "content": t} for i, t in enumerate((text, text, text[:-8] + "changed!", "short"))])
    out = str(tmp_path / "out")
    assert command.run(spark, command.arguments(["dup", str(tmp_path / "x.jsonl"), "--out", out])) == 1
    rows = spark.read.parquet(out + "/members").orderBy("place").collect()
    assert [(r.place, r.rid, r.copy_of is None) for r in rows] == [(1, "n0", True), (2, "n1", False), (3, "n2", True)] and rows[0].preview.endswith("…")
    report = (tmp_path / "out" / "report.md").read_text()
    assert "Group 1: 3 documents, with equal texts" in report and "| 3 | x.jsonl | n2 |" in report


def test_ties_go_to_what_came_first(spark):
    from pyspark.sql import functions as F

    from sievework.operators import findings as O

    df = spark.createDataFrame([("f", 3, "b"), ("f", 1, "c"), ("f", 2, "a"), ("f", 5, "a"), ("f", 4, "c"), ("h", 0, None)], "file string, pos long, v string")
    top = lambda h: [tuple(r) for r in O.top_of(h).collect()]
    assert top(O.histogram(df, "file", "pos", v=F.col("v"))) == [("v", "c", 2, 6)]
    assert top(O.histogram(df, v=F.col("v"))) == [("v", "a", 2, 6)]


def test_recount_and_shared_times_of_dialogues(spark, tmp_path):
    tokenizers = pytest.importorskip("public_tokenizers")
    meta = {"tokenizer": "openai/o200k_base", "question_time": "2024-01-01", "answer_time": "2024-01-02", "question_tokens": 1, "answer_tokens": 900, "primary_language": "c", "type": "x"}
    rows = [{"id": f"QA_2026_{i}", "message": [{"question": f"why {i}?", "answer": f"so it is {i}."}], "source": "forum", "domain": ["c"], "cleaning_status": {}, "metadata": meta} for i in range(120)]
    write(tmp_path / "q.jsonl", rows)
    out = str(tmp_path / "out")
    command.run(spark, command.arguments(["qa", str(tmp_path / "q.jsonl"), "--out", out, "--no-near-dup", "--data-class", "code", "--recount", str(tokenizers.path("byte_bpe_50k.tiktoken")), "--recount-share", "1"]))
    found = spark.read.parquet(out + "/findings")
    assert found.filter("item = 'token_recount'").count() == 120
    gate, = spark.read.parquet(out + "/gates").filter("gate = 'shared_time'").collect()
    assert (gate.level, gate.value, gate.numer, gate.denom) == ("WARN", 100.0, 120, 120)
