"""Markdown and HTML reports from bounded summaries; whole findings go to Parquet."""

from __future__ import annotations

import html

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.operators.findings import item_summary
from sievework.sources import corpora

#: Rows that a report's tables show at most; the Parquet table has them all.
DETAIL_ROWS = 400
ADVICE_DEFAULT = "Review the listed records against the delivery standard."
#: What to do about an item of the dialogue rules.
ADVICE_QA = {
    "structure": "Bring the record to the six top-level fields.",
    "message_missing": "Supply the list of turns.",
    "turn_malformed": "Give every turn a question and an answer.",
    "question_empty": "Restore the question's text.",
    "answer_empty": "Supply the answer.",
    "status_missing": "Add the three cleaning flags.",
    "cleaning_unfinished": "Run the cleaning step, then set its flag.",
    "metadata_missing": "Add language, token count and type.",
    "type_value": "Set type to its fixed value.",
    "domain_not_array": "Make domain a list of tags.",
    "time_missing": "Fill in question and answer times from the source.",
    "tokens_missing": "Count tokens anew and name the tokenizer.",
    "tokenizer_unknown": "Name the tokenizer that made the counts.",
    "token_count": "Count tokens anew.",
    "id_prefix": "Use ids with the fixed prefix.",
    "hidden_span": "Remove hidden watermark text.",
    "privacy": "Look at each hit: mask personal data of others, excuse examples and code values.",
    "private_ip": "Look at each hit: mask addresses of real networks, excuse examples.",
    "social_account": "Mask the account.",
    "media": "Remove images and binaries; keep text and code.",
    "garbled": "Repair the encoding or drop the record.",
    "forbidden": "Drop the record.",
    "public_data_set": "Look at each hit: a name alone proves nothing; drop copied records.",
    "source_missing": "Name the community, or the source and the answering model.",
    "low_model": "Drop the answer or write it anew with a stronger model.",
    "synthetic_question": "Replace the question with one that a user asked.",
    "message_duplicate": "Keep one of the copies.",
}


def tables(findings: DataFrame, gates: DataFrame, hist: DataFrame, advice: dict[str, str] | None = None) -> list[tuple[str, list[str], list[list[str]]]]:
    """(title, header, rows) of a report: gates, items with advice and state, distributions, details with errors first."""
    advice = ADVICE_QA if advice is None else advice
    summary = [[r.item, r.level, str(r.cnt), ", ".join(r.samples or []), "to fix" if r.level == "ERROR" else "to review", advice.get(r.item, ADVICE_DEFAULT)] for r in item_summary(findings).orderBy("level", "item").collect()]
    gate_rows = [[r.gate, r.level, "" if r.value is None else f"{r.value:.2f}", "" if r.threshold is None else f"{r.threshold:g}"] for r in gates.orderBy("gate").collect()]
    spread = [[r.dim, r.key or "", str(r.cnt)] for r in hist.orderBy("dim", hist["cnt"].desc(), "key").limit(DETAIL_ROWS).collect()]
    detail = [[r.rid, r.level, r.item, r.detail or ""] for r in findings.orderBy("level", "item", "rid").limit(DETAIL_ROWS).collect()]
    return [
        ("Gates", ["gate", "level", "value", "threshold"], gate_rows), ("Items", ["item", "level", "count", "samples", "state", "advice"], summary),
        ("Distributions", ["dimension", "key", "count"], spread), ("Details", ["id", "level", "item", "detail"], detail),
    ]


def dimension_tables(dims: DataFrame) -> list[tuple[str, list[str], list[list[str]]]]:
    """(title, header, rows) a section of the report's dimensions, in the lines' order; as many rows as the report has lines."""
    held: dict[str, list[list[str]]] = {}
    for r in dims.orderBy("place").collect():
        held.setdefault(r.section, []).append([r.name, r.level, f"{r.numer:,}", f"{r.denom:,}", f"{100 * r.numer / max(r.denom, 1):.2f}"])
    return [(section.capitalize(), ["check", "level", "count", "of records", "per cent"], rows) for section, rows in held.items()]


def group_tables(groups: DataFrame, members: DataFrame, most: int = 20, each: int = 20) -> list[tuple[str, list[str], list[list[str]]]]:
    """(title, header, rows) of the largest groups, each with its first members; all of both are in Parquet."""
    top = corpora.largest_groups(groups, most)
    held: dict = {}
    for m in members.filter(F.col("place") <= each).join(F.broadcast(top.select("root")), "root").orderBy("root", "place").collect():
        held.setdefault(m.root, []).append([str(m.place), m.file.rsplit("/", 1)[-1], m.rid, f"{m.chars:,}", "" if m.copy_of is None else "copy", f"{m.jaccard:.3f}", m.preview])
    header = ["#", "file", "id", "characters", "equal text", "similarity to the first", "beginning"]
    title = lambda k, g: f"Group {k}: {g.members} documents, {'with equal texts' if g.exact_in else 'near copies'}, largest similarity {g.max_j:.3f}, {g.saveable:,} characters to save"
    return [(title(k, g), header, held.get(g.root, [])) for k, g in enumerate(top.collect(), 1)]


def markdown(title: str, parts: list[tuple[str, list[str], list[list[str]]]]) -> str:
    cell = lambda x: x.replace("|", "\\|").replace("\n", " ")
    out = [f"# {title}", ""]
    for name, header, rows in parts:
        out += [f"## {name}", "", "| " + " | ".join(header) + " |", "|" + "---|" * len(header), *("| " + " | ".join(map(cell, r)) + " |" for r in rows), ""]
    return "\n".join(out)


def page(title: str, parts: list[tuple[str, list[str], list[list[str]]]]) -> str:
    row = lambda tag, cells: "<tr>" + "".join(f"<{tag}>{html.escape(c)}</{tag}>" for c in cells) + "</tr>"
    body = "".join(f"<h2>{html.escape(n)}</h2><table>{row('th', h)}{''.join(row('td', r) for r in rows)}</table>" for n, h, rows in parts)
    return f"<!doctype html><meta charset=utf-8><title>{html.escape(title)}</title><h1>{html.escape(title)}</h1>{body}"


def previous_findings(lines: DataFrame) -> DataFrame:
    """(rid, item) scraped from the detail rows of an earlier Markdown report; lines: a text table with column value."""
    rx = r"^\| (.+?) \| (ERROR|WARN) \| (\S+) \| .*\|$"
    hit = lines.select(F.regexp_extract("value", rx, 1).alias("rid"), F.regexp_extract("value", rx, 3).alias("item"))
    return hit.filter("rid <> ''").distinct()
