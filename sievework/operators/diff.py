"""Unified diffs: sections, hunks, strict application and the consistency proof.

Applying hunks is a walk with state, so it is plain Python inside one Arrow-batched UDF; all else is column expressions.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievework.functions import patterns as P
from sievework.functions.text import lines, starts_any, strip

_SECTION = re.compile(r"^diff --git a/(.+?) b/(.+?)$")
_HUNK = re.compile(r"^@@ -(\d+)(?:,\d+)? \+\d+(?:,\d+)? @@")


@dataclass
class Hunk:
    start: int
    old: list[str] = field(default_factory=list)
    new: list[str] = field(default_factory=list)
    added: list[str] = field(default_factory=list)
    context: int = 0


@dataclass
class Section:
    path: str
    fresh: bool = False
    hunks: list[Hunk] = field(default_factory=list)


def parse(diff: str) -> list[Section]:
    """File sections with their hunks; what stands before the first header is skipped, trailing white space of lines is dropped.

    A hunk is kept as the block it expects and the block it leaves, which is all that strict application needs.
    """
    sections: list[Section] = []
    hunk: Hunk | None = None
    for line in diff.split("\n"):
        if head := _SECTION.match(line):
            sections.append(Section(head[2]))
            hunk = None
        elif not sections:
            continue
        elif line.startswith("new file mode"):
            sections[-1].fresh = True
        elif mark := _HUNK.match(line):
            hunk = Hunk(int(mark[1]))
            sections[-1].hunks.append(hunk)
        elif hunk is not None and line[:1] in (" ", "-", "+"):
            body = line[1:].rstrip()
            if line[0] != "+":
                hunk.old.append(body)
            if line[0] != "-":
                hunk.new.append(body)
            if line[0] == "+":
                hunk.added.append(body)
            hunk.context += line[0] == " "
    return sections


def plain_lines(text: str) -> list[str]:
    """Right-stripped lines without blank lines at either end."""
    rows = [x.rstrip() for x in text.split("\n")]
    full = [i for i, x in enumerate(rows) if x]
    return rows[full[0] : full[-1] + 1] if full else []


def apply(base: list[str], hunks: list[Hunk]) -> tuple[list[str] | None, str]:
    """Each hunk exactly where it says, shifted by what went before; no search for another place."""
    out, shift = list(base), 0
    for h in hunks:
        at = h.start - 1 + shift
        if not 0 <= at < len(out):
            return None, f"out of range at {h.start}"
        if out[at : at + len(h.old)] != h.old:
            return None, f"context differs at {h.start}"
        out[at : at + len(h.old)] = h.new
        shift += len(h.new) - len(h.old)
    return out, ""


def consistency(before: str, after: str, diff: str, primary: str) -> tuple[bool, str]:
    """Whether the diff's sections for the primary file turn one text into the other."""
    sections = parse(diff)
    chosen = [s for s in sections if s.path == primary] or [s for s in sections if s.path.endswith("/" + primary) or primary.endswith("/" + s.path)]
    if not chosen:
        return False, "primary file not in diff"
    old, new = plain_lines(before), plain_lines(after)
    if not old and all(s.fresh for s in chosen):
        ok = [x for s in chosen for h in s.hunks for x in h.added] == new
        return ok, "new file" if ok else "new file differs"
    for s in chosen:
        result, why = apply(old, s.hunks)
        if result is None:
            return False, why
        old = result
    return (True, "consistent") if old == new else (False, "result differs")


EXAMINED = T.StructType([T.StructField("ok", T.BooleanType()), T.StructField("reason", T.StringType()), T.StructField("paths", T.ArrayType(T.StringType())), T.StructField("min_context", T.IntegerType())])


@F.pandas_udf(EXAMINED)
def examined(before: pd.Series, after: pd.Series, diff: pd.Series, primary: pd.Series) -> pd.DataFrame:
    """The proof, the diff's paths and its smallest hunk context; ok is NULL where a part is missing."""
    rows = []
    for b, a, d, p in zip(before, after, diff, primary, strict=True):
        sections = parse(d) if d else []
        contexts = [h.context for s in sections for h in s.hunks]
        ok, why = consistency(b, a, d, p) if b and a and d and p else (None, None)
        rows.append((ok, why, [s.path for s in sections], min(contexts) if contexts else None))
    out = pd.DataFrame(rows, columns=["ok", "reason", "paths", "min_context"])
    return out.astype({"ok": "object", "min_context": "Int32"})


def suffix(path: Column) -> Column:
    """The lower-cased extension with its dot, of the last path part; leading dots are part of the name."""
    name = F.regexp_replace(F.substring_index(path, "/", -1), r"^\.+", "")
    return F.when(F.contains(name, F.lit(".")), F.lower(F.concat(F.lit("."), F.substring_index(name, ".", -1)))).otherwise("")


def normal_sha(diff: Column) -> Column:
    """SHA-256 of the diff's stripped lines without mail, index and header lines."""
    header = lambda x: x.rlike(P.MAIL_FROM) | x.rlike(P.MAIL_HEAD) | x.rlike(P.INDEX_LINE) | x.rlike(r"^diff --git a/(.+?) b/(.+?)$")
    return F.sha2(F.array_join(F.transform(F.filter(lines(diff), lambda x: ~header(x)), strip), ""), 256)


def changed_lines(diff: Column) -> Column:
    return F.filter(lines(diff), lambda x: x.rlike(r"^[+-]") & ~x.rlike(r"^(\+\+\+|---)"))


def trivial(diff: Column, paths: Column) -> Column:
    """Why a diff changes nothing of substance, or NULL: no changed lines, documents only, comments and blanks only."""
    changed = F.transform(changed_lines(diff), lambda x: strip(F.substr(x, F.lit(2))))
    documents = (F.size(paths) > 0) & F.forall(paths, lambda p: suffix(p).isin(*P.DOC_SUFFIXES))
    comments = F.forall(changed, lambda x: (x == "") | starts_any(x, P.COMMENT_STARTS))
    return F.when((F.size(changed) == 0) & (F.size(paths) == 0), None).when(F.size(changed) == 0, "no changed lines").when(documents, "documents only").when(comments, "comments only")


def no_logic(diff: Column) -> Column:
    """Both sides are equal without comments, or all changes look like versions."""
    bare = lambda sign: F.array_sort(F.transform(F.filter(changed_lines(diff), lambda x: F.startswith(x, F.lit(sign))), lambda x: strip(F.regexp_replace(F.substr(x, F.lit(2)), r"\s*(?:#|//).*$", ""))))
    adds, dels = bare("+"), bare("-")
    versionish = lambda t: (t == "") | t.rlike(r'(?i)^"?\d+\.\d+(\.\d+)?[a-z0-9.\-+]*"?,?$') | t.rlike(r"(?i)^(?:version|__version__|versionCode|versionName)\s*[:=].*$") | t.rlike(r"(?i)^(?:bump|chore|pin)\s*.*$")
    same = (adds == dels) & (F.size(adds) > 0)
    return same | ((F.size(adds) > 0) & F.forall(adds, versionish) & F.forall(dels, versionish))


def mail_header(diff: Column) -> Column:
    """A mail header within the first eight lines, before any diff header."""
    head = F.slice(lines(diff), 1, 8)
    first = lambda *rx: F.array_position(F.transform(head, lambda x: F.exists(F.array(*map(F.lit, rx)), lambda r: F.regexp_like(x, r))), F.lit(True))
    mail, git = first(P.MAIL_FROM, P.MAIL_HEAD), first(P.DIFF_GIT)
    return (mail > 0) & ((git == 0) | (mail < git))
