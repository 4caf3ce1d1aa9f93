"""Column functions over text: normal forms, n-grams, matches with offsets, fences, masks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sievework.functions import patterns as P

# Fixed value: the placeholder-bearing Markdown image form that the dedup normaliser replaces.
DATA_IMAGE = r"!\[[^\]]*\]\(data:image/[a-z]+;base64,[^)]*\)"
# Python's \s over str: Unicode white space plus the four ASCII separators.
SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
NO_STRINGS = "array<string>"


def strip(text: Column) -> Column:
    """Without white space at the ends, in Python's sense of white space."""
    return F.trim(text, F.lit(SPACES))


def right_strip(text: Column) -> Column:
    return F.rtrim(text, F.lit(SPACES))


def replaced(text: Column, hint: str, pattern: str, by: str) -> Column:
    """regexp_replace for patterns that match nothing in a text without the hint, which is looked for first."""
    return F.when(F.contains(text, F.lit(hint)), F.regexp_replace(text, pattern, by)).otherwise(text)


def all_matches(text: Column, hint: str, pattern: str) -> Column:
    """Whole matches of a pattern that needs the hint in the text."""
    return F.when(F.contains(text, F.lit(hint)), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(F.array().cast(NO_STRINGS))


def match_count(text: Column, hint: str, pattern: str) -> Column:
    return F.when(F.contains(text, F.lit(hint)), F.regexp_count(text, F.lit(pattern))).otherwise(0)


def dedup_lower(text: Column) -> Column:
    """Lower-cased text; embedded images become one placeholder. NULL stays NULL."""
    return F.lower(replaced(text, "data:image", DATA_IMAGE, "[img]"))


def dedup_normal(text: Column) -> Column:
    """dedup_lower without white space."""
    return F.translate(dedup_lower(text), SPACES, "")


def gram_normal(text: Column) -> Column:
    """Lower-cased text without white space, as the near-duplicate gates compare it."""
    return F.translate(F.lower(text), SPACES, "")


def char_ngrams(text: Column, n: int, keep_short: bool) -> Column:
    """Distinct character n-grams; a text shorter than n is its own only gram when keep_short, else it has none."""
    grams = F.transform(F.sequence(F.lit(1), F.greatest(F.length(text) - n + 1, F.lit(1))), lambda i: F.substring(text, i, F.lit(n)))
    none = F.array().cast(NO_STRINGS)
    short = F.when(F.length(text) > 0, F.array(text)).otherwise(none) if keep_short else none
    return F.when(F.length(text) >= n, F.array_distinct(grams)).otherwise(short)


def jaccard(a: Column, b: Column) -> Column:
    """Of two distinct arrays; 0 if either is empty."""
    shared = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) > 0) & (F.size(b) > 0), shared / (F.size(a) + F.size(b) - shared)).otherwise(F.lit(0.0))


def matches(text: Column, pattern: str, window: int = 60) -> Column:
    """array<struct<value,start,pre,post>> of all matches: 0-based offset in code points, and the text around it.

    Offsets follow from the lengths of what lies between the matches, so no Python is needed.
    """
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    lengths = F.zip_with(F.slice(gaps, F.lit(1), F.size(values)), values, lambda g, v: F.struct(F.length(g).alias("g"), F.length(v).alias("v"), v.alias("value")))
    step = lambda acc, x: F.struct(
        (acc["at"] + x["g"] + x["v"]).alias("at"),
        F.concat(acc["found"], F.array(F.struct(x["value"].alias("value"), (acc["at"] + x["g"]).alias("start")))).alias("found"),
    )
    empty = F.array().cast("array<struct<value:string,start:int>>")
    found = F.aggregate(lengths, F.struct(F.lit(0).alias("at"), empty.alias("found")), step)["found"]
    located = F.transform(
        found,
        lambda m: F.struct(
            m["value"].alias("value"),
            m["start"].alias("start"),
            F.substring(text, F.greatest(m["start"] - window, F.lit(0)) + 1, F.least(m["start"], F.lit(window))).alias("pre"),
            F.substring(text, m["start"] + F.length(m["value"]) + 1, F.lit(window)).alias("post"),
        ),
    )
    return F.when(F.size(values) > 0, located).otherwise(F.array().cast("array<struct<value:string,start:int,pre:string,post:string>>"))


def contained(text: Column, words: tuple[str, ...]) -> Column:
    """Those of words that text contains, in their order."""
    return F.filter(F.array(*map(F.lit, words)), lambda w: F.contains(text, w))


def contains_any(text: Column, words: tuple[str, ...]) -> Column:
    return F.exists(F.array(*map(F.lit, words)), lambda w: F.contains(text, w))


def starts_any(text: Column, words: tuple[str, ...]) -> Column:
    return F.exists(F.array(*map(F.lit, words)), lambda w: F.startswith(text, w))


def lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def fence_state(text: Column) -> Column:
    """struct<open,line,n,fences,kept>: the Markdown fence state at the end, and the lines outside fences.

    A fence opens with three or more backticks and closes with at least as many and nothing after them.
    """
    start = F.struct(F.lit(0).alias("open"), F.lit(0).alias("line"), F.lit(0).alias("n"), F.lit(0).alias("fences"), F.array().cast(NO_STRINGS).alias("kept"))

    def step(s: Column, x: Column) -> Column:
        ticks = F.length(F.regexp_extract(x, P.FENCE, 1))
        info = F.trim(F.regexp_extract(x, P.FENCE, 2))
        opens, closes = (ticks > 0) & (s["open"] == 0), (ticks > 0) & (s["open"] > 0) & (ticks >= s["open"]) & (info == "")
        n = s["n"] + 1
        return F.struct(
            F.when(opens, ticks).when(closes, 0).otherwise(s["open"]).alias("open"),
            F.when(opens, n).when(closes, 0).otherwise(s["line"]).alias("line"),
            n.alias("n"),
            (s["fences"] + (ticks > 0).cast("int")).alias("fences"),
            F.when((ticks == 0) & (s["open"] == 0), F.concat(s["kept"], F.array(x))).otherwise(s["kept"]).alias("kept"),
        )

    # Most texts have no fence: their lines all stay, and none is walked through.
    plain = F.struct(F.lit(0).alias("open"), F.lit(0).alias("line"), F.size(lines(text)).alias("n"), F.lit(0).alias("fences"), lines(text).alias("kept"))
    return F.when(F.contains(text, F.lit("```")), F.aggregate(lines(text), start, step)).otherwise(plain)


def outside_fences(text: Column) -> Column:
    return F.array_join(fence_state(text)["kept"], "\n")


def prose_segments(text: Column) -> Column:
    """The parts between paired triple-backtick blocks."""
    return F.split(F.coalesce(text, F.lit("")), P.FENCED, -1)


def without_links(text: Column) -> Column:
    """Inline code and addresses become spaces."""
    for pattern in (r"`[^`\n]+`", P.SCHEME_URL, P.BARE_URL):
        text = F.regexp_replace(text, pattern, " ")
    return text


def escape_html(text: Column) -> Column:
    for plain, mark in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        text = F.replace(text, F.lit(plain), F.lit(mark))
    return text


def estimated_tokens(text: Column) -> Column:
    """One for each Chinese character and a quarter for each other, rounded down."""
    chinese = F.regexp_count(text, F.lit(P.CHINESE))
    return F.floor(chinese + (F.length(text) - chinese) / 4).cast("long")


def context(text: Column, start: Column, length: Column, window: int = 60) -> Column:
    """The match with so many characters around it, line ends shown, cut sides marked."""
    pre = F.replace(F.substring(text, F.greatest(start - window, F.lit(0)) + 1, F.least(start, F.lit(window))), F.lit("\n"), F.lit("⏎"))
    post = F.replace(F.substring(text, start + length + 1, F.lit(window)), F.lit("\n"), F.lit("⏎"))
    left = F.when(F.length(pre) < window, pre).otherwise(F.concat(F.lit("…"), pre))
    right = F.when(F.length(post) < window, post).otherwise(F.concat(post, F.lit("…")))
    return F.trim(F.concat(left, F.substring(text, start + 1, length), right))
