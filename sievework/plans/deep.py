"""Deep rules over dialogues: missing code, templates, label against code, token recount, cut answers, flat powers, AI authors.

The class of a data set decides which rules apply: in "code" sets an answer must hold code; in "forum" sets prose is a fair
answer, so only templates, authors, token counts and shared times are looked at. The rule on shared times is
``qa.time_concentration``. All are column expressions but the recount, which needs a tokenizer.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.functions import patterns as P
from sievework.functions.text import context, lines, strip
from sievework.operators import findings as O
from sievework.operators.sampling import bernoulli
from sievework.plans import qa
from sievework.sources.records import text_at, type_at

CLASSES = ("forum", "code")


def without_comments(text: Column) -> Column:
    """Without /* */ blocks, and without lines that begin as a line comment or a doc attribute."""
    kept = F.filter(lines(F.regexp_replace(text, P.BLOCK_COMMENT, "")), lambda x: ~x.rlike(P.COMMENT_LINE))
    return F.array_join(kept, "\n")


def _named(names: dict[str, str], value: Column) -> Column:
    return F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in names.items() for x in kv]), value), value)


def language_name(value: Column) -> Column:
    return _named(P.LANG_NAMES, F.lower(strip(F.coalesce(value, F.lit("")))))


def fence_languages(text: Column) -> Column:
    """The tags of fenced blocks as language names, in order; tags that aren't names, and plain-text tags, are left out."""
    heads = F.transform(F.regexp_extract_all(text, F.lit(P.FENCE_BLOCK), F.lit(1)), lambda h: F.regexp_extract(strip(h), r"^[^\s]+", 0))
    return F.filter(F.transform(F.filter(heads, lambda h: h.rlike(r"^[A-Za-z0-9+#.-]+$")), lambda h: language_name(_named(P.TAG_NAMES, F.lower(h)))), lambda x: x != "")


def bare_language(text: Column) -> Column:
    """The language of code outside fences by its marks, NULL if none is certain."""
    out = F.when(F.lit(False), F.lit(""))
    for name, rx in P.BARE_CODE:
        out = out.when(text.rlike(rx), name)
    return out


def differs(label: Column, found: Column) -> Column:
    """Whether no language found is the label's or of its family."""
    return ~F.exists(found, lambda x: _named(P.LANG_FAMILIES, x) == _named(P.LANG_FAMILIES, label))


def _excerpt(text: Column, pattern: str) -> Column:
    """The first match with forty characters on each side."""
    hit = F.regexp_extract(text, pattern, 0)
    return context(text, F.instr(text, hit) - 1, F.length(hit), 40)


def check(records: DataFrame, dataset_class: str = "forum", level: str = "WARN") -> DataFrame:
    """records with findings of the deep rules; level ERROR makes them count for the exit status."""
    if dataset_class not in CLASSES:
        raise ValueError(f"dataset_class: one of {CLASSES}")
    code_set = F.lit(dataset_class == "code")
    said = lambda k: F.array_join(F.transform("said", lambda t: F.concat(t[k], F.lit("\n"))), "")
    d = qa.derived(records).withColumn("q", said("question")).withColumn("a", said("answer"))
    d = d.withColumn("qc", without_comments(F.col("q"))).withColumn("ac", without_comments(F.col("a")))
    d = d.withColumn("tags", fence_languages(F.col("ac"))).withColumn("bare", bare_language(F.col("ac")))
    a, q, ac, bare, tags = (F.col(x) for x in ("a", "q", "ac", "bare", "tags"))
    declared = F.coalesce(text_at("$.metadata.primary_language"), F.lit(""))
    label = language_name(declared)
    flagged = (type_at("$.metadata.has_code") == "BOOLEAN") & F.coalesce(F.try_variant_get("v", "$.metadata.has_code", "boolean"), F.lit(False))
    looks = ac.rlike(P.CODE_MARKS) | ac.rlike(P.STRONG_CODE) | flagged
    fenced = ac.rlike(P.FENCE_BLOCK) | F.col("qc").rlike(P.FENCE_BLOCK)
    template = F.coalesce(*[F.when(F.contains(a, F.lit(phrase)), F.lit(name)) for name, phrase in P.TEMPLATE_PHRASES], F.when(strip(a).rlike(P.TITLE_ONLY_ANSWER), F.lit("title_only")))
    bare_name = language_name(bare)
    telling = F.filter(tags, lambda x: ~x.isin(*P.SILENT_TAGS))
    wrong = (
        F.when(F.lower(declared).isin(*P.NO_PROGRAM_LANGS), F.concat(declared, F.lit(" is no programming language")))
        .when(label.isin(*P.UNKNOWN_LANGS), F.lit(None).cast("string"))
        .when(F.size(tags) > 0, F.when((F.size(telling) > 0) & differs(label, telling), F.concat(declared, F.lit(" but code is "), F.array_join(F.array_sort(F.array_distinct(telling)), ","))))
        .when(bare.isNotNull(), F.when(label.isin(*P.BARE_LANGS) & differs(label, F.array(bare_name)), F.concat(declared, F.lit(" but bare code is "), bare_name)))
        .when(~looks & ~ac.rlike(P.CODE_WORDS), F.concat(declared, F.lit(" but no code")))
    )
    author = F.coalesce(*[F.when(text_at(f"$.metadata.{k}").rlike(P.AI_AUTHOR), F.concat(F.lit(k + ": "), _excerpt(text_at(f"$.metadata.{k}"), P.AI_AUTHOR))) for k in P.AUTHOR_KEYS])
    rules = O.collect(
        O.rule(level, "deep_no_code", code_set & ~fenced & bare.isNull() & ~looks & (F.length(strip(ac)) > 40), F.left(ac, F.lit(60))),
        O.rule(level, "deep_template", template.isNotNull(), template),
        O.rule(level, "deep_language", code_set & wrong.isNotNull(), wrong),
        O.rule(level, "deep_cut_answer", code_set & (F.regexp_count(ac, F.lit(P.FENCE_LINE)) % 2 == 1), F.right(ac, F.lit(60))),
        O.rule(level, "deep_flat_power", code_set & q.rlike(P.FLAT_POWER), _excerpt(q, P.FLAT_POWER)),
        O.rule(level, "deep_ai_author", author.isNotNull(), author),
    )
    return d.withColumn("findings", rules)


def encoding_counter(path: str, pattern: str = r"'(?i:[sdmt]|ll|ve|re)|[^\r\n\p{L}\p{N}]?+\p{L}+|\p{N}{1,3}| ?[^\s\p{L}\p{N}]++[\r\n]*|\s*[\r\n]|\s+(?!\S)|\s+") -> Callable[[], Callable[[str], int]]:
    """A factory of token counters over a file of ranked byte merges; the file must lie on every executor."""

    def make() -> Callable[[str], int]:
        import tiktoken
        from tiktoken.load import load_tiktoken_bpe

        ranks = load_tiktoken_bpe(path)
        encoding = tiktoken.Encoding("recount", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        return lambda text: len(encoding.encode_ordinary(text))

    return make


def token_recount(records: DataFrame, make_counter: Callable[[], Callable[[str], int]], share: float = 0.05, seed: int = 20260918, declared: str = "o200k") -> DataFrame:
    """(file, pos, rid, question_tokens, answer_tokens, question_recount, answer_recount) of sampled records whose counts differ.

    Sampled are records that declare the tokenizer; each enters by itself with the probability share. A missing count differs.
    """
    whole = lambda k: strip(F.array_join(F.transform("said", lambda t: F.concat(t[k], F.lit("\n"))), ""))
    stored = lambda k: F.try_variant_get("v", f"$.metadata.{k}", "double")
    claims = qa.derived(records).filter(F.contains(F.coalesce(text_at("$.metadata.tokenizer"), F.lit("")), F.lit(declared)))
    rows = bernoulli(claims, share, seed, "rid").select("file", "pos", "rid", stored("question_tokens").alias("question_tokens"), stored("answer_tokens").alias("answer_tokens"), whole("question").alias("q"), whole("answer").alias("a"))

    @F.pandas_udf("long")
    def counted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        count = make_counter()
        for texts in batches:
            yield texts.map(lambda t: count(t or ""))

    again = rows.withColumn("question_recount", counted("q")).withColumn("answer_recount", counted("a")).drop("q", "a")
    return again.filter(~F.col("question_tokens").eqNullSafe(F.col("question_recount").cast("double")) | ~F.col("answer_tokens").eqNullSafe(F.col("answer_recount").cast("double")))


def recount_findings(records: DataFrame, make_counter: Callable[[], Callable[[str], int]], share: float = 0.05, seed: int = 20260918, declared: str = "o200k") -> DataFrame:
    """token_recount as findings (file, pos, rid, level, item, detail)."""
    off = token_recount(records, make_counter, share, seed, declared)
    shown = lambda k: F.concat(F.coalesce(F.col(f"{k}_tokens").cast("long").cast("string"), F.lit("none")), F.lit(" for "), F.col(f"{k}_recount").cast("string"))
    return off.select("file", "pos", "rid", F.lit("WARN").alias("level"), F.lit("token_recount").alias("item"), F.concat(F.lit("question "), shown("question"), F.lit(", answer "), shown("answer")).alias("detail"))
