"""Quality rules by distribution divergence, with DataFrame functions only.

Every document has two histograms: its characters by CLASSES, and its words by the common words of its language, all other
words being one bin. A language's references are the sums of the same histograms over all documents of that `lang`. A
document fails where the Jensen-Shannon distance (root of the divergence to base 2, 0 to 1) of a histogram to its reference
exceeds a limit. Short histograms differ by chance: a document of fewer than `least_chars` characters or `least_words` words
isn't compared, nor is any with a language of fewer than `language_words` words in all. From the words' divergence of a document of
n words its expectation by chance, (bins - 1) / (8 n ln 2), is taken off before the root.

A common word occurs at least once in 1/COMMON_SHARE words of its language and is among its `common` most frequent (ties by the
smaller word), so the candidates are at most 1/COMMON_SHARE a language before any are ranked. Words of the histogram are
lower-cased runs of characters other than blanks and PUNCTUATION.

Base rules are counted beside that: words, characters in words, symbols, lines equal to an earlier line, and words in five-word
windows that the text holds twice or more. Windows are told apart by a 64-bit hash, in texts where one repeats by 128 bits.

Defined results: a NULL text is empty and fails the base rules. A NULL `lang` is a language of its own. Rows are judged one by
one, so repeated rows, NULL and repeated ids make as many result rows. A text's words are arrays within its row, whatever its
length, and nothing is gathered across rows but counts, which add up before they are shuffled: a source, language or copied text of
any size is no hot key. Other columns are kept by `measured` and not read by `report`. Empty tables give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievework.llm.common import columns_of, free_name, sized, written

#: White space, symbols and marks of the rules, and the classes of characters; fixed values.
BLANK = "[\\x20\\x09-\\x0D]"
BLANK_CHARS = " \t\n\x0b\f\r"
SYMBOLS = "[#*$%&|<>]"
PUNCTUATION = ".,;:!?'\"()-"
CLASSES = ("[a-z]", "[A-Z]", "[0-9]", BLANK, "[.,;:!?'\"()-]", SYMBOLS, "[\\u0080-\\u024F]")
WINDOW = 5
COMMON, COMMON_SHARE = 24, 0.001
LEAST_CHARS, LEAST_WORDS, LANGUAGE_WORDS = 200, 50, 10_000
CLASS_LIMIT, WORD_LIMIT = 0.3, 0.3


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is worked out once, however often body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, BLANK + "+"), lambda w: w != "")


def spaced_words(words: Column) -> Column:
    """The lower-cased words, parted by two spaces at each blank and PUNCTUATION, with two at both ends."""
    gap = F.lit("  ")
    return F.concat(gap, F.regexp_replace(F.lower(F.array_join(words, "  ")), f"[{PUNCTUATION}]+", "  "), gap)


def class_counts(text: Column) -> Column:
    """Characters by CLASSES, which don't overlap, and all others as the last."""

    def counted(rest: Column, left: tuple[str, ...], done: list[Column]) -> Column:
        if not left:
            return F.array(*done, F.length(rest).cast("long"))
        less = F.regexp_replace(rest, left[0] + "+", "")
        return let(less, lambda x: counted(x, left[1:], [*done, (F.length(rest) - F.length(x)).cast("long")]))

    return counted(text, CLASSES, [])


def repeated_words(words: Column) -> Column:
    """Words that lie in a window of five found twice or more."""

    def window(of: Column, i: Column, *first: Column) -> Column:
        return F.xxhash64(*first, *[F.get(of, i + k) for k in range(WINDOW)])

    def hashes(one: Column) -> Column:
        """Of every window, from hashes of its words."""
        return F.transform(F.slice(one, 1, F.size(one) - (WINDOW - 1)), lambda _, i: window(one, i))

    def covered(starts: Column) -> Column:
        steps = F.zip_with(starts, F.slice(starts, 2, F.size(starts)), lambda a, b: F.least(F.lit(WINDOW), b - a))
        return F.aggregate(steps, F.lit(0), lambda x, y: x + y)

    def beside(of: Column, *names: str) -> Callable[[Column, Column], Column]:
        """Whether one of a sorted array is like the one before or after it."""

        def same(s: Column, at: Column) -> Column:
            other = F.get(of, at)
            return F.coalesce(reduce(and_, [s[x] == other[x] for x in names]), F.lit(False))

        return lambda s, j: same(s, j - 1) | same(s, j + 1)

    def wide(likely: Column) -> Column:
        return F.sort_array(F.transform(likely, lambda s: F.struct(s["h"].alias("h"), window(words, s["i"], F.lit(WINDOW)).alias("g"), s["i"].alias("i"))))

    def starts(plain: Column) -> Column:
        """Where windows begin that are found twice: those of equal 64 bits are looked at by 64 more."""
        placed = F.sort_array(F.transform(plain, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        likely = let(placed, lambda p: F.filter(p, beside(p, "h")))
        return let(likely, lambda x: let(wide(x), lambda w: F.sort_array(F.transform(F.filter(w, beside(w, "h", "g")), lambda s: s["i"]))))

    def counted(plain: Column) -> Column:
        twice = F.size(F.array_distinct(plain)) < F.size(plain)
        return F.when(twice, let(starts(plain), covered)).otherwise(F.lit(0))

    one = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(F.size(words) > WINDOW, let(let(one, hashes), counted)).otherwise(F.lit(0))


def repeated_lines(text: Column) -> Column:
    return let(F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(BLANK_CHARS)) != ""), lambda a: F.size(a) - F.size(F.array_distinct(a)))


def shares(counts: Column) -> Column:
    return let(F.aggregate(counts, F.lit(0).cast("long"), lambda x, y: x + y), lambda n: F.transform(counts, lambda c: c / n))


def divergence(p: Column, q: Column) -> Column:
    """Jensen-Shannon divergence to base 2 of two arrays of shares."""

    def part(a: Column, b: Column) -> Column:
        return F.when(a > 0, a * F.log2(2 * a / (a + b))).otherwise(0.0)

    return F.aggregate(F.zip_with(p, q, lambda a, b: part(a, b) + part(b, a)), F.lit(0.0), lambda x, y: x + y) / 2


def distance(amount: Column) -> Column:
    return F.round(F.sqrt(F.greatest(amount, F.lit(0.0))), 6)


def references(docs: DataFrame, common: int = COMMON, language_words: int = LANGUAGE_WORDS) -> DataFrame:
    """(lang, common, words, classes) of every language with enough words: its common words, their counts and that of all others, and its characters.

    Words are counted as they are written, before they are shuffled; the counts of lower-cased words and of characters follow from those,
    so the texts are split once. Both counts are written, since they are read twice.
    """
    text = F.coalesce("text", F.lit(""))
    keyed = docs.select(F.coalesce("lang", F.lit("")).alias("lang"), F.col("lang").isNull().alias("none"), text.alias("text"))
    words = keyed.select("lang", "none", F.explode(F.split("text", BLANK + "+")).alias("word")).filter("word <> ''")
    written_as = written(words.groupBy("lang", "none", "word").agg(F.count("*").alias("n")))
    plain = F.split(F.regexp_replace(F.lower("word"), f"[{PUNCTUATION}]+", " "), " +")
    counts = written(written_as.select("lang", "none", "n", F.explode(plain).alias("key")).filter("key <> ''").groupBy("lang", "none", "key").agg(F.sum("n").alias("n")))
    totals = counts.groupBy("lang", "none").agg(F.sum("n").alias("all")).filter(F.col("all") >= language_words)
    often = counts.join(sized(totals), ["lang", "none"]).filter(F.col("n") >= F.col("all") * COMMON_SHARE)
    rank = F.row_number().over(Window.partitionBy("lang", "none").orderBy(F.desc("n"), "key"))
    top = often.withColumn("rank", rank).filter(F.col("rank") <= common).groupBy("lang", "none", "all").agg(F.sort_array(F.collect_list(F.struct("rank", "key", "n"))).alias("top"))
    chars = keyed.groupBy("lang", "none").agg(F.sum(F.length("text")).alias("chars"))
    signs = written_as.select("lang", "none", "n", class_counts(F.col("word")).alias("c"))
    inside = signs.groupBy("lang", "none").agg(F.array(*[F.sum(F.get("c", F.lit(i)) * F.col("n")) for i in range(len(CLASSES) + 1)]).alias("c"))
    # Words hold all characters but blanks.
    blanks = F.col("chars") - F.aggregate("c", F.lit(0).cast("long"), lambda x, y: x + y)
    classes = inside.join(chars, ["lang", "none"]).select("lang", "none", F.transform("c", lambda n, i: F.when(i == CLASSES.index(BLANK), blanks).otherwise(n)).alias("classes"))
    rest = F.col("all") - F.aggregate("top.n", F.lit(0).cast("long"), lambda x, y: x + y)
    return top.join(classes, ["lang", "none"]).select(
        F.when(~F.col("none"), F.col("lang")).alias("lang"), F.col("top.key").alias("common"), F.concat("top.n", F.array(rest)).alias("words"), "classes"
    )


def measured(
    docs: DataFrame, refs: DataFrame, least_chars: int = LEAST_CHARS, least_words: int = LEAST_WORDS, class_limit: float = CLASS_LIMIT, word_limit: float = WORD_LIMIT
) -> tuple[DataFrame, str]:
    """docs with one more column, a struct of the measures and verdicts, and that column's name.

    References are broadcast while they are few; beyond that they are joined by shuffle.
    """
    name, lang = free_name(docs, "measures"), free_name(docs, "reference")
    own = refs.select(F.col("lang").alias(f"{lang}_lang"), F.struct(F.transform("common", lambda w: F.concat(F.lit(" "), w, F.lit(" "))).alias("spaced"), (F.array_max(F.transform("common", F.length)) + 1).cast("string").alias("longer"), "words", "classes").alias(lang))
    rows = docs.join(sized(own), docs["lang"].eqNullSafe(own[f"{lang}_lang"]), "left")
    text, ref = F.coalesce(docs["text"], F.lit("")), F.col(lang)

    def common_counts(said: Column) -> Column:
        """Of each common word and of all others. Words longer than any common one become a mark that no word can be, and go first; each
        common word is then taken out in turn, which leaves two spaces between those beside it. The bytes that went tell how often it stood there."""
        size = F.octet_length

        def less(acc: Column, word: Column) -> Column:
            n = lambda rest: F.concat(acc["n"], F.array(((size(acc["rest"]) - size(rest)) / size(word)).cast("long")))
            return let(F.replace(acc["rest"], word, F.lit("")), lambda rest: F.struct(rest.alias("rest"), n(rest).alias("n")))

        mark = F.concat(F.lit("  "), F.lit(PUNCTUATION[0]))
        short = F.regexp_replace(said, F.concat(F.lit("[^ ]{"), ref["longer"], F.lit(",}")), F.lit(PUNCTUATION[0]))

        def counted(marked: Column, rest: Column) -> Column:
            begin = F.struct(rest.alias("rest"), F.array().cast("array<long>").alias("n"))
            others = lambda left: F.regexp_count(left, F.lit("[^ ]+")) + (size(marked) - size(rest)) / size(mark)
            return F.aggregate(ref["spaced"], begin, less, lambda acc: F.concat(acc["n"], F.array(others(acc["rest"]).cast("long"))))

        return let(short, lambda marked: let(F.replace(marked, mark, F.lit("")), lambda rest: counted(marked, rest)))

    def word_distance(said: Column) -> Column:
        counts, bins = common_counts(said), F.size(ref["words"])
        n = lambda c: F.aggregate(c, F.lit(0).cast("long"), lambda x, y: x + y)
        chance = lambda c: (bins - 1) / (n(c) * (8 * math.log(2)))
        return let(counts, lambda c: F.when(n(c) >= least_words, distance(divergence(shares(c), shares(ref["words"])) - chance(c))))

    def of_words(words: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"), repeated_words(words).cast("long").alias("n_repeat_words"), let(F.array_join(words, ""), of_joined).alias("c"),
            F.when(ref.isNotNull(), let(spaced_words(words), word_distance)).alias("word_distance"),
        )

    def of_joined(joined: Column) -> Column:
        """The words without blanks hold long runs of a class, and all characters but blanks."""
        blanks = (F.length(text) - F.length(joined)).cast("long")
        return let(F.transform(class_counts(joined), lambda n, i: F.when(i == CLASSES.index(BLANK), blanks).otherwise(n)), lambda counts: of_signs(counts, joined))

    def of_signs(counts: Column, joined: Column) -> Column:
        far = F.when((F.length(text) >= least_chars) & ref.isNotNull(), distance(divergence(shares(counts), shares(ref["classes"]))))
        return F.struct(F.length(joined).cast("long").alias("word_chars"), F.get(counts, F.lit(CLASSES.index(SYMBOLS))).alias("n_symbols"), far.alias("class_distance"))

    whole = let(
        F.struct(let(words_of(text), of_words).alias("w"), repeated_lines(text).cast("long").alias("n_dup_lines")),
        lambda s: let(
            (s["w"]["n_words"] < 10) | (100 * s["w"]["n_repeat_words"] > 20 * s["w"]["n_words"]),
            lambda failed: F.struct(
                s["w"]["n_words"].alias("n_words"), s["w"]["c"]["word_chars"].alias("word_chars"), s["w"]["c"]["n_symbols"].alias("n_symbols"), s["n_dup_lines"].alias("n_dup_lines"),
                s["w"]["n_repeat_words"].alias("n_repeat_words"), failed.alias("base_failed"),
                (~failed & (F.coalesce(s["w"]["c"]["class_distance"], F.lit(0.0)) <= class_limit) & (F.coalesce(s["w"]["word_distance"], F.lit(0.0)) <= word_limit)).alias("kept"),
                s["w"]["c"]["class_distance"].alias("class_distance"), s["w"]["word_distance"].alias("word_distance"),
            ),
        ),
    )
    return rows.select(*columns_of(docs), whole.alias(name)), name


def report(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, class_distance, word_distance), a row a document."""
    plain = docs.select("doc_id", "text", "lang")
    rows, name = measured(plain, references(plain))
    return rows.select("doc_id", f"{name}.*")


_CLASS = ", ".join(f"length(text) - length(regexp_replace(text, '{c.replace(chr(39), chr(39) * 2).replace(chr(92) + 'u0080-' + chr(92) + 'u024F', chr(92) + 'x{80}-' + chr(92) + 'x{24F}')}', '', 'g'))" for c in CLASSES)
_JSD = "(SELECT sum(CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) / 2 FROM (SELECT unnest({0}) / list_sum({0}) AS p, unnest({1}) / list_sum({1}) AS q))"
ORACLE = rf"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, lang, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
c AS MATERIALIZED (SELECT r, list_concat(a, [length(text) - list_sum(a)]) AS a FROM (SELECT r, text, [{_CLASS}] AS a FROM d)),
w AS MATERIALIZED (SELECT r, lang, unnest(regexp_extract_all(lower(text), '[^\x20\x09-\x0D{PUNCTUATION.replace(chr(39), chr(39) * 2)}]+')) AS p FROM d),
v AS (SELECT r, count(*) AS said FROM w GROUP BY r),
t AS (SELECT lang, count(*) AS total FROM w GROUP BY lang HAVING count(*) >= {LANGUAGE_WORDS}),
k AS (SELECT w.lang, p, total, count(*) AS n, row_number() OVER (PARTITION BY w.lang ORDER BY count(*) DESC, p) AS rank FROM w JOIN t ON t.lang IS NOT DISTINCT FROM w.lang GROUP BY w.lang, p, total
  HAVING count(*) >= total * {COMMON_SHARE} QUALIFY rank <= {COMMON}),
f AS (SELECT lang, list(n ORDER BY rank) || [any_value(total) - sum(n)] AS words FROM k GROUP BY lang),
g AS (SELECT lang, [sum(a[1]), sum(a[2]), sum(a[3]), sum(a[4]), sum(a[5]), sum(a[6]), sum(a[7]), sum(a[8])] AS classes FROM d JOIN c USING (r) GROUP BY lang),
h AS (SELECT r, list(n ORDER BY rank) AS counts FROM (SELECT d.r, k.rank, count(w.p) AS n FROM d JOIN k ON d.lang IS NOT DISTINCT FROM k.lang LEFT JOIN w ON w.r = d.r AND w.p = k.p GROUP BY d.r, k.rank) GROUP BY r),
s AS (SELECT r, i, array_to_string(words[i:i + 4], ' ') AS win FROM (SELECT r, words, unnest(range(1, len(words) - 3)) AS i FROM d)),
x AS (SELECT r, count(DISTINCT j) AS n FROM (SELECT r, unnest(range(i, i + 5)) AS j FROM (SELECT r, i, count(*) OVER (PARTITION BY r, win) AS m FROM s) WHERE m > 1) GROUP BY r),
l AS (SELECT r, (count(*) - count(DISTINCT line))::BIGINT AS n FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
m AS (SELECT doc_id, len(d.words) AS n_words, length(array_to_string(d.words, '')) AS word_chars, length(text) - length(regexp_replace(text, '{SYMBOLS}', '', 'g')) AS n_symbols, coalesce(l.n, 0) AS n_dup_lines, coalesce(x.n, 0) AS n_repeat_words,
  len(d.words) < 10 OR 100 * coalesce(x.n, 0) > 20 * len(d.words) AS base_failed,
  CASE WHEN length(text) >= {LEAST_CHARS} AND classes IS NOT NULL AND f.words IS NOT NULL THEN round(sqrt(greatest({_JSD.format("c.a", "classes")}, 0)), 6) END AS class_distance,
  CASE WHEN said >= {LEAST_WORDS} AND f.words IS NOT NULL THEN
    round(sqrt(greatest({_JSD.format("list_concat(counts, [said - list_sum(counts)])", "f.words")} - (len(f.words) - 1) / (said * (8 * ln(2))), 0)), 6) END AS word_distance
  FROM d JOIN c USING (r) LEFT JOIN f ON f.lang IS NOT DISTINCT FROM d.lang LEFT JOIN g ON g.lang IS NOT DISTINCT FROM d.lang LEFT JOIN h USING (r) LEFT JOIN v USING (r) LEFT JOIN l USING (r) LEFT JOIN x USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND coalesce(class_distance, 0) <= {CLASS_LIMIT} AND coalesce(word_distance, 0) <= {WORD_LIMIT} AS kept, class_distance, word_distance FROM m
"""
