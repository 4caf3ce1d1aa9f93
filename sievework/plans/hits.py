"""Every hit of personal data in a text column as a row: kind, place, masked value, masked context and, where one excuses it, the reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.functions import contacts, pii
from sievework.functions import patterns as P
from sievework.functions.text import contains_any, matches
from sievework.sources.tables import spread, table

#: Characters of context on each side; a record with so many addresses is a list, none of which counts.
CONTEXT, LIST_OF_ADDRESSES = 60, 3


def masked_context(m: Column, masked: Column) -> Column:
    """The masked value with what stands around it on one line; cut sides are marked."""
    flat = lambda c: F.replace(c, F.lit("\n"), F.lit("⏎"))
    pre, post = flat(F.right(m["pre"], F.lit(CONTEXT))), flat(F.left(m["post"], F.lit(CONTEXT)))
    left = F.when(F.length(pre) < CONTEXT, pre).otherwise(F.concat(F.lit("…"), pre))
    right = F.when(F.length(post) < CONTEXT, post).otherwise(F.concat(post, F.lit("…")))
    return F.trim(F.concat(left, masked, right))


def _rows(kind: str, hits: Column, masked, why) -> Column:
    return F.transform(hits, lambda m: F.struct(F.lit(kind).alias("kind"), m["start"].alias("start"), masked(m).alias("masked"), masked_context(m, masked(m)).alias("context"), why(m).alias("reason")))


def all_hits(df: DataFrame, text: str, keys: list[str], test_cards: tuple[str, ...] = P.TEST_CARDS) -> DataFrame:
    """(*keys, kind, start, masked, context, reason), a row a hit of e-mail, phone, id_card, bank_card, private_ip or social.

    reason is empty for a hit that counts. start is in code points; ID cards are sought in a text whose plain-number contexts are blanked
    out. Rows without text have no hit, equal hits at two places are two rows.
    """
    c = F.col(text)
    lists = contacts.judged(df.select(*keys, text), text)
    masked = lambda kind: lambda m: pii.mask(F.lit(kind), m["value"])
    own = contains_any(F.lower(c), P.OWN_NETWORK)

    def contact(kind: str, column: str, more: Column | None = None) -> Column:
        def why(x: Column) -> Column:
            return x["why"] if more is None else F.when((x["why"] == "") & more, "list of addresses").otherwise(x["why"])

        hits = F.transform(column, lambda x: F.struct(x["hit"]["value"].alias("value"), x["hit"]["start"].alias("start"), x["hit"]["pre"].alias("pre"), x["hit"]["post"].alias("post"), why(x).alias("why")))
        return _rows(kind, hits, masked(kind), lambda m: m["why"])

    ip_reason = lambda m: F.when(pii.private_ip_reason(m, own) != "", pii.private_ip_reason(m, own)).when(contacts.configured_ip(m), "configuration").otherwise("")
    parts = [
        contact("email", "emails", F.size("emails") >= LIST_OF_ADDRESSES),
        contact("phone", "phones"),
        _rows("id_card", pii.id_card_matches(c), masked("id_card"), pii.id_card_reason),
        _rows("bank_card", matches(c, P.CARD), masked("bank_card"), lambda m: pii.bank_card_reason(m, test_cards)),
        _rows("private_ip", matches(c, P.QA_PRIVATE_IP, 120), lambda m: pii.mask_ip(m["value"]), ip_reason),
        _rows("social", matches(c, P.SOCIAL), lambda m: pii.mask_social(m["value"]), lambda m: pii.first_reason(("masked", pii.social_masked(m["value"])))),
    ]
    return lists.select(*keys, F.inline(F.concat(*parts)))


def documents_and_turns(spark, sf_dir) -> DataFrame:
    """(origin, id, turn, text) of all documents and all turns of conversations."""
    docs = spread(table(spark, sf_dir, "documents").select(F.lit("document").alias("origin"), F.col("doc_id").alias("id"), F.lit(None).cast("long").alias("turn"), "text"))
    return docs.unionByName(spread(table(spark, sf_dir, "conversations").select(F.lit("turn").alias("origin"), F.col("conv_id").alias("id"), "turn", "text")))


def privacy_hits(spark, sf_dir):
    """All hits in the texts of documents and of conversations' turns."""
    return all_hits(documents_and_turns(spark, sf_dir), "text", ["origin", "id", "turn"])


def privacy_places(spark, sf_dir):
    """privacy_hits without reasons, which partly need neighbouring tokens and have no SQL."""
    return privacy_hits(spark, sf_dir).drop("reason")


def card_reasons(spark, sf_dir):
    """Numbers of a bank card's form by the reason why they are none."""
    return privacy_hits(spark, sf_dir).filter("kind = 'bank_card'").groupBy("reason").agg(F.count("*").alias("n"))


QUERIES = {"privacy_hits": privacy_hits, "privacy_places": privacy_places, "privacy_card_reasons": card_reasons}

_quoted = lambda words: ", ".join("'" + w.replace("'", "''") + "'" for w in words)
_TEXTS = f"""WITH t AS (SELECT 'document' AS origin, doc_id AS id, NULL::BIGINT AS turn, text FROM documents UNION ALL SELECT 'turn', conv_id, turn, text FROM conversations),
n AS MATERIALIZED (SELECT row_number() OVER () AS r, * FROM t WHERE text IS NOT NULL),
m AS (SELECT r, text, unnest(range(1, len(v) + 1)) AS k, v, string_split_regex(text, '{P.EMAIL}') AS gaps FROM (SELECT r, text, regexp_extract_all(text, '{P.EMAIL}') AS v FROM n WHERE contains(text, '@'))),
e AS (SELECT r, 'email' AS kind, v[k] AS value, (list_sum([length(x) FOR x IN gaps[1:k]]) + coalesce(list_sum([length(x) FOR x IN v[1:k - 1]]), 0))::INT AS start FROM m),
d AS MATERIALIZED (SELECT r, text, i, CASE WHEN i > 1 THEN substr(text, i - 1, 1) ELSE '' END AS before, substr(text, i, 40) AS here FROM (SELECT r, text, unnest(range(1, length(text) + 1)) AS i FROM n WHERE regexp_matches(text, '[0-9]')) WHERE substr(text, i, 1) BETWEEN '0' AND '9'),
f AS (SELECT r, 'phone' AS kind, here[1:11] AS value, i - 1 AS start FROM d WHERE regexp_matches(here, '^1[3-9][0-9]{{9}}([^0-9a-fA-F]|$)') AND NOT regexp_matches(before, '[0-9a-fA-F]')
  UNION ALL SELECT r, 'id_card', here[1:18], i - 1 FROM d WHERE regexp_matches(here, '^[0-9]{{6}}(19|20)[0-9]{{2}}(0[1-9]|1[0-2])([0-2][0-9]|3[01])[0-9]{{3}}[0-9Xx]([^0-9Xx]|$)') AND NOT regexp_matches(before, '[0-9Xx]')
  UNION ALL SELECT r, 'private_ip', regexp_extract(here, '^(192[.]168|172[.](1[6-9]|2[0-9]|3[01]))[.][0-9]{{1,3}}[.][0-9]{{1,3}}'), i - 1 FROM d
    WHERE regexp_matches(here, '^(192[.]168|172[.](1[6-9]|2[0-9]|3[01]))[.][0-9]{{1,3}}[.][0-9]{{1,3}}([^0-9a-zA-Z.]|$)') AND NOT regexp_matches(before, '[0-9a-zA-Z.]')
  UNION ALL SELECT r, 'bank_card', max_by(here[1:c], c), i - 1 FROM (SELECT r, i, here, before, unnest(range(13, 38)) AS c FROM d WHERE regexp_matches(here, '^[3-6](\\s?[0-9]){{12}}'))
    WHERE NOT regexp_matches(before, '[0-9.]') AND length(here) >= c AND regexp_full_match(here[1:c], '[3-6](\\s?[0-9]){{12,18}}') AND NOT regexp_matches(here[c + 1:c + 1], '[0-9.]') GROUP BY r, i),
h AS (SELECT n.r, origin, id, turn, text, kind, value, start::INT AS start, regexp_replace(value, '[^0-9]', '', 'g') AS digits, replace(substr(text, greatest(start - 60, 0)::INT + 1, least(start, 60)::INT), chr(10), '⏎') AS pre,
  replace(substr(text, (start + length(value) + 1)::INT, 60), chr(10), '⏎') AS post FROM (SELECT * FROM e UNION ALL SELECT * FROM f) JOIN n USING (r))"""
ORACLE_SQL = {
    "privacy_places": f"""{_TEXTS},
k AS (SELECT *, CASE kind WHEN 'email' THEN 'xxxxxx@' || regexp_extract(value, '@(.*)', 1) WHEN 'phone' THEN left(digits, 3) || repeat('X', length(digits) - 5) || right(digits, 2) WHEN 'id_card' THEN left(digits, 6) || repeat('X', length(digits) - 10) || right(digits, 4)
  WHEN 'bank_card' THEN left(digits, 4) || repeat('X', length(digits) - 8) || right(digits, 4) ELSE regexp_extract(value, '^[0-9]+[.][0-9]+') || '.x.x' END AS masked FROM h)
SELECT origin, id, turn, kind, start, masked, trim(CASE WHEN length(pre) < 60 THEN pre ELSE '…' || pre END || masked || CASE WHEN length(post) < 60 THEN post ELSE post || '…' END) AS context FROM k""",
    "privacy_card_reasons": f"""{_TEXTS},
b AS (SELECT right(pre, 1) AS before, left(post, 1) AS after, lower(pre || value || post) AS around, digits AS s, [x::INT FOR x IN string_split(digits, '')] AS g FROM h WHERE kind = 'bank_card')
SELECT CASE WHEN regexp_matches(before, '[\\pL_#"''&:]') OR regexp_matches(after, '[\\pL_#"''&:}}]') THEN 'inside a name'
  WHEN len(list_distinct(g)) = 1 OR (s[1] = s[2] AND s[2] = s[3] AND s[4] = s[5] AND s[5] = s[6]) OR len([i FOR i IN range(1, len(g)) IF (g[i + 1] - g[i] + 10) % 10 <> 1]) = 0 THEN 'plain pattern'
  WHEN s IN ({_quoted(P.TEST_CARDS)}) THEN 'test number' WHEN NOT regexp_matches(around, '{P.PAYMENT_EN}') AND NOT ({" OR ".join(f"contains(around, '{w}')" for w in P.PAYMENT_CN)}) THEN 'no payment word'
  WHEN list_sum([CASE WHEN (len(g) - i) % 2 = 1 THEN CASE WHEN g[i] > 4 THEN 2 * g[i] - 9 ELSE 2 * g[i] END ELSE g[i] END FOR i IN range(1, len(g) + 1)]) % 10 <> 0 THEN 'check digit' ELSE '' END AS reason, count(*) AS n FROM b GROUP BY reason""",
}
