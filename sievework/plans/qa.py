"""Rules over code dialogues: {id, message, source, domain, cleaning_status, metadata}."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.functions import contacts, pii
from sievework.functions import patterns as P
from sievework.functions.code import block_counts, closed_blocks, unbalanced_blocks
from sievework.functions.text import contained, contains_any, estimated_tokens, gram_normal, matches, prose_segments, starts_any, strip, without_links
from sievework.operators import findings as O
from sievework.sources.records import absent, missing, missing_of, text_at, type_at


def _number(path: str) -> Column:
    return F.when(~type_at(path).isin("STRING", "VOID") & ~type_at(path).rlike("^(ARRAY|OBJECT)"), F.coalesce(F.try_variant_get("v", path, "double"), F.try_variant_get("v", path, "boolean").cast("double")))


def prose(field: Column) -> Column:
    """A field without code blocks, formulas, samples, inline code and addresses."""
    text = F.array_join(prose_segments(field), "\n")
    for pattern in (r"(?s)\$\$.+?\$\$|\$[^$\n]+\$", P.SAMPLE_SPAN):
        text = F.regexp_replace(text, pattern, " ")
    return without_links(text)


def derived(records: DataFrame) -> DataFrame:
    turn_type = "array<variant>"
    d = records.filter("status in ('ok', 'not_object')").select("file", "pos", "v", "keys", F.coalesce(text_at("$.id"), F.lit("?")).alias("rid"), F.coalesce(F.try_variant_get("v", "$.message", turn_type), F.array().cast(turn_type)).alias("raw"))
    q = lambda t, k: F.coalesce(F.try_variant_get(t, f"$.{k}", "string"), F.lit(""))
    shape = lambda t: F.startswith(F.coalesce(F.schema_of_variant(t), F.lit("VOID")), F.lit("OBJECT"))
    lacks = lambda t, k: F.try_variant_get(t, f"$.{k}", "variant").isNull()
    # A turn is malformed if it is no object or its keys are a proper part of {question, answer}.
    size = lambda t: F.size(F.json_object_keys(F.to_json(t)))
    partial = lambda t: (size(t) == 0) | ((size(t) == 1) & (~lacks(t, "question") | ~lacks(t, "answer")))
    turns = F.transform("raw", lambda t: F.struct((~shape(t) | F.coalesce(partial(t), F.lit(True))).alias("bad"), shape(t).alias("object"), q(t, "question").alias("question"), q(t, "answer").alias("answer")))
    d = d.withColumn("turns", turns).withColumn("said", F.filter("turns", lambda t: t["object"]))
    d = d.withColumn("full", F.array_join(F.transform("said", lambda t: F.concat(t["question"], F.lit("\n"), t["answer"])), "\n"))
    d = d.withColumn("answers", F.array_join("said.answer", "\n"))
    d = d.withColumn("prose", F.array_join(F.flatten(F.transform("said", lambda t: F.array(prose(t["question"]), prose(t["answer"])))), "\n"))
    return d.withColumn("blocks", F.flatten(F.transform("said", lambda t: F.concat(closed_blocks(t["question"]), closed_blocks(t["answer"])))))


def public_set(full: Column) -> Column:
    """The first name of a public data set that stands in no method phrase, code or link; NULL if there is none."""

    def counts(m: Column) -> Column:
        fences = F.regexp_count(F.substring(full, F.lit(1), m["start"]), F.lit(r"(?m)^(```|~~~)"))
        link = m["pre"].rlike(r"\[[^\]]*\z") & m["post"].rlike(r"^[^\[]*?\]\(")
        return ~m["post"].rlike(P.PUBLIC_SET_STYLE) & ~((F.right(m["pre"], F.lit(1)) == "`") & F.startswith(m["post"], F.lit("`"))) & (fences % 2 == 0) & ~link

    return F.get(F.filter(matches(full, P.PUBLIC_SETS, 300), counts), F.lit(0))["value"]


def privacy(text: Column, test_cards: tuple[str, ...] = P.TEST_CARDS, around: bool = False) -> Column:
    """array<struct<kind,value>>: the first leak of each kind; test_cards are card numbers that belong to nobody.

    around: addresses and phone numbers are those of contacts.with_personal(), which judges them by what stands around them too.
    """
    emails = matches(text, P.EMAIL)
    own = F.col("emails") if around else F.filter(emails, lambda m: pii.real_email(m["value"]))
    email = F.when(F.size(emails) < 3, F.get(own, F.lit(0))["value"])
    phone = F.get("phones", F.lit(0))["value"] if around else F.get(F.filter(matches(text, P.PHONE), lambda m: ~pii.made_up_phone(m["value"]) & ~F.right(m["pre"], F.lit(1)).rlike(r"[\w.\-=_/#+]") & ~F.left(m["post"], F.lit(1)).rlike(r"[\w\-=_/#%]")), F.lit(0))["value"]
    card, account = F.get(pii.id_cards(text), F.lit(0))["value"], F.get(pii.bank_cards(text, test_cards), F.lit(0))["value"]
    kinds = F.array(*[F.when(v.isNotNull(), F.struct(F.lit(k).alias("kind"), v.alias("value"))) for k, v in (("email", email), ("phone", phone), ("id_card", card), ("bank_card", account))])
    return F.filter(kinds, lambda x: x.isNotNull())


def check(records: DataFrame, exempt_intranet: bool = False, test_cards: tuple[str, ...] = P.TEST_CARDS, around: bool = False) -> DataFrame:
    """records with findings and the columns that statistics count; around: see privacy(), and private addresses amid configuration are excused."""
    d = contacts.with_personal(derived(records), "prose") if around else derived(records)
    ips = pii.private_ips(F.col("prose"))
    ips = F.filter(ips, lambda m: ~contacts.configured_ip(m)) if around else ips
    d = d.withColumn("private", privacy(F.col("prose"), test_cards, around)).withColumn("ips", ips)
    d = d.withColumn("bad_blocks", unbalanced_blocks("blocks")).withColumn("code", block_counts(F.col("blocks")))
    whole = F.md5(F.coalesce(F.to_json(F.try_variant_get("v", "$.message", "variant")), F.lit("[]")))
    d = O.first_seen(d, whole, F.col("rid"), "file", "pos").withColumnRenamed("seen_before", "message_of")
    question = strip(F.coalesce(F.get("turns.question", F.lit(0)), F.lit("")))
    d = O.first_seen(d, F.md5(question), F.col("rid"), "file", "pos").withColumnRenamed("seen_before", "question_of")
    turns, full, source = F.col("turns"), F.col("full"), strip(F.coalesce(text_at("$.source"), F.lit("")))
    numbered = F.transform(turns, lambda t, i: F.struct(t.alias("t"), (i + 1).alias("n")))
    at = lambda test: F.array_join(F.transform(F.filter(numbered, lambda x: test(x["t"])), lambda x: x["n"].cast("string")), ",")
    bad, no_q, no_a = at(lambda t: t["bad"]), at(lambda t: ~t["bad"] & (strip(t["question"]) == "")), at(lambda t: ~t["bad"] & (strip(t["answer"]) == ""))
    asked, answered = text_at("$.metadata.question_time"), text_at("$.metadata.answer_time")
    timed = (type_at("$.metadata.question_time") == "STRING") & (type_at("$.metadata.answer_time") == "STRING") & (asked != "") & (answered != "")
    tokenizer = F.lower(strip(F.coalesce(text_at("$.metadata.tokenizer"), F.lit(""))))
    known = tokenizer.rlike(P.TOKENIZER_NAME) & (F.contains(tokenizer, F.lit("/")) | starts_any(tokenizer, P.TOKENIZER_PREFIXES))
    lower = F.lower(source)
    low = contained(lower, P.LOW_MODELS)
    synthetic = contained(F.lower(F.coalesce(F.get("turns.question", F.lit(0)), F.lit(""))), P.SYNTHETIC)
    sets = F.coalesce(public_set(full), F.nullif(F.regexp_extract(source, P.PUBLIC_SETS, 0), F.lit("")))
    segments = F.flatten(F.transform("said", lambda t: F.concat(prose_segments(t["question"]), prose_segments(t["answer"]))))
    media = F.exists(segments, lambda s: s.rlike(P.QA_IMAGE_TAG) | s.rlike(P.QA_IMAGE_LINK) | s.rlike(P.QA_BASE64))
    forbidden, framed = contained(full, P.FORBIDDEN_QA), F.size(contained(full, P.PROBLEM_MARKS)) >= 2
    qt, at_, tc = (_number(f"$.metadata.{k}") for k in ("question_tokens", "answer_tokens", "token_count"))
    both = (qt >= 0) & (at_ >= 0)
    estimate = estimated_tokens(full)
    off = F.when(F.coalesce(both, F.lit(False)), (tc > 0) & (tc != qt + at_)).otherwise((tc > 0) & (F.abs(tc - estimate) / F.greatest(estimate, F.lit(1)) > 0.8))
    social = pii.social_accounts(F.col("answers"))
    false_status = F.filter(F.array(*[F.when((type_at(f"$.cleaning_status.{k}") == "BOOLEAN") & ~F.try_variant_get("v", f"$.cleaning_status.{k}", "boolean"), F.lit(k)) for k in P.QA_STATUS]), lambda x: x.isNotNull())
    absent_status = missing_of("$.cleaning_status", P.QA_STATUS, absent)
    missing_meta = missing_of("$.metadata", P.QA_META)
    no_time = missing_of("$.metadata", ("question_time", "answer_time"))
    no_tokens = missing_of("$.metadata", ("question_tokens", "answer_tokens"))
    garbled = F.regexp_count(full, F.lit("�"))
    rules = O.collect(
        O.rule("ERROR", "structure", ~F.col("keys").eqNullSafe(F.array(*map(F.lit, P.QA_KEYS))), F.concat_ws(" / ", F.array_join(F.array_except(F.array(*map(F.lit, P.QA_KEYS)), "keys"), ","), F.array_join(F.array_except("keys", F.array(*map(F.lit, P.QA_KEYS))), ","))),
        O.rule("ERROR", "message_missing", F.size("raw") == 0),
        O.rule("ERROR", "turn_malformed", bad != "", bad), O.rule("ERROR", "question_empty", no_q != "", no_q), O.rule("ERROR", "answer_empty", no_a != "", no_a),
        O.rule("ERROR", "status_missing", F.size(absent_status) > 0, F.array_join(absent_status, ",")),
        O.rule("WARN", "cleaning_unfinished", F.size(false_status) > 0, F.array_join(false_status, ",")),
        O.rule("ERROR", "metadata_missing", F.size(missing_meta) > 0, F.array_join(missing_meta, ",")),
        O.rule("ERROR", "type_value", (type_at("$.metadata.type") != "VOID") & ~text_at("$.metadata.type").eqNullSafe(F.lit(P.QA_TYPE)), text_at("$.metadata.type")),
        O.rule("ERROR", "domain_not_array", ~F.startswith(type_at("$.domain"), F.lit("ARRAY"))),
        O.rule("ERROR", "time_missing", F.size(no_time) > 0, F.array_join(no_time, ",")),
        O.rule("ERROR", "time_inverted", timed & (answered < asked)),
        O.rule("ERROR", "tokens_missing", F.size(no_tokens) > 0, F.array_join(no_tokens, ",")),
        O.rule("ERROR", "tokenizer_unknown", ~known, tokenizer),
        O.rule("ERROR", "id_prefix", ~F.startswith("rid", F.lit(P.QA_ID_PREFIX))),
        O.rule("ERROR", "hidden_span", full.rlike(P.HIDDEN_SPAN)),
        O.rule("ERROR", "source_missing", source == ""),
        O.rule("ERROR", "low_model", F.size(low) > 0, F.array_join(low, ",")),
        O.rule("WARN", "synthetic_question", F.size(synthetic) > 0, F.array_join(synthetic, ",")),
        O.rule("WARN", "public_data_set", sets.isNotNull(), sets),
        O.rule("WARN", "privacy", F.size("private") > 0, F.array_join(F.transform("private", lambda p: F.concat(p["kind"], F.lit(" "), pii.mask(p["kind"], p["value"]))), "; ")),
        O.rule("WARN", "private_ip", (F.size("ips") > 0) & F.lit(not exempt_intranet), pii.mask_ip(F.get("ips", F.lit(0))["value"])),
        O.rule("WARN", "social_account", F.size(social) > 0, pii.mask_social(F.get(social, F.lit(0)))),
        O.rule("ERROR", "media", media),
        O.rule("ERROR", "garbled", garbled > 5, garbled),
        O.rule(F.when(framed, "WARN").otherwise("ERROR"), "forbidden", F.size(forbidden) > 0, F.array_join(forbidden, ",")),
        O.rule("WARN", "token_count", F.coalesce(off, F.lit(False)), tc),
        O.rule("ERROR", "message_duplicate", F.col("message_of").isNotNull(), F.col("message_of")),
    )
    domain = F.when(F.startswith(type_at("$.domain"), F.lit("ARRAY")), strip(F.coalesce(F.get(F.try_variant_get("v", "$.domain", "array<string>"), F.lit(0)), F.lit("")))).otherwise(strip(F.substring_index(F.coalesce(text_at("$.domain"), F.lit("?")), "/", 1)))
    return d.withColumn("findings", rules).withColumns({
        "kind": F.when(F.size("raw") >= 2, "multi").when(F.size("raw") == 1, "single"), "time_equal": F.coalesce(timed & (answered == asked), F.lit(False)), "source_multi": F.contains(source, F.lit("/")), "source_model": contains_any(lower, P.MODEL_WORDS),
        "language": F.lower(F.coalesce(text_at("$.metadata.primary_language"), F.lit("?"))), "domain": F.when(domain == "", "?").otherwise(domain), "question_time": F.coalesce(asked, F.lit("None")),
        "tokens": F.when(F.coalesce(both, F.lit(False)), qt + at_).when(tc > 0, tc).otherwise(estimate).cast("double"),
    })


def stats(checked: DataFrame) -> DataFrame:
    n = lambda c: F.count_if(c).alias
    has = lambda item: F.exists("findings", lambda f: f["item"] == item)
    names = ("time_inverted", "hidden_span", "source_missing", "low_model", "synthetic_question", "public_data_set", "privacy", "forbidden", "garbled", "message_duplicate")
    return checked.agg(
        F.count("*").alias("total"), *[n(has(x))(x) for x in names], n(F.col("kind") == "multi")("multi_turn"), n((F.col("kind") == "multi") & (F.size("raw") < 3))("two_turns"), n(F.col("time_equal"))("time_equal"),
        n(F.col("source_multi"))("source_multi"), n(F.col("source_model"))("source_model"), n(F.col("question_of").isNotNull())("same_question"), F.coalesce(F.sum("bad_blocks"), F.lit(0)).alias("bad_blocks"), n(F.col("bad_blocks") > 0)("bad_code"),
        *[F.coalesce(F.sum(f"code.{x}"), F.lit(0)).alias(x) for x in ("blocks", "nolang", "tiny")], F.coalesce(F.sum("tokens"), F.lit(0.0)).alias("tokens"),
    )


def mixed_files(checked: DataFrame) -> DataFrame:
    """Files that hold single and multi-turn records."""
    return checked.filter("kind is not null").groupBy("file").agg(F.collect_set("kind").alias("kinds")).filter(F.size("kinds") > 1).select("file")


def near_texts(checked: DataFrame) -> DataFrame:
    """(norm) for the near-duplicate search: each dialogue's questions and answers."""
    return checked.select(gram_normal(F.col("full")).alias("norm"))


def time_concentration(checked: DataFrame, least: int = 100, share: float = 0.05) -> DataFrame:
    """(question_time, cnt, total) if one time holds over 5 % of at least 100 records; a missing time counts as None, and of equals the first counts."""
    counts = O.top_of(O.histogram(checked, "file", "pos", question_time=F.col("question_time")))
    return counts.filter((F.col("total") >= least) & (F.col("cnt") / F.col("total") > share)).select(F.col("key").alias("question_time"), "cnt", "total")


def histograms(checked: DataFrame) -> DataFrame:
    return O.histogram(checked, language=F.col("language"), domain=F.col("domain"))


def gate_rows(stat: DataFrame, hist: DataFrame, mixed: int, near: int | None = None, exempt_multi_turn: bool = True) -> DataFrame:
    """Threshold gates; mixed: files of mixed kinds; near: near-duplicate pairs, None where they weren't searched (level SKIP)."""
    c = F.col
    rows = O.gates(
        stat, O.ratio_gate("multi_turn", c("multi_turn"), c("total"), P.MIN_MULTI_TURN, at_least=True, bad="WARN" if exempt_multi_turn else "ERROR"), O.ratio_gate("message_duplicate", c("message_duplicate"), c("total"), P.MAX_QA_DUP, inclusive=True),
        *[O.any_gate(x, c(x)) for x in ("hidden_span", "source_missing", "time_inverted", "low_model")], *[O.any_gate(x, c(x), "WARN") for x in ("two_turns", "time_equal", "synthetic_question", "public_data_set", "bad_blocks")],
        O.any_gate("mixed_files", F.lit(mixed), "WARN"),
    )
    near_level = F.lit("SKIP") if near is None else F.lit("WARN" if near else "PASS")
    near_row = stat.select(F.lit("near_dup").alias("gate"), near_level.alias("level"), F.lit(near).cast("double").alias("value"), F.lit(0.0).alias("threshold"), F.lit(near).cast("long").alias("numer"), c("total").alias("denom"))
    langs = hist.filter("dim = 'language'")
    own = O.top_of(langs.filter(~c("key").isin(*P.QA_PLACEHOLDER_LANGS)))
    share = c("cnt") / c("total") * 100
    one = own.select(F.lit("one_language").alias("gate"), F.when(share > P.MAX_ONE_LANGUAGE, "WARN").otherwise("PASS").alias("level"), share.alias("value"), F.lit(P.MAX_ONE_LANGUAGE).alias("threshold"), c("cnt").alias("numer"), c("total").alias("denom"))
    held = langs.filter(c("key").isin(*P.QA_PLACEHOLDER_LANGS)).agg(F.sum("cnt").alias("numer")).filter("numer is not null")
    skip = held.select(F.lit("placeholder_language").alias("gate"), F.lit("SKIP").alias("level"), c("numer").cast("double").alias("value"), F.lit(None).cast("double").alias("threshold"), c("numer"), F.lit(None).cast("long").alias("denom"))
    return rows.unionByName(near_row).unionByName(one).unionByName(skip)


def info_rows(stat: DataFrame) -> DataFrame:
    """Rows that tell and judge nothing: the syntax check that isn't made, and the tokens in all."""
    none = F.lit(None)
    row = lambda gate, level, numer: F.struct(F.lit(gate).alias("gate"), F.lit(level).alias("level"), numer.cast("double").alias("value"), none.cast("double").alias("threshold"), numer.cast("long").alias("numer"), none.cast("long").alias("denom"))
    return stat.select(F.inline(F.array(row("syntax", "SKIP", none), row("tokens", "PASS", F.col("tokens")))))


def time_rows(checked: DataFrame) -> DataFrame:
    """time_concentration as a row of the gates: WARN with the share of the one time, no row where none stands out."""
    share = F.col("cnt") / F.col("total") * 100
    return time_concentration(checked).select(F.lit("shared_time").alias("gate"), F.lit("WARN").alias("level"), share.alias("value"), F.lit(5.0).alias("threshold"), F.col("cnt").alias("numer"), F.col("total").alias("denom"))


__all__ = ["time_rows", "info_rows", "check", "derived", "gate_rows", "histograms", "missing", "mixed_files", "near_texts", "privacy", "public_set", "stats", "time_concentration"]
