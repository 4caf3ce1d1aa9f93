"""Rules over security articles: {id, content, meta}."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.functions import patterns as P
from sievework.functions import pii
from sievework.functions.text import all_matches, contained, contains_any, fence_state, gram_normal, lines, match_count, replaced, right_strip, strip
from sievework.operators import findings as O
from sievework.sources.records import missing_of, strings_at, text_at, type_at


def derived(records: DataFrame) -> DataFrame:
    """records (file, pos, v, keys, status) with the text views that rules share."""
    content = F.coalesce(text_at("$.content"), F.lit(""))
    out = records.filter("status in ('ok', 'not_object')").select("file", "pos", "v", "keys", F.coalesce(text_at("$.id"), F.lit("?")).alias("rid"), content.alias("content"))
    out = out.withColumn("work", replaced(F.col("content"), "data:image/", P.BASE64_IMAGE, "")).withColumn("images", match_count(F.col("content"), "data:image/", P.BASE64_IMAGE))
    out = out.withColumn("fence", fence_state(F.col("work"))).withColumn("no_code", replaced(F.array_join("fence.kept", "\n"), "`", P.INLINE_CODE, ""))
    return out.withColumn("tail", right_strip(F.col("work"))).withColumn("bare", strip(F.col("work")))


def empty_section(tail: Column) -> Column:
    """The last heading, if nothing follows it, it is no sentence and names a part that should have content; else NULL."""
    head = F.try_element_at(all_matches(tail, "#", P.SECTION_HEAD), F.lit(-1))
    ends = F.endswith(tail, F.rtrim(head))
    return F.when(ends & ~head.rlike(P.SENTENCE_END) & contains_any(head, P.EMPTY_SECTION_WORDS), head)


def ad_hits(work: Column, category: Column) -> Column:
    """struct<strong,weak>: advertising words of lines that neither describe content nor tell of flags."""
    plain = F.filter(lines(work), lambda x: ~x.rlike(P.BODY_WORDS) & ~x.rlike("(?i)flag|ctf") & ~F.contains(x, F.lit(P.AD_PHRASE_EXEMPT)))
    strong = F.array_distinct(F.flatten(F.transform(plain, lambda x: contained(x, P.AD_STRONG))))
    weak = F.array_distinct(F.flatten(F.transform(F.filter(plain, lambda x: x.rlike(P.AD_CALL)), lambda x: contained(x, P.AD_WEAK))))
    # Lines are looked at only where a word to be found stands somewhere in the text.
    exempt = contains_any(F.coalesce(category, F.lit("")), P.AD_CATEGORY_EXEMPT) | ~contains_any(work, P.AD_STRONG + P.AD_WEAK)
    none = F.array().cast("array<string>")
    return F.struct(F.when(exempt, none).otherwise(strong).alias("strong"), F.when(exempt, none).otherwise(weak).alias("weak"))


def live_ip_links(no_code: Column) -> Column:
    found = all_matches(no_code, ":", P.IP_URL)
    return F.filter(found, lambda x: F.startswith(F.lower(x), F.lit("http")) & ~x.rlike(P.DEFANGED) & ~pii.excluded_ip(F.regexp_extract(x, P.PLAIN_IP, 0)))


def check(records: DataFrame, as_of: str) -> DataFrame:
    """records with findings (array) and the flags that statistics count; as_of: the date (yyyy-mm-dd) that ages refer to."""
    d = derived(records)
    d = d.withColumn("ads", ad_hits(F.col("work"), text_at("$.meta.content_category"))).withColumn("links", live_ip_links(F.col("no_code")))
    emails = F.filter(all_matches(F.col("work"), "@", P.EMAIL), pii.blog_email_counts)
    d = d.withColumn("private", F.concat(emails, pii.article_cards(F.col("work"), as_of)))
    d = d.withColumn("cves", F.array_distinct(F.transform(all_matches(F.col("work"), "-", P.CVE), F.upper)))
    d = d.withColumn("related", F.transform(strings_at("$.meta.related_cves"), F.upper)).withColumn("missing", missing_of("$.meta", P.BLOG_META))
    d = O.first_seen(d, F.nullif(strip(text_at("$.meta.url")), F.lit("")), F.col("rid"), "file", "pos").withColumnRenamed("seen_before", "url_of")
    d = O.first_seen(d, F.md5(strip(F.col("content"))), F.col("rid"), "file", "pos").withColumnRenamed("seen_before", "body_of")
    tail, work, no_code = F.col("tail"), F.col("work"), F.col("no_code")
    poc, colon, section = tail.rlike(P.POC_END), tail.rlike(P.COLON_END), empty_section(tail)
    blobs = match_count(work, "](blob:", P.BLOB_IMAGE)
    linked = match_count(no_code, "](", P.LINKED_IMAGE) + match_count(no_code, "<", P.LINKED_TAG)
    published = F.left(F.coalesce(text_at("$.meta.publish_time"), F.lit("")), F.lit(10))
    age = F.datediff(F.lit(as_of).cast("date"), F.when(published.rlike(r"^\d{4}-\d{2}-\d{2}$"), published.try_cast("date"))) / 365.25
    original = F.try_variant_get("v", "$.meta.is_original", "boolean")
    is_bool = type_at("$.meta.is_original") == "BOOLEAN"
    phones = all_matches(work, "1", P.PHONE)
    private_ips = all_matches(work, "1", P.PRIVATE_IP)
    forbidden = contained(work, P.FORBIDDEN_BLOG)
    d = d.withColumns({
        "truncated": poc | (~colon & section.isNotNull()), "blobs": blobs, "linked": linked, "outdated": F.coalesce(age > 10, F.lit(False)),
        "nontech": (F.size("ads.strong") > 0) | (F.size("ads.weak") >= 2),
        "authority": contains_any(F.coalesce(text_at("$.meta.source_platform"), F.lit("")), P.AUTHORITIES),
        "original": F.coalesce(is_bool & original, F.lit(False)),
    })
    rules = O.collect(
        O.rule("ERROR", "structure", ~F.col("keys").eqNullSafe(F.array(*map(F.lit, P.BLOG_KEYS))), F.array_join("keys", ",")),
        O.rule("ERROR", "required_meta", F.size("missing") > 0, F.array_join("missing", ",")),
        O.rule("ERROR", "url_duplicate", F.col("url_of").isNotNull(), F.col("url_of")),
        O.rule("ERROR", "body_duplicate", F.col("body_of").isNotNull(), F.col("body_of")),
        O.rule("ERROR", "poc_truncated", poc, F.right(tail, F.lit(25))),
        O.rule("WARN", "colon_ending", ~poc & colon, F.right(tail, F.lit(25))),
        O.rule("ERROR", "empty_section", ~poc & ~colon & section.isNotNull(), section),
        O.rule("ERROR", "blob_image", blobs > 0, blobs),
        O.rule("ERROR", "linked_image", linked > 0, linked),
        O.rule("ERROR", "privacy", F.size("private") > 0, F.array_join(F.slice("private", 1, 3), "; ")),
        O.rule("WARN", "phone", F.size(phones) > 0, F.get(phones, F.lit(0))),
        O.rule("WARN", "live_ip_link", F.size("links") > 0, F.get("links", F.lit(0))),
        O.rule("ERROR", "private_ip", F.size(private_ips) > 0, F.get(private_ips, F.lit(0))),
        O.rule("ERROR", "open_fence", F.col("fence.open") > 0, F.col("fence.line")),
        O.rule("ERROR", "cve_unlisted", (F.size("cves") > 0) & (F.size("related") == 0), F.array_join(F.slice(F.array_sort("cves"), 1, 3), ",")),
        O.rule("ERROR", "cve_incomplete", (F.size("related") > 0) & (F.size(F.array_except("cves", "related")) > 0), F.array_join(F.slice(F.array_sort(F.array_except("cves", "related")), 1, 3), ",")),
        O.rule("WARN", "translation_source", is_bool & ~original & F.forall(F.array(*[F.coalesce(text_at(f"$.meta.{k}"), F.lit("")) for k in P.TRANSLATION_SOURCES]), lambda x: x == "")),
        O.rule("WARN", "outdated", F.col("outdated"), published),
        O.rule("WARN", "too_short", (F.length("bare") < P.MIN_CHARS) & (F.col("images") + match_count(work, "<image_desc>", P.IMAGE_NOTE) == 0), F.length("bare")),
        O.rule("WARN", "not_technical", F.col("nontech"), F.array_join(F.concat("ads.strong", "ads.weak"), ",")),
        O.rule("ERROR", "forbidden", F.size(forbidden) > 0, F.array_join(forbidden, ",")),
    )
    return d.withColumn("findings", rules)


def stats(checked: DataFrame) -> DataFrame:
    """One row of exact counters."""
    n = lambda c: F.count_if(c).alias
    has = lambda item: F.exists("findings", lambda f: f["item"] == item)
    return checked.agg(
        F.count("*").alias("total"), n(has("structure"))("structure"), n(F.size("missing") > 0)("missing"), n(has("url_duplicate"))("url_dup"), n(has("body_duplicate"))("body_dup"),
        n(F.col("truncated"))("truncated"), n(F.col("blobs") > 0)("blob"), n(F.col("linked") > 0)("linked"), F.coalesce(F.sum("blobs"), F.lit(0)).alias("blob_images"), F.coalesce(F.sum("linked"), F.lit(0)).alias("linked_images"),
        n(has("privacy"))("privacy"), n(F.col("nontech"))("nontech"), n(has("forbidden"))("forbidden"), n(F.col("outdated"))("outdated"), n(F.col("authority"))("authority"), n(F.col("original"))("original"),
        n(F.size("related") > 0)("cve_listed"), n(F.size("cves") > 0)("cve_named"), n(F.col("bare") == "")("empty"), n(F.length("bare") < P.MIN_CHARS)("short"), n(F.col("fence.open") > 0)("open_fence"),
        F.coalesce(F.sum("images"), F.lit(0)).alias("images"), F.coalesce(F.sum(F.length("content")), F.lit(0)).alias("chars"),
    )


def histograms(checked: DataFrame) -> DataFrame:
    """(dim, key, cnt): platform, category, language (each label counts), year."""
    year = F.left(F.coalesce(text_at("$.meta.publish_time"), F.lit("")), F.lit(4))
    single = O.histogram(checked, platform=F.coalesce(text_at("$.meta.source_platform"), F.lit("?")), category=F.coalesce(text_at("$.meta.content_category"), F.lit("?")), year=F.when(year.rlike(r"^\d{4}$"), year)).filter("key is not null")
    langs = checked.select(F.explode(strings_at("$.meta.primary_languages")).alias("key")).groupBy("key").agg(F.count("*").alias("cnt"))
    return single.unionByName(langs.select(F.lit("language").alias("dim"), "key", "cnt"))


def near_texts(checked: DataFrame) -> DataFrame:
    """(norm) for the near-duplicate search: each article's text without embedded images."""
    return checked.select(gram_normal(F.col("work")).alias("norm"))


def gate_rows(stat: DataFrame, hist: DataFrame, near: int | None = None) -> DataFrame:
    """Threshold gates; near: near-duplicate pairs, None where they weren't searched (level SKIP)."""
    c = F.col
    rows = O.gates(
        stat, O.ratio_gate("url_dup", c("url_dup"), c("total"), P.MAX_DUP), O.ratio_gate("body_dup", c("body_dup"), c("total"), P.MAX_DUP),
        O.ratio_gate("privacy", c("privacy"), c("total"), P.MAX_MISSING, some="WARN"), O.any_gate("truncated", c("truncated")), O.any_gate("images", c("blob") + c("linked")),
        O.ratio_gate("missing", c("missing"), c("total"), P.MAX_MISSING), O.ratio_gate("nontech", c("nontech"), c("total"), P.MAX_NONTECH, some="WARN"),
        O.ratio_gate("authority", c("authority"), c("total"), P.MIN_AUTHORITY, at_least=True), O.ratio_gate("outdated", c("outdated"), c("total"), 50.0, bad="WARN"),
    )
    near_level = F.lit("SKIP") if near is None else F.lit("WARN" if near else "PASS")
    near_row = stat.select(F.lit("near_dup").alias("gate"), near_level.alias("level"), F.lit(near).cast("double").alias("value"), F.lit(0.0).alias("threshold"), F.lit(near).cast("long").alias("numer"), c("total").alias("denom"))
    tops = O.top_of(hist.filter("dim in ('language', 'platform', 'category')")).crossJoin(F.broadcast(stat.select("total").withColumnRenamed("total", "n")))
    limit = F.when(c("dim") == "language", P.MAX_ONE_LANGUAGE).otherwise(50.0)
    share = c("cnt") / F.when(c("dim") == "language", c("total")).otherwise(c("n")) * 100
    spread = tops.select(F.concat(F.lit("one_"), "dim").alias("gate"), F.when(share > limit, "WARN").otherwise("PASS").alias("level"), share.alias("value"), limit.alias("threshold"), c("cnt").alias("numer"), F.when(c("dim") == "language", c("total")).otherwise(c("n")).alias("denom"))
    return rows.unionByName(near_row).unionByName(spread)
