"""Rules over vulnerability-fix commits: {id, text, meta}."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.functions import patterns as P
from sievework.functions import pii
from sievework.functions.text import contains_any, lines, starts_any, strip
from sievework.operators import diff as D
from sievework.operators import findings as O
from sievework.sources.records import absent, missing_of, strings_at, text_at, type_at

RECENT_YEARS = 3
#: Dimensions of the histograms, and the fields that hold them.
DIMENSIONS = {"language": "programming_language", "severity": "severity", "owner": "project_owner", "vulnerability": "vulnerability_type", "cwe": "cwe_classification", "license": "license"}


def _flag(path: str) -> Column:
    """A JSON boolean, NULL for any other value."""
    return F.when(type_at(path) == "BOOLEAN", F.try_variant_get("v", path, "boolean"))


def _polluted(code: Column) -> Column:
    """Marks of mails or diffs inside a code field, leaving out protocol headers and quoted tokens."""
    kept = F.array_join(F.filter(lines(code), lambda x: ~(x.rlike(P.MAIL_HEAD) & (x.rlike(P.PROTOCOL_LINE) | x.rlike(P.QUOTED_TOKEN)))), "\n")
    marks = (("mail_from", P.MAIL_FROM), ("diff_git", P.DIFF_GIT), ("hunk", P.HUNK_MARK), ("mail_head", P.MAIL_HEAD))
    return F.filter(F.array(*[F.when(kept.rlike(rx), F.lit(name)) for name, rx in marks]), lambda x: x.isNotNull())


def _code_lines(code: Column) -> Column:
    return F.size(F.filter(F.transform(lines(code), strip), lambda x: (x != "") & ~starts_any(x, P.CODE_COMMENT_STARTS)))


def _first_email(text: Column) -> Column:
    return F.get(F.filter(F.regexp_extract_all(text, F.lit(P.EMAIL), F.lit(0)), pii.code_email_counts), F.lit(0))


def derived(records: DataFrame, verify: bool = True) -> DataFrame:
    m = lambda k: F.coalesce(text_at(f"$.meta.{k}"), F.lit(""))
    d = records.filter("status in ('ok', 'not_object')").select(
        "file", "pos", "v", "keys", F.coalesce(text_at("$.id"), F.lit("?")).alias("rid"), F.coalesce(text_at("$.text"), F.lit("")).alias("text"),
        *[m(k).alias(a) for k, a in (("vulnerable_code", "before"), ("fixed_code", "after"), ("unified_diff", "diff"), ("commit_message", "message"), ("primary_file", "primary"), ("cve_id", "cve"))],
        _flag("$.meta.complete_code_fetched").alias("complete"), _flag("$.meta.revert_flag").alias("reverted"), missing_of("$.meta", P.COMMIT_META).alias("missing"),
    )
    proof = D.examined("before", "after", "diff", "primary")
    d = d.withColumn("proof", proof)
    return d if verify else d.withColumn("proof", F.col("proof").withField("ok", F.lit(None).cast("boolean")))


def check(records: DataFrame, verify: bool = True) -> DataFrame:
    """records with findings and the columns that statistics count.

    All rules but the one of repeated diffs come before the lookup of first diffs, so that a query of findings, statistics or
    histograms moves no texts there: it takes no column that holds one.
    """
    d = derived(records, verify)
    before, after, diff, message, text, cve = (F.col(x) for x in ("before", "after", "diff", "message", "text", "cve"))
    classes = F.transform(strings_at("$.meta.cwe_classification"), lambda c: F.upper(F.trim(c)))
    cwe = F.upper(F.trim(F.coalesce(text_at("$.meta.cwe_id"), F.lit(""))))
    severity = F.upper(F.trim(F.coalesce(text_at("$.meta.severity"), F.lit(""))))
    number = ~type_at("$.meta.cvss_score").isin("STRING", "VOID", "BOOLEAN")
    cvss = F.when(number, F.try_variant_get("v", "$.meta.cvss_score", "double"))
    band = F.when(cvss >= 9, "CRITICAL").when(cvss >= 7, "HIGH").when(cvss >= 4, "MEDIUM").otherwise("LOW")
    blank = lambda k: strip(F.coalesce(text_at(f"$.meta.{k}"), F.lit(""))) == ""
    code_files = F.filter("proof.paths", lambda p: D.suffix(p).isin(*P.CODE_SUFFIXES))
    verified = F.col("proof.ok").isNotNull() & F.coalesce(F.col("complete"), F.lit(True))
    project = F.coalesce(text_at("$.meta.project_name"), F.lit(""))
    labels = F.filter(F.regexp_extract_all(text, F.lit(P.TEXT_LABEL), F.lit(1)), lambda x: x.rlike(P.CHINESE))
    fields = (("vulnerable_code", before), ("fixed_code", after), ("commit_message", message))
    leak = F.coalesce(*[F.get(F.regexp_extract_all(c, F.lit(P.PRIVATE_IP), F.lit(0)), F.lit(0)) for _, c in fields])
    masked = F.coalesce(*[F.nullif(F.regexp_extract(F.regexp_replace(c, P.UUID_FORM, ""), P.X_RUN, 0), F.lit("")) for c in (before, after)])
    short = [(_code_lines(c) > 0) & (_code_lines(c) < P.MIN_CODE_LINES) for c in (before, after)]
    has_diff = diff != ""
    first = F.substring_index(message, "\n", 1).rlike(P.REVERT_FIRST)
    why = D.trivial(diff, F.col("proof.paths"))
    other = F.array_except(F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(P.CVE_CASED), F.lit(0)), F.upper)), F.array(F.upper(cve)))
    void = text.rlike(P.CVE_VOID) | cve.rlike(P.CVE_VOID) | cve.rlike(P.CVE_VOID_ALONE)
    rules = O.collect(
        O.rule("ERROR", "structure", ~F.col("keys").eqNullSafe(F.array(*map(F.lit, P.COMMIT_KEYS))), F.array_join("keys", ",")),
        O.rule("ERROR", "required_meta", F.size("missing") > 0, F.array_join("missing", ",")),
        *[O.rule("ERROR", "code_field_absent", absent(f"$.meta.{k}"), k) for k in P.COMMIT_CODE],
        O.rule("ERROR", "cve_format", (cve != "") & ~cve.rlike(P.CVE_FORMAT), cve),
        O.rule("ERROR", "cve_status", void),
        O.rule("ERROR", "cwe_mismatch", (cwe != "") & (F.size(classes) > 0) & ~F.array_contains(classes, cwe), cwe),
        O.rule("ERROR", "severity_mismatch", (severity != "") & (cvss > 0) & (severity != band), F.concat_ws(" ", severity, cvss)),
        O.rule("ERROR", "code_note_missing", ~F.col("complete") & blank("code_note")),
        *[O.rule("ERROR", "code_polluted", F.size(_polluted(c)) > 0, F.concat(F.lit(n + ": "), F.array_join(_polluted(c), ","))) for n, c in fields[:2]],
        O.rule("ERROR", "primary_is_document", (F.col("primary") != "") & D.suffix(F.col("primary")).isin(*P.DOC_SUFFIXES) & (F.size(code_files) > 0), F.array_join(F.slice(code_files, 1, 3), ",")),
        O.rule("ERROR", "new_file_mark", before.rlike(P.NEW_FILE_MARK) | after.rlike(P.NEW_FILE_MARK)),
        O.rule("ERROR", "diff_inconsistent", verified & ~F.col("proof.ok"), F.col("proof.reason")),
        O.rule("ERROR", "text_label_language", (project != "") & ~project.rlike(P.CHINESE) & (F.size(labels) > 0), F.array_join(F.slice(labels, 1, 4), ",")),
        *[O.rule("ERROR", "pii_email", _first_email(c).isNotNull(), F.concat(F.lit(n + ": "), _first_email(c))) for n, c in fields],
        *[O.rule("ERROR", "pii_aws_key", c.rlike(P.AWS_KEY), n) for n, c in fields],
        *[O.rule("ERROR", "pii_github_token", c.rlike(P.GITHUB_TOKEN), n) for n, c in fields],
        O.rule("ERROR", "private_ip", leak.isNotNull(), leak),
        O.rule("WARN", "x_mask", masked.isNotNull(), F.length(masked)),
        O.rule("WARN", "diff_mail_header", D.mail_header(diff)),
        *[O.rule(F.when(F.col("complete"), "ERROR").otherwise("WARN"), "code_short", s, n) for s, (n, _) in zip(short, fields[:2], strict=True)],
        O.rule("WARN", "no_logic_change", has_diff & D.no_logic(diff)),
        O.rule("ERROR", "revert_flag", F.col("reverted")),
        O.rule("WARN", "revert_first_line", ~F.coalesce("reverted", F.lit(False)) & first, F.substring_index(message, "\n", 1)),
        O.rule("WARN", "revert_word", message.rlike(P.REVERT_ANY) & ~first),
        O.rule("ERROR", "trivial_diff", has_diff & why.isNotNull(), why),
    )
    late = O.collect(
        O.rule("WARN", "thin_context", F.col("proof.min_context") < 10, F.col("proof.min_context")),
        O.rule("WARN", "several_cves", F.size(other) >= 2, F.array_join(F.slice(F.array_sort(other), 1, 4), ",")),
    )
    year = F.coalesce(F.nullif(F.regexp_extract(cve, r"^CVE-(\d{4})-", 1), F.lit("")), F.nullif(F.regexp_extract(F.coalesce(text_at("$.meta.published_date"), F.lit("")), r"^(\d{4})-", 1), F.lit("")))
    m = lambda k: F.coalesce(text_at(f"$.meta.{k}"), F.lit("?"))
    d = d.withColumns({
        "_early": rules, "_late": late, "year": year.cast("int"), "no_license": blank("license"), "verified": verified, "text_has_code": contains_any(text, P.TEXT_CODE_KEYS),
        "diff_lines": F.when(has_diff, F.size(lines(F.regexp_replace(diff, r"\n\z", "")))).otherwise(0),
        "all_code": (before != "") & (after != "") & has_diff & (message != ""), "scored": F.coalesce(text_at("$.meta.cvss_score"), F.lit("")) != "", "cve_valid": cve.rlike(P.CVE_FORMAT), "proved": F.col("proof.ok"),
        "dims": F.struct(*[m(k).alias(a) for a, k in DIMENSIONS.items()]),
    })
    d = O.first_seen(d, F.when(has_diff, D.normal_sha(diff)), F.col("rid"), "file", "pos").withColumnRenamed("seen_before", "diff_of")
    again = O.collect(O.rule("ERROR", "diff_duplicate", F.col("diff_of").isNotNull(), F.col("diff_of")))
    has = lambda item: F.exists("findings", lambda f: f["item"] == item)
    return d.withColumn("findings", F.concat("_early", again, "_late")).drop("_early", "_late").withColumns({
        "incomplete": has("diff_inconsistent") | has("code_note_missing") | F.exists("findings", lambda f: (f["item"] == "code_short") & (f["level"] == "ERROR")),
        "revert_like": has("revert_flag") | has("revert_first_line") | has("revert_word") | has("trivial_diff"),
    })


def counted(checked: DataFrame) -> DataFrame:
    """What stats and histograms read of checked records; no column holds a text of theirs."""
    return checked.select("missing", "findings", "year", "no_license", "verified", "text_has_code", "incomplete", "revert_like", "diff_lines", "all_code", "scored", "cve_valid", "proved", "complete", "dims")


def throttled(findings: DataFrame, items: tuple[str, ...] = ("thin_context", "several_cves"), most: int = 30) -> DataFrame:
    """For reports: at most so many rows of the noisy items, the first by record; counts elsewhere stay exact."""
    noisy = findings.filter(F.col("item").isin(*items))
    out = findings.filter(~F.col("item").isin(*items))
    for item in items:
        out = out.unionByName(noisy.filter(F.col("item") == item).orderBy("file", "pos").limit(most))
    return out


def stats(checked: DataFrame, this_year: int) -> DataFrame:
    n = lambda c: F.count_if(c).alias
    has = lambda item: F.exists("findings", lambda f: f["item"] == item)
    return checked.agg(
        F.count("*").alias("total"), n(F.size("missing") > 0)("missing"), n(has("structure"))("structure"), n(F.col("no_license"))("no_license"), n(F.col("cve_valid"))("cve_valid"),
        n(F.col("verified") & F.col("proved"))("consistent"), n(has("diff_inconsistent"))("inconsistent"), n(F.col("proved").isNotNull() & ~F.col("verified"))("unverified"), n(F.col("text_has_code"))("text_has_code"),
        n(F.col("incomplete"))("incomplete"), n(F.col("revert_like"))("revert_like"), n(has("no_logic_change"))("no_logic"), n(has("diff_duplicate"))("diff_dup"), n(has("thin_context"))("thin_context"), n(has("several_cves"))("several_cves"),
        F.coalesce(F.sum("diff_lines"), F.lit(0)).alias("diff_lines"), n(F.col("year").isNotNull())("years"), n(F.col("year") > this_year - RECENT_YEARS)("recent"), F.min("year").alias("first_year"), F.max("year").alias("last_year"),
        n(F.col("all_code"))("all_code"), n(F.col("complete"))("complete"),
        n(has("text_label_language"))("label_language"), n(has("code_polluted") | has("new_file_mark"))("polluted"), n(F.col("scored"))("scored"),
    )


def histograms(checked: DataFrame) -> DataFrame:
    return O.histogram(checked, **{k: F.col(f"dims.{k}") for k in DIMENSIONS}, year=F.col("year")).filter("key is not null")


def gate_rows(stat: DataFrame, hist: DataFrame) -> DataFrame:
    c = F.col
    rows = O.gates(
        stat, O.ratio_gate("recent", c("recent"), c("years"), P.MIN_RECENT, at_least=True), O.any_gate("inconsistent", c("inconsistent")), O.any_gate("text_has_code", c("text_has_code")), O.any_gate("no_license", c("no_license")),
        O.ratio_gate("revert_like", c("revert_like"), c("total"), P.MAX_REVERT, some="WARN"), O.ratio_gate("incomplete", c("incomplete"), c("total"), P.MAX_INCOMPLETE, some="WARN"),
        O.ratio_gate("missing", c("missing"), c("total"), P.MAX_MISSING), O.any_gate("diff_dup", c("diff_dup")), O.any_gate("thin_context", c("thin_context"), "WARN"),
    )
    top = O.top_of(hist.filter("dim = 'language'")).crossJoin(F.broadcast(stat.select(c("total").alias("n"))))
    share = c("cnt") / c("n") * 100
    return rows.unionByName(top.select(F.lit("one_language").alias("gate"), F.when(share > P.MAX_ONE_LANGUAGE, "ERROR").otherwise("PASS").alias("level"), share.alias("value"), F.lit(P.MAX_ONE_LANGUAGE).alias("threshold"), c("cnt").alias("numer"), c("n").alias("denom")))


def info_rows(stat: DataFrame) -> DataFrame:
    """The years that the records span: value is the first, threshold the last, numer how many records have a year."""
    c = F.col
    return stat.select(F.lit("year_span").alias("gate"), F.lit("PASS").alias("level"), c("first_year").cast("double").alias("value"), c("last_year").cast("double").alias("threshold"), c("years").cast("long").alias("numer"), c("total").cast("long").alias("denom"))
