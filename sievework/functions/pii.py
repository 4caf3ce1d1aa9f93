"""Personal-data predicates and masks, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sievework.functions import patterns as P
from sievework.functions.text import contains_any, matches, starts_any


def _in(c: Column, words: tuple[str, ...]) -> Column:
    return c.isin(*words)


def blog_email_counts(value: Column) -> Column:
    """Whether an address in an article is a leak: not an example domain, mask, placeholder or bare punctuation."""
    local, domain = F.substring_index(value, "@", 1), F.lower(F.substring_index(value, "@", -1))
    harmless = _in(domain, P.EMAIL_ALLOWED) | value.rlike(P.EMAIL_MASKED) | value.rlike(P.EMAIL_SAMPLE) | local.rlike(r"^[xX×*]+$") | local.rlike(r"^[._+-]{1,3}$")
    return ~harmless


def code_email_counts(value: Column) -> Column:
    """Whether an address in a commit is a leak."""
    local, domain = F.substring_index(value, "@", 1), F.lower(F.substring_index(value, "@", -1))
    return ~(_in(domain, P.EMAIL_ALLOWED) | (local == "x") | value.rlike(P.EMAIL_MASKED))


def package_version(value: Column) -> Column:
    """name@version and image@tag: the part behind @ begins with a digit and reads like a version, not like 163.com."""
    domain = F.lower(F.substring_index(value, "@", -1))
    parts = F.split(domain, r"\.", -1)
    rest = F.array_join(F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))), ".")
    numbers = F.size(F.filter(F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))), lambda p: p.rlike(r"^\d+$")))
    return domain.rlike(r"^\d") & ((numbers >= 2) | rest.rlike(r"^[\dx.]+(?:[-~][a-z0-9.-]+)+$") | rest.rlike(r"^x(?:[.][\dx.]+)*$"))


def real_email(value: Column) -> Column:
    """Whether an address in prose looks real: no version, code or file suffix, no mask, a local part with a letter."""
    local, domain = F.substring_index(value, "@", 1), F.lower(F.substring_index(value, "@", -1))
    suffix = F.substring_index(domain, ".", -1)
    labels = F.split(domain, r"\.", -1)
    masked_ip = (F.size(labels) >= 4) & F.forall(labels, lambda x: x.rlike("^[0-9x]+$"))
    masked = (F.regexp_replace(F.lower(local), "[x.]", "") == "") | (F.replace(F.get(labels, F.lit(0)), F.lit("x"), F.lit("")) == "")
    fit = suffix.rlike("^[a-z]{2,10}$") & ~_in(suffix, P.FILE_SUFFIXES) & (F.length(local) >= 2) & local.rlike("[a-zA-Z]") & ~F.contains(local, F.lit("%"))
    return fit & ~package_version(value) & ~masked_ip & ~masked & ~_in(domain, P.EMAIL_ALLOWED)


def made_up_phone(value: Column) -> Column:
    """Constants, 555 prefixes, five equal digits of some kinds, straight runs, a tail of zeros."""
    digits = F.transform(F.sequence(F.lit(1), F.length(value)), lambda i: F.substring(value, i, F.lit(1)).cast("int"))
    steps = F.zip_with(F.slice(digits, F.lit(2), F.size(digits) - 1), F.slice(digits, F.lit(1), F.size(digits) - 1), lambda b, a: b - a)
    run = F.forall(steps, lambda s: s == 1) | F.forall(steps, lambda s: s == -1)
    return _in(value, P.CONSTANT_NUMBERS) | F.contains(F.substring(value, 2, 3), F.lit("555")) | contains_any(value, ("00000", "11111", "99999", "22222")) | run | F.endswith(value, F.lit("0000"))


def article_cards(text: Column, as_of: str) -> Column:
    """ID-card numbers in an article whose birth year is plausible and that stand outside braces."""
    brace_free = F.regexp_replace(text, r"\{[^{}]*\}", "{}")
    return F.filter(F.regexp_extract_all(brace_free, F.lit(P.ID_CARD), F.lit(0)), lambda v: F.substring(v, 7, 4).cast("int").between(1900, int(as_of[:4])))


def first_reason(*tests: tuple[str, Column]) -> Column:
    """The name of the first test that holds, empty where none does."""
    out = F
    for name, test in tests:
        out = out.when(F.coalesce(test, F.lit(False)), name)
    return out.otherwise("")


def id_card_reason(m: Column) -> Column:
    """Why a number of an ID card's form is none: province, month and day must be valid and no date, decimals or other long number near."""
    near = F.concat(F.right(m["pre"], F.lit(40)), m["value"], F.left(m["post"], F.lit(40)))
    wide = F.concat(m["pre"], m["value"], m["post"])
    others = F.filter(F.regexp_extract_all(wide, F.lit(r"(?<![0-9.])\d{15,}(?![0-9.])"), F.lit(0)), lambda o: o != m["value"])
    return first_reason(
        ("province", ~_in(F.substring(m["value"], 1, 2), P.PROVINCES)),
        ("day", ~F.substring(m["value"], 13, 2).cast("int").between(1, 31)),
        ("date or time near", near.rlike(r"\b\d{4}-\d{2}-\d{2}\b|\b\d{1,2}:\d{2}:\d{2}\b")),
        ("long number near", F.size(others) > 0),
        ("decimals near", F.regexp_count(wide, F.lit(r"(?<!\d)\d+\.\d{2,}(?!\d)")) >= 2),
    )


def id_card_matches(text: Column) -> Column:
    """Matches of the form of an ID card; contexts of plain numbers are blanked out, so offsets are those of that text."""
    return matches(F.regexp_replace(text, P.NUMBER_CONTEXT, " "), P.ID_CARD, 200)


def id_cards(text: Column) -> Column:
    """Matches of ID-card numbers in prose."""
    return F.filter(id_card_matches(text), lambda m: id_card_reason(m) == "")


def luhn(digits: Column) -> Column:
    return F.call_function("luhn_check", digits)


def bank_card_reason(m: Column, test_cards: tuple[str, ...] = P.TEST_CARDS) -> Column:
    """Why a number of a card's form is none: inside a name or literal, a plain pattern, a test number, no payment word within
    60 characters, or a wrong check digit. test_cards: published numbers that belong to nobody."""
    s, before, after = F.regexp_replace(m["value"], r"\s", ""), F.right(m["pre"], F.lit(1)), F.left(m["post"], F.lit(1))
    around = F.lower(F.concat(m["pre"], m["value"], m["post"]))
    places = F.sequence(F.lit(1), F.length(s) - 1)
    rising = F.forall(places, lambda i: F.pmod(F.substring(s, i + 1, F.lit(1)).cast("int") - F.substring(s, i, F.lit(1)).cast("int"), F.lit(10)) == 1)
    return first_reason(
        ("inside a name", before.rlike(r"(?U)[\p{L}_#\"'&:]") | after.rlike(r"(?U)[\p{L}_#\"'&:}]")),
        ("plain pattern", s.rlike(r"^(\d)\1+$") | s.rlike(r"^(\d)\1{2}(\d)\2{2}") | rising),
        ("test number", _in(s, test_cards)),
        ("no payment word", ~(around.rlike(P.PAYMENT_EN) | contains_any(around, P.PAYMENT_CN))),
        ("check digit", ~luhn(s)),
    )


def bank_cards(text: Column, test_cards: tuple[str, ...] = P.TEST_CARDS) -> Column:
    """Matches of card numbers: 13 to 19 digits that bank_card_reason has nothing against."""
    return F.filter(matches(text, P.CARD, 60), lambda m: bank_card_reason(m, test_cards) == "")


def excluded_ip(ip: Column) -> Column:
    """Addresses that need no defanging: loopback, link-local, documentation and private nets, resolvers, teaching values."""
    parts = F.transform(F.split(ip, r"\.", -1), lambda p: p.try_cast("int"))
    a, b = F.get(parts, F.lit(0)), F.get(parts, F.lit(1))
    c = F.get(parts, F.lit(2))
    invalid = (F.size(parts) != 4) | F.exists(parts, lambda p: p.isNull() | (p > 255))
    documentation = ((a == 192) & (b == 0) & (c == 2)) | ((a == 192) & (b == 2)) | ((a == 198) & (b == 51)) | ((a == 203) & (b == 0) & (c == 113)) | ((a == 203) & (b == 11))
    own = _in(a.cast("string"), ("0", "10", "127")) | ((a == 169) & (b == 254)) | ((a == 100) & b.between(64, 127)) | ((a == 172) & b.between(16, 31))
    return invalid | (F.size(F.array_distinct(parts)) == 1) | documentation | own | ((a == 8) & (b == 8)) | _in(ip, P.TEACHING_IPS)


def private_ip_reason(m: Column, own_network: Column) -> Column:
    """Why a private address needs no masking; own_network: whether the text speaks of the writer's own network."""
    near = F.lower(F.concat(F.right(m["pre"], F.lit(30)), m["value"], F.left(m["post"], F.lit(30))))
    return first_reason(
        ("own network", own_network),
        ("part of a name", F.left(m["post"], F.lit(1)).rlike(r"^[_\-/.]$")),
        ("inline code", F.right(m["pre"], F.lit(1)) == "`"),
        ("documentation net", starts_any(m["value"], P.DOC_NETS) | _in(m["value"], P.DOC_IPS)),
        ("example", near.rlike(P.EXAMPLE_WORDS)),
    )


def private_ips(text: Column) -> Column:
    """Matches of private addresses in prose, less file names, inline code, documentation nets and talk of one's own network."""
    own = contains_any(F.lower(text), P.OWN_NETWORK)
    return F.filter(matches(text, P.QA_PRIVATE_IP, 120), lambda m: private_ip_reason(m, own) == "")


def social_masked(value: Column) -> Column:
    core = F.regexp_replace(F.regexp_replace(value, P.SOCIAL_KEY, ""), r"^\d+|\d+$", "")
    return core.rlike("^x+$")


def social_accounts(text: Column) -> Column:
    return F.filter(F.regexp_extract_all(text, F.lit(P.SOCIAL), F.lit(0)), lambda v: ~social_masked(v))


def mask(kind: Column, value: Column) -> Column:
    """email keeps its domain, phone 3 + 2 digits, id 6 + 4, card 4 + 4; all else is replaced."""
    digits = F.regexp_replace(value, r"\D", "")

    def kept(head: int, tail: int) -> Column:
        middle = F.repeat(F.lit("X"), F.greatest(F.length(digits) - head - tail, F.lit(0)))
        return F.when(F.length(digits) >= head + tail, F.concat(F.left(digits, F.lit(head)), middle, F.right(digits, F.lit(tail)))).otherwise(F.lit("X" * (head + tail)))

    email = F.when(F.instr(value, "@") > 1, F.concat(F.lit("xxxxxx@"), F.substring_index(value, "@", -1))).otherwise("xxxxxx")
    return F.when(kind == "email", email).when(kind == "phone", kept(3, 2)).when(kind == "id_card", kept(6, 4)).when(kind == "bank_card", kept(4, 4)).otherwise("xxxxxx")


def mask_ip(ip: Column) -> Column:
    return F.when(F.size(F.split(ip, r"\.")) == 4, F.concat(F.substring_index(ip, ".", 2), F.lit(".x.x"))).otherwise(F.replace(ip, F.lit("."), F.lit("x.")))


def mask_social(value: Column) -> Column:
    core = F.regexp_replace(value, P.SOCIAL_KEY, "")
    n = F.length(core)
    digits = F.when(n >= 5, F.concat(F.left(core, F.lit(3)), F.repeat(F.lit("x"), n - 5), F.right(core, F.lit(2)))).otherwise(F.repeat(F.lit("x"), n))
    masked = F.when(core.rlike(r"^\d+$"), digits).otherwise(F.repeat(F.lit("x"), F.greatest(n, F.lit(5))))
    return F.when(social_masked(value), value).otherwise(F.replace(value, core, masked))
