"""Whether an e-mail address or a phone number in prose belongs to a person, by its value and by what stands around it.

The rules look at neighbouring characters, tokens and windows at each hit, and hits are rare, so one Arrow-batched function
gives every hit of a text its reason to be excused. Texts without a hit aren't sent to Python.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.functions import contact_values as V
from sievework.functions import patterns as P
from sievework.functions import pii
from sievework.functions.text import matches

_rx = {name: re.compile(getattr(V, name)) for name in dir(V) if name.isupper() and isinstance(getattr(V, name), str) and name != "CODE_MARKS"}
for _name in ("RESOURCE_LABEL", "CODE_TOKEN", "PHONE_EXPONENT"):
    _rx[_name] = re.compile(getattr(V, _name), re.IGNORECASE)
_CAMEL = re.compile(r"[a-z][A-Z]")


@dataclass
class Hit:
    """A value at its place, with the views that rules look at."""

    text: str
    start: int
    end: int

    @property
    def value(self) -> str:
        return self.text[self.start : self.end]

    def before(self, n: int) -> str:
        return self.text[max(0, self.start - n) : self.start]

    def after(self, n: int) -> str:
        return self.text[self.end : self.end + n]

    @property
    def sides(self) -> tuple[str, str]:
        """The characters next to the value; a blank at the ends of the text."""
        return self.before(1) or " ", self.after(1) or " "

    @property
    def tokens(self) -> tuple[str, str]:
        """The nearest runs without white space before and after; the one before lacks its last character, as the rule has it."""
        left, right = self.text[: self.start].rsplit(None, 1), self.text[self.end :].split(None, 1)
        return (left[-1][:-1] if left else ""), (right[0] if right else "")

    def window(self, left: int, right: int) -> str:
        return self.text[max(0, self.start - left) : self.end + right]


def filler_local(local: str) -> bool:
    """Whether every part of a local name is a placeholder word, with digits or without, or there is nothing but digits and marks."""
    if re.fullmatch(r"[.\-_+0-9]+", local):
        return True
    parts = [p.strip() for p in re.split(r"[.\-_+]", local.lower())]
    return all(p in V.FILLER_WORDS or p.rstrip("0123456789") in V.FILLER_WORDS for p in parts if p)


def _service_domain(domain: str) -> bool:
    labels = domain.split(".")
    return any(".".join(labels[i:]) in V.SERVICE_DOMAINS for i in range(len(labels)))


#: Reasons that an address's value gives, each a test of (local, domain as written, domain, first label).
ADDRESS_RULES: tuple[tuple[str, Callable[[str, str, str, str], bool]], ...] = (
    ("public address", lambda local, raw, dom, head: f"{local.lower()}@{dom}" in V.PUBLIC_ADDRESSES),
    ("upper-case domain", lambda local, raw, dom, head: raw.isupper() and len(raw) > 3),
    ("placeholder", lambda local, raw, dom, head: local.lower() in V.PLACEHOLDER_LOCALS or dom in V.PLACEHOLDER_DOMAINS or head in V.PLACEHOLDER_FIRST),
    ("internal domain", lambda local, raw, dom, head: dom.endswith(tuple(V.INTERNAL_SUFFIXES))),
    ("long local part", lambda local, raw, dom, head: len(local) > V.LONGEST_LOCAL),
    ("service local part", lambda local, raw, dom, head: local.lower() in V.SERVICE_LOCALS or local.lower().startswith(V.GENERATED_PREFIXES)),
    ("code reference", lambda local, raw, dom, head: local.endswith(".") or local.lower() in V.EXPRESSION_WORDS or bool(_CAMEL.search(local))),
    ("algorithm", lambda local, raw, dom, head: bool(_rx["CRYPTO_LOCAL"].match(local.lower())) or any(w in local.lower() for w in V.CRYPTO_WORDS)),
    ("short code", lambda local, raw, dom, head: local.isupper() and local.isalpha() and 2 <= len(local) <= 6),
    ("number", lambda local, raw, dom, head: local.replace(".", "").isdigit() or bool(re.fullmatch(r"[0-9a-fA-F]{16,}", local))),
    ("service domain", lambda local, raw, dom, head: _service_domain(dom)),
    ("list or meeting", lambda local, raw, dom, head: bool(_rx["LIST_NAME"].match(head)) or head == "conference"),
    ("invented name", lambda local, raw, dom, head: bool(_rx["FICTIONAL_LOCAL"].match(local)) or filler_local(local)),
    ("template", lambda local, raw, dom, head: bool(_rx["PLACEHOLDER_DOMAIN_HEAD"].match(head) or _rx["TEMPLATE_LOCAL"].match(local))),
)


def address_reason(value: str) -> str:
    """Why an address belongs to nobody, by its value; empty if it may be a person's."""
    local, raw = value.split("@")[0], value.split("@")[-1]
    dom = raw.lower()
    if dom.rsplit(".", 1)[-1] in V.CODE_SUFFIXES:
        return "code suffix"
    return next((name for name, test in ADDRESS_RULES if test(local, raw, dom, dom.split(".")[0])), "")


def address_context(hit: Hit) -> str:
    """Why an address at its place is an example, a field or a piece of code; empty if it may be a person's."""
    before, after = hit.sides
    if before in "\"'(<[{@:;=#|,>" and (before != ">" or after == "<") or after in "\"'>)]}/:;#|,":
        return "delimited"
    if hit.before(2).strip().endswith("|") or hit.after(2).strip().startswith("|"):
        return "table cell"
    if _rx["MAIL_HEADER_END"].search(hit.before(14)):
        return "header field"
    around = hit.window(46, 24)
    return "cue" if _rx["EMAIL_CUE"].search(around) else "code around" if _rx["EMAIL_CODE"].search(around) else ""


def number_context(hit: Hit) -> str:
    """Why a number at its place is no phone number, as a number in code or data."""
    before, after = hit.sides
    if before in V.CODE_MARKS or after in V.CODE_MARKS:
        return "code mark"
    for token in hit.tokens:
        if token.isdigit():
            return "number beside"
        if _rx["CODE_TOKEN"].search(token):
            return "code beside"
    return ""


def _other_numbers(hit: Hit) -> list[str]:
    return [n for n in _rx["PHONE_NUMBER"].findall(hit.window(40, 40)) if n != hit.value]


#: Reasons of syntax around a phone number.
PHONE_RULES: tuple[tuple[str, Callable[[Hit], bool]], ...] = (
    ("part of a name", lambda h: any(c.isalpha() or c == "_" for c in h.sides)),
    ("signed", lambda h: h.sides[0] in "-+"),
    ("hexadecimal beside", lambda h: any(_rx["PHONE_HEX"].fullmatch(t) for t in h.tokens)),
    ("assigned", lambda h: bool(_rx["PHONE_ASSIGNED"].search(h.before(14)) or _rx["PHONE_JSON"].search(h.before(14)))),
    ("table cell", lambda h: bool(_rx["PHONE_CELL_BEFORE"].search(h.before(14)) or _rx["PHONE_CELL_AFTER"].search(h.after(14)))),
    ("operator", lambda h: bool(_rx["PHONE_OPERATOR"].search(h.window(40, 40)))),
    ("identifier", lambda h: bool(_rx["PHONE_IDENTIFIER"].search(h.window(40, 40)))),
    ("example", lambda h: bool(_rx["PHONE_EXAMPLE"].search(h.window(40, 40)))),
    ("resource", lambda h: bool(_rx["PHONE_RESOURCE"].search(h.window(40, 40)))),
    ("decimal", lambda h: bool(_rx["PHONE_DECIMAL"].search(h.window(40, 40)))),
    ("date or time", lambda h: bool(_rx["PHONE_DATE"].search(h.window(40, 40)) or _rx["PHONE_TIME"].search(h.window(40, 40)))),
    ("hexadecimal", lambda h: bool(_rx["PHONE_HEX"].search(h.window(40, 40))) or "0x" in h.window(40, 40).lower()),
    ("exponent", lambda h: bool(_rx["PHONE_EXPONENT"].search(h.window(40, 40)))),
    ("backtick", lambda h: "`" in h.sides),
    ("shell", lambda h: bool(_rx["PHONE_SHELL"].search(h.before(14)))),
    ("long number", lambda h: any(len(n) >= 12 for n in _other_numbers(h))),
    ("several numbers", lambda h: len(_other_numbers(h)) >= 2),
)


def phone_reason(hit: Hit) -> str:
    """Why a number that looks like a phone number belongs to nobody; empty if it may be a person's."""
    if hit.value[1:4] in V.NOT_MOBILE:
        return "service prefix"
    if _rx["RESOURCE_LABEL"].match(hit.after(60)):
        return "resource label"
    return number_context(hit) or next((name for name, test in PHONE_RULES if test(hit)), "")


def reasons(text: str, values: list[str], starts: list[int], kind: str) -> list[str]:
    """The reason of each hit, empty where none excuses it."""
    hits = [Hit(text, s, s + len(v)) for v, s in zip(values, starts, strict=True)]
    return [phone_reason(h) for h in hits] if kind == "phone" else [address_reason(h.value) or address_context(h) for h in hits]


def _judge(kind: str) -> Callable[..., Column]:
    @F.pandas_udf("array<string>")
    def judge(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, values, starts in batches:
            yield pd.Series([[] if t is None or v is None else reasons(t, list(v), list(s), kind) for t, v, s in zip(texts, values, starts, strict=True)])

    return judge


def judged(df: DataFrame, text: str) -> DataFrame:
    """df with emails and phones, arrays of struct<hit<value,start,pre,post>,why> of all that look so in a text column.

    why is empty for a hit that nothing excuses. Only texts with a hit whose value alone doesn't excuse it go to Python.
    """
    c = F.col(text)
    plain = {"emails": (P.EMAIL, "not a real address", pii.real_email), "phones": (P.PHONE, "made up", lambda v: ~pii.made_up_phone(v))}
    # The hits are columns of their own below the Python function, which takes plain columns only.
    hits = df.withColumns({f"_{k}": matches(c, rx) for k, (rx, _, _) in plain.items()})
    fitting = lambda k, fine: F.filter(f"_{k}", lambda m: fine(m["value"]))
    hits = hits.withColumns({f"_{k}_open": fitting(k, fine) for k, (_, _, fine) in plain.items()})
    some = {k: F.size(f"_{k}_open") > 0 for k in plain}
    why = {f"_{k}_why": _judge(kind)(F.when(some[k], c), F.when(some[k], F.col(f"_{k}_open")["value"]), F.when(some[k], F.col(f"_{k}_open")["start"])) for k, kind in (("emails", "email"), ("phones", "phone"))}
    told = hits.withColumns(why)

    def named(k: str, excuse: str, fine: Callable[[Column], Column]) -> Column:
        # The function's result stays outside of lambdas, where it couldn't be taken out again.
        asked = F.transform(F.arrays_zip(F.col(f"_{k}_open").alias("hit"), F.coalesce(f"_{k}_why", F.array().cast("array<string>")).alias("why")), lambda x: F.struct(x["hit"].alias("hit"), x["why"].alias("why")))
        return F.concat(asked, F.transform(F.filter(f"_{k}", lambda m: ~fine(m["value"])), lambda m: F.struct(m.alias("hit"), F.lit(excuse).alias("why"))))

    return told.withColumns({k: named(k, excuse, fine) for k, (_, excuse, fine) in plain.items()}).drop(*[f"_{k}{x}" for k in plain for x in ("", "_open", "_why")])


def with_personal(df: DataFrame, text: str) -> DataFrame:
    """df with emails and phones, arrays of the hits (value, start, pre, post) in a text column that nothing excuses."""
    own = {k: F.transform(F.filter(k, lambda x: x["why"] == ""), lambda x: x["hit"]) for k in ("emails", "phones")}
    return judged(df, text).withColumns(own)


def configured_ip(m: Column) -> Column:
    """Whether configuration or diagnosis stands within 120 characters of a private address."""
    return F.lower(F.concat(m["pre"], m["value"], m["post"])).rlike(V.IP_CONFIGURATION)
