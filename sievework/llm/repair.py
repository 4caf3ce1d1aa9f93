"""Conversation structure repair by a dynamic programme over a prefix trie of role and fault signatures.

A conversation's rows in order become a signature of one sign a row: the role's initial (`s`, `u`, `a`, `x` for any other), a
capital if the row is truncated, `-` if it is blank or a duplicate and must go. The cheapest edits depend on the signature alone.
The distinct signatures are sorted over partitions of ranges; within one, a walk keeps the path from the trie's root to the
signature at hand, so a prefix shared with the signature before has its layers already and each is computed once. A layer holds,
for each state of the role grammar `(s?(ua)+)?`, the cost, where it came from and by which edits, and the rank of its edits among
the states by ASCII order. Inserts go in front of the row that needs them or to the end, so two edit strings of a layer never are
prefixes of each other and their order can't change later; ranks therefore replace the strings. A terminal node reads its edits back.

Edits: Keep 0, Rerole to user or assistant 1, Delete 2, Insert an empty user or assistant turn 5; a truncated row that stays adds 5.

Order: rows by turn (NULL first), then role and text. Duplicates: of equal role and text the first stays. Texts stream through sorted partitions, once for the signatures, once for the digests. What a
conversation gathers is its signature and its edits, one character a row, which is what `audit` returns; a digest over a whole
dialogue is made in order, so a conversation is one stream, while signatures and copies of conversations are no hot keys.

Defined results: NULL in conv_id, turn, role or text counts as one space in damage and texts; conversations of NULL conv_id
are one, returned as NULL; turns that are NULL come first. A role without an initial, or another initial than s, u or a, can't be kept.
A repeated row is a duplicate. A conversation all of whose rows are dropped has zeros, an empty audit and the digest of the empty
string. Very long texts pass row by row. Other columns are not read. Empty tables give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from sievework.llm.common import release_memory, small_batches, written

#: What isn't white space, and what ends a sentence; fixed values.
VISIBLE, ENDS = r"[^\x20\x09-\x0D]", "[.!?]"
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: Signatures of at most so many characters in all may be broadcast with their answers; more are joined by shuffle.
BROADCAST_CHARS = 64_000_000
#: States of the grammar: nothing yet, after the system turn, after a user turn, after an assistant turn; where it may end.
START, SYSTEM, USER, ASSISTANT = range(4)
STEPS = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
FINAL = (START, ASSISTANT)
ROLES = {"u": "user", "a": "assistant"}


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) after the damage that crc32 of `conv_id:turn` decides: drop, empty, unpunctuate, repeat, mistake the role."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn")).cast("binary")) % 20
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace(blank("text"), ENDS, "")).otherwise(blank("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(blank("role"))
    rows = conversations.select("conv_id", "turn", "role", "text", kind.alias("kind")).filter("kind <> 0")
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1))).alias("copy")).drop("copy")


def signed(rows: DataFrame) -> DataFrame:
    """rows (conv_id, turn, role, text) with seen (the how-manieth of its role and text), fault (blank, duplicate, truncated or NULL) and sign."""
    copies = Window.partitionBy("conv_id", "role", F.xxhash64("text"), "text").orderBy(F.col("turn").asc_nulls_first())
    last = F.regexp_extract("text", rf"({VISIBLE})[\x20\x09-\x0D]*\z", 1)
    fault = F.when(last == "", "blank").when(F.col("seen") > 1, "duplicate").when(~last.rlike(ENDS), "truncated")
    initial = F.substring("role", 1, 1)
    sign = F.when(initial.isin("s", "u", "a"), initial).otherwise("x")
    return rows.withColumn("seen", F.row_number().over(copies)).withColumn("fault", fault).withColumn("sign", F.when(F.col("fault").isin("blank", "duplicate"), "-").when(F.col("fault") == "truncated", F.upper(sign)).otherwise(sign))


Layer = list[tuple[int, int, str, int] | None]
ROOT: Layer = [(0, START, "", 0), None, None, None]


def _widened(layer: Layer) -> list[tuple[int, int, str]]:
    """(state, from, inserts) of every state reached from a layer by at most two inserts; further inserts only come back."""
    found = [(q, q, "") for q in range(4) if layer[q]]
    for q, start, inserts in found:
        found += [(STEPS[q, r], start, inserts + "I") for r in "ua" if (q, r) in STEPS and len(inserts) < 2]
    return found


def _best(layer: Layer, options: Iterable[tuple[int, int, int, str]]) -> Layer:
    """The cheapest options (state, cost beyond the layer, from, edits) of each state; ties go to the ASCII-least edits."""
    best: dict[int, tuple[int, int, str, int]] = {}
    for q, cost, start, edits in options:
        one = (layer[start][0] + cost, layer[start][3], edits, start)
        if q not in best or one < best[q]:
            best[q] = one
    order = {q: rank for rank, q in enumerate(sorted(best, key=lambda q: best[q][1:3]))}
    return [(best[q][0], best[q][3], best[q][2], order[q]) if q in best else None for q in range(4)]


def next_layer(layer: Layer, sign: str) -> Layer:
    """The layer after one more row."""
    options = [(q, DELETE, q, "D") for q in range(4) if layer[q]]
    if sign != "-":
        role, more = sign.lower(), TRUNCATED if sign.isupper() else 0
        for q, start, inserts in _widened(layer):
            cost = INSERT * len(inserts) + more
            if (q, role) in STEPS:
                options.append((STEPS[q, role], cost, start, inserts + "K"))
            options += [(STEPS[q, r], cost + REROLE, start, inserts + "R") for r in ROLES if (q, r) in STEPS]
    return _best(layer, options)


def answer(path: list[Layer]) -> tuple[int, str]:
    """Cost and edits of the signature whose layers the path holds."""
    ends = [(path[-1][start][0] + INSERT * len(inserts), path[-1][start][3], inserts, start) for q, start, inserts in _widened(path[-1]) if q in FINAL]
    # Equal ranks mean one state, where fewer inserts are the prefix and so the lesser.
    cost, _, tail, q = min(ends)
    edits = [tail]
    for layer in reversed(path[1:]):
        _, start, done, _ = layer[q]
        edits.append(done)
        q = start
    return cost, "".join(reversed(edits))


def trie_answers(signatures: Iterable[str]) -> Iterator[tuple[str, int, str]]:
    """(signature, cost, audit) of sorted signatures; layers of the prefix shared with the one before stay."""
    path, before = [ROOT], ""
    for signature in signatures:
        shared, most = 0, min(len(signature), len(before))
        while shared < most and signature[shared] == before[shared]:
            shared += 1
        del path[shared + 1 :]
        for sign in signature[shared:]:
            path.append(next_layer(path[-1], sign))
        before = signature
        yield signature, *answer(path)


def solved(signatures: DataFrame) -> DataFrame:
    """(signature, cost, audit) of distinct signatures, each range of the sorted signatures in a task of its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signs = (s for batch in batches for s in batch.column(0).to_pylist())
        yield from _batches(trie_answers(signs), ["signature", "cost", "audit"], [pa.string(), pa.int64(), pa.string()])
        release_memory()

    ranged = signatures.repartitionByRange("signature").sortWithinPartitions("signature")
    return ranged.mapInArrow(run, "signature string, cost bigint, audit string")


def _streamed(rows: DataFrame, of: list[str], scan, schema: str) -> DataFrame:
    """scan over the rows of each partition in the order of conversation, turn, role, text and seen; a conversation never is in two partitions."""
    at = [F.col("turn").asc_nulls_first(), "role", "text", "seen"]
    placed = rows.repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), *of, *at)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from scan(row for batch in small_batches(batches) for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        release_memory()

    return placed.mapInArrow(run, schema)


def _batches(results: Iterable[tuple], names: list[str], types: list[pa.DataType]) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for result in results:
        held.append(result)
        if len(held) == 256:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), types, strict=True)], names)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), types, strict=True)], names)


def _signatures(rows: Iterable[tuple]) -> Iterator[tuple]:
    """(conv_id, signature, initials that may not follow each other) of rows (conv_id, turn, role, text, seen, sign) in order."""
    conv, signs, illegal, last = None, None, 0, None
    for conv_id, _, role, _, _, sign in rows:
        if signs is None or conv_id != conv:
            if signs is not None:
                yield conv, "".join(signs), illegal
            conv, signs, illegal, last = conv_id, [], 0, None
        signs.append(sign)
        if last is not None and last + role[:1] not in ("su", "ua", "au"):
            illegal += 1
        last = role[:1]
    if signs is not None:
        yield conv, "".join(signs), illegal


class _Repaired:
    """The digest of a repaired dialogue, made turn by turn from its edits."""

    def __init__(self, audit: str) -> None:
        self.audit, self.at, self.state, self.digest, self.first = audit, 0, START, hashlib.sha256(), True

    def say(self, role: str, text: str) -> None:
        self.digest.update(("" if self.first else "\n").encode() + f"{role}:{text}".encode("utf-8", "surrogatepass"))
        self.first = False

    def inserts(self) -> None:
        while self.audit[self.at : self.at + 1] == "I":
            self.at += 1
            self.say(self.stepped("a" if self.state == USER else "u"), "")

    def stepped(self, sign: str) -> str:
        self.state = STEPS[self.state, sign]
        return ROLES.get(sign, "system")

    def row(self, role: str, text: str) -> None:
        self.inserts()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self.stepped(role[:1])
            self.say(role, text)
        elif edit == "R":
            self.say(self.stepped("a" if self.state == USER else "u"), text)

    def end(self) -> str:
        self.inserts()
        return self.digest.hexdigest()


def _digests(rows: Iterable[tuple]) -> Iterator[tuple]:
    """(conv_id, digest) of rows (conv_id, turn, role, text, seen, audit) in order; a conversation's first has its edits and is no turn."""
    conv, now = None, None
    for conv_id, _, role, text, _, audit in rows:
        if audit is not None:
            if now:
                yield conv, now.end()
            conv, now = conv_id, _Repaired(audit)
        else:
            now.row(role, text)
    if now:
        yield conv, now.end()


def repaired(rows: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of rows (conv_id, turn, role, text)."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    arrow = to_arrow_type(rows.schema["conv_id"].dataType)
    base = written(signed(rows))
    signs = written(
        _streamed(
            base.select("conv_id", "turn", "role", "text", "seen", "sign"), [],
            lambda r: _batches(_signatures(r), ["conv_id", "signature", "illegal"], [arrow, pa.string(), pa.int64()]), f"conv_id {kind}, signature string, illegal bigint",
        )
    )
    distinct = written(solved(signs.select("signature").distinct()))
    chars = distinct.agg(F.coalesce(F.sum(F.length("signature") + F.length("audit")), F.lit(0))).first()[0]
    edits = written(signs.join(F.broadcast(distinct) if chars <= BROADCAST_CHARS else distinct, "signature").select("conv_id", "illegal", "cost", "audit"))
    heads = edits.select("conv_id", F.lit(None).cast(rows.schema["turn"].dataType).alias("turn"), F.lit("").alias("role"), F.lit("").alias("text"), F.lit(0).alias("seen"), "audit")
    turns = base.select("conv_id", "turn", "role", "text", "seen", F.lit(None).cast("string").alias("audit"))
    first = F.when(F.col("audit").isNull(), 1).otherwise(0)
    digests = _streamed(
        heads.unionByName(turns), [first], lambda r: _batches(_digests(r), ["conv_id", "repaired_sha256"], [arrow, pa.string()]), f"conv_id {kind}, repaired_sha256 string"
    )
    turn = F.col("turn").cast("long")
    counts = base.groupBy("conv_id").agg(
        F.coalesce(F.max(turn) - F.min(turn) + 1 - F.count_distinct(turn), F.lit(0)).alias("gaps"),
        *[F.count_if(F.coalesce(F.col("fault") == f, F.lit(False))).alias(f) for f in ("blank", "duplicate", "truncated")],
    )
    found = counts
    for part in (edits.withColumnRenamed("conv_id", "c1"), digests.withColumnRenamed("conv_id", "c2")):
        found = found.join(part, found["conv_id"].eqNullSafe(part[part.columns[0]])).drop(part.columns[0])
    return found.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def report(conversations: DataFrame) -> DataFrame:
    """repaired() of the damaged conversations, with a row for each conversation of which no row is left."""
    done = repaired(damaged(conversations))
    all_ids = conversations.select(F.col("conv_id").alias("id")).distinct()
    rows = all_ids.join(done, all_ids["id"].eqNullSafe(done["conv_id"]), "left")
    zero = {c: F.coalesce(F.col(c), F.lit(0).cast("long")) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    return rows.select(
        F.col("id").alias("conv_id"), *[v.alias(k) for k, v in zero.items()], F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256")
    )


def _least(*options: tuple[int, str, str, str]) -> str:
    """SQL for the least (cost, edits) among states of the layer before, with cost and edits added under a condition."""
    each = ", ".join(f"CASE WHEN b{q} IS NOT NULL AND {when} THEN {{'c': b{q}.c + {cost}, 't': b{q}.t || '{edits}'}} END" for q, cost, edits, when in options)
    return f"list_min(list_filter([{each}], lambda o: o IS NOT NULL))"


def _into(states: tuple[int, ...], via: int, role: str) -> list[tuple[int, str, str, str]]:
    """Keeping or reroling a row from these states, and from `via` after an insert."""
    direct = [(q, "0", "") for q in states] + [(q, "5", "I") for q in ((via,) if role == "u" else (START, SYSTEM, ASSISTANT))]
    stays = [(q, f"{n} + late", e + "K", f"sign = '{role}'") for q, n, e in direct]
    return stays + [(q, f"{n} + late + 1", e + "R", "sign <> '-'") for q, n, e in direct]


_CRC = "xor(list_reduce(list_prepend(4294967295, list_transform(string_split(key, ''), lambda c: ascii(c)::BIGINT)), lambda x, b: list_reduce(list_prepend(xor(x, b), range(8)), lambda y, _: xor(y >> 1, 3988292384 * (y & 1)))), 4294967295)"
ORACLE = rf"""
WITH RECURSIVE o AS MATERIALIZED (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations),
k AS MATERIALIZED (SELECT *, {_CRC} % 20 AS kind FROM o),
d AS (SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
  unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM k),
n AS MATERIALIZED (SELECT conv_id, turn, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS seen,
  regexp_extract(text, '([^ 	-
])[ 	-
]*$', 1) AS last FROM d),
f AS MATERIALIZED (SELECT *, CASE WHEN last = '' THEN 'blank' WHEN seen > 1 THEN 'duplicate' WHEN last NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault, role[1] AS initial FROM n),
s AS MATERIALIZED (SELECT conv_id, i, CASE WHEN fault IN ('blank', 'duplicate') THEN '-' WHEN initial IN ('s', 'u', 'a') THEN initial ELSE 'x' END AS sign, CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END AS late FROM f),
p(conv_id, i, b0, b1, b2, b3) AS (
  SELECT conv_id, 0::BIGINT, {{'c': 0, 't': ''}}, NULL::STRUCT(c INTEGER, t VARCHAR), NULL::STRUCT(c INTEGER, t VARCHAR), NULL::STRUCT(c INTEGER, t VARCHAR) FROM (SELECT DISTINCT conv_id FROM f)
  UNION ALL SELECT p.conv_id, s.i, {_least((0, "2", "D", "true"))}, {_least((1, "2", "D", "true"), (0, "late", "K", "sign = 's'"))},
    {_least((2, "2", "D", "true"), *_into((0, 1, 3), 2, "u"))}, {_least((3, "2", "D", "true"), *_into((2,), 0, "a"))}
  FROM p JOIN s ON s.conv_id IS NOT DISTINCT FROM p.conv_id AND s.i = p.i + 1),
z AS MATERIALIZED (SELECT conv_id, {_least((0, "0", "", "true"), (3, "0", "", "true"), (2, "5", "I", "true"), (1, "10", "II", "true"))} AS best FROM p
  WHERE (SELECT max(i) FROM s WHERE s.conv_id IS NOT DISTINCT FROM p.conv_id) = p.i),
e AS (SELECT conv_id, j, e, count(*) FILTER (e <> 'I') OVER w AS i, count(*) FILTER (e <> 'D') OVER w AS m FROM (SELECT conv_id, unnest(string_split(best.t, '')) AS e, generate_subscripts(string_split(best.t, ''), 1) AS j FROM z WHERE best.t <> '')
  WINDOW w AS (PARTITION BY conv_id ORDER BY j)),
g AS (SELECT e.*, f.role, f.text, coalesce(bool_or(m = 1 AND e = 'K' AND initial = 's') OVER (PARTITION BY e.conv_id), false) AS led FROM e LEFT JOIN f ON f.conv_id IS NOT DISTINCT FROM e.conv_id AND f.i = e.i AND e.e <> 'I'),
h AS (SELECT conv_id, string_agg(CASE WHEN e = 'K' THEN role WHEN (m - led::INT) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || coalesce(text, ''), chr(10) ORDER BY j) AS whole FROM g WHERE e <> 'D' GROUP BY conv_id),
c AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
  count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM (SELECT *, lag(initial) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM f) GROUP BY conv_id)
SELECT a.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best.c, 0)::BIGINT AS cost,
  coalesce(best.t, '') AS audit, sha256(coalesce(whole, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a LEFT JOIN c ON c.conv_id IS NOT DISTINCT FROM a.conv_id LEFT JOIN z ON z.conv_id IS NOT DISTINCT FROM a.conv_id LEFT JOIN h ON h.conv_id IS NOT DISTINCT FROM a.conv_id
"""
