"""Distribution divergence, conversation repair and ranked search against brute force."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sievework.llm import divergence, ranked, repair
from sievework.llm.queries import ORACLE_SQL, QUERIES

DOCS = "doc_id long, text string, lang string, source string"


@pytest.mark.parametrize("name", ["op11_ranked", "op12_divergence", "op13_repair"])
def test_query_matches_its_oracle(same_rows, name):
    same_rows(QUERIES[name], ORACLE_SQL[name])


def counted(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) by plain Python."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    inside = {j for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside)


def test_base_rules_of_odd_texts(spark):
    rng = random.Random(1)
    texts = [None, "", " \t\n", "a", "a b c d e", "a b c d e a b c d e", "x x x x x x", "a\n\na\n b\n b\nb", "\x1f is no blank nor this", "# $ | <b> 100%", "ü😀 ñ\r\nü😀 ñ", "a.b a.b " * 40]
    texts += [rng.choice([" ", "\n", "  ", "\t"]).join(rng.choice("abc") for _ in range(rng.randint(1, 60))) for _ in range(60)]
    rows = [(i, t, None, None) for i, t in enumerate(texts)] + [(500, " ".join(f"w{i}" for i in range(60_000)), "long", None), (3, "a", None, None), (None, "a b", "en", None)]
    got = sorted((repr(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept) for r in divergence.report(spark.createDataFrame(rows, DOCS).repartition(3)).collect())
    want = []
    for i, t, _, _ in rows:
        c = counted(t)
        failed = c[0] < 10 or 100 * c[4] > 20 * c[0]
        want.append((repr(i), *c, failed, not failed))
    assert got == sorted(want)


def test_windows_are_hashed_in_one_pass(spark):
    """Windows come from the hashes of their words at once, and the second 64 bits only for those found twice: no arrays are zipped but for their steps."""
    plan = spark.createDataFrame([], "words array<string>").select(divergence.repeated_words(F.col("words")).alias("n"))._jdf.queryExecution().analyzed().toString()
    assert len(re.findall("zip_?with[(]", plan)) == 1


def jensen_shannon(p, q):
    p, q = ([x / sum(v) for x in v] for v in (p, q))
    part = lambda a, b: a * math.log2(2 * a / (a + b)) if a else 0.0
    return sum(part(a, b) + part(b, a) for a, b in zip(p, q, strict=True)) / 2


def test_distances_against_plain_python(spark):
    """Two languages and one of NULL; one has too few words for references; text of another language and noise are told apart."""
    rng = random.Random(2)
    words = {"x": ["the", "of", "a|b", "$$", "cat", "Dog"], None: ["der", "die", "das", "und", "hund"], "few": ["one", "two"]}
    text = lambda lang, n: " ".join(rng.choice(words[lang]) + rng.choice(["", ".", ",", ")"]) for _ in range(n))
    rows = [(i, text(lang, 80), lang, "s") for i, lang in enumerate(["x"] * 150 + [None] * 140 + ["few"] * 3)]
    rows += [(900, text("x", 90), None, "s"), (901, "#### $$$ %%% " * 40, "x", "s"), (902, text("x", 30), "x", "s"), (903, None, "x", "s"), (904, "one two three four five six seven eight nine ten eleven", "new", "s")]
    docs = spark.createDataFrame(rows, DOCS).withColumnRenamed("source", "measures")
    refs = divergence.references(docs)
    out, name = divergence.measured(docs, refs)
    assert name == "_measures" and out.columns == [*docs.columns, name]
    got = {r.doc_id: r[name] for r in out.collect()}
    said = lambda t: re.findall(r"[^\x20\x09-\x0D.,;:!?'\"()-]+", (t or "").lower())
    classes = ["[a-z]", "[A-Z]", "[0-9]", r"[\x20\x09-\x0D]", r"[.,;:!?'\"()-]", r"[#*$%&|<>]", r"[\u0080-ɏ]"]

    def signs(t):
        counts = [len(re.findall(c, t or "")) for c in classes]
        return [*counts, len(t or "") - sum(counts)]

    for lang in ("x", None, "few", "new"):
        mine = [r for r in rows if r[2] == lang]
        total = Counter(w for r in mine for w in said(r[1]))
        n = sum(total.values())
        common = sorted((w for w in total if total[w] >= n * divergence.COMMON_SHARE), key=lambda w: (-total[w], w))[: divergence.COMMON]
        ref_words = [*(total[w] for w in common), n - sum(total[w] for w in common)]
        ref_signs = [sum(x) for x in zip(*(signs(r[1]) for r in mine), strict=True)]
        for i, t, _, _ in mine:
            far = other = None
            if n >= divergence.LANGUAGE_WORDS:
                c = Counter(said(t))
                k = sum(c.values())
                own = [*(c[w] for w in common), k - sum(c[w] for w in common)]
                if k >= divergence.LEAST_WORDS:
                    other = math.sqrt(max(0, jensen_shannon(own, ref_words) - (len(own) - 1) / (k * 8 * math.log(2))))
                if len(t or "") >= divergence.LEAST_CHARS:
                    far = math.sqrt(max(0, jensen_shannon(signs(t), ref_signs)))
            assert got[i].class_distance == pytest.approx(far, abs=2e-6) and got[i].word_distance == pytest.approx(other, abs=2e-6)
    assert got[900].word_distance > divergence.WORD_LIMIT and not got[900].kept and not got[901].kept
    assert got[902].word_distance is None and got[902].class_distance is None and got[904].kept and not got[904].base_failed


def test_divergence_of_empty_tables(spark):
    assert divergence.report(spark.createDataFrame([], DOCS)).count() == 0
    assert divergence.references(spark.createDataFrame([], DOCS)).count() == 0


def broken(rows):
    """The damage by plain Python: (turn, role, text) of one conversation in order."""
    out = []
    for conv, turn, role, text in rows:
        some = lambda x: " " if x is None else str(x)
        kind = zlib.crc32(f"{some(conv)}:{some(turn)}".encode()) % 20
        role, text = some(role), some(text)
        if kind:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            out += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        body = re.findall(r"[^\x20\x09-\x0D]", text)
        out.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows, found):
    """Least (cost, audit) over all edits, by trying them; at most one insert before a row and two at the end are ever of use."""
    best = None
    options = []
    for (_, role, _), fault in zip(rows, found, strict=True):
        late = 5 if fault == "truncated" else 0
        edits = [(2, "D", "")]
        if fault not in ("blank", "duplicate"):
            edits += [(late, "K", role[:1] or "?"), *((late + 1, "R", r) for r in "ua")]
        options.append([(c + 5 * len(i), "I" * len(i) + e, i + s) for c, e, s in edits for i in ("", "u", "a")])
    options.append([(5 * len(i), "I" * len(i), i) for i in ("", "u", "a", "ua", "au")])
    for picked in itertools.product(*options):
        if re.fullmatch("(s?(ua)+)?", "".join(p[2] for p in picked)):
            one = (sum(p[0] for p in picked), "".join(p[1] for p in picked))
            best = one if best is None or one < best else best
    return best


def digest(rows, audit):
    out, at, kept = [], 0, 0
    system = False
    for e in audit:
        role, text = ("", "") if e == "I" else rows[at][1:]
        at += e != "I"
        if e == "D":
            continue
        if e == "K" and not out and role[:1] == "s":
            system = True
        elif e in "IR":
            role = "assistant" if (kept - system) % 2 else "user"
        out.append(f"{role}:{text}")
        kept += 1
    return hashlib.sha256("\n".join(out).encode()).hexdigest()


TURNS = "conv_id long, turn long, role string, text string, extra string"


def test_repair_against_all_edits(spark):
    rng = random.Random(3)
    rows = []
    for conv in [*range(70), None]:
        for _ in range(rng.randint(0, 4)):
            turn = rng.choice([None, 0, 1, 2, 3, 5, 9])
            rows.append((conv, turn, rng.choice(["system", "user", "user", "assistant", "assistant", "tool", "", None]), rng.choice(["Yes.", "yes", "No!", " ", None, "", "why? ", "a.b"]), "e"))
    rows += [(99, 1, "user", "same.", "e")] * 3
    got = {r.conv_id: tuple(r)[1:] for r in repair.report(spark.createDataFrame(rows, TURNS).repartition(4)).collect()}
    assert set(got) == {r[0] for r in rows}
    for conv in got:
        left = broken([r[:4] for r in rows if r[0] == conv])
        found = faults(left)
        turns = [t for t, _, _ in left if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(left, left[1:], strict=False))
        cost, audit = cheapest(left, found)
        assert got[conv] == (gaps, *(found.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest(left, audit)), conv


def test_trie_answers_share_layers(monkeypatch):
    """Every signature of up to five rows: the same answers as alone, and a layer for each node of the trie only."""
    signs = "suax-SUAX"
    many = sorted("".join(p) for n in range(4) for p in itertools.product(signs, repeat=n))
    alone = {s: next(repair.trie_answers([s])) for s in many}
    made, step = [], repair.next_layer
    monkeypatch.setattr(repair, "next_layer", lambda layer, sign: made.append(1) or step(layer, sign))
    assert [alone[s] for s in many] == list(repair.trie_answers(many))
    assert len(made) == len(many) - 1


def test_a_very_long_dialogue_and_empty_tables(spark):
    rows = [(1, i, "user" if i % 2 else "assistant", f"turn {i}.", "") for i in range(20_000)]
    r, = repair.report(spark.createDataFrame(rows, TURNS)).collect()
    left = broken([x[:4] for x in rows])
    assert digest(left, r.audit) == r.repaired_sha256 and len(r.audit.replace("I", "")) == len(left)
    assert repair.report(spark.createDataFrame([], TURNS)).count() == 0


ITEMS = "item_id long, text string, extra string"


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def ranking(docs, items, k):
    told = [(i, Counter(terms(t))) for i, t in docs]
    n, length = sum(bool(c) for _, c in told), sum(sum(c.values()) for _, c in told)
    df = Counter(t for _, c in told for t in c)
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(terms(text))
    out = []
    for item, wanted in asked.items():
        scores = []
        for i, c in told:
            m = 10 + (90 * sum(c.values()) * n) // length if length else 0
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in wanted if t in c)
            if s > 0:
                scores.append((-s, i is None, i or 0))
        out += [(item, rank, None if none else i, -s) for rank, (s, none, i) in enumerate(sorted(scores)[:k], 1)]
    return out


@pytest.mark.parametrize("waves", [(4, 20, 84), (1, 2, 3)])
def test_search_against_all_scores(spark, monkeypatch, waves):
    """Small clusters, many copies and ties, NULL and repeated ids, odd texts; all waves and bounds give the scores of a full scan."""
    rng = random.Random(4)
    vocabulary = ["alpha", "BETA", "γάμμα", "d1", "e", "ÉTÉ", "été", "zeta", "eta", "x_y"] + [f"t{i}" for i in range(60)]
    text = lambda: " ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 30)))
    copy = text()
    docs = [(i, text()) for i in range(300)] + [(400 + i, copy) for i in range(150)] + [(None, copy), (7, copy), (7, copy), (8, None), (9, ""), (10, "--- ..."), (11, "alpha " * 30_000)]
    items = [(1, copy), (2, text()), (2, "alpha zeta"), (3, None), (4, "absent words"), (None, "beta d1"), (5, "x_y, E! alpha"), (6, "alpha"), (6, "alpha")]
    monkeypatch.setattr(ranked, "CLUSTER_DOCS", 8)
    monkeypatch.setattr(ranked, "BUCKET_POSTINGS", 500)
    monkeypatch.setattr(ranked, "WAVES", waves)
    frame = spark.createDataFrame([(i, t, "e") for i, t in docs], "doc_id long, text string, cluster string").repartition(5)
    got = [tuple(r) for r in ranked.report(frame, spark.createDataFrame([(i, t, "e") for i, t in items], ITEMS), 10).collect()]
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(got, key=key) == sorted(ranking(docs, items, 10), key=key)


def test_search_of_empty_tables(spark):
    none, items = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([(1, "a", "")], ITEMS)
    assert ranked.report(none, items).count() == 0
    assert ranked.report(spark.createDataFrame([(1, "a b")], "doc_id long, text string"), spark.createDataFrame([], ITEMS)).count() == 0


def test_bisection_halves_and_gathers():
    """Two kinds of documents shuffled together: halves stay equal and each ends with one kind; swaps never raise the cost."""
    import numpy as np

    rng = np.random.default_rng(5)
    kind = rng.permutation(np.repeat([0, 1], 64))
    docs = np.repeat(np.arange(128), 12)
    words = np.concatenate([rng.choice(40, 12, replace=False) + 40 * k for k in kind])
    node = ranked.bisected(docs, words, 128, 1, rounds=20)
    assert np.bincount(node).tolist() == [64, 64]
    assert max(np.mean(kind[node == 0]), 1 - np.mean(kind[node == 0])) > 0.95

    def cost(node):
        d = np.zeros((2, 80))
        np.add.at(d, (node[docs], words), 1)
        return (d * np.log2(64 / (d + 1))).sum()

    start = (np.arange(128) >= 64).astype(int)
    costs = [cost(start)] + [cost(ranked.bisected(docs, words, 128, 1, rounds=r)) for r in (1, 2, 4, 8)]
    assert costs[-1] < costs[0]
    for levels in (2, 3):
        sizes = np.bincount(ranked.bisected(docs, words, 128, levels), minlength=1 << levels)
        assert sizes.max() - sizes.min() <= 1


def test_languages_of_equal_rows_are_learned(spark):
    """Ten languages of one row repeated many times: each has rows in the learning sample, whatever its hash."""
    from sievework.llm import language

    rows = [(None, f"words of language {k} only", f"l{k}", "s") for k in range(10) for _ in range(3000)] + [(5, "", "l3", "s"), (6, None, "l4", "s")]
    sample = language.learning_sample(spark.createDataFrame(rows, DOCS)).groupBy("lang").count().collect()
    assert {r.lang for r in sample} == {f"l{k}" for k in range(10)} and all(r["count"] <= language.PER_LANGUAGE for r in sample)
