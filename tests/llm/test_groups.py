import pickle
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from sievework.llm import common, graph, jaccard, packing

DOC = "doc_id long, text string, lang string, source string, n_chars long, n long, node string, bucket int"


def doc(i, text, source=None):
    return (i, text, None, source, None, 4, "x", 1)


def brute(rows, k, num, den):
    """Sets, components and links by comparing all rows."""
    sets = []
    for _, t, *_ in rows:
        w = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower())
        sets.append({tuple(w)} if 0 < len(w) < k else {tuple(w[i : i + k]) for i in range(len(w) - k + 1)})
    comp = list(range(len(rows)))
    links = [0] * len(rows)

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and den * len(sets[i] & sets[j]) >= num * len(sets[i] | sets[j]):
                links[i] += 1
                links[j] += 1
                comp[find(i)] = find(j)
    low = defaultdict(lambda: None)
    for i, r in enumerate(rows):
        if r[0] is not None:
            c = find(i)
            low[c] = r[0] if low[c] is None else min(low[c], r[0])
    return Counter((r[0], len(s), low[find(i)], n) for i, (r, s, n) in enumerate(zip(rows, sets, links)))


def corpus(seed, n=260):
    rng = random.Random(seed)
    vocab = ["w%d" % i for i in range(60)] + ["The", "of", "É"]
    passage = " ".join(rng.choice(vocab) for _ in range(60))
    rows = []
    for i in range(n):
        kind = rng.random()
        if kind < 0.5 and rows:
            w = (rng.choice(rows)[1] or "a").split()
            for _ in range(rng.randint(0, max(1, len(w) // 25))):
                w[rng.randrange(len(w))] = rng.choice(vocab)
            t = "\t".join(w) if kind < 0.1 else " ".join(w)
        elif kind < 0.6:
            t = passage + " " + " ".join(rng.choice(vocab) for _ in range(rng.randint(0, 8)))
        else:
            t = " ".join(rng.choice(vocab) for _ in range(rng.choice([0, 1, 2, 3, 8, 40, 150])))
        rows.append(doc(1000 - i * 3, t))
    rows += [doc(7, None), doc(8, " \n"), doc(9, "one"), doc(10, "ONE"), doc(11, rows[5][1]), doc(11, rows[5][1]), doc(None, rows[6][1]), doc(12, "big " * 30_000)]
    return rows


@pytest.mark.parametrize(("k", "num", "den", "members", "bits", "most"), [(3, 90, 100, 1024, 16, 4096), (5, 80, 100, 7, 8, 2), (2, 60, 100, 3, 12, 4), (3, 100, 100, 50, 8, 4096)])
def test_join_matches_brute_force(spark, monkeypatch, k, num, den, members, bits, most):
    monkeypatch.setattr(jaccard, "LIST_ROWS", most)
    monkeypatch.setattr(jaccard, "MEMBERS", members)
    monkeypatch.setattr(jaccard, "SKETCH_BITS", bits)
    monkeypatch.setattr(jaccard, "LIST_BLOCK", 3)
    rows = corpus(k)
    df = spark.createDataFrame(rows, DOC).repartition(6)
    got = Counter(map(tuple, jaccard.join(df, k, num, den).collect()))
    assert got == brute(rows, k, num, den)


def test_one_of_each_keeps_one_row_of_a_component(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "SKETCH_BITS", 12)
    rows = [r for r in corpus(9, 120) if r[0] is not None]
    df = spark.createDataFrame(rows, DOC).repartition(3)
    kept = jaccard.one_of_each(df, 5, 80, 100)
    assert kept.columns == df.columns
    want = {c for (i, n, c, _) in brute(rows, 5, 80, 100) if n}
    empty = [r[0] for r in rows if not (r[1] or "").split()]
    assert sorted(r.doc_id for r in kept.collect()) == sorted([*want, *empty])
    assert jaccard.one_of_each(df.limit(0)).collect() == [] and jaccard.join(df.limit(0)).collect() == []


def test_many_null_and_repeated_ids(spark, monkeypatch):
    """Half of the rows have no id, the others three ids between them; every text is judged by itself."""
    monkeypatch.setattr(jaccard, "SKETCH_BITS", 12)
    rows = [(None if i % 2 else i % 3, *r[1:]) for i, r in enumerate(corpus(4, 160))]
    got = Counter(map(tuple, jaccard.join(spark.createDataFrame(rows, DOC).repartition(5), 3, 80, 100).collect()))
    assert got == brute(rows, 3, 80, 100)
    only = [(None, *r[1:]) for r in rows]
    got = Counter(map(tuple, jaccard.join(spark.createDataFrame(only, DOC).repartition(5), 3, 80, 100).collect()))
    assert got == brute(only, 3, 80, 100) and any(n for *_, n in got)


def test_one_of_each_judges_texts_apart(spark, monkeypatch):
    """Texts that share an id are kept or dropped by themselves; names with dots and clashing names pass through."""
    monkeypatch.setattr(jaccard, "SKETCH_BITS", 10)
    a, b, c = ("a b c d e f g h", "q r s t u v w x y", "k l m n o p")
    rows = [(1, a, 0), (2, a, 1), (2, b, 2), (2, b, 3), (None, c, 4), (None, c, 5), (None, None, 6), (3, "", 7), (3, "", 8)]
    df = spark.createDataFrame([(i, t, n, "x", 1) for i, t, n in rows], "doc_id long, text string, `a.b` int, _seal string, node int")
    kept = jaccard.one_of_each(df)
    assert kept.columns == df.columns
    got = kept.collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in got) == sorted([(False, 1, a), (False, 2, b), (True, 0, c), (True, 0, ""), (False, 3, ""), (False, 3, "")])


def test_a_long_list_is_scanned_in_runs():
    """A list of 20,000 entries without links, cut into runs: pairs of runs whose sizes exclude a link are left out, the rest finds all."""
    import time

    rng = np.random.default_rng(0)
    e = np.zeros(20_000, jaccard.POSTING)
    e["n"], e["p"], e["d"] = np.sort(rng.integers(50, 1500, len(e))), 0, np.arange(len(e))
    e["b"] = rng.integers(0, 1 << 63, (len(e), 8), dtype=np.uint64)
    e["b"][1::1000] = e["b"][::1000]
    e["n"][1::1000] = e["n"][::1000]
    pairs = list(jaccard.run_pairs(e, 1000, 90, 100))
    assert len(pairs) < 20 * 21 // 4
    forest, slowest = jaccard.Forest(), 0.0
    for a, b in pairs:
        began = time.process_time()
        if a is b or a["d"][0] == b["d"][0]:
            jaccard.scan_list(a, forest, 90, 100)
        else:
            jaccard.scan_list(np.concatenate([a, b]), forest, 90, 100, split=len(a))
        slowest = max(slowest, time.process_time() - began)
    assert {forest.find(i + 1) for i in range(0, 20_000, 1000)} == set(range(0, 20_000, 1000)) and slowest < 20


def test_short_column_equals_short(spark):
    from pyspark.sql import functions as F

    nodes = [bytes(random.Random(i).randrange(256) for _ in range(16)) for i in range(50)]
    df = spark.createDataFrame([(n,) for n in nodes], "node binary")
    assert [r.s for r in df.select(jaccard._short_column(F.col("node")).alias("s")).collect()] == [jaccard.short(n) for n in nodes]


def test_components_of_paths_stars_and_loops(spark):
    rng = random.Random(0)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(200, 200), (201, 200), (300, 300), (400, None)]
    rng.shuffle(edges)
    out = dict(map(tuple, graph.components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert out == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}, 200: 200, 201: 200, 300: 300}
    assert graph.components(spark.createDataFrame([], "a long, b long")).collect() == []


def whole_ids(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(packing.default_tokenizer())
    return [[*e.ids, 1] for e in t.encode_batch(list(texts), add_special_tokens=False)]


def test_words_encode_as_whole_texts():
    rng = random.Random(5)
    alphabet = "ab'sStReEé́ßΣσİ漢字12٣ \t\n  \x1c\x85.,!?*-_<|>endoftext"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(3000)] + ["<|endoftext|> x<|startoftext|>y", "don't we'll", "ΑΣ. ΟΔΟΣ", "a\x1cb", "\x1c", "é ́x", "ﬁ Å", "x" * 3000]
    got = [np.frombuffer(x, "<u2").tolist() for x in packing.WordIds(packing.default_tokenizer()).documents(texts)]
    assert got == whole_ids(texts)


def test_words_seen_once_stay_known(monkeypatch):
    """A worker encodes each of 300,000 different words once, in all its tasks, and the cutting into windows lets go of them."""
    sent = pickle.dumps(packing.WordIds(packing.default_tokenizer()))
    packing.words_of_worker.cache_clear()
    words = pickle.loads(sent)
    letters = "abcdefghijklmnopqrstuvwxyz"
    made = ["".join(letters[i // 26**k % 26] for k in range(4)) for i in range(300_000)]
    texts = [" ".join(made[i : i + 1000]) for i in range(0, len(made), 1000)]
    first = words.documents(texts)
    merged = []
    monkeypatch.setattr(packing.WordIds, "_merge", lambda self, low: merged.append(low) or b"")
    assert words.documents(texts) == first and merged == []
    assert pickle.loads(sent) is words
    packing.words_of_worker.cache_clear()
    assert len(pickle.loads(sent)) == 0


def test_forms_of_a_word_are_encoded_once():
    """Capitals and marks make no words of their own, marks alone are few, and runs as long as texts aren't kept."""
    words = packing.WordIds(packing.default_tokenizer())
    texts = ["Alpha alpha alpha, ALPHA! alpha?", "beta Beta, beta?", "x" * 3000, "", " ", "a\u00a0b\u2028c " * 30]
    assert [np.frombuffer(x, "<u2").tolist() for x in words.documents(texts)] == whole_ids(texts)
    assert sorted(k for k in words if k.isalpha()) == ["alpha", "beta"] and {",", "!", "?"} <= set(words.others)
    assert words.documents([]) == [] and words.documents([""]) == [b"\x01\x00"]


def test_texts_beyond_a_batch_are_halved(monkeypatch):
    texts = ["Alpha, beta %d" % i * (i % 7) for i in range(50)]
    words = packing.WordIds(packing.default_tokenizer())
    at_once = words.documents(texts)
    monkeypatch.setattr(packing, "CHARS", 40)
    monkeypatch.setattr(packing, "ROWS", 3)
    monkeypatch.setattr(packing, "KEPT_WORDS", 2)
    assert words.documents(texts) == at_once and len(words) + len(words.others) < 10


def test_pieces_come_from_blocks_of_windows(monkeypatch):
    """Against the state of each window by itself; totals beyond 64-bit products too."""
    rng = random.Random(7)
    for huge in (False, True) * 30:
        window = 2048 if huge else rng.choice([8, 64])
        totals = [rng.randint(10**12, 10**13) if huge else rng.randint(300, 4000) for _ in range(rng.randint(1, 6))]
        weights = None if huge or rng.random() < 0.5 else [rng.randint(1, 3) for _ in totals]
        if weights is None and min(totals) * window < sum(totals):
            continue
        s = packing.Schedule(totals, window, weights)
        w = rng.randint(0, -(-s.all // window))
        assert s.table(w, 4).tolist() == [s.served(w + i) for i in range(4)]
        q = rng.randrange(len(totals))
        place = rng.randint(0, totals[q] - 200)
        sizes = [rng.randint(1, 60) for _ in range(3)]
        expected, w = [], s.window_of(q, place)
        for i, n in enumerate(sizes):
            at, end = place + sum(sizes[:i]), place + sum(sizes[: i + 1])
            first = at
            while at < end:
                a, b = s.served(w), s.served(w + 1)
                if (upto := min(end, b[q])) > at:
                    expected.append((i, at - first, upto - at, w, sum(b[:q]) - sum(a[:q]) + at - a[q]))
                    at = upto
                w += at == b[q]
        with monkeypatch.context() as m:
            if weights is None:
                m.setattr(s, "level", None)  # no window by itself
            assert list(zip(*(c.tolist() for c in s.pieces(q, place, np.array(sizes))))) == expected


def test_schedule_serves_by_deficit():
    rng = random.Random(1)
    for _ in range(200):
        window = rng.choice([8, 16, 64])
        totals = [rng.randint(200, 4000) for _ in range(rng.randint(1, 6))]
        if min(totals) * window < sum(totals):  # such sources share a queue
            continue
        s = packing.Schedule(totals, window)
        windows = -(-s.all // window)
        for w in range(windows + 1):
            a, b = s.served(w), s.served(w + 1)
            at = min(w * window, s.all)
            assert sum(a) == at and all(x <= y for x, y in zip(a, b))
            assert all(abs(x - at * t / s.all) <= 1 for x, t in zip(a, totals))
        assert s.served(windows) == totals


def test_schedule_with_targets_lets_dry_queues_go():
    """Against a round-robin that credits weights ids by id: the state of each window, and every id in exactly one place."""
    rng = random.Random(2)
    for _ in range(60):
        window = rng.choice([16, 32])
        n = rng.randint(1, 4)
        totals, weights = [rng.randint(1, 400) for _ in range(n)], [rng.randint(1, 3) for _ in range(n)]
        s = packing.Schedule(totals, window, weights)
        windows = -(-s.all // window)
        assert s.served(0) == [0] * n and s.served(windows) == totals
        fluid = [0.0] * n  # credits in small steps, a dry queue's part going to the others
        for w in range(windows):
            left = min(window, s.all - w * window)
            while left > 1e-9:
                live = [q for q in range(n) if totals[q] - fluid[q] > 1e-9]
                step = min([left / sum(weights[q] for q in live), *((totals[q] - fluid[q]) / weights[q] for q in live)])
                for q in live:
                    fluid[q] += step * weights[q]
                left -= step * sum(weights[q] for q in live)
            a, b = s.served(w), s.served(w + 1)
            assert all(abs(x - y) < 1 + 1e-6 for x, y in zip(b, fluid)) and all(x <= y for x, y in zip(a, b))
        for q in range(n):
            for place in range(0, totals[q], 7):
                w = s.window_of(q, place)
                assert s.served(w)[q] <= place < s.served(w + 1)[q]


def test_pack_to_targets(spark):
    rows = [doc(i, "alpha beta gamma " * 40, ["a", "b", "c", None][i % 4]) for i in range(80)]
    out = packing.pack(spark.createDataFrame(rows, DOC).repartition(3), window=256, targets={"a": 3, "b": 1, None: 2}).collect()
    names = {r[0]: r[3] for r in rows}
    first = Counter()
    for r in out:
        if r.sequence_id < 8:
            first[names[r.doc_id]] += r.length
    assert sum(r.length for r in out) == sum(map(len, whole_ids([r[1] for r in rows])))
    assert {k: round(v * 7 / (8 * 256), 1) for k, v in first.items()} == {"a": 3, "b": 1, "c": 1, None: 2}
    with pytest.raises(ValueError):
        packing.pack(spark.createDataFrame(rows, DOC), window=256, targets={"a": 256})


def test_pack_is_gapless_and_mixed(spark):
    rng = random.Random(3)
    rows = [doc(i, " ".join(rng.choice(["alpha", "beta,", "Gamma!", "délta"]) for _ in range(rng.randint(0, 300))), rng.choice(["hot"] * 8 + ["a", "b", None])) for i in range(300)]
    rows += [doc(500, None, "tiny"), doc(501, "", "tiny2"), doc(501, "", "tiny2"), doc(None, "long " * 20_000, "a")]
    df = spark.createDataFrame(rows, DOC).repartition(5)
    out = packing.pack(df, window=256, with_ids=True).collect()
    ids = dict(zip([r[0] for r in rows], whole_ids([r[1] or "" for r in rows])))
    total = sum(len(x) for x in whole_ids([r[1] or "" for r in rows]))
    assert sum(r.length for r in out) == total
    windows = defaultdict(list)
    for r in out:
        piece = np.array(ids[r.doc_id][r.start : r.start + r.length], "<u4")
        assert r.doc_tokens == len(ids[r.doc_id]) and zlib.crc32(piece.tobytes()) == r.ids_crc32 and bytes(r.ids) == piece.tobytes()
        windows[r.sequence_id].append((r.offset, r.length))
    assert sorted(windows) == list(range(-(-total // 256)))
    for w, pieces in windows.items():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at and length > 0
            at += length
        assert at == (256 if w < len(windows) - 1 else total - 256 * w)
    covered = defaultdict(list)
    for r in out:
        covered[r.doc_id].append((r.start, r.length))
    assert sum(covered[None][i][1] for i in range(len(covered[None]))) == len(ids[None])
    assert packing.pack(df.limit(0)).collect() == []


def test_written_tables_live_in_the_shared_folder(spark):
    assert common.shared_dir(spark)
    assert common.written(spark.range(3)).count() == 3
