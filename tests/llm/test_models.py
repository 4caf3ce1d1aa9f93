import math
import random
import zlib

import numpy as np
import pytest

from sievework.llm import language, quality, toxicity

DOC = "doc_id long, text string, lang string, source string, n_chars long, score double"


def brute_marginals(scores, trans, start):
    n = len(scores)
    w = np.zeros(n)
    total = 0.0
    for path in range(2**n):
        s = [(path >> i) & 1 for i in range(n)]
        v = math.exp(sum(x for x, b in zip(scores, s) if b)) * (start if s[0] else 1.0)
        for a, b in zip(s, s[1:]):
            v *= trans[a][b]
        total += v
        for i, b in enumerate(s):
            w[i] += v * b
    return w / total


def test_marginals_equal_enumeration_across_segments(monkeypatch):
    rng = np.random.default_rng(1)
    trans = np.array([[1.0, 0.2], [0.6, 1.7]])
    lengths = np.array([5, 0, 1, 9, 7, 0, 12])
    scores = rng.normal(0, 2, lengths.sum())
    for segment in (2, 3, 64):
        monkeypatch.setattr(toxicity, "SEGMENT", segment)
        p = 1 / (1 + np.exp(-toxicity.marginal_logits(scores, lengths, trans, 0.3)))
        at = 0
        for n in lengths:
            if n:
                np.testing.assert_allclose(p[at : at + n], brute_marginals(scores[at : at + n], trans, 0.3), rtol=1e-9)
            at += n


def words(rng, letters):
    return ["".join(rng.choice(letters) for _ in range(rng.randint(3, 8))) for _ in range(rng.randint(5, 40))]


def rows_toxic(n):
    rng = random.Random(4)
    out = []
    for i in range(n):
        w = words(rng, "abcdefgh")
        if i % 4 == 0:
            w[rng.randrange(len(w))] = rng.choice(["vilex", "vilexes,", "nastyq"])
        out.append({"doc_id": i, "text": " ".join(w), "y": int(i % 4 == 0)})
    return out


def test_toxicity_spans_and_edge_cases(spark):
    crf = toxicity.train(rows_toxic(600))
    text = "Abc  def\nghi vilexes, abc nastyq! end"
    df = spark.createDataFrame([(1, text, "en", None, 1, 9.0), (1, text, None, None, 1, None), (2, None, None, None, None, None), (3, "", "x", "y", 0, 0.0), (None, "abc vilex " * 5000, None, None, None, None), (4, "abc def", None, None, None, None)], DOC)
    out = toxicity.score(df, crf).collect()
    assert len(out) == 6
    by = {r.doc_id: r for r in out if r.doc_id != 1}
    for r in out:
        if r.doc_id == 1:
            assert r.predicted == 1 and [text[s.start : s.end] for s in r.spans] == ["vilexes,", "nastyq!"]
    assert by[None].predicted == 1 and by[2].predicted == by[3].predicted == by[4].predicted == 0 and by[2].spans == []
    assert {r.doc_id for r in toxicity.keep_clean(df, crf).collect()} == {2, 3, 4}
    assert toxicity.keep_clean(df, crf).columns == df.columns
    assert toxicity.score(df.limit(0), crf).collect() == []


def test_toxicity_without_labels_rejects_nothing(spark):
    crf = toxicity.train([])
    df = spark.createDataFrame([(1, "a b", None, None, None, None)], DOC)
    assert toxicity.score(df, crf).first().score == 0


def test_mil_gradient_matches_differences():
    rng = np.random.default_rng(0)
    rows = [{"text": " ".join(words(random.Random(i), "abAB1!")) if i else "", "y": i % 2} for i in range(12)]
    x, counts = quality.encode(quality._Words(), [r["text"] for r in rows])
    params = {k: rng.normal(0, 0.4, s) for k, s in {"w": (quality.DIMS, 4), "b": 4, "v": (4, 3), "u": (4, 3), "a": 3, "o": 4, "c": 1}.items()}
    mil = quality.Mil(x.mean(0), np.ones(quality.DIMS), params)
    y, w = np.array([r["y"] for r in rows], float), np.ones(12)

    def loss():
        s = mil.forward(x, counts)["score"]
        return -np.mean(y * np.log(s) + (1 - y) * np.log(1 - s))

    for k, g in mil.gradient(x, counts, y, w).items():
        flat = params[k].reshape(-1)
        i = int(np.abs(g.reshape(-1)).argmax())
        keep = flat[i]
        flat[i] = keep + 1e-5
        up = loss()
        flat[i] = keep - 1e-5
        down = loss()
        flat[i] = keep
        assert g.reshape(-1)[i] == pytest.approx((up - down) / 2e-5, rel=1e-3)


def test_quality_learns_and_handles_edges(spark):
    rng = random.Random(2)
    rows = [{"text": " ".join(w.upper() + "!!" if i % 3 == 0 else w for w in words(rng, "abcdefgh")), "y": int(i % 3 != 0)} for i in range(300)]
    mil = quality.train(rows)
    df = spark.createDataFrame([(1, "ABC!! DEF!! GH!! " * 9, "a", "b", 1, 2.0), (2, "abc def gh " * 9, None, None, None, None), (3, None, None, None, None, None), (4, "", None, None, None, None), (4, "x" * 100_000, None, None, None, None)], DOC)
    out = quality.score(df, mil).collect()
    assert len(out) == 5 and all(0 <= r.score <= 1 for r in out)
    by = {r.doc_id: r.predicted for r in out if r.doc_id < 3}
    assert by == {1: 0, 2: 1}
    assert 1 not in {r.doc_id for r in quality.keep_good(df, mil).collect()}
    assert quality.score(df.limit(0), mil).collect() == []
    assert quality.score(df, quality.train(rows[:1])).first().score == 1


def small_net(seed, languages=2):
    rng = np.random.default_rng(seed)
    params = {"c": rng.normal(0, 0.2, languages)}
    for d in "fb":
        params |= {"t" + d: rng.normal(0, 0.5, (256, 3 * language.HIDDEN)), "u" + d: rng.normal(0, 0.5, (language.HIDDEN, 3 * language.HIDDEN)), "v" + d: rng.normal(0, 0.5, (language.HIDDEN, languages))}
    return language.BiGru(["a", "b", "c"][:languages], params)


def plain_states(net, raw, d):
    """States after every byte, one byte at a time."""
    t, u, k = net.params["t" + d], net.params["u" + d], language.HIDDEN
    h, out = np.zeros(k), []
    for b in raw:
        x, m = t[b], h @ u
        z, r = (1 / (1 + np.exp(-(x[i * k : i * k + k] + m[i * k : i * k + k]))) for i in (0, 1))
        h = z * h + (1 - z) * np.tanh(x[2 * k :] + r * m[2 * k :])
        out.append(h)
    return np.array(out)


def plain_label(ahead, back, net):
    e = np.exp(ahead @ net.params["vf"] + back @ net.params["vb"] + net.params["c"])
    return e / e.sum(-1, keepdims=True)


def test_bigru_gradient_matches_differences():
    net = small_net(3)
    params = net.params
    batch, y = [b"hello", b"abc", b"z"], np.array([1, 0, 1])

    def loss():
        total = 0.0
        for w, t in zip(batch, y):
            p = plain_label(plain_states(net, w, "f"), plain_states(net, w[::-1], "b")[::-1], net)
            total -= np.log(p[:, t]).sum()
        return total / sum(map(len, batch))

    grads = net.gradient(batch, y)
    for k, g in grads.items():
        flat = params[k].reshape(-1)
        i = int(np.abs(g.reshape(-1)).argmax())
        keep = flat[i]
        flat[i] = keep + 1e-5
        up = loss()
        flat[i] = keep - 1e-5
        down = loss()
        flat[i] = keep
        assert g.reshape(-1)[i] == pytest.approx((up - down) / 2e-5, rel=1e-3)


@pytest.mark.parametrize(("chunk", "context", "lanes"), [(7, 3, 5), (4, 9, 2), (1000, 0, 64)])
def test_chunks_equal_a_direct_pass(monkeypatch, chunk, context, lanes):
    """Every byte's label is that of a plain pass over its chunk and the context of each direction; one chunk is the whole text."""
    monkeypatch.setattr(language, "CHUNK", chunk)
    monkeypatch.setattr(language, "CONTEXT", context)
    monkeypatch.setattr(language, "LANES", lanes)
    rng, net = random.Random(chunk), small_net(chunk, 3)
    texts = [bytes(rng.randrange(256) for _ in range(rng.choice([1, 2, chunk, 40, 93]))) for _ in range(12)] + [b"", b"x" * 200]
    for raw, got in zip(texts, language.document_sums(net, texts)):
        want = np.zeros(3)
        for s in range(0, len(raw), chunk):
            n = min(chunk, len(raw) - s)
            ahead = plain_states(net, raw[max(0, s - context) : s + n], "f")[-n:]
            back = plain_states(net, raw[s : s + n + context][::-1], "b")[-n:][::-1]
            want += plain_label(ahead, back, net).sum(0)
        np.testing.assert_allclose(got, want, rtol=1e-9, atol=1e-9)


def test_emissions_and_layer_equal_a_plain_pass(spark):
    """Scores of whole texts against features summed token by token and marginals by enumeration."""
    crf = toxicity.train(rows_toxic(300))
    for text in ("abc vilex, def", "Nastyq! -- gh", "-- --", "abcdefgh", "", "vilexes vilex a b c nastyq bad"):
        tokens = text.split()
        bare = [toxicity.bare_word(t) for t in tokens]
        own = [sum(crf.weights.get(f, 0.0) for f in toxicity.token_features(t)) for t in tokens]
        left = [crf.weights.get("l:" + bare[i - 1], 0.0) if i else 0.0 for i in range(len(tokens))]
        right = [crf.weights.get("r:" + bare[i + 1], 0.0) if i + 1 < len(tokens) else 0.0 for i in range(len(tokens))]
        p = brute_marginals([crf.bias + sum(x) for x in zip(own, left, right)], crf.trans, crf.start) if tokens else np.zeros(0)
        top = max([-toxicity.MARGINAL_CAP, *np.clip(np.log(p / (1 - p)), -toxicity.MARGINAL_CAP, toxicity.MARGINAL_CAP)])
        c, w0, w1 = crf.layer
        want = 1 / (1 + np.exp(-(c + w0 * top + w1 * np.log1p(p[p > 0.5].sum()))))
        scores, spans = toxicity._scored(crf, toxicity._Tokens(crf), [text], True)
        assert scores[0] == pytest.approx(want, rel=1e-6)
        inside = [any(s["start"] <= text.find(t) < s["end"] for s in spans[0]) for t in tokens]
        assert inside == [x > 0.5 for x in p]


def test_attention_equals_a_plain_pass():
    """Passages encoded word by word and pooled one document at a time."""
    rng = np.random.default_rng(6)
    params = {k: rng.normal(0, 0.4, s) for k, s in {"w": (quality.DIMS, 4), "b": 4, "v": (4, 3), "u": (4, 3), "a": 3, "o": 4, "c": 1}.items()}
    mil = quality.Mil(rng.normal(0, 0.1, quality.DIMS), np.full(quality.DIMS, 0.7), params)
    texts = [" ".join(words(random.Random(i), "abAB1!?") * (i % 4)) for i in range(9)] + ["x" * 3000 + " Y"]
    x, counts = quality.encode(quality._Words(), texts)
    got, at = mil.scores(x, counts), 0
    for text, score, n in zip(texts, got, counts):
        w = text.split()
        passages = [w[i : i + quality.PASSAGE] for i in range(0, len(w), quality.PASSAGE)]
        assert len(passages) == n
        hidden, weight = [], []
        for part, row in zip(passages, x[at : at + n]):
            means = sum(quality.word_row(a) for a in part) / len(part)
            np.testing.assert_allclose(row[: len(means)], means, rtol=1e-4, atol=1e-5)
            assert row[len(means)] == pytest.approx(len(set(part)) / len(part), rel=1e-5)
            assert row[len(means) + 2] == pytest.approx(np.log1p(len(part)) / 4, rel=1e-5)
            assert row[len(means) + 3] == pytest.approx(len(set(w)) / len(w) ** 0.9, rel=1e-5)
            h = np.tanh(np.clip((row - mil.mean) / mil.scale, -8, 8) @ params["w"] + params["b"])
            hidden.append(h)
            weight.append(np.exp((np.tanh(h @ params["v"]) / (1 + np.exp(-(h @ params["u"])))) @ params["a"]))
        z = sum((a * h for a, h in zip(weight, hidden)), np.zeros(4)) / (sum(weight) or 1)
        assert score == pytest.approx(1 / (1 + np.exp(-(z @ params["o"] + params["c"][0]))), rel=1e-6)
        at += n


def test_many_words_are_encoded_at_once_as_each_alone(monkeypatch):
    """Words of all kinds of code points and lengths; texts together and one by one; no call for each word."""
    rng = random.Random(11)
    kinds = ["a", "Z", "9", "!", ".", "é", "É", "ß", "ǅ", "Ⓐ", "ª", "²", "٣", "中", "𝔄", "𐐨", "\u0301", "\u200b", "\x00", "😀"]
    pool = [rng.choice(kinds) * rng.randint(1, 3) + "".join(rng.choices(kinds, k=rng.choice([0, 1, 5, 19, 80]))) for _ in range(2000)] + ["x" * 5000, "a1" * 900, "?"]
    traits, shapes = quality.word_rows(pool)
    want = np.array([quality.word_row(w) for w in pool])
    np.testing.assert_array_equal(traits, want[:, : -quality.SHAPES])
    np.testing.assert_array_equal(shapes, want[:, -quality.SHAPES :].argmax(1))

    texts = ["", " \n"] + [rng.choice([" ", "\n ", "\u2003"]).join(rng.choices(pool[: rng.choice([3, 2003])], k=rng.choice([1, 2, 47, 48, 49, 200]))) for _ in range(40)] + [""]
    alone = [quality.encode(quality._Words(), [t]) for t in texts]
    monkeypatch.setattr(quality, "word_row", None)
    for together, cache in ((1, 0), (3000, 100), (10**9, 10**9)):
        monkeypatch.setattr(quality, "TOGETHER", together)
        monkeypatch.setattr(quality, "_CACHE", cache)
        x, counts = quality.encode(quality._Words(), texts)
        np.testing.assert_array_equal(x, np.concatenate([a for a, _ in alone]))
        np.testing.assert_array_equal(counts, np.concatenate([n for _, n in alone]))
    assert [len(a) for a in quality.encode(quality._Words(), [])] == [0, 0]


def test_a_long_row_costs_no_other_row_its_place(spark):
    """Rows beyond the bounds are passed over one by one; the rest is learned from, in the order of the hash."""
    from sievework.llm import common

    rows = [{"text": "a" * n, "y": y} for n, y in ((50, 1), (5, 1), (7, 0), (60, 0), (9, 1), (8, 1), (3, 1))]
    assert [len(r["text"]) for r in common.fitting(rows, 20, 17)] == [5, 7, 9, 3]
    docs = spark.createDataFrame([(i, "w%d " % i * (400_000 if i == 9 else 3)) for i in range(60)] + [(7, "w7 again"), (None, "x"), (8, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(None, 1), (4, None)], "doc_id long, toxic int")
    sample = common.labelled_sample(docs, labels, "toxic", {0: 100, 1: 100})
    kept = common.trained(sample, ["h", "doc_id"], lambda rows: [len(r["text"]) for r in common.fitting(rows, 1000)])
    learnable = [i for i in range(60) if zlib.crc32(str(i).encode()) % 3 != 1]
    assert 9 in learnable and len(kept) == len(learnable) - 1 and max(kept) < 1000


def test_language_learns_and_handles_edges(spark):
    rng = random.Random(7)
    rows = [{"lang": lang, "text": " ".join(words(rng, letters))} for _ in range(150) for lang, letters in (("aa", "abcde"), ("bb", "vwxyzé"))]
    net = language.train(rows)
    df = spark.createDataFrame([(1, "Abc, bcd 12 éé"[:8], None, None, 1, None), (2, "vwx zyé WXY", "aa", None, None, None), (3, None, None, None, None, None), (4, "12 !? 3", None, None, None, None), (5, "", None, None, None, None), (5, "xyz" * 40_000, None, None, None, 1.0)], DOC)
    out = [(r.doc_id, r.lang_pred, r.score) for r in language.predict(df, net).collect()]
    assert sorted((a, b) for a, b, _ in out) == [(1, "aa"), (2, "bb"), (3, "und"), (4, "und"), (5, "bb"), (5, "und")]
    assert all(0 <= s <= 1 for _, _, s in out)
    assert language.predict(df, None).first().lang_pred == "und"
    assert language.predict(df.limit(0), net).collect() == []


@pytest.mark.parametrize(("name", "table", "truth", "least"), [("op1_toxicity", "labels", "toxic", 0.95), ("op4_quality", "labels", "quality", 0.97), ("op5_language", "documents", "lang", 0.97)])
def test_held_out_accuracy(spark, name, table, truth, least):
    from pyspark.sql import functions as F

    from sievework.llm.queries import QUERIES

    sf = "/root/testdata/sf0.1"
    out = QUERIES[name](spark, sf)
    pred = "lang_pred" if truth == "lang" else "predicted"
    held = out.filter("held_out").select("doc_id", F.col(pred).alias("p")).join(spark.read.parquet(f"{sf}/{table}.parquet").select("doc_id", F.col(truth).alias("t")), "doc_id")
    assert held.agg(F.avg((F.col("p") == F.col("t")).cast("int"))).first()[0] >= least
