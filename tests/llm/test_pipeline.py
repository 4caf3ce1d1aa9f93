"""The pipeline against plain Python for every stage whose rule is not a learned score, and against scores for the others."""

import re
import zlib
from collections import Counter, defaultdict

from sievework.llm import pipeline as cp
from sievework.llm import common, mixing, packing, quality, toxicity

SF = "/root/testdata/sf0.001"


def sets(text):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    return {tuple(w)} if 0 < len(w) < 5 else {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def test_each_stage(spark, tmp_path):
    docs = common.documents(spark, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    read, kept = docs, []
    for i, (name, stage) in enumerate(cp.STAGES):
        stage(spark, read, SF).write.parquet(str(tmp_path / str(i)))
        before, read = read, spark.read.parquet(str(tmp_path / str(i)))
        kept.append((name, before, read))
    assert [n for n, *_ in kept] == ["toxicity", "quality", "near_copies", "mixing", "packing"]
    assert all(out.columns == docs.columns for _, _, out in kept[:4])

    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
    _, before, out = kept[0]
    assert ids(out) == ids(toxicity.score(before, toxicity.fit(before, labels)).filter("score < 0.7"))
    _, before, out = kept[1]
    assert ids(out) == ids(quality.score(before, quality.fit(before, labels)).filter("score >= 0.5"))

    _, before, out = kept[2]
    rows = [(r.doc_id, sets(r.text)) for r in before.collect()]
    root = {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, (i, a) in enumerate(rows):
        for j, b in rows[:n]:
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                low, high = sorted((find(i), find(j)))
                root[high] = low
    assert ids(out) == sorted({find(i) for i, _ in rows})

    _, before, out = kept[3]
    want = Counter({r.doc_id: r.copies for r in mixing.mix_report(before).collect() if r.copies})
    assert Counter(ids(out)) == want

    _, before, out = kept[4]
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(packing.default_tokenizer())
    texts = [(r.doc_id, r.text or "") for r in before.collect()]
    encoded = {i: [*t.encode(x, add_special_tokens=False).ids, 1] for i, x in texts}
    total = sum(len(encoded[i]) for i, _ in texts)
    fill = defaultdict(int)
    for r in out.collect():
        part = b"".join(x.to_bytes(4, "little") for x in encoded[r.doc_id][r.start : r.start + r.length])
        assert zlib.crc32(part) == r.ids_crc32 and r.doc_tokens == len(encoded[r.doc_id])
        fill[r.sequence_id] += r.length
    assert sum(fill.values()) == total and sorted(fill) == list(range(-(-total // 2048)))
    assert all(n == 2048 for w, n in fill.items() if w < len(fill) - 1)


def test_run_returns_pieces(spark):
    assert "sequence_id" in cp.run(spark, SF).columns


def odd_rows(spark):
    """NULLs in every column, an empty and a long text, repeated rows and ids, and columns with odd names."""
    rows = [(i, f"word{i} " * 30, "en", "ab"[i % 2], 1, None, i) for i in range(40)]
    rows += [(None, None, None, None, None, None, None), (None, "lone " * 9, None, None, None, None, 1), (50, "", "en", "a", 0, "x", 2), (51, "long words " * 40_000, "en", "b", 5, "y", 3)]
    rows += [(52, "same row of seven words or so", "en", "a", 5, "y", 3)] * 3 + [(1, "another text under a known id", "en", "a", 1, "z", 4)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, `a.b` string, size int")


def test_stages_on_odd_rows(spark):
    odd = odd_rows(spark).repartition(3)
    whole = Counter(map(tuple, odd.collect()))
    for name, stage in cp.STAGES[:4]:
        out = stage(spark, odd, SF)
        assert out.columns == odd.columns, name
        got = Counter(map(tuple, out.collect()))
        assert got and set(got) <= set(whole), name
        if name == "toxicity":
            assert got == whole
        if name == "near_copies":
            assert got == Counter({r: 1 if r[1] and r[1].split() else n for r, n in whole.items()})
    pieces = cp.STAGES[4][1](spark, odd, SF).collect()
    assert sum(r.start == 0 for r in pieces) == sum(whole.values())


def test_stages_on_an_empty_table(spark):
    empty = odd_rows(spark).limit(0)
    for name, stage in cp.STAGES:
        assert stage(spark, empty, SF).collect() == [], name
