"""Language identification by a bidirectional gated recurrent network over a document's bytes.

The network reads the UTF-8 bytes of the text, ASCII letters in lower case, in both directions and labels every byte with a
distribution over languages; a document's probabilities are the mean over all its bytes. A text is read in chunks of CHUNK
bytes, many side by side; the state of each direction runs across words and starts CONTEXT bytes ahead of the chunk, so a label
depends on at least that much text before and after its byte (or on all there is), and texts of any length take bounded memory.
Training is backpropagation through time in numpy, over stretches of the learning documents.

Defined results: NULL texts and texts without a letter are `und` with score 0. With no learnable row every text is `und`.
Ties go to the language that sorts first. Repeated rows are labelled each; other columns are not read. Every language
that has a learnable text is learned.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sievework.llm.common import id_text_crc, mapped, sized, trained

CHUNK = 192
CONTEXT = 32
HIDDEN = 8
#: Chunks that are read side by side.
LANES = 1024
#: Bounds of the learning sample: documents of each language, stretches of each document and their bytes.
PER_LANGUAGE = 500
STRETCHES = 6
STRETCH = 96
_LETTER = re.compile(r"[^\W\d_]")


def bytes_of(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "replace").lower()


class Lanes:
    """Runs of bytes side by side, the longest first, left-aligned (places by lanes)."""

    def __init__(self, runs: list[bytes]):
        self.n = np.fromiter(map(len, runs), np.int64, len(runs))
        wide = int(self.n.max(initial=0))
        self.bytes = np.zeros((wide, len(runs)), np.uint8)
        self.bytes.T[np.arange(wide) < self.n[:, None]] = np.frombuffer(b"".join(runs), np.uint8)


class BiGru:
    """params: for each direction d a table t{d} of input terms by byte, recurrent u{d}, output v{d}; then c."""

    def __init__(self, languages: list[str], params: dict[str, np.ndarray]):
        self.languages, self.params = languages, params

    def run(self, lanes: Lanes, d: str, keep: list | None = None) -> np.ndarray:
        """States (places, lanes, HIDDEN) of one direction, whose lanes come longest first; keep gets what the gradient needs."""
        t, u = self.params["t" + d], self.params["u" + d]
        states = np.zeros((*lanes.bytes.shape, HIDDEN), t.dtype)
        h = np.zeros((len(lanes.n), HIDDEN), t.dtype)
        live = np.searchsorted(-lanes.n, -np.arange(len(states)), side="left")
        for i, k in enumerate(live.tolist()):
            was, mixed = h[:k], h[:k] @ u
            x = t[lanes.bytes[i, :k]]
            zr = x[:, : 2 * HIDDEN] + mixed[:, : 2 * HIDDEN]
            np.tanh(np.multiply(zr, 0.5, out=zr), out=zr)  # the logistic function by way of tanh
            zr += 1
            zr *= 0.5
            z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
            new = np.tanh(x[:, 2 * HIDDEN :] + r * mixed[:, 2 * HIDDEN :])
            if keep is not None:
                keep.append((was, mixed, z, r, new))
            h = new + z * (was - new)
            states[i, :k] = h
        return states

    def labels(self, ahead: np.ndarray, back: np.ndarray) -> np.ndarray:
        """Distributions from the states of both directions at the same bytes."""
        logits = ahead @ self.params["vf"] + back @ self.params["vb"] + self.params["c"]
        e = np.exp(logits - logits.max(-1, keepdims=True))
        return e / e.sum(-1, keepdims=True)

    def gradient(self, runs: list[bytes], y: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean cross-entropy over all labelled bytes, by backpropagation through time; runs come longest first."""
        p, kept = self.params, {"f": [], "b": []}
        lanes, turned = Lanes(runs), Lanes([r[::-1] for r in runs])
        n, places = lanes.n, np.arange(len(lanes.bytes))[:, None]
        sf, sb = self.run(lanes, "f", kept["f"]), self.run(turned, "b", kept["b"])
        at = np.maximum(n - 1 - places, 0)[:, :, None]
        hb = np.take_along_axis(sb, at, 0)
        d = self.labels(sf, hb)
        d[:, np.arange(len(n)), y] -= 1
        d *= (places < n)[:, :, None] / n.sum()
        out = {"vf": np.tensordot(sf, d, ([0, 1], [0, 1])), "vb": np.tensordot(hb, d, ([0, 1], [0, 1])), "c": d.sum((0, 1))}
        d_back = np.where((places < n)[:, :, None], np.take_along_axis(d, at, 0), 0)
        for name, rows, err in (("f", lanes.bytes, d @ p["vf"].T), ("b", turned.bytes, d_back @ p["vb"].T)):
            u, gu, dh, moves = p["u" + name], np.zeros_like(p["u" + name]), np.zeros_like(err[0]), []
            for i in range(len(rows) - 1, -1, -1):
                was, mixed, z, r, new = kept[name][i]
                k = len(was)
                dh += err[i]
                own = dh[:k]
                dn = own * (1 - z) * (1 - new * new)
                dz = own * (was - new) * z * (1 - z)
                dr = dn * mixed[:, 2 * HIDDEN :] * r * (1 - r)
                moves.append((rows[i, :k], np.concatenate([dz, dr, dn], 1)))
                dm = np.concatenate([dz, dr, dn * r], 1)
                gu += was.T @ dm
                dh[:k] = own * z + dm @ u.T
            at_bytes, dx = (np.concatenate(x) for x in zip(*moves, strict=True))
            gt = np.column_stack([np.bincount(at_bytes, dx[:, j], 256) for j in range(dx.shape[1])])
            out |= {"t" + name: gt.astype(u.dtype), "u" + name: gu}
        return out


def document_sums(net: BiGru, texts: list[bytes]) -> np.ndarray:
    """For each text, the sum over its bytes of the label distributions."""
    out = np.zeros((len(texts), len(net.languages)))
    spans = [(min(CHUNK, len(t) - s), i, s) for i, t in enumerate(texts) for s in range(0, len(t), CHUNK)]
    spans.sort(key=lambda x: -x[0])
    for j in range(0, len(spans), LANES):
        part = spans[j : j + LANES]
        states = []
        for d in "fb":
            runs = [texts[i][max(0, s - CONTEXT) : s + n] if d == "f" else texts[i][s : s + n + CONTEXT][::-1] for n, i, s in part]
            lengths = np.fromiter(map(len, runs), np.int64, len(runs))
            order = np.argsort(-lengths, kind="stable")
            got = net.run(Lanes([runs[k] for k in order]), d)
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            # The chunk's own bytes are the last of the run, in the direction's order.
            own = np.fromiter((x[0] for x in part), np.int64, len(part))
            at = np.arange(own[0])[:, None]
            at = lengths - own + at if d == "f" else lengths - 1 - at
            states.append(got[np.clip(at, 0, len(got) - 1), place])
        p = net.labels(*states)
        p[np.arange(own[0])[:, None] >= own] = 0
        np.add.at(out, [i for _, i, _ in part], p.sum(0))
    return out


def stretches(rows: Iterable[dict], rng: np.random.Generator) -> Iterator[tuple[str, bytes]]:
    """(language, bytes) at random places of each row's whole text."""
    for r in rows:
        raw = bytes_of(r["text"])
        if _LETTER.search(r["text"] or ""):
            for at in rng.integers(max(1, len(raw) - STRETCH + 1), size=min(STRETCHES, -(-len(raw) // STRETCH))).tolist():
                yield r["lang"], raw[at : at + STRETCH]


def train(rows: Iterable[dict], batch: int = 384, steps: int = 130, seed: int = 3) -> BiGru | None:
    """The network from rows with text and lang; languages weigh the same."""
    rng = np.random.default_rng(seed)
    by: dict[str, list[bytes]] = {}
    for lang, raw in stretches(rows, rng):
        by.setdefault(lang, []).append(raw)
    languages = sorted(by)
    if not languages:
        return None
    k = len(languages)
    params = {"c": np.zeros(k)}
    for d in "fb":
        params |= {"t" + d: rng.normal(0, 0.3, (256, 3 * HIDDEN)), "u" + d: rng.normal(0, HIDDEN**-0.5, (HIDDEN, 3 * HIDDEN)), "v" + d: rng.normal(0, 0.3, (HIDDEN, k))}
    net = BiGru(languages, {q: v.astype(np.float32) for q, v in params.items()})
    first, second = ({q: np.zeros_like(v) for q, v in net.params.items()} for _ in range(2))
    for step in range(1, steps + 1):
        y = rng.integers(k, size=batch)
        runs = [by[languages[i]][rng.integers(len(by[languages[i]]))] for i in y]
        order = np.argsort([-len(x) for x in runs], kind="stable")
        rate = 0.03 * (1 - step / (steps + 1)) + 0.001
        for q, g in net.gradient([runs[i] for i in order], y[order]).items():
            first[q] = 0.9 * first[q] + 0.1 * g
            second[q] = 0.99 * second[q] + 0.01 * g * g
            net.params[q] -= (rate * (first[q] / (1 - 0.9**step)) / (np.sqrt(second[q] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return net


def predict(docs: DataFrame, net: BiGru | None) -> DataFrame:
    """(doc_id, lang_pred, score) of every row."""

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(1).to_pylist()
        names, scores = ["und"] * len(texts), np.zeros(len(texts))
        if net and (at := [i for i, t in enumerate(texts) if t and _LETTER.search(t)]):
            sums = document_sums(net, [bytes_of(texts[i]) for i in at])
            p = sums / sums.sum(1, keepdims=True)
            scores[at] = np.minimum(p.max(1), 1.0)
            for i, best in zip(at, p.argmax(1).tolist(), strict=True):
                names[i] = net.languages[best]
        return pa.record_batch([batch.column(0), pa.array(names, pa.string()), pa.array(scores)], ["doc_id", "lang_pred", "score"])

    return mapped(docs.select("doc_id", "text"), one, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double")


def learning_sample(docs: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """(lang, h, doc_id, text): of each language at most so many rows, those with the smallest hashes.

    Learnable: lang isn't NULL and crc32 of doc_id as text, modulo 4, is not 2. Rows are thinned by their hash before they are ranked;
    equal rows share it, so a language's rows with the least hash of those with a letter always stay.
    """
    known = docs.select("doc_id", "text", "lang").filter("lang is not null").filter((id_text_crc("doc_id") % 4 != 2) | F.col("doc_id").isNull())
    h = F.xxhash64("doc_id", "text")
    counts = known.groupBy("lang").agg(F.count("*").alias("rows"), F.min(F.when(F.col("text").rlike(r"\p{L}"), h)).alias("least"))
    share = 2.0 * per_language / F.col("rows")
    thinned = known.join(sized(counts), "lang").withColumn("h", h).filter((F.pmod("h", F.lit(1 << 30)) / F.lit(1 << 30) < share) | (F.col("h") == F.col("least")))
    ranked = thinned.withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy("h", "doc_id", "text")))
    return ranked.filter(F.col("n") <= per_language).select("lang", "h", "doc_id", "text")


def fit(docs: DataFrame) -> BiGru | None:
    """The network from learning_sample()."""
    return trained(learning_sample(docs), ["lang", "h", "doc_id", "text"], train)
