"""Toxic spans by a linear-chain conditional random field.

Documents carry labels, tokens don't, so the labelled tokens are derived first: a token of a toxic document is
labelled when its word, or the word's first four or five letters, is tied to toxic documents by a likelihood ratio beyond
chance, where near copies count once. The field sees other things than that list: of every token its word, prefixes and
suffix, and the words on both sides; the word itself is hidden for half of the labelled tokens, so that its
parts, its neighbours and the transitions must tell as well. It is trained on stretches around words of the list, in documents of
both classes, and on random stretches of clean documents, by gradient ascent on the conditional likelihood.
Forward-backward then gives every token of a whole text its marginal; the highest marginal and the expected number of
toxic tokens give the document's score through a logistic layer, and runs of tokens with a marginal of at least one
half are the offending spans.

Defined results: NULL and empty texts have no tokens, no spans and the score of a text without toxic tokens. With no
labelled rows of either class every score is 0. Repeated rows are scored each. Columns other than those named are not
read. Texts of any length are scored whole; common.LONGEST_ROW and CLASS_CHARS bound what is learned from.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from sievework.llm.common import CACHE_WORDS, fitting, labelled_sample, mapped, rows_where, texts_of, trained

PER_CLASS = {1: 2500, 0: 5000}
MIN_G = 20.0
MAX_CLEAN_RATIO = 0.05
#: Tokens on each side of a centre that a stretch for learning holds, and tokens of a clean document for each random centre.
WINDOW = 12
CLEAN_EVERY = 512
#: Weights nearer to 0 are left out of the field.
LEAST_WEIGHT = 0.02
SEGMENT = 64
MARGINAL_CAP = 12.0
_EDGES = re.compile(r"^\W+|\W+$")
_SPACED = re.compile(r"\S+")


def bare_word(token: str) -> str:
    """Lower case, without outer punctuation."""
    return _EDGES.sub("", token.lower())


def token_features(token: str) -> tuple[str, ...]:
    """The word, its prefixes and its suffix; none for a token without word characters. All but the suffix can label a token."""
    word = bare_word(token)
    return (f"w:{word}", f"4:{word[:4]}", f"5:{word[:5]}", f"s:{word[-3:]}") if len(word) > 3 else (f"w:{word}",) if word else ()


def _g(k1: int, n1: int, k0: int, n0: int) -> float:
    """Signed log-likelihood ratio of a feature seen in k1 of n1 toxic and k0 of n0 clean documents."""
    p = (k1 + k0) / (n1 + n0)
    total = sum(k * math.log(k / (n * q)) for k, n, q in ((k1, n1, p), (k0, n0, p), (n1 - k1, n1, 1 - p), (n0 - k0, n0, 1 - p)) if k)
    return 2 * total if k1 * n0 > k0 * n1 else -2 * total


def novel(tokens: list[str], seen: set[int]) -> bool:
    """Whether a document's smallest word-triple hashes are new; near copies would count as independent evidence."""
    low = sorted({zlib.crc32(" ".join(tokens[i : i + 3]).encode("utf-8", "replace")) for i in range(max(1, len(tokens) - 2))})[:4]
    fresh = seen.isdisjoint(low)
    seen.update(low)
    return fresh


def chain(odds: np.ndarray, lengths: np.ndarray, trans: np.ndarray, start: float) -> np.ndarray:
    """Forward odds of state 1 for every position of many sequences laid end to end.

    One step maps the odds before it by a Moebius transform, so a segment of SEGMENT steps is one 2x2 matrix; matrices
    of all segments are built together, chained along each sequence, and the steps inside replayed. The result is that
    of the plain recursion.
    """
    n = int(lengths.sum())
    if not n:
        return np.zeros(0)
    starts = np.cumsum(lengths) - lengths
    pos = np.arange(n) - np.repeat(starts, lengths)
    per = -(-lengths // SEGMENT)
    base = np.cumsum(per) - per
    seg, col = np.repeat(base, lengths) + pos // SEGMENT, pos % SEGMENT
    count = int(per.sum())
    e, real = np.ones((SEGMENT, count)), np.zeros((SEGMENT, count), bool)
    e[col, seg], real[col, seg] = odds, True
    first = np.zeros(count, bool)
    first[base[lengths > 0]] = True
    t00, t01, t10, t11 = trans.ravel()
    a, b, c, d = np.ones(count), np.zeros(count), np.zeros(count), np.ones(count)
    if per.max() > 1:
        for t in range(SEGMENT):
            m11, m01, m10, m00 = e[t] * t11, e[t] * t01, t10, t00
            if t == 0:
                m11, m01 = np.where(first, 0.0, m11), np.where(first, e[0] * start, m01)
                m10, m00 = np.where(first, 0.0, t10), np.where(first, 1.0, t00)
            a2, b2, c2, d2 = m11 * a + m01 * c, m11 * b + m01 * d, m10 * a + m00 * c, m10 * b + m00 * d
            scale = np.maximum(np.maximum(a2, b2), np.maximum(c2, d2))
            a, b, c, d = (np.where(real[t], x / scale, y) for x, y in ((a2, a), (b2, b), (c2, c), (d2, d)))
    before = np.ones(count)
    for r in range(1, int(per.max())):
        at = base[per > r] + r
        x = before[at - 1]
        before[at] = np.clip((a[at - 1] * x + b[at - 1]) / (c[at - 1] * x + d[at - 1]), 1e-200, 1e200)
    out = np.empty((SEGMENT, count))
    x = before
    for t in range(SEGMENT):
        y = e[t] * (t01 + t11 * x) / (t00 + t10 * x)
        x = np.clip(np.where(first, e[0] * start, y) if t == 0 else y, 1e-200, 1e200)
        out[t] = x
    return out[col, seg]


def marginal_logits(scores: np.ndarray, lengths: np.ndarray, trans: np.ndarray, start: float) -> np.ndarray:
    """Log-odds of the toxic state at every token given its whole sequence."""
    odds = np.exp(np.clip(scores, -30, 30))
    forward = chain(odds, lengths, trans, start)
    backward = chain(odds[::-1], lengths[::-1], trans.T, 1.0)[::-1]
    return np.log(np.maximum(forward, 1e-200)) + np.log(np.maximum(backward, 1e-200)) - np.log(odds)


class Crf:
    """Emission weights by feature, transition potentials and the logistic layer over a document's marginals."""

    def __init__(self, weights: dict[str, float], bias: float, trans: np.ndarray, start: float, layer: tuple[float, float, float] | None):
        self.weights, self.bias, self.trans, self.start, self.layer = weights, bias, trans, start, layer

    def token_scores(self, token: str) -> tuple[float, float, float]:
        """What a token adds to its own score, to that of the token after it and to that of the token before it."""
        word = bare_word(token)
        return sum(self.weights.get(f, 0.0) for f in token_features(token)), self.weights.get(f"l:{word}", 0.0), self.weights.get(f"r:{word}", 0.0)

    def emissions(self, table: np.ndarray, tokens: np.ndarray) -> np.ndarray:
        """Scores of a text's tokens, given as rows of a table of token_scores."""
        e = table[tokens, 0] + self.bias
        e[1:] += table[tokens[:-1], 1]
        e[:-1] += table[tokens[1:], 2]
        return e

    def document_stats(self, logits: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """For each sequence: its highest marginal log-odds, capped, and log(1 + expected toxic tokens among likely ones)."""
        out = np.zeros((len(lengths), 2))
        out[:, 0] = -MARGINAL_CAP
        full = lengths > 0
        if full.any():
            at = (np.cumsum(lengths) - lengths)[full]
            out[full, 0] = np.clip(np.maximum.reduceat(logits, at), -MARGINAL_CAP, MARGINAL_CAP)
            likely = np.where(logits > 0, 1 / (1 + np.exp(-np.clip(logits, 0, 50))), 0.0)
            out[full, 1] = np.log1p(np.add.reduceat(likely, at))
        return out

    def scores(self, stats: np.ndarray) -> np.ndarray:
        if self.layer is None:
            return np.zeros(len(stats))
        c, w0, w1 = self.layer
        return 1 / (1 + np.exp(-(c + w0 * stats[:, 0] + w1 * stats[:, 1])))


class _Tokens(dict):
    """Numbers of tokens, and a table with the scores of each."""

    def __init__(self, crf: Crf):
        super().__init__()
        self.crf, self.table = crf, np.zeros((1024, 3))

    def __missing__(self, token: str) -> int:
        n = len(self)
        if n == len(self.table):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        self.table[n] = self.crf.token_scores(token)
        self[token] = n
        return n


def _emit(cache: _Tokens, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    parts, lengths = [], np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        if len(cache) > CACHE_WORDS:
            cache.clear()
        tokens = text.split()
        lengths[i] = len(tokens)
        numbers = np.fromiter(map(cache.__getitem__, tokens), np.int64, len(tokens))
        parts.append(cache.crf.emissions(cache.table, numbers))
    return (np.concatenate(parts) if parts else np.zeros(0)), lengths


class Sample:
    """The learning documents as numbered tokens; features lists each token's features by number."""

    def __init__(self, rows: Iterable[dict]):
        self.names: dict[str, int] = {}
        self.features: list[tuple[int, ...]] = []
        self.tokens: list[np.ndarray] = []
        self.counts, self.independent = (Counter(), Counter()), [0, 0]
        toxic, numbers, copies = [], {}, (set(), set())
        for r in rows:
            tokens, y = r["text"].split(), r["y"] == 1
            for t in tokens:
                if t not in numbers:
                    numbers[t] = len(self.features)
                    self.features.append(tuple(self.names.setdefault(f, len(self.names)) for f in token_features(t)))
            self.tokens.append(np.fromiter(map(numbers.__getitem__, tokens), np.int32, len(tokens)))
            toxic.append(y)
            if novel(tokens, copies[y]):
                self.counts[y].update({f for t in set(self.tokens[-1].tolist()) for f in self.features[t]})
                self.independent[y] += 1
        self.toxic, self.words = np.array(toxic, bool), list(numbers)

    def forget_features(self) -> None:
        self.names, self.features, self.counts = {}, [], (Counter(), Counter())

    def telling(self, min_g: float) -> np.ndarray:
        """For each numbered token, whether one of its labelling features is tied to toxic documents."""
        (n0, n1), (clean, toxic) = self.independent, self.counts
        found = {f for f, k in toxic.items() if k > 1 and clean[f] * n1 <= MAX_CLEAN_RATIO * k * n0 and _g(k, n1, clean[f], n0) >= min_g}
        return np.array([any(f in found for f in fs[:3]) for fs in self.features], bool)


def stretches(sample: Sample, marked: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Tokens, their left and right neighbours (-1: none), labels, and the lengths of the stretches that they make up.

    A stretch is what lies within WINDOW tokens of a marked token or, in clean documents, of random centres; stretches that
    meet are one.
    """
    out: tuple[list, ...] = ([], [], [], [], [])
    for tokens, toxic in zip(sample.tokens, sample.toxic, strict=True):
        hit = marked[tokens]
        centres = np.flatnonzero(hit)
        if not toxic and len(tokens):
            centres = np.append(centres, rng.integers(len(tokens), size=-(-len(tokens) // CLEAN_EVERY)))
        edges = np.zeros(len(tokens) + 1, np.int64)
        np.add.at(edges, np.maximum(centres - WINDOW, 0), 1)
        np.add.at(edges, np.minimum(centres + WINDOW + 1, len(tokens)), -1)
        inside = np.cumsum(edges[:-1]) > 0
        bounds = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
        around = np.concatenate([[-1], tokens, [-1]])
        for part, values in zip(out, (tokens, around[:-2], around[2:], hit & toxic), strict=False):
            part.append(values[inside])
        out[4].append(bounds[1::2] - bounds[::2])
    return tuple(np.concatenate(x) if x else np.zeros(0, np.int64) for x in out)


def feature_rows(sample: Sample, tokens: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, list[str]]:
    """The features of every position, six at most, numbered from 1 (0: none), and their names; those seen once are left out."""
    count, width = len(sample.names), max([1, *map(len, sample.features)])
    own = np.full((len(sample.features) + 1, width), -1, np.int64)
    for i, fs in enumerate(sample.features):
        own[i, : len(fs)] = fs
    word = own[:, 0]  # the last row, which -1 reads, has none
    sides = [np.where(word[x] >= 0, word[x] + (i + 1) * count, -1)[:, None] for i, x in enumerate((left, right))]
    raw = np.concatenate([own[tokens], *sides], 1)
    seen = np.bincount(raw[raw >= 0], minlength=3 * count) > 1
    renumbered = np.append(np.where(seen, np.cumsum(seen), 0), 0)  # -1 reads the 0 at the end
    names = list(sample.names)
    return renumbered[raw].astype(np.int32), [(names[i] if i < count else "lr"[i // count - 1] + names[i % count][1:]) for i in np.flatnonzero(seen).tolist()]


def train(rows: Iterable[dict], min_g: float = MIN_G, steps: int = 60, seed: int = 11) -> Crf:
    """The field from rows with text and y."""
    sample = Sample(rows)
    if sample.toxic.all() or not sample.toxic.any():
        return Crf({}, -6.0, np.array([[1.0, 0.05], [0.5, 0.5]]), 0.05, None)
    rng = np.random.default_rng(seed)
    tokens, left, right, label, lengths = stretches(sample, sample.telling(min_g), rng)
    f, names = feature_rows(sample, tokens, left, right)
    sample.forget_features()
    f[label.astype(bool) & (rng.random(len(f)) < 0.5), 0] = 0
    y = label.astype(float)
    last = np.zeros(len(y), bool)
    last[np.cumsum(lengths) - 1] = True
    here = np.flatnonzero(~last)  # positions whose stretch goes on
    k = len(names) + 1
    params = np.zeros(k + 4)  # features (0 is none), bias, then log potentials 0->1, 1->0, 1->1
    params[-4:] = (-3.0, -1.0, 0.0, 0.0)
    rate, first, second = 0.15, np.zeros_like(params), np.zeros_like(params)
    seen = np.stack([(1 - y[here]) * y[here + 1], y[here] * (1 - y[here + 1]), y[here] * y[here + 1]]).sum(1)
    for step in range(1, steps + 1):
        flat = params[f].sum(1) + params[-4]
        trans = np.exp(np.array([[0.0, params[-3]], [params[-2], params[-1]]]))
        odds = np.exp(np.clip(flat, -30, 30))
        fw, bw = chain(odds, lengths, trans, 1.0), chain(odds[::-1], lengths[::-1], trans.T, 1.0)[::-1]
        residual = y - 1 / (1 + odds / (fw * bw))
        a, c = fw[here], bw[here + 1]
        joint = np.stack([trans[0, 1] * c, trans[1, 0] * a, trans[1, 1] * a * c])
        joint /= trans[0, 0] + joint.sum(0)
        grad = np.bincount(f.ravel(), np.repeat(residual, f.shape[1]), len(params))
        grad[-4:] = residual.sum(), *(seen - joint.sum(1))
        grad[0] = 0
        grad = grad / max(1, len(lengths)) - 1e-4 * params
        first, second = 0.9 * first + 0.1 * grad, 0.99 * second + 0.01 * grad * grad
        params += rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
        params[0] = 0
    weights = {n: float(w) for n, w in zip(names, params[1:k], strict=True) if abs(w) >= LEAST_WEIGHT}
    crf = Crf(weights, float(params[-4]), np.exp(np.array([[0.0, params[-3]], [params[-2], params[-1]]])), 1.0, None)
    crf.layer = document_layer(crf, sample)
    return crf


def document_layer(crf: Crf, sample: Sample) -> tuple[float, float, float]:
    """The logistic layer over document_stats, by Newton's method with a small penalty."""
    table = np.array([crf.token_scores(w) for w in sample.words]).reshape(-1, 3)
    stats = []
    for i in range(0, len(sample.tokens), 500):
        part = sample.tokens[i : i + 500]
        e, n = np.concatenate([crf.emissions(table, t) for t in part]), np.array([len(t) for t in part])
        stats.append(crf.document_stats(marginal_logits(e, n, crf.trans, crf.start), n))
    x, layer = np.column_stack([np.ones(len(sample.tokens)), np.concatenate(stats)]), np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ layer, -40, 40)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 0.05 * np.eye(3)
        move = np.linalg.solve(hessian, x.T @ (sample.toxic - p) - 0.05 * layer)
        layer += move * min(1.0, 3.0 / (np.abs(move).max() + 1e-12))
    return tuple(float(v) for v in layer)


def spans_of(text: str, toxic: np.ndarray) -> list[dict]:
    """Character offsets of runs of toxic tokens."""
    out: list[dict] = []
    before = False
    for flag, match in zip(toxic, _SPACED.finditer(text), strict=False):
        if flag and before:
            out[-1]["end"] = match.end()
        elif flag:
            out.append({"start": match.start(), "end": match.end()})
        before = bool(flag)
    return out


SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def _scored(crf: Crf, cache: _Tokens, texts: list[str], with_spans: bool) -> tuple[np.ndarray, list | None]:
    e, n = _emit(cache, texts)
    logits = marginal_logits(e, n, crf.trans, crf.start)
    scores = crf.scores(crf.document_stats(logits, n))
    if not with_spans:
        return scores, None
    ends = np.cumsum(n)
    hits = logits > 0
    any_hit = np.add.reduceat(np.append(hits, False), np.minimum(ends - n, len(hits))) if len(n) else []
    spans = [spans_of(t, hits[b - k : b]) if k and h else [] for t, h, b, k in zip(texts, any_hit, ends, n, strict=True)]
    return scores, spans


def score(docs: DataFrame, crf: Crf, threshold: float = 0.7) -> DataFrame:
    """(doc_id, score, predicted, spans) of every row."""
    cache = _Tokens(crf)

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        scores, spans = _scored(crf, cache, texts_of(batch), True)
        return pa.record_batch([batch.column(0), pa.array(scores), pa.array((scores >= threshold).astype(np.int32)), pa.array(spans, SPANS)], ["doc_id", "score", "predicted", "spans"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return mapped(docs.select("doc_id", "text"), one, f"doc_id {kind}, score double, predicted int, spans array<struct<start:int,end:int>>")


def keep_clean(docs: DataFrame, crf: Crf, threshold: float = 0.7) -> DataFrame:
    """The rows of docs, all columns, whose score is below the threshold."""
    cache = _Tokens(crf)
    return rows_where(docs, lambda texts: _scored(crf, cache, texts, False)[0] < threshold)


def fit(docs: DataFrame, labels: DataFrame, per_class: dict[int, int] | None = None) -> Crf:
    """The field from a bounded sample of learnable labelled rows (per_class rows of each class at most)."""
    return trained(labelled_sample(docs, labels, "toxic", per_class or PER_CLASS), ["h", "doc_id"], lambda rows: train(fitting(rows)))
