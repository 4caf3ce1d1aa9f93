"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages, runs of PASSAGE words over the whole text. Each passage is encoded by statistics of
its words (hashed word shapes, lengths, letter cases, symbols, repetition), mapped to a hidden vector; gated attention
(tanh times sigmoid) weighs the passages, and the weighted sum is scored by a logistic unit. Everything is learned
from document labels alone by Adam on exact gradients.

Defined results: NULL and empty texts have no passage and score as the zero representation. With no labelled rows of
either class every score is 1, so that nothing is rejected. Repeated rows are scored each; other columns are not read.
Texts of any length are scored whole; common.LONGEST_ROW and CLASS_CHARS bound what is learned from.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from itertools import batched, chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from sievework.llm.common import CACHE_WORDS, fitting, labelled_sample, mapped, rows_where, texts_of, trained

PER_CLASS = {0: 2500, 1: 3500}
PASSAGE = 48
SHAPES = 40
HIDDEN = 16
GATE = 12
_RUNS = re.compile(r"(.)\1+")
_TRAITS = 9


def word_row(word: str) -> np.ndarray:
    """The encoding of one word: its traits, then its shape hashed to one of SHAPES columns."""
    n = len(word)
    letters = sum(c.isalpha() for c in word)
    upper = sum(c.isupper() for c in word)
    digits = sum(c.isdigit() for c in word)
    row = np.zeros(_TRAITS + SHAPES, np.float32)
    row[:_TRAITS] = (
        min(n, 40) / 10, n > 20, upper > 1 and upper == letters, letters == 0, digits > 0,
        min(n - letters - digits, 8) / 4, word[-1] in ".!?", letters > 0 and word[0].isupper(), letters / n,
    )
    shape = _RUNS.sub(r"\1", "".join("A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c for c in word))
    row[_TRAITS + shape_hash(map(ord, shape)) % SHAPES] = 1
    return row


def shape_hash(codes: Iterable[int]) -> int:
    h = 2166136261
    for c in codes:
        h = (h ^ c) * 16777619 & 0xFFFFFFFF
    return h


_KNOWN, _ALPHA, _UPPER, _DIGIT = 1, 2, 4, 8
#: These bits of each code point; 0 until it is first met.
_KINDS = np.zeros(0x110000, np.uint8)
#: Longest shape, without its repeats, that is hashed side by side with those of other words.
_LONG_SHAPE = 32


def _kinds(codes: np.ndarray) -> np.ndarray:
    """The bits of every code point given."""
    kinds = _KINDS[codes]
    if len(new := np.unique(codes[kinds == 0])):
        _KINDS[new] = [_KNOWN | _ALPHA * c.isalpha() | _UPPER * c.isupper() | _DIGIT * c.isdigit() for c in map(chr, new)]
        kinds = _KINDS[codes]
    return kinds


def word_rows(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The encodings of many words at once, as word_row has them: their traits, and which of SHAPES columns their shape has."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
    kinds, at = _kinds(codes), np.cumsum(sizes) - sizes
    letters, upper, digits = (np.add.reduceat((kinds & bit) > 0, at, dtype=np.int64) for bit in (_ALPHA, _UPPER, _DIGIT))
    traits = np.empty((len(words), _TRAITS), np.float32)
    for i, column in enumerate((
        np.minimum(sizes, 40) / 10, sizes > 20, (upper > 1) & (upper == letters), letters == 0, digits > 0,
        np.minimum(sizes - letters - digits, 8) / 4, np.isin(codes[at + sizes - 1], [46, 33, 63]), (letters > 0) & ((kinds[at] & _UPPER) > 0), letters / sizes,
    )):
        traits[:, i] = column
    shape = np.where(kinds & _UPPER, 65, np.where(kinds & _ALPHA, 97, np.where(kinds & _DIGIT, 48, codes)))
    fresh = np.ones(len(codes), bool)
    fresh[1:] = shape[1:] != shape[:-1]
    fresh[at] = True
    left = np.add.reduceat(fresh, at, dtype=np.int64)
    shape, at = shape[fresh], np.cumsum(left) - left
    hashes = np.full(len(words), 2166136261, np.uint32)
    todo = np.flatnonzero(left <= _LONG_SHAPE)
    for i in range(_LONG_SHAPE):
        todo = todo[left[todo] > i]
        hashes[todo] = (hashes[todo] ^ shape[at[todo] + i]) * np.uint32(16777619)
    for k in np.flatnonzero(left > _LONG_SHAPE):
        hashes[k] = shape_hash(shape[at[k] : at[k] + left[k]].tolist())
    return traits, (hashes % SHAPES).astype(np.int64)


class _Words(dict):
    """Row numbers of words in a growing table of encodings; those of new words are made together by fill."""

    def __init__(self):
        super().__init__()
        self.fresh: list[str] = []
        self.traits, self.shapes = np.zeros((0, _TRAITS), np.float32), np.zeros(0, np.int64)

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        self.fresh.append(word)
        return n

    def fill(self) -> None:
        if self.fresh:
            traits, shapes = word_rows(self.fresh)
            self.traits, self.shapes, self.fresh = np.concatenate([self.traits, traits]), np.concatenate([self.shapes, shapes]), []

    def forget(self) -> None:
        self.clear()
        self.__init__()


DIMS = _TRAITS + SHAPES + 4
#: Words of the cache, which texts encoded together may exceed once.
_CACHE = CACHE_WORDS // 2
#: Code points of texts that are encoded together; a longer text is encoded alone.
TOGETHER = 500_000


def encode(cache: _Words, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The passages of all texts, one row each, and how many each text has."""
    rows, counts, start, chars = [], [], 0, 0
    for i, text in enumerate(texts):
        if i > start and chars + len(text) > TOGETHER:
            x, n = _encoded(cache, texts[start:i])
            rows, counts, start, chars = [*rows, x], [*counts, n], i, 0
        chars += len(text)
    x, n = _encoded(cache, texts[start:])
    return np.concatenate([*rows, x]), np.concatenate([*counts, n])


def _passages(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The number of passages of each text of so many words, and the number of words of each passage."""
    counts = -(-sizes // PASSAGE)
    lengths = np.full(counts.sum(), PASSAGE)
    full = counts > 0
    lengths[np.cumsum(counts)[full] - 1] = (sizes - (counts - 1) * PASSAGE)[full]
    return counts, lengths


def _distinct(ids: np.ndarray, sizes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many different ids there are in each run of ids; at has the places where runs begin."""
    keys = np.sort(np.repeat(np.arange(len(sizes)) * (ids.max() + 1), sizes) + ids)
    fresh = np.ones(len(keys), bool)
    fresh[1:] = keys[1:] != keys[:-1]
    return np.add.reduceat(fresh, at, dtype=np.int64)


def _encoded(cache: _Words, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """As encode, all texts at once."""
    if len(cache) > _CACHE:
        cache.forget()
    parts = [text.split() for text in texts]
    words = np.fromiter(map(len, parts), np.int64, len(parts))
    counts, sizes = _passages(words)
    if not len(sizes):
        return np.zeros((0, DIMS), np.float32), counts
    ids = np.fromiter(map(cache.__getitem__, chain.from_iterable(parts)), np.int64, words.sum())
    cache.fill()
    at, owner = np.cumsum(sizes) - sizes, np.repeat(np.arange(len(texts)), counts)
    x = np.empty((len(sizes), DIMS), np.float32)
    x[:, :_TRAITS] = np.add.reduceat(cache.traits[ids], at, axis=0) / sizes[:, None]
    shapes = np.bincount(np.repeat(np.arange(len(sizes)) * SHAPES, sizes) + cache.shapes[ids], minlength=len(sizes) * SHAPES)
    x[:, _TRAITS : _TRAITS + SHAPES] = shapes.reshape(-1, SHAPES) / sizes[:, None]
    full = words[words > 0]
    ends = np.cumsum(full)
    same = np.append(ids[1:] == ids[:-1], False)
    same[ends - 1] = False
    whole = np.zeros(len(texts))
    whole[words > 0] = _distinct(ids, full, ends - full) / full**0.9
    x[:, -4] = _distinct(ids, sizes, at) / sizes
    x[:, -3] = np.add.reduceat(same, at, dtype=np.int64) / sizes
    x[:, -2] = np.log1p(sizes) / 4
    x[:, -1] = whole[owner]
    return x, counts


class Mil:
    """Encoder, gated attention and output unit; mean and scale standardise the passages."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, params: dict[str, np.ndarray] | None):
        self.mean, self.scale, self.params = mean, scale, params

    def forward(self, x: np.ndarray, counts: np.ndarray) -> dict[str, np.ndarray]:
        p = self.params
        x = np.clip((x - self.mean) / self.scale, -8, 8)
        h = np.tanh(x @ p["w"] + p["b"])
        v, u = np.tanh(h @ p["v"]), 1 / (1 + np.exp(-(h @ p["u"])))
        raw = (v * u) @ p["a"]
        full = counts > 0
        at, owner = (np.cumsum(counts) - counts)[full], np.repeat(np.arange(len(counts)), counts)
        top = np.zeros(len(counts))
        weight, z = np.zeros(len(x)), np.zeros((len(counts), p["w"].shape[1]))
        if len(at):
            top[full] = np.maximum.reduceat(raw, at)
            weight = np.exp(raw - top[owner])
            total = np.ones(len(counts))
            total[full] = np.add.reduceat(weight, at)
            weight = weight / total[owner]
            z[full] = np.add.reduceat(h * weight[:, None], at, axis=0)
        logit = z @ p["o"] + p["c"][0]
        return {"x": x, "h": h, "v": v, "u": u, "owner": owner, "weight": weight, "z": z, "score": 1 / (1 + np.exp(-np.clip(logit, -40, 40)))}

    def gradient(self, x: np.ndarray, counts: np.ndarray, y: np.ndarray, weights: np.ndarray) -> dict[str, np.ndarray]:
        p, f = self.params, self.forward(x, counts)
        d = (f["score"] - y) * weights / weights.sum()
        h, v, u, owner, a = f["h"], f["v"], f["u"], f["owner"], f["weight"]
        dz = d[:, None] * p["o"]
        da = (dz[owner] * h).sum(1)
        mean = np.bincount(owner, a * da, len(counts)) if len(a) else np.zeros(len(counts))
        draw = a * (da - mean[owner])
        dv, du = draw[:, None] * u * p["a"] * (1 - v * v), draw[:, None] * v * p["a"] * u * (1 - u)
        dh = dz[owner] * a[:, None] + dv @ p["v"].T + du @ p["u"].T
        dx = dh * (1 - h * h)
        return {"w": f["x"].T @ dx, "b": dx.sum(0), "v": h.T @ dv, "u": h.T @ du, "a": (v * u).T @ draw, "o": f["z"].T @ d, "c": np.array([d.sum()])}

    def scores(self, x: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return np.ones(len(counts)) if self.params is None else self.forward(x, counts)["score"]


def train(rows: Iterable[dict], epochs: int = 14, seed: int = 5) -> Mil:
    """The model from rows with text and y."""
    cache, parts, y = _Words(), [encode(_Words(), [])], []
    for some in batched(rows, 64):
        parts.append(encode(cache, [r["text"] for r in some]))
        y += [float(r["y"] == 1) for r in some]
    x, counts, y = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]), np.array(y)
    if not len(x) or y.min() == y.max():
        return Mil(np.zeros(DIMS), np.ones(DIMS), None)
    rng = np.random.default_rng(seed)
    scale = x.std(0)
    shape = {"w": (DIMS, HIDDEN), "b": HIDDEN, "v": (HIDDEN, GATE), "u": (HIDDEN, GATE), "a": GATE, "o": HIDDEN, "c": 1}
    params = {k: rng.normal(0, 0.3 if k in "vuao" else 0.0 if k in "bc" else 0.15, s) for k, s in shape.items()}
    mil = Mil(x.mean(0), np.where(scale < 1e-3, 1.0, scale), params)
    starts = np.cumsum(counts) - counts
    weights = np.where(y == 1, 1.5, 1.0)
    first, second, step = ({k: np.zeros_like(v) for k, v in params.items()} for _ in range(2)), None, 0
    first, second = first
    for epoch in range(max(epochs, min(200, 60_000 // len(y)))):
        order = rng.permutation(len(y))
        for i in range(0, len(order), 128):
            part = order[i : i + 128]
            n = counts[part]
            at = np.repeat(starts[part] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            step += 1
            for k, g in mil.gradient(x[at], n, y[part], weights[part]).items():
                g = g + 1e-4 * params[k]
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                params[k] -= 0.01 * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return mil


def score(docs: DataFrame, mil: Mil, threshold: float = 0.5) -> DataFrame:
    """(doc_id, score, predicted) of every row."""
    cache = _Words()

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        scores = mil.scores(*encode(cache, texts_of(batch)))
        return pa.record_batch([batch.column(0), pa.array(scores, pa.float64()), pa.array((scores >= threshold).astype(np.int32))], ["doc_id", "score", "predicted"])

    return mapped(docs.select("doc_id", "text"), one, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double, predicted int")


def keep_good(docs: DataFrame, mil: Mil, threshold: float = 0.5) -> DataFrame:
    """The rows of docs, all columns, whose score reaches the threshold."""
    cache = _Words()
    return rows_where(docs, lambda texts: mil.scores(*encode(cache, texts)) >= threshold)


def fit(docs: DataFrame, labels: DataFrame, per_class: dict[int, int] | None = None) -> Mil:
    """The model from a bounded sample of learnable labelled rows (per_class rows of each class at most)."""
    return trained(labelled_sample(docs, labels, "quality", per_class or PER_CLASS), ["h", "doc_id"], lambda rows: train(fitting(rows)))
