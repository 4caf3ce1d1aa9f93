"""Mixture-controlled packing of tokenised documents into fixed windows.

Each source is a queue: the token ids of its documents, end to end, in the order of hashed buckets and ids. Windows are
filled by deficit round-robin: before a window every queue is credited its share of the window (its target, or its part of all
tokens), serves the whole tokens it is owed, and carries the rest as its deficit; tokens left over go to the queues with the
largest deficits. A queue that runs dry leaves its share to the others in proportion. The state at any window follows in
closed form from totals and weights, so each task fills its own stretch of every queue, and deficits carry over
windows and partitions alike. Documents are cut wherever a window ends; only the last window is padded.

A queue needs at least one token a window. Without targets, sources with less share one queue, in the same order, and if that
has less still it joins the smallest other queue; so there are at most as many queues as a window has tokens.

Tokens come from a public vocabulary that lower-cases and splits at white space, so the ids of a text are those of its
words, and a worker encodes each distinct word once, as long as it keeps it. Arrow splits a batch into words, parts them from the marks
at their ends and numbers the distinct ones, so that Python sees each of them once a batch.

Defined results: NULL counts as the empty text, whose only id is the end id. A NULL source is a source. Repeated rows are
documents of their own. An empty table stays empty. Other columns are not read. Ids are kept in 16 bits; a vocabulary with a
larger id is refused.
"""

from __future__ import annotations

import bisect
import codecs
import functools
import unicodedata
import zlib
from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sievework.llm.common import mapped, release_memory, small_batches, texts_of, written

WINDOW = 2048
END_ID = 1
BUCKETS_PER_TASK = 4
#: Words with their ids that a Python worker keeps before it starts afresh, about 130 bytes each; most of the time goes into words that it doesn't hold.
KEPT_WORDS = 800_000
#: Marks that may follow a word without changing how its letters are split.
_MARKS = '.,!?;:*$%&#|"()[]{}-+=/\\@~^<>_`'
#: A word of more letters, as whole texts without white space are, isn't kept.
LONGEST_KEPT = 64
#: Rows and characters that are encoded at once: Arrow holds them without an object a word, and the more there are, the fewer words are looked up again.
ROWS, CHARS = 2048, 16_000_000
#: Windows of a schedule that are worked out together, and cells of them (windows times queues) that a task keeps.
BLOCK, BLOCK_CELLS, KEPT_CELLS = 256, 65_536, 4_000_000


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _byte_letters() -> str:
    """The letters for bytes of byte-level vocabularies: printable Latin-1 stands for itself, the rest follows from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return "".join(chr(b if b in plain else 256 + rest.index(b)) for b in range(256))


def _strings(words: pa.Array) -> list[str]:
    """The values of an array of words without spaces; as_py() value by value takes many times as long."""
    joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words), " ")
    return joined[0].as_py().split(" ") if len(words) else []


class WordIds(dict):
    """Little-endian 16-bit ids, as bytes, of words (runs of letters) with ASCII in lower case; None for what isn't encoded by its letters alone."""

    def __init__(self, path: str):
        super().__init__()
        self.path, self.tokenizer = path, None
        self.letters = _byte_letters()
        self.others: dict[str, bytes] = {}

    def __reduce__(self):
        return words_of_worker, (self.path,)

    def _load(self) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(self.path)
        size = self.tokenizer.get_vocab_size()
        if size > 1 << 16:
            raise ValueError(f"{self.path}: ids beyond 16 bits")
        self.model = self.tokenizer.model
        self.id_bytes = [i.to_bytes(2, "little") for i in range(size)]

    def _whole(self, text: str) -> bytes:
        """The ids of marks, or of any run without ASCII white space."""
        if (ids := self.others.get(text)) is None:
            ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u2").tobytes()
            if len(text) <= LONGEST_KEPT:
                self.others[text] = ids
        return ids

    def _merge(self, letters: str) -> bytes:
        """The ids of lower-case letters in composed form, which are one unit to the vocabulary's merges."""
        if not letters.isascii():
            letters = codecs.charmap_decode(letters.encode(), "strict", self.letters)[0]
        id_bytes = self.id_bytes
        return b"".join([id_bytes[t.id] for t in self.model.tokenize(letters)])

    def __missing__(self, word: str) -> bytes | None:
        ids = None
        if word.isalpha():
            low = word.lower()
            # A capital sigma lowers by its context in Python, and some letters lower to a letter and a mark.
            if word.isascii() or "Σ" not in word and low.isalpha() and unicodedata.is_normalized("NFC", word):
                ids = self._merge(low)
        if len(word) <= LONGEST_KEPT:
            self[word] = ids
        return ids

    def clear(self) -> None:
        super().clear()
        self.others.clear()

    def _known(self, words: list[str], ids_of: Callable[[str], bytes | None]) -> pa.Array:
        out = []
        for i in range(0, len(words), ROWS):
            if len(self) + len(self.others) > KEPT_WORDS:
                self.clear()
            out += map(ids_of, words[i : i + ROWS])
        return pa.array(out, pa.binary())

    def documents(self, texts: list[str]) -> list[bytes]:
        """The ids of each text and the end id.

        Letters are encoded by themselves and marks after them by themselves; any other run without ASCII white space goes whole, also
        where other white space lies within.
        """
        if self.tokenizer is None:
            self._load()
        if len(texts) > 1 and sum(map(len, texts)) > CHARS:
            half = len(texts) // 2
            return self.documents(texts[:half]) + self.documents(texts[half:])
        runs = pc.ascii_split_whitespace(pa.array(texts, pa.string()))
        coded = runs.values.dictionary_encode()
        forms = coded.dictionary
        cores = pc.ascii_rtrim(forms, characters=_MARKS)
        words = pc.ascii_lower(cores).dictionary_encode()
        ids = self._known(_strings(words.dictionary), self.__getitem__).take(words.indices)

        odd = ids.is_null()
        marks = pc.subtract(pc.binary_length(forms), pc.binary_length(cores))
        marked = pc.and_not(pc.greater(marks, 0), odd)
        ends = [f[-n:] for f, n in zip(_strings(forms.filter(marked)), marks.filter(marked).to_numpy().tolist(), strict=True)]
        ids = pc.replace_with_mask(ids, odd, self._known(_strings(forms.filter(odd)), self._whole))
        tails = pc.replace_with_mask(pa.repeat(pa.scalar(b"", pa.binary()), len(forms)), marked, self._known(ends, self._whole))
        ids = pc.binary_join_element_wise(ids, tails, pa.scalar(b"", pa.binary())).take(coded.indices)

        _, at, data = ids.buffers()
        ends = np.frombuffer(at, np.int32, len(ids) + 1)[runs.offsets.to_numpy()].tolist() if len(ids) else [0] * (len(texts) + 1)
        view, end = memoryview(data or b""), END_ID.to_bytes(2, "little")
        return [b"".join((view[i:j], end)) for i, j in zip(ends, ends[1:], strict=False)]


@functools.cache
def words_of_worker(path: str) -> WordIds:
    """The words that a Python worker has met, for all its tasks; the cutting into windows, which needs no words, lets go of them."""
    return WordIds(path)


class Schedule:
    """The closed form of deficit round-robin over queues with given totals and weights (the totals themselves where none are given).

    While all queues last, a queue's part of the ids is its weight's part of all weights; a queue that runs dry leaves its part to
    the others. So queue q has given min(total_q, level * weight_q) when the level is such that these amounts add up, which
    holds for every count of ids, whatever was served before. Amounts are exact fractions, rounded to whole ids.
    """

    def __init__(self, totals: list[int], window: int = WINDOW, weights: list[int] | None = None):
        self.totals, self.window, self.all = totals, window, sum(totals)
        self.weights = weights or totals
        # Queues in the order in which they run dry: the level, the ids of all queues up to there, the weight that lasts beyond.
        order = sorted(range(len(totals)), key=lambda q: Fraction(totals[q], self.weights[q]))
        self.steps: list[tuple[Fraction, Fraction, int]] = [(Fraction(0), Fraction(0), sum(self.weights))]
        for q in order:
            level, ids, weight = self.steps[-1]
            dry = Fraction(totals[q], self.weights[q])
            self.steps.append((dry, ids + (dry - level) * weight, weight - self.weights[q]))
        self.even = weights is None
        self.block = max(1, min(BLOCK, BLOCK_CELLS // max(1, len(totals))))
        self._blocks: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def level(self, ids: int) -> Fraction:
        at = bisect.bisect_right(self.steps, ids, key=lambda s: s[1]) - 1
        level, before, weight = self.steps[at]
        return level + (ids - before) / weight if weight else level

    def served(self, w: int) -> list[int]:
        """Ids that each queue has given before window w."""
        at = min(w * self.window, self.all)
        level = self.level(at)
        top, bottom = level.numerator, level.denominator
        whole, rest = zip(*(divmod(min(t * bottom, wt * top), bottom) for t, wt in zip(self.totals, self.weights, strict=True)), strict=True)
        got = list(whole)
        for q in sorted(range(len(rest)), key=lambda q: (-rest[q], q))[: at - sum(whole)]:
            got[q] += 1
        return got

    def table(self, w: int, n: int) -> np.ndarray:
        """served() of n windows from w on, a row each.

        Where queues weigh what they have, whole ids and remainders grow by the same amounts from window to window, so that only
        the first row takes numbers beyond 64 bits.
        """
        if not self.even:
            return np.array([self.served(i) for i in range(w, w + n)], np.int64)
        step = np.arange(n, dtype=np.int64)[:, None]
        first = np.array([divmod(w * self.window * t, self.all) for t in self.totals], np.int64)
        grown = np.array([divmod(self.window * t, self.all) for t in self.totals], np.int64)
        more, rest = np.divmod(first[:, 1] + step * grown[:, 1], self.all)
        got = first[:, 0] + step * grown[:, 0] + more
        left = (w + step) * self.window - got.sum(axis=1, keepdims=True)
        order = np.argsort(-rest, axis=1, kind="stable")
        np.put_along_axis(got, order, np.take_along_axis(got, order, 1) + (np.arange(len(self.totals)) < left), 1)
        got[(w + step[:, 0]) * self.window >= self.all] = self.totals
        return got

    def _block(self, b: int) -> tuple[np.ndarray, np.ndarray]:
        """For a block of windows: ids given before each window and the next one after them, and where each queue's ids begin in a window."""
        if (got := self._blocks.get(b)) is None:
            if len(self._blocks) * self.block * len(self.totals) > KEPT_CELLS:
                self._blocks.clear()
            served = self.table(b * self.block, self.block + 1)
            part = np.diff(served, axis=0)
            got = self._blocks[b] = served, np.cumsum(part, axis=1) - part
        return got

    def _given(self, q: int, w: int) -> int:
        return int(self._block(w // self.block)[0][w % self.block, q])

    def window_of(self, q: int, place: int) -> int:
        level = Fraction(place, self.weights[q])
        at = bisect.bisect_right(self.steps, level, key=lambda s: s[0]) - 1
        w = int((self.steps[at][1] + (level - self.steps[at][0]) * self.steps[at][2]) // self.window)
        while w and self._given(q, w) > place:
            w -= 1
        while self._given(q, w + 1) <= place:
            w += 1
        return w

    def pieces(self, q: int, place: int, sizes: np.ndarray) -> tuple[np.ndarray, ...]:
        """(document, start there, length, window, offset there) of the pieces of documents that follow each other in a queue from a place on."""
        ends = place + np.cumsum(sizes)
        first, last = self.window_of(q, place), self.window_of(q, int(ends[-1]) - 1)
        bounds, offsets = [], []
        for b in range(first // self.block, last // self.block + 1):
            served, begins = self._block(b)
            i, j = max(first - b * self.block, 0), min(last + 1 - b * self.block, self.block)
            bounds.append(served[i:j, q])
            offsets.append(begins[i:j, q])
        bounds, offsets = np.concatenate(bounds), np.concatenate(offsets)
        # A piece begins where a document or a window does.
        starts = np.union1d(np.concatenate(([place], ends[:-1])), bounds[bounds > place])
        docs = np.searchsorted(ends, starts, "right")
        windows = np.searchsorted(bounds, starts, "right") - 1
        lengths = np.diff(starts, append=ends[-1])
        return docs, starts - (ends - sizes)[docs], lengths, first + windows, offsets[windows] + starts - bounds[windows]


def tokenised(docs: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, source, n, ids): every row's ids with the end id, 16 bits each."""
    cache = WordIds(tokenizer)

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = cache.documents(texts_of(batch))
        return pa.record_batch([batch.column(0), batch.column(2), pa.array([len(x) // 2 for x in ids], pa.int64()), pa.array(ids, pa.binary())], ["doc_id", "source", "n", "ids"])

    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}
    return mapped(docs.select("doc_id", "text", "source"), one, f"doc_id {kinds['doc_id']}, source {kinds['source']}, n long, ids binary", ROWS)


def _sorted(rows: list) -> list[tuple]:
    return sorted(((r["source"], r["tokens"]) for r in rows), key=lambda x: (x[0] is None, x[0] or ""))


def _own_shares(by_source: DataFrame, total: int, window: int) -> tuple[list[tuple], list[int], None, int]:
    """Sources with a queue of their own, tokens of all queues, no weights, and the queue of all other sources.

    At most `window` sources can have a token in each window, so the list is bounded.
    """
    large = _sorted(by_source.filter(F.col("tokens") * window >= total).collect())
    totals = [t for _, t in large]
    rest = total - sum(totals)
    other = len(totals)
    if rest * window >= total:
        totals.append(rest)
    elif rest:
        other = min(range(len(totals)), key=lambda q: (totals[q], q))
        totals[other] += rest
    return large, totals, None, other


def _target_shares(by_source: DataFrame, targets: dict[str | None, int], window: int) -> tuple[list[tuple], list[int], list[int], int]:
    """As _own_shares, with a queue for each named source and one, of weight 1, for all others."""
    if any(w < 1 for w in targets.values()) or sum(targets.values()) >= window:
        raise ValueError("targets are whole numbers from 1 that add up to less than a window")
    named = F.array(*[F.lit(s) for s in targets if s is not None]).cast("array<string>")
    chosen = F.coalesce(F.array_contains(named, F.col("source").cast("string")), F.lit(None in targets))
    large = _sorted(by_source.filter(chosen).collect())
    totals, weights, other = [t for _, t in large], [targets[s] for s, _ in large], len(large)
    if rest := by_source.filter(~chosen).agg(F.sum("tokens")).first()[0]:
        totals.append(rest)
        weights.append(1)
    return large, totals, weights, other


def pack(docs: DataFrame, tokenizer: str | None = None, window: int = WINDOW, with_ids: bool = False, targets: dict[str | None, int] | None = None) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, queue[, ids]), a row a piece.

    targets: whole weights by source (1 where a source isn't named), at most a window's tokens in all; without them a source
    weighs what it has, so that every window holds the corpus's own proportions and no queue runs dry before the end.
    """
    spark = docs.sparkSession
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, queue int" + ", ids binary" * with_ids
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = BUCKETS_PER_TASK * parts
    table = written(tokenised(docs, tokenizer or default_tokenizer()).withColumn("bucket", F.pmod(F.xxhash64("doc_id", "n"), F.lit(buckets)).cast("int")))
    total = table.agg(F.sum("n")).first()[0] or 0
    if not total:
        return spark.createDataFrame([], schema)
    by_source = table.groupBy("source").agg(F.sum("n").alias("tokens"))
    if targets is None:
        large, totals, weights, other = _own_shares(by_source, total, window)
    else:
        large, totals, weights, other = _target_shares(by_source, targets, window)
    names = spark.createDataFrame([(s, q) for q, (s, _) in enumerate(large)], f"_source {docs.schema['source'].dataType.simpleString()}, _queue int")
    queued = table.join(F.broadcast(names), table["source"].eqNullSafe(names["_source"]), "left").withColumn("queue", F.coalesce("_queue", F.lit(other)))

    upto = Window.partitionBy("queue").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = queued.groupBy("bucket", "queue").agg(F.sum("n").alias("tokens")).withColumn("base", F.coalesce(F.sum("tokens").over(upto), F.lit(0)))
    heads = sums.groupBy("bucket").agg(F.collect_list(F.struct("queue", "base")).alias("bases"))
    id_type = docs.schema["doc_id"].dataType
    stream = queued.select("bucket", F.lit(1).alias("kind"), "doc_id", "queue", "n", "ids", F.lit(None).cast("array<struct<queue:int,base:bigint>>").alias("bases")).unionByName(
        heads.select("bucket", F.lit(0).alias("kind"), F.lit(None).cast(id_type).alias("doc_id"), F.lit(None).cast("int").alias("queue"), F.lit(None).cast("long").alias("n"), F.lit(None).cast("binary").alias("ids"), "bases")
    )
    schedule = Schedule(totals, window, weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if words_of_worker.cache_info().currsize:
            words_of_worker.cache_clear()
            release_memory()
        at: dict[int, int] = {}
        names = [n.strip().split(" ")[0] for n in schema.split(",")]

        def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
            """The pieces of documents of one bucket."""
            queues, sizes = (batch.column(i).to_numpy().astype(np.int64) for i in (3, 4))
            wide = memoryview(np.frombuffer(b"".join(batch.column(5).to_pylist()), "<u2").astype("<u4").view(np.uint8))
            found = []
            for q in np.unique(queues).tolist():
                rows = np.flatnonzero(queues == q)
                docs, *rest = schedule.pieces(q, at[q], sizes[rows])
                found.append((rows[docs], *rest, np.full(len(docs), q)))
                at[q] += int(sizes[rows].sum())
            columns = [np.concatenate(c) for c in zip(*found, strict=True)]
            order = np.argsort(columns[0], kind="stable")
            rows, starts, lengths, windows, offsets, served = (c[order] for c in columns)
            begins = 4 * ((np.cumsum(sizes) - sizes)[rows] + starts)
            parts = [wide[i:j] for i, j in zip(begins.tolist(), (begins + 4 * lengths).tolist(), strict=True)]
            crcs = pa.array(map(zlib.crc32, parts), pa.int64(), size=len(parts))
            arrays = [batch.column(2).take(pa.array(rows)), pa.array(starts), pa.array(lengths), crcs, pa.array(sizes[rows]), pa.array(windows), pa.array(offsets), pa.array(served.astype(np.int32))]
            if with_ids:
                arrays.append(pa.array(map(bytes, parts), pa.binary(), size=len(parts)))
            return pa.record_batch(arrays, names)

        for batch in small_batches(batches):
            heads = np.flatnonzero(batch.column(1).to_numpy() == 0).tolist()
            for head, upto in zip([-1, *heads], [*heads, batch.num_rows], strict=True):
                if head >= 0:
                    at = {b["queue"]: b["base"] for b in batch.column(6)[head].as_py()}
                if upto > head + 1:
                    yield cut(batch.slice(head + 1, upto - head - 1))

    ordered = stream.repartition(parts, "bucket").sortWithinPartitions("bucket", "kind", "doc_id", F.xxhash64("ids"))
    return ordered.mapInArrow(run, schema)
