"""Exact top-k search by distributed histogram selection.

Every candidate is scored against every query of a block. Passes over the candidates count scores in a histogram for
each query over a range known to hold its kth best score; the histograms of all tasks are added up and the range shrinks
to the bin with the kth score, until the bin is one score wide. A last pass keeps scores that reach it and breaks ties
by the smaller vec_id. Queries are dealt into blocks of about BLOCK by a hash, so what a pass sends out is bounded;
candidates are never moved.

In a task only the bins that hold its own k best scores count: the global kth score is at least a task's kth, so a lower
bin can't hold it. For the same reason the last pass returns at most k rows for each query and task.

Vectors are integers floor(256 x), of any size. Products are exact: in double precision while the sums stay below 2^53, else in
Python integers. The work is queries times candidates.

Defined results: vectors that are NULL, or hold NULL or non-finite components, or have a NULL vec_id, take no part. A query of
another length than a candidate isn't compared with it. Repeated rows are candidates of their own; a query id repeated
with other vectors is asked with the smallest. A score beyond 64 bits counts as the nearest one within, and such scores tie.
Other columns are not read. Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sievework.llm.common import new_table, small_batches, written

SCALE = 256
BINS = 4096
BLOCK = 8_192
#: Candidates scored at once.
STEP = 256
#: The largest score; the least is its negative.
MOST = (1 << 63) - 1


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v array<double>) of the rows that take part."""
    x = F.transform("embedding", lambda e: e.cast("double"))
    whole = F.forall("v", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) != F.lit(float("inf"))))
    return vectors.filter("vec_id is not null and embedding is not null").select("vec_id", x.alias("v")).filter(whole)


def quantised(x: np.ndarray) -> np.ndarray:
    """floor(256 x): 64-bit integers, or Python integers where one would not be exact in double precision."""
    if not x.size or np.abs(x).max() < 1 << 44:
        return np.floor(x * SCALE).astype(np.int64)
    # From 2^44 on a double times 256 is whole.
    return np.vectorize(lambda e: int(e * SCALE // 1) if abs(e) < 1 << 44 else SCALE * e.as_integer_ratio()[0] // e.as_integer_ratio()[1], otypes=[object])(x)


def largest_of(v: np.ndarray) -> int:
    return max(abs(int(v.min())), abs(int(v.max()))) if v.size else 0


class Queries:
    """A block of queries: ids, quantised vectors by length."""

    def __init__(self, rows: list):
        self.ids = np.array([r["vec_id"] for r in rows], np.int64)
        self.groups: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        by: dict[int, list[int]] = {}
        for i, r in enumerate(rows):
            by.setdefault(len(r["v"]), []).append(i)
        for width, at in by.items():
            self.groups[width] = (np.array(at), quantised(np.array([rows[i]["v"] for i in at], np.float64).reshape(len(at), width)))
        self.largest = {w: largest_of(m) for w, (_, m) in self.groups.items()}


def exact_product(q: np.ndarray, c: np.ndarray, largest: int) -> np.ndarray:
    """Integer inner products of rows of q with rows of c, held within 64 bits."""
    if largest * largest_of(c) * max(q.shape[1], 1) < 1 << 53:
        return (q.astype(np.float64) @ c.T.astype(np.float64)).astype(np.int64)
    exact = q.astype(object) @ c.T.astype(object)
    return np.vectorize(lambda v: min(max(int(v), -MOST), MOST), otypes=[np.int64])(exact)


def _blocks(batch: pa.RecordBatch, width: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, vectors) of a batch's candidates of one length, STEP at a time."""
    ids, lists = batch.column(0).to_numpy(), batch.column(1)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    n = np.diff(lists.offsets.to_numpy())
    ok = np.flatnonzero(n == width)
    ends = np.cumsum(n)
    for i in range(0, len(ok), STEP):
        part = ok[i : i + STEP]
        yield ids[part], quantised(flat[(ends[part] - width)[:, None] + np.arange(width)])


def _own_best(scores: np.ndarray, ids: np.ndarray, query_ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a block, each query's k best candidates by (score down, id up): query places, ids, scores."""
    own = ids[None, :] == query_ids[:, None]
    masked = np.where(own, np.iinfo(np.int64).min, scores)
    kk = min(k, masked.shape[1])
    kth = np.partition(masked, masked.shape[1] - kk, axis=1)[:, masked.shape[1] - kk]
    q, c = np.nonzero((masked >= kth[:, None]) & ~own)
    return _best(q, ids[c], scores[q, c], k)


def _best(q: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The first k of each query in the order of score down, id up."""
    by = np.lexsort((ids, ~scores, q))
    q, ids, scores = q[by], ids[by], scores[by]
    keep = np.arange(len(q)) - np.searchsorted(q, q, side="left") < k
    return q[keep], ids[keep], scores[keep]


def _scored_best(cands: DataFrame, asked, k: int, shared) -> DataFrame:
    """(query_id, vec_id, score): for each task the k best of every query, of scores that reach the query's floor.

    asked, shared: broadcasts of the block and of the floors.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, floor = asked.value, shared.value
        held = (np.zeros(0, np.int64),) * 3
        waiting: list[tuple] = []
        for batch in small_batches(batches, 4096):
            for width, (at, q) in block.groups.items():
                for ids, rows in _blocks(batch, width):
                    place, found, scores = _own_best(exact_product(q, rows, block.largest[width]), ids, block.ids[at], k)
                    ok = scores >= floor[at][place]
                    waiting.append((at[place][ok], found[ok], scores[ok]))
            if sum(len(w[0]) for w in waiting) > 200_000:
                held, waiting = _best(*map(np.concatenate, zip(held, *waiting, strict=True)), k), []
        q, c, s = _best(*map(np.concatenate, zip(held, *waiting, strict=True)), k)
        for i in range(0, len(q), 50_000):
            yield pa.record_batch([pa.array(block.ids[q[i : i + 50_000]]), pa.array(c[i : i + 50_000]), pa.array(s[i : i + 50_000])], ["query_id", "vec_id", "score"])

    return cands.mapInArrow(run, "query_id long, vec_id long, score long")


def _best_bins(key: np.ndarray, n: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Of counts by place * (BINS + 1) + bin, the highest bins of each place down to the one with its kth score."""
    key, where = np.unique(key, return_inverse=True)
    n = np.bincount(where, n, len(key)).astype(np.int64)[::-1]
    key = key[::-1]
    before = np.cumsum(n) - n
    first = np.searchsorted(-(key // (BINS + 1)), -(key // (BINS + 1)), side="left")
    keep = before - before[first] < k if len(key) else np.zeros(0, bool)
    return key[keep], n[keep]


def _histograms(cands: DataFrame, asked, k: int, shared) -> DataFrame:
    """(place, bin, n): each query's scores counted by bin, from each task the best bins down to its kth score.

    Bins are numbered up from low, each so wide as the query's width; scores above the range count in bin BINS, scores
    below it don't count. asked, shared: broadcasts of the block and of (low, width).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, (low, width) = asked.value, shared.value
        held = (np.zeros(0, np.int64), np.zeros(0, np.int64))
        waiting: list[tuple] = []
        for batch in small_batches(batches, 4096):
            for w, (at, q) in block.groups.items():
                for ids, rows in _blocks(batch, w):
                    scores = exact_product(q, rows, block.largest[w])
                    place, c = np.nonzero((scores >= low[at][:, None]) & (ids[None, :] != block.ids[at][:, None]))
                    # The difference may pass 63 bits; as an unsigned number it is right.
                    above = (scores[place, c] - low[at][place]).astype(np.uint64)
                    bins = np.minimum(above // width[at][place].astype(np.uint64), np.uint64(BINS)).astype(np.int64)
                    key = at[place] * (BINS + 1) + bins
                    waiting.append(_best_bins(key, np.ones(len(key), np.int64), k))
            if sum(len(x[0]) for x in waiting) > 200_000:
                held, waiting = _best_bins(*map(np.concatenate, zip(held, *waiting, strict=True)), k), []
        key, n = _best_bins(*map(np.concatenate, zip(held, *waiting, strict=True)), k)
        yield pa.record_batch([pa.array((key // (BINS + 1)).astype(np.int32)), pa.array((key % (BINS + 1)).astype(np.int32)), pa.array(n)], ["place", "bin", "n"])

    return cands.mapInArrow(run, "place int, bin int, n long").groupBy("place", "bin").agg(F.sum("n").alias("n"))


def search(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k best rows of vectors but its own, ties to the smaller vec_id.

    Each block's result is written before the next block begins, so the plan stays as small as for one block.
    """
    spark = vectors.sparkSession
    cands = usable(vectors)
    asked = written(usable(queries).groupBy("vec_id").agg(F.min("v").alias("v")))
    n = asked.count()
    schema = "query_id long, vec_id long, score long"
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    blocks = max(1, -(-n // BLOCK))
    asked = asked.withColumn("b", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)))
    peak = cands.agg(F.max(F.array_max(F.transform("v", F.abs))).alias("m"), F.max(F.size("v")).alias("d")).first()
    most = SCALE * (int(peak["m"] or 0) + 1)
    path = new_table(spark)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    for b in range(blocks):
        rows = asked.filter(F.col("b") == b).select("vec_id", "v").collect()
        block = Queries(rows)
        held = spark.sparkContext.broadcast(block)
        floors = spark.sparkContext.broadcast(_kth_scores(cands, block, held, k, most * max(block.largest.values(), default=0) * int(peak["d"] or 0)))
        best = _scored_best(cands, held, k, floors).withColumn("rank", F.row_number().over(order).cast("int")).filter(F.col("rank") <= k)
        best.select("query_id", "rank", "vec_id", "score").write.mode("append").parquet(path)
        held.destroy()
        floors.destroy()
    return spark.read.schema(schema + ", rank int").parquet(path).select("query_id", "rank", "vec_id", "score")


def _kth_scores(cands: DataFrame, block: Queries, held, k: int, bound: int) -> np.ndarray:
    """Each query's kth best score by refinement of histograms; a lower bound of all scores where there are fewer than k."""
    n = len(block.ids)
    bound = min(bound, MOST)
    low = np.full(n, -bound, np.int64)
    width = np.full(n, max(1, -(-(2 * bound + 1) // BINS)), np.int64)
    best = Window.partitionBy("place").orderBy(F.desc("bin"))
    alone = Window.partitionBy("place")
    while True:
        shared = cands.sparkSession.sparkContext.broadcast((low, width))
        counted = _histograms(cands, held, k, shared).withColumn("upto", F.sum("n").over(best)).withColumn("all", F.sum("n").over(alone))
        hit = counted.filter((F.col("upto") >= k) & (F.col("upto") - F.col("n") < k) & (F.col("all") >= k)).select("place", "bin").collect()
        shared.destroy()
        low = low.copy()
        for r in hit:
            low[r["place"]] = int(low[r["place"]]) + r["bin"] * int(width[r["place"]])
        if not hit or width.max() == 1:
            return low
        width = -(-width // BINS)


ORACLE = """
WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM e q JOIN e c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
