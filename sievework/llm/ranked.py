"""Ranked lexical search over a clustered index whose documents are ordered by recursive graph bisection.

Index. Each document's terms are counted once. A bisection tree, fitted on a bounded sample of documents in one executor task, sends
every document to one of 2^TREE_DEPTH leaves; leaves are cut by a hash into buckets of about BUCKET_POSTINGS postings. In each
bucket recursive graph bisection orders all documents by all their terms: halves swap the pairs of documents whose moves lower the
summed log gaps of the terms' postings, level by level, down to clusters of at most CLUSTER_DOCS documents. The index has one row a
cluster and term: slots, impacts and the largest impact; and one a cluster with its members' ids. The order never changes a
result, it only makes bounds tight.

Search. A cluster's bound for an item sums weight times largest impact over the item's terms. Clusters are visited in waves by
falling bound (WAVES are the ranks that end them); after each wave an item's kth score is its threshold, and only clusters whose bound
reaches it are visited further, a bound equal to it too, as ties go to the smaller doc_id. The last wave takes every such cluster,
so the result is exact. Scores are 64-bit integers summed over exploded postings; slots are mapped back to doc_id before ranking.

Defined results: terms are the maximal runs of characters other than ASCII ones that are neither letters nor digits, A-Z lower-cased. A NULL or
empty text has no term and takes no part in any count. Every row is a document of its own, repeated rows and ids too; NULL ids come last
among equal scores. Rows of one item_id are one item with all their terms; NULL is an item. An item without terms or matches has no row.
A very long text is one row, its postings a run of one bucket; a third of all documents being copies makes more buckets, not larger ones.
Other columns are not read. Empty tables give no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievework.llm.common import mapped, release_memory, sized, small_batches, texts_of, trained, written

#: What a term is, in bytes of lower-cased UTF-8 and for SQL; fixed values.
TERM_BYTES = re.compile(rb"[0-9a-z\x80-\xff]+")
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
CLUSTER_DOCS, BUCKET_POSTINGS = 256, 1_000_000
#: The tree is fitted on so many documents at most, the least by hash, by hashed terms.
SAMPLE_DOCS, TREE_DEPTH, TREE_FEATURES = 4096, 6, 1 << 13
ROUNDS = 4
WAVES = (4, 20, 84)


@dataclass
class Index:
    """rows (cluster, term, slots, impacts, top, ids) in the shared folder; documents with a term, and their terms with repeats."""

    rows: DataFrame
    documents: int
    terms: int


def _lists(lengths: Iterable[int], flat: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(np.fromiter(lengths, np.int64))]), pa.int32()), flat)


def counted_terms(docs: DataFrame) -> DataFrame:
    """(doc_id, n, terms, tfs) of every document with a term: its terms with repeats, the different ones and their occurrences."""

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [Counter(TERM_BYTES.findall(t.encode("utf-8", "replace").lower())) for t in texts_of(batch)]
        has = np.array([bool(c) for c in found], bool)
        kept = [c for c in found if c]
        terms = pa.array([t for c in kept for t in c], pa.binary()).cast(pa.string())
        tfs = pa.array([n for c in kept for n in c.values()], pa.int32())
        sizes = [len(c) for c in kept]
        ids = batch.column(batch.schema.get_field_index("doc_id")).filter(pa.array(has))
        return pa.RecordBatch.from_arrays([ids, pa.array([sum(c.values()) for c in kept], pa.int64()), _lists(sizes, terms), _lists(sizes, tfs)], ["doc_id", "n", "terms", "tfs"])

    return mapped(docs.select("doc_id", "text"), one, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n bigint, terms array<string>, tfs array<int>")


def _swapped(node: np.ndarray, half: np.ndarray, gain: np.ndarray) -> np.ndarray:
    """half after the best of each node's left documents changed places with the best of its right ones, pair by pair while both gain together."""
    order = np.lexsort((-gain, half, node))
    starts = np.flatnonzero(np.r_[True, (node[order][1:] != node[order][:-1]) | (half[order][1:] != half[order][:-1])])
    rank = np.arange(len(order)) - np.repeat(starts, np.diff(np.r_[starts, len(order)]))
    left, right = half[order] == 0, half[order] == 1
    # Pairs by (node, rank): both sides are sorted by it, so the common keys meet in order.
    span = len(order) + 1
    pairs, at, to = np.intersect1d(node[order][left] * span + rank[left], node[order][right] * span + rank[right], assume_unique=True, return_indices=True)
    a, b = order[left][at], order[right][to]
    better = gain[a] + gain[b] > 1e-9
    half = half.copy()
    half[a[better]], half[b[better]] = 1, 0
    return half


def bisected(docs: np.ndarray, terms: np.ndarray, count: int, levels: int, rounds: int = ROUNDS) -> np.ndarray:
    """The node, 0 to 2^levels - 1, of each of count documents after so many levels of graph bisection; a posting is a document and a term.

    The cost of a half of n documents is the sum over its terms of d * log2(n / (d + 1)), d being how many of them hold the term.
    """
    logs = np.log2(np.arange(count + 3) + 1.0)  # logs[d] is log2(d + 1)
    node, place = np.zeros(count, np.int64), np.arange(count)
    for _ in range(levels):
        order = np.lexsort((place, node))
        starts = np.searchsorted(node[order], np.arange(node.max() + 2))
        sizes = np.diff(starts)
        rank = np.empty(count, np.int64)
        rank[order] = np.arange(count) - starts[node[order]]
        half = (rank >= (sizes[node] + 1) // 2).astype(np.int64)
        left = (sizes + 1) // 2
        # Terms of one document of a node don't tell its halves apart.
        keys, inverse, degree = np.unique(node[docs] * (terms.max() + 1 if len(terms) else 1) + terms, return_inverse=True, return_counts=True)
        some = degree[inverse] > 1
        held, key = docs[some], inverse[some]
        of = np.zeros(len(keys), np.int64)
        of[key] = node[held]
        n1, n2 = np.log2(np.maximum(left[of], 1)), np.log2(np.maximum((sizes - left)[of], 1))
        for _ in range(rounds):
            d2 = np.bincount(key, weights=half[held], minlength=len(keys)).astype(np.int64)
            d1 = np.where(degree > 1, degree, 0) - d2
            cost = lambda d, n: d * (n - logs[d])
            now = cost(d1, n1) + cost(d2, n2)
            to_right = now - cost(np.maximum(d1 - 1, 0), n1) - cost(d2 + 1, n2)
            to_left = now - cost(d1 + 1, n1) - cost(np.maximum(d2 - 1, 0), n2)
            gain = np.bincount(held, weights=np.where(half[held] == 0, to_right[key], to_left[key]), minlength=count)
            after = _swapped(node, half, gain)
            if (after == half).all():
                break
            half = after
        place, node = rank, node * 2 + half
    return node


def _features(terms: pa.Array) -> np.ndarray:
    """A hashed number for each term; each different term of the batch is hashed once."""
    coded = terms.dictionary_encode()
    hashed = np.fromiter((zlib.crc32(t.encode()) % TREE_FEATURES for t in coded.dictionary.to_pylist()), np.int64, len(coded.dictionary))
    return hashed[coded.indices.to_numpy()] if len(hashed) else np.zeros(0, np.int64)


def _stepped(tree: np.ndarray, docs: np.ndarray, features: np.ndarray, node: np.ndarray) -> np.ndarray:
    """Each document's sum of its features' weights at its node."""
    return np.bincount(docs, weights=tree[node[docs], features], minlength=len(node))


def fitted_tree(rows: Iterable[dict]) -> np.ndarray:
    """Weights (node, feature) of a bisection tree in heap order, the last column being the node's limit; a document goes right where its
    features' weights sum to more. Limits are medians over the sample's documents at the node, so that leaves are about equal."""
    found = [np.unique(_features(pa.array(r["terms"], pa.string()))) for r in rows]
    tree = np.zeros((1 << TREE_DEPTH, TREE_FEATURES + 1), np.float32)
    if not found:
        return tree
    docs, features = np.repeat(np.arange(len(found)), [len(f) for f in found]), np.concatenate(found)
    leaf, node = bisected(docs, features, len(found), TREE_DEPTH), np.ones(len(found), np.int64)
    for depth in range(TREE_DEPTH):
        child = leaf >> (TREE_DEPTH - depth - 1)
        degrees = np.bincount(child[docs] * TREE_FEATURES + features, minlength=(2 << depth) * TREE_FEATURES).reshape(-1, TREE_FEATURES)
        shares = np.log2((degrees + 1) / (np.bincount(child, minlength=2 << depth)[:, None] + 2))
        tree[1 << depth : 2 << depth, :TREE_FEATURES] = shares[1::2] - shares[::2]
        sums = _stepped(tree, docs, features, node)
        for k in np.unique(node):
            tree[k, TREE_FEATURES] = np.median(sums[node == k])
        node = 2 * node + (sums > tree[node, TREE_FEATURES])
    return tree


def routed(counted: DataFrame, tree: np.ndarray) -> DataFrame:
    """counted with the leaf of each document."""
    weights = counted.sparkSession.sparkContext.broadcast(tree)

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        terms = batch.column(batch.schema.get_field_index("terms"))
        features, lengths = _features(terms.flatten()), terms.value_lengths().to_numpy(zero_copy_only=False)
        docs, node = np.repeat(np.arange(batch.num_rows), lengths), np.ones(batch.num_rows, np.int64)
        once = np.unique(docs * TREE_FEATURES + features)
        docs, features = once // TREE_FEATURES, once % TREE_FEATURES
        for _ in range(TREE_DEPTH):
            node = 2 * node + (_stepped(weights.value, docs, features, node) > weights.value[node, TREE_FEATURES])
        return batch.append_column("leaf", pa.array(node - (1 << TREE_DEPTH), pa.int32()))

    return mapped(counted, one, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in counted.schema) + ", leaf int")


def index(docs: DataFrame) -> Index:
    """The clustered index of docs (doc_id, text)."""
    counted = written(counted_terms(docs).withColumn("row", F.monotonically_increasing_id()))
    total, length = counted.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    h = F.pmod(F.xxhash64("row"), F.lit(1 << 30))
    few = counted.withColumn("h", h).filter(F.col("h") < min(1.0, 2 * SAMPLE_DOCS / max(total, 1)) * (1 << 30))
    tree = trained(few.orderBy("h", "row").limit(SAMPLE_DOCS).select("h", "row", "terms"), ["h", "row"], fitted_tree)
    placed = written(routed(counted.withColumn("h", F.xxhash64("row")).drop("row"), tree))
    sizes = {r["leaf"]: r["s"] for r in placed.groupBy("leaf").agg(F.sum(F.size("terms")).alias("s")).collect()}  # 2^TREE_DEPTH at most
    cuts = F.array(*[F.lit(-(-sizes.get(leaf, 0) // BUCKET_POSTINGS) or 1) for leaf in range(1 << TREE_DEPTH)])
    kind = docs.schema["doc_id"].dataType.simpleString()

    def build(key: tuple, bucket: pa.Table) -> pa.Table:
        table = _clusters(key[0].as_py(), key[1].as_py(), bucket, total, length)
        release_memory()
        return table

    cut = placed.withColumn("sub", F.pmod("h", F.get(cuts, F.col("leaf"))).cast("long")).drop("h")
    rows = cut.groupBy("leaf", "sub").applyInArrow(build, f"cluster bigint, term string, slots array<int>, impacts array<int>, top int, ids array<{kind}>")
    return Index(written(rows), total, length)


def _clusters(leaf: int, sub: int, bucket: pa.Table, total: int, length: int) -> pa.Table:
    """The index rows of a bucket's clusters."""
    whole = bucket.combine_chunks()
    lists = whole["terms"].combine_chunks() if isinstance(whole["terms"], pa.ChunkedArray) else whole["terms"]
    coded = lists.flatten().dictionary_encode()
    terms, tfs = coded.indices.to_numpy().astype(np.int64), pa.concat_arrays([c.flatten() for c in whole["tfs"].chunks]).to_numpy().astype(np.int64)
    n, count = whole["n"].to_numpy().astype(np.int64), whole.num_rows
    docs = np.repeat(np.arange(count), lists.value_lengths().to_numpy(zero_copy_only=False))
    levels = max(0, int(np.ceil(np.log2(max(count, 1) / CLUSTER_DOCS))))
    node = bisected(docs, terms, count, levels)
    order = np.argsort(node, kind="stable")
    firsts = np.searchsorted(node[order], node[order], side="left")
    slot = np.empty(count, np.int64)
    slot[order] = np.arange(count) - firsts
    m = 10 + (90 * n * total) // length
    impact = (1_000_000_000 * tfs) // (1000 * tfs + 8 * m[docs])
    by = np.lexsort((slot[docs], terms, node[docs]))
    key = node[docs[by]] * (len(coded.dictionary) + 1) + terms[by]
    starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    base = (leaf << 48) | (sub << 16)
    ends = np.r_[starts[1:], len(key)]
    offsets = pa.array(np.r_[starts, len(key)], pa.int32())
    ids, id_type = whole["doc_id"].combine_chunks(), whole.schema.field("doc_id").type
    ids = ids.take(pa.array(order))
    nodes, first = np.unique(node[order], return_index=True)
    some = pa.table(
        {
            "cluster": pa.array(base + node[docs[by[starts]]]),
            "term": coded.dictionary.take(pa.array(terms[by[starts]])).cast(pa.string()),
            "slots": pa.ListArray.from_arrays(offsets, pa.array(slot[docs[by]], pa.int32())),
            "impacts": pa.ListArray.from_arrays(offsets, pa.array(impact[by], pa.int32())),
            "top": pa.array(np.maximum.reduceat(impact[by], starts), pa.int32()),
            "ids": pa.nulls(len(ends), pa.list_(id_type)),
        }
    )
    members = pa.table(
        {
            "cluster": pa.array(base + nodes), "term": pa.nulls(len(nodes), pa.string()), "slots": pa.nulls(len(nodes), pa.list_(pa.int32())), "impacts": pa.nulls(len(nodes), pa.list_(pa.int32())),
            "top": pa.nulls(len(nodes), pa.int32()), "ids": pa.ListArray.from_arrays(pa.array(np.r_[first, count], pa.int32()), ids),
        }
    )
    names = [f.name for f in some.schema]
    return pa.concat_tables([some, members.select(names).cast(some.schema)])


def item_terms(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(TERM), F.lit(0)))


def search(found: Index, items: DataFrame, k: int = 10) -> DataFrame:
    """(item_id, rank, doc_id, score): the k documents of the highest score above 0 of each item (item_id, text)."""
    spark = items.sparkSession
    numbered = written(items.select("item_id").distinct().withColumn("item", F.monotonically_increasing_id()))
    asked = items.select("item_id", F.explode(item_terms(F.col("text"))).alias("term"))
    wanted = written(asked.join(sized(numbered.withColumnRenamed("item_id", "i")), F.col("item_id").eqNullSafe(F.col("i"))).select("item", "term").distinct())
    hits = written(found.rows.filter("term is not null").join(sized(wanted.select("term").distinct()), "term").drop("ids"))
    weight = F.floor(1000 * F.log((F.lit(2 * found.documents + 2).cast("double")) / (2 * F.col("df") + 1)))
    weights = written(wanted.join(hits.groupBy("term").agg(F.sum(F.size("slots")).alias("df")), "term").select("item", "term", weight.cast("long").alias("w")))
    weights = sized(weights)
    bounds = written(hits.select("cluster", "term", "top").join(weights, "term").groupBy("item", "cluster").agg(F.sum(F.col("w") * F.col("top")).alias("bound")).filter("bound > 0"))
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("bound"), "cluster"))
    first = written(bounds.withColumn("place", rank).filter(F.col("place") <= WAVES[-1]))
    members = found.rows.filter("term is null").select("cluster", "ids")
    best_first = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last(), "cluster", "slot")

    def scored(visits: DataFrame) -> DataFrame:
        """(item, cluster, slot, score, doc_id) of the clusters' documents, the k best of an item."""
        postings = hits.join(weights, "term").join(visits.select("item", "cluster", "least"), ["item", "cluster"])
        each = postings.select("item", "cluster", "least", "w", F.inline(F.arrays_zip(F.col("slots").alias("slot"), F.col("impacts").alias("impact"))))
        each = each.toDF("item", "cluster", "least", "w", "slot", "impact")
        sums = each.groupBy("item", "cluster", "least", "slot").agg(F.sum(F.col("w") * F.col("impact")).alias("score")).filter("score > 0 and score >= least")
        named = sums.join(members, "cluster").select("item", "cluster", "slot", "score", F.get("ids", F.col("slot")).alias("doc_id"))
        return named.withColumn("rank", F.row_number().over(best_first)).filter(F.col("rank") <= k).drop("rank")

    best = None
    for low, high in [*zip((0, *WAVES), WAVES, strict=False), (WAVES[-1], None)]:
        wave = first.filter((F.col("place") > low) & (F.col("place") <= high)) if high else bounds.join(first.select("item", "cluster"), ["item", "cluster"], "left_anti")
        if best is None:
            visits = wave.withColumn("least", F.lit(0).cast("long"))
        else:
            least = best.groupBy("item").agg(F.when(F.count("*") >= k, F.min("score")).otherwise(0).cast("long").alias("least"))
            visits = wave.join(sized(least), "item", "left").withColumn("least", F.coalesce("least", F.lit(0).cast("long"))).filter("bound >= least")
        visits = written(visits.select("item", "cluster", "least"))
        if best is not None and visits.isEmpty():
            break
        more = scored(visits)
        best = written(more if best is None else best.unionByName(more).withColumn("rank", F.row_number().over(best_first)).filter(F.col("rank") <= k).drop("rank"))
    ranked = best.withColumn("rank", F.row_number().over(best_first))
    return ranked.join(sized(numbered), "item").select("item_id", "rank", "doc_id", "score")


def report(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    return search(index(docs), items, k)


ORACLE = rf"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{TERM}') AS t FROM documents),
s AS (SELECT count(*) FILTER (len(t) > 0) AS docs, sum(len(t))::BIGINT AS terms FROM d),
q AS MATERIALIZED (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{TERM}')) AS term FROM benchmark),
p AS MATERIALIZED (SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, len(t) AS n, unnest(t) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY r, doc_id, n, term),
f AS (SELECT term, floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM p, s GROUP BY term),
u AS (SELECT r, doc_id, term, (1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // terms)) AS u FROM p, s),
x AS (SELECT item_id, r, doc_id, sum(w * u)::BIGINT AS score FROM q JOIN u USING (term) JOIN f USING (term) GROUP BY item_id, r, doc_id HAVING sum(w * u) > 0)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST, r)::INT AS rank, doc_id, score FROM x
QUALIFY rank <= 10
"""
