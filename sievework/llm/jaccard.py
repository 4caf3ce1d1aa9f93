"""Exact Jaccard join of word-shingle sets, with set relations used to skip work.

A document's set holds 64-bit hashes of its distinct runs of k words (lower-cased A-Z, split at ASCII white space); with
fewer words the whole sequence is its one element. Two sets are linked when intersection / union >= num / den.

Equal sets are one node from the start. For each node the rarest elements by a corpus-wide count sketch form a prefix so
long that linked sets must share an element of it. Index lists of prefix elements are ordered by set size and cut into
blocks that know their sizes and first positions, so a probe skips whole blocks that no size or position can match
(index-level skipping); what remains passes a bitmap bound on the symmetric difference. Entries that already hang together
are not compared again. A list beyond LIST_ROWS entries is cut into runs of its size order, and pairs of runs that can hold
links are scanned by tasks of their own. The candidate graph's components are then solved exactly: a local index over all elements gives one
set's overlaps with all others, and the overlaps of a set that is highly similar to one already answered are derived from
its answers by adding and taking off the lists of the few elements in which they differ (answer-level skipping).

A large component is solved in blocks of members, one task for each pair of blocks, so no task holds a group of unbounded
size. Sketch counts steer the order only; any order gives the same links.

Defined results: NULL and blank texts have the empty set, linked with nothing. Rows of equal sets are linked. A NULL doc_id
never names a component unless all its rows are NULL. Rows with one doc_id and different texts are nodes of their own, and a row
counts by its own text, whatever its id. Very long texts are whole sets. An empty table has no rows. Columns other than doc_id and
text are not read; one_of_each() returns them as they are, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.llm.common import CACHE_WORDS, columns_of, free_name, release_memory, sized, small_batches, written
from sievework.llm.graph import components

#: The sketch: 2^SKETCH_BITS counters that stop at 15, in SLICES slices.
SKETCH_BITS = 26
SLICES = 64
BITMAP = 64  # bytes
LIST_BLOCK = 64
#: Entries of an index list, or of a run of a longer one, that one task compares with each other; postings of a part, about.
LIST_ROWS, PART_ROWS = 4096, 200_000
#: Members and elements that one block of a candidate component holds at most, about.
MEMBERS, ELEMENTS = 1024, 1_500_000
_MIX = np.uint64(0x9E3779B97F4A7C15)
POSTING = np.dtype([("t", "<u8"), ("d", "<i8"), ("n", "<u4"), ("p", "<u4"), ("b", "<u8", (BITMAP // 8,))])


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h * _MIX
    return h ^ (h >> np.uint64(29))


def shingle_set(cache: dict, text: bytes | None, k: int) -> np.ndarray:
    """Sorted distinct shingle hashes."""
    words = (text or b"").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(cache) > CACHE_WORDS:
        cache.clear()
    a = np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))
    size = min(k, len(a))
    h = np.full(len(a) - size + 1, size, np.uint64)
    for j in range(size):
        h = _mixed(h + a[j : len(a) - size + 1 + j])
    return np.unique(_mixed(h))


def node_of(elements: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(elements.tobytes())


def short(node: bytes) -> int:
    return int.from_bytes(node[:8], "little", signed=True)


def prefix_length(n: int, num: int, den: int) -> int:
    return n + num * n // -den + 1


def least_overlap(a, b, num: int, den: int):
    """The smallest intersection at which sets of sizes a and b are linked."""
    return -(-num * (a + b) // (num + den))


def bitmap(elements: np.ndarray) -> np.ndarray:
    """Parities of the elements in 8 * BITMAP places; unequal places bound the symmetric difference from below."""
    at = (elements >> np.uint64(7)) % np.uint64(8 * BITMAP)
    return np.packbits(np.bincount(at.astype(np.int64), minlength=8 * BITMAP) & 1).view("<u8")


def profile(docs: DataFrame, k: int) -> DataFrame:
    """Rows (doc_id, seal, n, node) of all documents, seal being a hash of the text, and rows (slice, counts) with each task's part of the sketch."""
    bits = SKETCH_BITS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, seen = _Hashes(), set()
        counts = np.zeros(1 << bits, np.uint8)
        names = ["doc_id", "seal", "n", "node", "slice", "counts"]
        doc_type = None
        for batch in small_batches(batches):
            n, nodes, doc_type = [], [], batch.schema.field(0).type
            for text in batch.column(2).to_pylist():
                s = shingle_set(cache, text, k)
                n.append(len(s))
                nodes.append(node_of(s) if len(s) else None)
                if len(s) and nodes[-1] not in seen:
                    if len(seen) > CACHE_WORDS:
                        seen.clear()
                    seen.add(nodes[-1])
                    at = (s >> np.uint64(64 - bits)).astype(np.int64)
                    np.add.at(counts, at[counts[at] < 15], 1)
            rows = len(n)
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(nodes, pa.binary()), pa.nulls(rows, pa.int32()), pa.nulls(rows, pa.binary())], names)
        parts = np.minimum(counts, 15, out=counts).reshape(SLICES, -1)
        for i in range(SLICES if seen else 0):
            blob = zstandard.compress(parts[i].tobytes(), 1)
            yield pa.record_batch([pa.nulls(1, doc_type), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.array([i], pa.int32()), pa.array([blob], pa.binary())], names)
        del counts, parts, cache
        seen.clear()
        release_memory()

    source = docs.select("doc_id", F.xxhash64("text").alias("seal"), F.col("text").cast("binary"))
    return source.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, seal long, n long, node binary, slice int, counts binary")


def whole_sketch(parts: DataFrame) -> np.ndarray:
    """The sketch of all tasks, two counters a byte; its size is fixed by SKETCH_BITS."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                part = np.frombuffer(zstandard.decompress(blob), np.uint8)
                sums[i] = np.minimum(sums[i] + part, 15) if i in sums else part
        for i, s in sums.items():
            yield pa.record_batch([pa.array([i], pa.int32()), pa.array([zstandard.compress((s[::2] | (s[1::2] << 4)).tobytes(), 1)], pa.binary())], ["slice", "counts"])

    out = np.zeros((SLICES, (1 << SKETCH_BITS) // SLICES // 2), np.uint8)
    for r in parts.repartition(SLICES, "slice").mapInArrow(run, "slice int, counts binary").collect():
        out[r["slice"]] = np.frombuffer(zstandard.decompress(bytes(r["counts"])), np.uint8)
    return out.ravel()


def counted(sketch: np.ndarray, elements: np.ndarray) -> np.ndarray:
    """The sketch's count of each element."""
    at = (elements >> np.uint64(64 - len(sketch).bit_length())).astype(np.int64)
    return (sketch[at >> 1] >> ((at & 1) << 2).astype(np.uint8)) & 15


def prefix_postings(elements: np.ndarray, node: bytes, sketch: np.ndarray, num: int, den: int) -> np.ndarray:
    """Postings of the rarest elements; those that the whole corpus has once can't be shared and are left out."""
    n = len(elements)
    p = prefix_length(n, num, den)
    count = counted(sketch, elements).astype(np.uint64)
    key = (count << np.uint64(60)) | (elements >> np.uint64(4))
    chosen = np.argsort(key, kind="stable")[:p] if p * 4 > n else (lambda c: c[np.argsort(key[c], kind="stable")])(np.argpartition(key, p - 1)[:p])
    place = np.flatnonzero(count[chosen] > 1)
    out = np.zeros(len(place), POSTING)
    if len(place):
        out["t"], out["d"], out["n"], out["p"], out["b"] = elements[chosen[place]], short(node), n, place, bitmap(elements)
    return out


def postings(docs: DataFrame, k: int, num: int, den: int, shared, parts: int) -> DataFrame:
    """(part, blob): postings dealt by element; shared: the broadcast sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, seen, held, size = _Hashes(), set(), [], 0

        def flush() -> pa.RecordBatch:
            rows = np.concatenate(held)
            part = (_mixed(rows["t"]) % np.uint64(parts)).astype(np.int64)
            by = np.argsort(part, kind="stable")
            ids, starts = np.unique(part[by], return_index=True)
            blobs = [x.tobytes() for x in np.split(rows[by], starts[1:])]
            return pa.record_batch([pa.array(ids.astype(np.int32)), pa.array(blobs, pa.binary())], ["part", "blob"])

        for batch in small_batches(batches):
            for text in batch.column(0).to_pylist():
                s = shingle_set(cache, text, k)
                if not len(s) or (node := node_of(s)) in seen:
                    continue
                if len(seen) > CACHE_WORDS:
                    seen.clear()
                seen.add(node)
                held.append(prefix_postings(s, node, shared.value, num, den))
                size += len(held[-1])
            if size > 100_000:
                yield flush()
                held, size = [], 0
        if size:
            yield flush()
        held.clear()
        cache.clear()
        release_memory()

    return docs.select(F.col("text").cast("binary")).mapInArrow(run, "part int, blob binary")


class Forest:
    """Union-find whose roots are the smallest members."""

    def __init__(self):
        self.up: dict = {}

    def find(self, x):
        root = x
        while (above := self.up.get(root, root)) != root:
            root = above
        while x != root:
            self.up[x], x = root, self.up.get(x, x)
        return root

    def join(self, a, b) -> bool:
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        low, high = (a, b) if a < b else (b, a)
        self.up[high] = self.up[low] = low
        return True


def _possible(a: np.ndarray, b: np.ndarray, num: int, den: int) -> np.ndarray:
    """Which pairs of postings of one element pass the bounds by size, position and bitmap."""
    na, nb = a["n"].astype(np.int64), b["n"].astype(np.int64)
    need = least_overlap(na, nb, num, den)
    room = 1 + np.minimum(na - a["p"] - 1, nb - b["p"] - 1)
    ok = (np.minimum(na, nb) * den >= np.maximum(na, nb) * num) & (room >= need)
    differ = np.bitwise_count(a["b"] ^ b["b"]).sum(-1, dtype=np.int64)
    return ok & (differ <= na + nb - 2 * need)


def scan_list(entries: np.ndarray, forest: Forest, num: int, den: int, size: int = LIST_BLOCK, split: int = 0) -> None:
    """Joins the candidates of one index list, whose entries ascend by size, skipping blocks that can't match.

    split: entries before it are compared with those from it on only.
    """
    root = np.array([forest.find(d) for d in entries["d"].tolist()], np.int64)
    starts = range(0, len(entries), size)
    first = np.minimum.reduceat(entries["p"], starts).astype(np.int64)
    low, high = entries["n"][::size].astype(np.int64), np.maximum.reduceat(entries["n"], starts).astype(np.int64)
    same = bool((root == root[0]).all())
    for i in range(split or len(entries) - 1):
        if same:
            return
        e = entries[i : i + 1]
        n, p, after = int(e["n"][0]), int(e["p"][0]), max(i + 1, split)
        b0 = after // size
        need = least_overlap(n, np.maximum(low[b0:], n), num, den)
        room = 1 + np.minimum(n - p - 1, high[b0:] - first[b0:] - 1)
        alive = np.flatnonzero((low[b0:] * num <= n * den) & (room >= need))
        at = ((b0 + alive) * size + np.arange(size)[:, None]).T.ravel()
        at = at[(at >= after) & (at < len(entries))]
        at = at[root[at] != root[i]]
        at = at[_possible(np.broadcast_to(e, len(at)), entries[at], num, den)]
        if len(at):
            joined = np.unique(np.append(root[at], root[i]))
            for r in joined[1:].tolist():
                forest.join(int(joined[0]), r)
            root[np.isin(root, joined)] = forest.find(int(joined[0]))
            same = bool((root == root[0]).all())


def edges_of(forest: Forest) -> Iterator[pa.RecordBatch]:
    """(a, b): each member with its root."""
    found = [(x, r) for x in list(forest.up) if (r := forest.find(x)) != x]
    if found:
        x, r = zip(*found, strict=True)
        yield pa.record_batch([pa.array(x, pa.int64()), pa.array(r, pa.int64())], ["a", "b"])


def scan_part(rows: np.ndarray, forest: Forest, num: int, den: int, block: int, most: int) -> Iterator[np.ndarray]:
    """Joins the candidates of a part's index lists; lists beyond `most` entries are returned instead, ascending by size."""
    rows = rows[np.lexsort((rows["d"], rows["n"], rows["t"]))]
    fresh = np.ones(len(rows), bool)
    fresh[1:] = (rows["t"][1:] != rows["t"][:-1]) | (rows["d"][1:] != rows["d"][:-1])
    rows = rows[fresh]
    starts = np.flatnonzero(np.append(True, rows["t"][1:] != rows["t"][:-1]))
    sizes = np.diff(np.append(starts, len(rows)))
    twos = starts[sizes == 2]
    a, b = rows[twos], rows[twos + 1]
    ok = _possible(a, b, num, den)
    for x, y in zip(a["d"][ok].tolist(), b["d"][ok].tolist(), strict=True):
        forest.join(x, y)
    for s, n in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist(), strict=True):
        if n > most:
            yield rows[s : s + n]
        else:
            scan_list(rows[s : s + n], forest, num, den, block)


def run_pairs(entries: np.ndarray, most: int, num: int, den: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of runs of a long list, each with itself and with later ones whose sizes allow a link."""
    runs = [entries[i : i + most] for i in range(0, len(entries), most)]
    for i, a in enumerate(runs):
        for b in runs[i:]:
            if int(b["n"][0]) * num > int(a["n"][-1]) * den:
                break
            yield a, b


def candidate_edges(dealt: DataFrame, num: int, den: int, parts: int) -> DataFrame:
    """(a, b): a spanning forest of the candidates that each task finds; dealt: (part, blob) with whole parts together.

    A task holds one part at a time. Runs of long lists go on to tasks of their own, so a list of any length is split.
    """
    block, most = LIST_BLOCK, LIST_ROWS
    names = ["a", "b", "left", "right"]

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest, part, blobs = Forest(), None, []

        def done() -> Iterator[pa.RecordBatch]:
            if blobs:
                for entries in scan_part(np.frombuffer(b"".join(blobs), POSTING), forest, num, den, block, most):
                    for x, y in run_pairs(entries, most, num, den):
                        blob = [pa.array([z.tobytes()], pa.binary()) for z in (x, y)]
                        yield pa.record_batch([pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), *blob], names)

        for batch in small_batches(batches, 64):
            for now, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if now != part:
                    yield from done()
                    part, blobs = now, []
                blobs.append(blob)
        yield from done()
        for e in edges_of(forest):
            yield pa.record_batch([e.column(0), e.column(1), pa.nulls(e.num_rows, pa.binary()), pa.nulls(e.num_rows, pa.binary())], names)

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = Forest()
        for batch in small_batches(batches, 16):
            for left, right in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                a, b = np.frombuffer(left, POSTING), np.frombuffer(right, POSTING)
                # One run after the other ascends by size still.
                if left == right:
                    scan_list(a, forest, num, den, block)
                else:
                    scan_list(np.concatenate([a, b]), forest, num, den, block, len(a))
        yield from edges_of(forest)

    found = written(dealt.mapInArrow(first, "a long, b long, left binary, right binary"))
    near = found.filter("left is null").select("a", "b")
    long_lists = found.filter("left is not null").select("left", "right")
    if long_lists.isEmpty():
        return near
    return near.unionByName(long_lists.repartition(parts, F.xxhash64("left", "right")).mapInArrow(second, "a long, b long"))


def solve(nodes: list[bytes], sets: list[np.ndarray], copies: list[int], side: list[bool] | None, num: int, den: int) -> tuple[list[tuple[bytes, bytes]], dict[bytes, int]]:
    """Links of a group, exactly: a spanning forest of them, and for each node the documents that its links reach.

    side: in a task for two blocks, which of them a node is from; only links across count there.
    """
    m = len(nodes)
    sizes = np.array([len(s) for s in sets])
    weight = np.array(copies)
    owner = np.repeat(np.arange(m), sizes)
    elements, token = np.unique(np.concatenate(sets), return_inverse=True)
    order = np.argsort(token, kind="stable")
    holders, ptr = owner[order], np.append(0, np.cumsum(np.bincount(token, minlength=len(elements))))
    own = np.split(token, np.cumsum(sizes)[:-1])
    across = None if side is None else np.array(side)

    def gathered(tokens: np.ndarray) -> np.ndarray:
        n = ptr[tokens + 1] - ptr[tokens]
        at = np.repeat(ptr[tokens] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return np.bincount(holders[at], minlength=m)

    forest, links, degree = Forest(), [], {}
    leaders: list[tuple[int, np.ndarray]] = []  # answered sets, each with its overlaps
    for i in range(m):
        base = max(leaders, key=lambda x: x[1][i], default=None)
        if base is not None and base[1][i] * 2 > max(sizes[i], sizes[base[0]]):
            there = own[base[0]]
            overlap = base[1] + gathered(np.setdiff1d(own[i], there, assume_unique=True)) - gathered(np.setdiff1d(there, own[i], assume_unique=True))
        else:
            overlap = gathered(own[i])
            leaders = (leaders + [(i, overlap)])[-8:]
        linked = overlap * (num + den) >= num * (sizes + sizes[i])
        linked[i] = False
        if across is not None:
            linked &= across != across[i]
        degree[nodes[i]] = int(weight[linked].sum())
        for j in np.flatnonzero(linked).tolist():
            if forest.join(i, j):
                links.append((nodes[i], nodes[j]))
    return links, degree


def by_group(df: DataFrame, keys: list[str], parts: int, fn: Callable[[list[dict]], list[tuple]], names: list[str], schema: str, *order: str) -> DataFrame:
    """fn over the rows of each group, one group in memory at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[dict] = []
        key = None

        def done() -> Iterator[pa.RecordBatch]:
            if group and (rows := fn(group)):
                columns = list(zip(*rows, strict=True))
                yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, (pa.binary(), pa.binary(), pa.int64()), strict=True)], names)

        for batch in small_batches(batches):
            for row in batch.to_pylist():
                now = tuple(row[k] for k in keys)
                if now != key:
                    yield from done()
                    group, key = [], now
                group.append(row)
        yield from done()

    return df.repartition(parts, *keys).sortWithinPartitions(*keys, *order).mapInArrow(run, schema)


def join(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """(doc_id, n_shingles, component_id, n_links) of every row.

    component_id is the smallest doc_id reachable by links; n_links counts the other rows that are linked directly, among
    them rows with the same set. An empty set has its own doc_id and no links.
    """
    found = _joined(docs, k, num, den)
    return found.select("doc_id", "n_shingles", "component_id", "n_links")


def _joined(docs: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """join() with seal, the hash of the row's text, and chosen: whether the row's text is that of its component's first row."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = written(profile(docs, k))
    rows = table.filter("slice is null").select("doc_id", "seal", "n", "node")
    shared = spark.sparkContext.broadcast(whole_sketch(table.filter("slice is not null").select("slice", "counts")))
    # Every set gives its prefix at most, so this many parts hold PART_ROWS postings each, or fewer.
    most = rows.agg(F.sum(F.col("n") * (den - num) / den + 1)).first()[0] or 0
    pieces = max(4 * parts, int(most // PART_ROWS))
    dealt = postings(docs, k, num, den, shared, pieces).repartition(parts, "part").sortWithinPartitions("part")
    groups = components(candidate_edges(dealt, num, den, parts))
    shared.destroy()

    first = F.min(F.struct("doc_id", "seal"))
    known = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "seal")))
    nodes = written(rows.filter("node is not null").groupBy("node").agg(F.coalesce(known, first).alias("rep"), F.count("*").alias("copies"), F.min("n").alias("n")))
    shorted = nodes.withColumn("short", _short_column(F.col("node")))
    inside = written(shorted.join(groups.select(F.col("node").alias("short"), "root"), "short").drop("short"))
    load = inside.groupBy("root").agg(F.count("*").alias("m"), F.sum("n").alias("elements"))
    blocks = F.greatest(F.lit(1), F.ceil(F.col("m") / MEMBERS), F.ceil(F.col("elements") / ELEMENTS)).cast("int")
    members = written(inside.join(load.filter("m > 1").select("root", blocks.alias("blocks")), "root"))
    links = written(_solved(docs, members, k, num, den, parts))

    tree = components(links.filter("b is not null").select("a", "b"))
    degrees = links.filter("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("degree").alias("degree"))
    reps = nodes.select("node", "rep", "copies")
    known_rep = F.min(F.when(F.col("rep.doc_id").isNotNull(), F.col("rep")))
    lows = tree.join(reps, "node").groupBy("root").agg(F.coalesce(known_rep, F.min("rep")).alias("low"))
    named = tree.join(lows, "root").select("node", "low")
    special = reps.join(named, "node", "left").join(degrees, "node", "left").filter("copies > 1 or low is not null or degree > 0")
    special = written(special.select("node", F.coalesce("low", "rep").alias("low"), (F.col("copies") - 1 + F.coalesce("degree", F.lit(0))).alias("n_links")))
    # Rows without a set have no node; they take no part in the join, where they would meet in one task.
    out = rows.filter("node is not null").join(sized(special), "node", "left")
    chosen = F.col("low").isNull() | (F.col("low.doc_id").eqNullSafe(F.col("doc_id")) & F.col("low.seal").eqNullSafe(F.col("seal")))
    shape = lambda df, *own: df.select("doc_id", "seal", F.col("n").alias("n_shingles"), *own)
    linked = shape(out, F.when(F.col("low").isNull(), F.col("doc_id")).otherwise(F.col("low.doc_id")).alias("component_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), chosen.alias("chosen"))
    return linked.unionByName(shape(rows.filter("node is null"), F.col("doc_id").alias("component_id"), F.lit(0).cast("long").alias("n_links"), F.lit(True).alias("chosen")))


def _short_column(node):
    """short() of a node as a column: its first eight bytes, little-endian and signed."""
    digits = [F.hex(F.substring(node, i, 1)) for i in range(8, 0, -1)]
    high = F.conv(F.concat(*digits[:4]), 16, 10).cast("long")
    low = F.conv(F.concat(*digits[4:]), 16, 10).cast("long")
    signed = F.when(high >= 1 << 31, high - F.lit(1 << 32)).otherwise(high)
    return F.shiftleft(signed, 32).bitwiseOR(low)


def _solved(docs: DataFrame, members: DataFrame, k: int, num: int, den: int, parts: int) -> DataFrame:
    """Rows (a, b) of links and rows (a, NULL, degree); members: (node, rep, copies, root, blocks).

    A node's set is made again from the text of its first row, found by id and seal. Rows that agree in both are taken once a task.
    """
    few = sized(written(members.select(F.col("rep.doc_id").alias("id"), F.col("rep.seal").alias("mark"), F.struct("node", "copies", "root", "blocks").alias("m"))))
    texts = docs.select("doc_id", F.xxhash64("text").alias("seal"), F.col("text").cast("binary").alias("text"))
    found = texts.join(few, (texts["seal"] == few["mark"]) & texts["doc_id"].eqNullSafe(few["id"])).select("text", "m")

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, seen = _Hashes(), set()
        for batch in small_batches(batches):
            out = []
            for text, m in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if m["node"] in seen:
                    continue
                if len(seen) > CACHE_WORDS:
                    seen.clear()
                s = shingle_set(cache, text, k)
                if len(s) and node_of(s) == m["node"]:  # else texts of one id share a seal
                    seen.add(m["node"])
                    out.append((m["root"], m["blocks"], m["node"], m["copies"], s.tobytes()))
            if out:
                c = list(zip(*out, strict=True))
                kinds = (pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.binary())
                yield pa.record_batch([pa.array(x, t) for x, t in zip(c, kinds, strict=True)], ["root", "blocks", "node", "copies", "set"])

    sets = found.mapInArrow(fetch, "root long, blocks int, node binary, copies long, set binary")
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: F.struct(F.least("block", j).alias("i"), F.greatest("block", j).alias("j")))
    tasks = sets.withColumn("block", block).withColumn("pair", F.explode(pairs)).select("root", "pair.i", "pair.j", "block", "node", "copies", "set")

    def one(group: list[dict]) -> list[tuple]:
        unique = {r["node"]: r for r in group}
        if len(unique) < 2:
            return []
        members = list(unique.values())
        side = None if members[0]["i"] == members[0]["j"] else [r["block"] == r["i"] for r in members]
        links, degree = solve([r["node"] for r in members], [np.frombuffer(r["set"], np.uint64) for r in members], [r["copies"] for r in members], side, num, den)
        return [(a, b, None) for a, b in links] + [(a, None, d) for a, d in degree.items() if d]

    return by_group(tasks, ["root", "i", "j"], parts, one, ["a", "b", "degree"], "a binary, b binary, degree long", "node")


def one_of_each(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """docs, all columns, with one row of each component: the row of its smallest doc_id. Rows without a set stay.

    A row goes by its id and its own text, so texts that share an id are judged apart. Of rows that agree in both, one stays.
    A component whose ids are all NULL keeps one row as well.
    """
    found = written(_joined(docs, k, num, den).filter("n_shingles > 0").select("doc_id", "seal", "chosen", "n_links"))
    seal = free_name(docs, "_seal")
    sealed = docs.withColumn(seal, F.xxhash64("text"))

    def of(keys: DataFrame, how: str, rows: DataFrame) -> DataFrame:
        few = sized(written(keys.select(F.col("doc_id").alias("_id"), F.col("seal").alias("_mark")).distinct()))
        return rows.join(few, (rows[seal] == few["_mark"]) & rows["doc_id"].eqNullSafe(few["_id"]), how)

    kept = of(found.filter("not chosen"), "left_anti", sealed)
    again = found.filter("chosen and n_links > 0").groupBy("doc_id", "seal").count().filter("count > 1")
    if again.isEmpty():
        return kept.select(*columns_of(docs))
    once, twice = of(again, "left_anti", kept), of(again, "left_semi", kept)
    return once.unionByName(twice.dropDuplicates(["doc_id", seal])).select(*columns_of(docs))


ORACLE = r"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT DISTINCT r, array_to_string(w[i:i + least(3, len(w)) - 1], ' ') AS g FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
z AS (SELECT r, count(*) AS c FROM g GROUP BY r),
p AS (SELECT a.r AS i, b.r AS j, count(*) AS common FROM g a JOIN g b ON a.g = b.g AND a.r < b.r GROUP BY a.r, b.r),
e AS MATERIALIZED (SELECT i, j FROM p JOIN z x ON x.r = i JOIN z y ON y.r = j WHERE 100 * common >= 90 * (x.c + y.c - common)),
l AS MATERIALIZED (SELECT i, j FROM e UNION ALL SELECT j, i FROM e),
t AS (SELECT r, r AS root FROM z UNION SELECT l.j, t.root FROM t JOIN l ON l.i = t.r),
c AS (SELECT t.r, min(d.doc_id) AS low FROM t JOIN d ON d.r = t.root GROUP BY t.r),
k AS (SELECT i AS r, count(*) AS n FROM l GROUP BY i)
SELECT d.doc_id, coalesce(z.c, 0)::BIGINT AS n_shingles, CASE WHEN z.c IS NULL THEN d.doc_id ELSE c.low END AS component_id, coalesce(k.n, 0)::BIGINT AS n_links
FROM d LEFT JOIN z USING (r) LEFT JOIN c USING (r) LEFT JOIN k USING (r)
"""
