"""Canonical exact digests of documents.

The canonical form of a text is its NFKC normalisation, case-folded, normalised again, with every run of white space
folded to one space and none at the ends. The fingerprint is the 128-bit xxhash of its UTF-8 bytes in hexadecimal.
Documents group by fingerprint, and inside equal buckets the canonical bytes themselves decide: two different texts
with one digest fall into different classes, and all but the first class carry their number behind the digest. Two rows
therefore have equal fingerprints exactly when their canonical bytes are equal.

Defined results: NULL counts as the empty text. Lone surrogates encode as `?`. Repeated rows are rows of their own and
follow each other. A NULL doc_id sorts before all others. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.llm.common import mapped, sized, small_batches, texts_of, written

#: Documents that one bucket of the neighbour search should hold, and the most buckets for each shuffle partition.
BUCKET_ROWS = 2_000
BUCKETS_PER_TASK = 8
#: Hexadecimal digits of a digest. Shorter ones are for tests that need collisions.
WIDE = 32


def canonical(text: str) -> bytes:
    if text.isascii():
        folded = text.lower()
    else:
        folded = unicodedata.normalize("NFKC", unicodedata.normalize("NFKC", text).casefold())
    return " ".join(folded.split()).encode("utf-8", "replace")


def digest(form: bytes, width: int = WIDE) -> str:
    return xxhash.xxh3_128_hexdigest(form)[:width]


def fingerprint(text: str) -> str:
    return digest(canonical(text))


def edited(text: str, following: str) -> str:
    """text with its last quarter of code points replaced by the first as many (or all) of the following text."""
    k = len(text) // 4
    return text[: len(text) - k] + following[:k]


def likeness(one: bytes, other: bytes) -> float:
    """1 for equal canonical bytes, which equal digests only suggest; else 0."""
    return float(xxhash.xxh3_128_digest(one) == xxhash.xxh3_128_digest(other) and one == other)


def digests(docs: DataFrame, width: int = WIDE) -> DataFrame:
    """(doc_id, fingerprint) of every row."""

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.record_batch([batch.column(0), pa.array([digest(canonical(t), width) for t in texts_of(batch)], pa.string())], ["doc_id", "fingerprint"])

    return mapped(docs.select("doc_id", "text"), one, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, fingerprint string")


def canonical_classes(docs: DataFrame, width: int = WIDE) -> DataFrame:
    """(fingerprint, canonical bytes, class) of every distinct canonical text among rows whose digest is shared.

    Only digests that occur more than once are compared; a task passes on each distinct canonical text once, so that a
    group of copies, however large, costs the shuffle one row a task. class numbers the texts of a digest by their bytes;
    it is 0 but for a collision.
    """
    from pyspark.sql import Window

    shared = written(digests(docs, width).groupBy("fingerprint").agg(F.count("*").alias("rows")).filter("rows > 1").select("fingerprint"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[str] = set()
        for batch in small_batches(batches):
            names, forms = [], []
            for t in texts_of(batch):
                form = canonical(t)
                name = digest(form, width)
                wide = xxhash.xxh3_128_hexdigest(form) + xxhash.xxh64_hexdigest(form, 7)
                if wide not in seen:
                    if len(seen) > 200_000:
                        seen.clear()
                    seen.add(wide)
                    names.append(name)
                    forms.append(form)
            yield pa.record_batch([pa.array(names, pa.string()), pa.array(forms, pa.binary())], ["fingerprint", "form"])

    forms = docs.select("text").mapInArrow(run, "fingerprint string, form binary")
    compared = forms.join(sized(shared), "fingerprint", "left_semi").distinct()
    order = Window.partitionBy("fingerprint").orderBy("form")
    return compared.withColumn("class", F.row_number().over(order) - 1)


def collisions(docs: DataFrame, width: int = WIDE) -> DataFrame:
    """Canonical texts beyond the first of their digest; no row means that digests equal exact classes."""
    return canonical_classes(docs, width).filter("class > 0")


def _cuts(docs: DataFrame, buckets: int) -> list:
    """Ascending doc_ids that cut the table into about equal buckets; any cuts are right, these are even."""
    if buckets < 2:
        return []
    share = [i / buckets for i in range(1, buckets)]
    found = docs.agg(F.percentile_approx("doc_id", F.array(*map(F.lit, share)), F.lit(20 * buckets)).alias("c")).first()["c"]
    return sorted(set(found or []))


def with_next(docs: DataFrame) -> DataFrame:
    """Rows of docs dealt out so that each task sees whole buckets in ascending doc_id, ended by the next bucket's first row.

    Columns: bucket, ghost (1 for that borrowed first row), doc_id, text. The order is doc_id, then a hash of the text.
    The bucket of the largest ids is followed by the first row of all.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    count = rows.count()
    cuts = _cuts(rows, max(1, min(BUCKETS_PER_TASK * parts, -(-count // BUCKET_ROWS))))
    # The bucket of an id: how many cuts are at most the id, by bisection over a literal array.
    bucket = F.expr("0") if not cuts else F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c <= F.col("doc_id")))
    if len(cuts) > 64:
        step = int(len(cuts) ** 0.5)
        coarse = F.size(F.filter(F.array(*map(F.lit, cuts[::step])), lambda c: c <= F.col("doc_id")))
        fine = F.array(*[F.array(*map(F.lit, cuts[i : i + step])) for i in range(0, len(cuts), step)])
        inner = F.size(F.filter(F.get(fine, coarse - 1), lambda c: c <= F.col("doc_id")))
        bucket = F.when(coarse == 0, 0).otherwise((coarse - 1) * step + inner)
    rows = rows.withColumn("bucket", F.when(F.col("doc_id").isNull(), -1).otherwise(bucket).cast("int"))
    heads = sorted((r["bucket"], r["head"]) for r in rows.groupBy("bucket").agg(F.min("doc_id").alias("head")).collect())
    if not heads:
        return rows.select("bucket", F.lit(0).alias("ghost"), "doc_id", "text")
    before = {b: heads[i - 1][0] for i, (b, _) in enumerate(heads)}
    table = spark.createDataFrame([(b, before[b], h) for b, h in heads], f"bucket int, previous int, head {docs.schema['doc_id'].dataType.simpleString()}")
    # Rows with their bucket's smallest id also go, as a ghost, to the bucket before.
    joined = rows.join(F.broadcast(table), "bucket")
    copies = F.array(F.struct(F.col("bucket").alias("b"), F.lit(0).alias("g")), F.struct(F.col("previous").alias("b"), F.lit(1).alias("g")))
    targets = F.when(F.col("doc_id").eqNullSafe(F.col("head")), copies).otherwise(F.slice(copies, 1, 1))
    return (
        joined.select(F.explode(targets).alias("t"), "doc_id", "text")
        .select(F.col("t.b").alias("bucket"), F.col("t.g").alias("ghost"), "doc_id", "text")
        .repartition(parts, "bucket")
        .sortWithinPartitions("bucket", "ghost", "doc_id", F.xxhash64("text"))
    )


def neighbour_report(docs: DataFrame, width: int = WIDE) -> DataFrame:
    """For every row: n_chars, the edited text's SHA-256, fingerprints of both, and likenesses to it and to the next text.

    class is the row's class inside its digest: 0, but for texts that collide with another one. The edited text is no row
    of the table; its fingerprint carries a class only where it has the row's own canonical bytes.
    """
    beyond = written(collisions(docs, width).select(F.col("fingerprint").alias("digest"), F.sha2("form", 256).alias("seal"), "class"))
    found = _neighbour_rows(docs, width).join(sized(beyond), ["digest", "seal"], "left")
    own = F.when(F.col("class").isNull(), F.col("digest")).otherwise(F.concat_ws("-", "digest", "class"))
    return found.select(
        "doc_id", "n_chars", "edited_sha256", own.alias("fingerprint"), F.when(F.col("near_edited") == 1, own).otherwise(F.col("edited_digest")).alias("edited_fingerprint"),
        "near_edited", "near_next", F.coalesce("class", F.lit(0)).alias("class"),
    )


def _neighbour_rows(docs: DataFrame, width: int) -> DataFrame:
    """The report before classes: digests of both texts, and seal, the SHA-256 of the row's canonical bytes."""
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_chars long, edited_sha256 string, digest string, edited_digest string, seal string, near_edited double, near_next double"
    id_type = pa.int64() if docs.schema["doc_id"].dataType.simpleString() == "bigint" else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        held: tuple | None = None  # (bucket, doc_id, text, canonical) still without its successor

        def close(text: str, form: bytes) -> None:
            _, doc_id, own, own_form = held
            change = edited(own, text)
            change_form = canonical(change)
            sealed = (hashlib.sha256(change.encode("utf-8", "replace")).hexdigest(), digest(own_form, width), digest(change_form, width), hashlib.sha256(own_form).hexdigest())
            out.append((doc_id, len(own), *sealed, likeness(own_form, change_form), likeness(own_form, form)))

        def flush() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True))
            arrays = [pa.array(columns[0], id_type), pa.array(columns[1], pa.int64()), *(pa.array(c, pa.string()) for c in columns[2:6]), *(pa.array(c, pa.float64()) for c in columns[6:])]
            out.clear()
            return pa.record_batch(arrays, ["doc_id", "n_chars", "edited_sha256", "digest", "edited_digest", "seal", "near_edited", "near_next"])

        for batch in small_batches(batches):
            buckets, ghosts, ids = (batch.column(i).to_pylist() for i in range(3))
            for bucket, ghost, doc_id, text in zip(buckets, ghosts, ids, texts_of(batch), strict=True):
                form = canonical(text)
                if held is not None and held[0] == bucket:
                    close(text, form)
                held = None if ghost else (bucket, doc_id, text, form)
            if out:
                yield flush()

    return with_next(docs).mapInArrow(run, schema)

