"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import gc
import pickle
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows that an operator turns into Python objects at once; the session's own Arrow batches may be larger.
BATCH_ROWS = 256
#: A table of at most this many rows may be broadcast; beyond it the join shuffles.
BROADCAST_ROWS = 100_000
#: Entries a Python worker keeps in a word cache before it starts afresh.
CACHE_WORDS = 120_000
#: Bounds of a learning sample: code points of one row, and of all rows of a class. Rows that don't fit are passed over.
LONGEST_ROW, CLASS_CHARS = 1_000_000, 20_000_000


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def small_batches(batches: Iterable[pa.RecordBatch], rows: int = BATCH_ROWS) -> Iterator[pa.RecordBatch]:
    """The batches in slices of at most so many rows, so that what is made of them stays small."""
    for batch in batches:
        for i in range(0, batch.num_rows, rows):
            yield batch.slice(i, rows)


def release_memory() -> None:
    """Gives what a Python worker no longer uses back to the system; workers live on for later tasks."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim:
        trim(0)


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share. A temporary one serves a local session (tests); elsewhere it must be set."""
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="sievework-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def tables_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark).rstrip('/')}/tables/{spark.sparkContext.applicationId}"


def new_table(spark: SparkSession) -> str:
    """A path for a table of this application in the shared folder."""
    return f"{tables_dir(spark)}/{uuid.uuid4().hex}"


def drop_tables(spark: SparkSession) -> None:
    """Deletes every table that this application has written; results that read them must have been saved before."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(tables_dir(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def written(df: DataFrame) -> DataFrame:
    """df as a table in the shared folder: cuts lineage and survives lost executors."""
    path = new_table(df.sparkSession)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sized(small: DataFrame, rows: int | None = None) -> DataFrame:
    """Marks a table for broadcast if its counted rows stay within BROADCAST_ROWS; else it is joined by shuffle."""
    n = small.count() if rows is None else rows
    return F.broadcast(small) if n <= BROADCAST_ROWS else small


def columns_of(df: DataFrame) -> list[Column]:
    """All columns by their quoted names, dots and all."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


def free_name(df: DataFrame, name: str) -> str:
    """name with as many underscores in front as it takes to be no column of df."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def id_text_crc(column: str) -> Column:
    return F.crc32(F.col(column).cast("string").cast("binary"))


def mapped(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str, rows: int = BATCH_ROWS) -> DataFrame:
    """fn over small Arrow batches of df; None results are dropped."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, rows):
            if (out := fn(batch)) is not None:
                yield out
        release_memory()

    return df.mapInArrow(run, schema)


def rows_where(docs: DataFrame, keep: Callable[[list[str]], Iterable[bool]]) -> DataFrame:
    """The rows of docs, all columns whatever their names, whose text is kept; keep judges many texts at once."""
    at = docs.columns.index("text")
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch.filter(pa.array(keep([t or "" for t in batch.column(at).to_pylist()]), pa.bool_()))

    return mapped(plain, one, plain.schema).toDF(*docs.columns)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    return [t or "" for t in batch.column(batch.schema.get_field_index(column)).to_pylist()]


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: dict[int, int]) -> DataFrame:
    """(h, doc_id, y, text) of learnable labelled documents, at most per_class[y] of each class in the order of a hash of the id.

    Learnable: crc32 of doc_id as text, modulo 3, is not 1. NULL ids or labels take no part; of several labels of a
    document the largest counts, of repeated rows one.
    """
    by_id = (
        labels.select("doc_id", F.col(label).cast("int").alias("y"))
        .filter("doc_id is not null and y is not null")
        .filter(id_text_crc("doc_id") % 3 != 1)
        .groupBy("doc_id")
        .agg(F.max("y").alias("y"))
        .withColumn("h", F.xxhash64("doc_id"))
    )
    picked = None
    for y, n in per_class.items():
        part = by_id.filter(F.col("y") == y).orderBy("h", "doc_id").limit(n)
        picked = part if picked is None else picked.unionByName(part)
    rows = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").groupBy("doc_id", "y", "h").agg(F.min("text").alias("text"))
    return rows.select("h", "doc_id", "y", "text")


def fitting(rows: Iterable[dict], longest: int = LONGEST_ROW, total: int = CLASS_CHARS) -> Iterator[dict]:
    """The rows (y, text) in their order, but for those beyond the bounds; a row passed over costs no other row its place."""
    used: dict = {}
    for r in rows:
        n = len(r["text"] or "")
        if n <= longest and used.get(r["y"], 0) + n <= total:
            used[r["y"]] = used.get(r["y"], 0) + n
            yield {"text": r["text"] or "", "y": r["y"]}


def trained(sample: DataFrame, order: list[str], train: Callable[[Iterable[dict]], Any]) -> Any:
    """What train makes of a bounded sample's rows in the given order, in one task on an executor: the driver gets the result alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for batch in small_batches(batches, 64) for r in batch.to_pylist())
        model = pickle.dumps(train(rows))
        release_memory()
        yield pa.record_batch([pa.array([model], pa.binary())], ["model"])

    made = sample.repartition(1).sortWithinPartitions(*order).mapInArrow(run, "model binary").collect()
    return pickle.loads(made[0]["model"]) if made else train([])
