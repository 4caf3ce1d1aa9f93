"""The record rules over a folder that receives JSONL files: each micro-batch is checked and appended.

Duplicates are found within a batch only; gates and near duplicates stay batch work. The engine it follows has no stream, so
this is an addition.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from sievework.operators.findings import exploded
from sievework.sources.records import parsed


def stream_findings(spark: SparkSession, folder: str, check: Callable[[DataFrame], DataFrame], out: str, checkpoint: str) -> StreamingQuery:
    """Starts the query; it ends when what the folder holds is done."""
    lines = spark.readStream.option("lineSep", "\n").text(folder).select(F.input_file_name().alias("file"), F.rtrim("value", F.lit("\r")).alias("line"))

    def write(batch: DataFrame, _: int) -> None:
        exploded(check(parsed(batch.withColumn("pos", F.monotonically_increasing_id())))).write.mode("append").parquet(out)

    return lines.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
