"""Parquet table access for the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The named Parquet table below ``sf_dir`` (any path Spark can read)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """df over all cores where its files hold less than a full split for each core, else df as it is read.

    A small file may be a single row group, which is one task whatever its splits. The rows moved are bounded by that size, so
    large tables never shuffle here. Rows and columns stay the same.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    split = int(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return df.repartition(cores) if size < cores * split else df
