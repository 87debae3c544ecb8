"""Parquet tables as job inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


SPREAD_BYTES = 128 * 1024 * 1024


def read_spread(spark: SparkSession, path: str) -> DataFrame:
    """A table whose scan keeps every core busy.

    Small tables often come as one file, so one task would do all the work; they are dealt out
    after the scan, which Catalyst still narrows to the needed columns and rows. Tables of more
    than SPREAD_BYTES have splits of their own and are read as they are.
    """
    df = spark.read.parquet(path)
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(spark.sparkContext.defaultParallelism) if size <= SPREAD_BYTES else df
