"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.session import checkpoint_root, scratch_path

# Rows that Python hands back at a time; bounds the memory of an output batch.
OUT_ROWS = 4096
# Text of one task, before compression, where the distinct words of a task are what costs.
TASK_BYTES = 96 << 20


def rows_of(batches: Iterable[pa.RecordBatch], *names: str, step: int = 256) -> Iterator[tuple]:
    """The rows of Arrow batches, a slice at a time, so that long texts are not all Python objects at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, step):
            part = batch.slice(at, step)
            yield from zip(*(part.column(n).to_pylist() for n in names))


def packed(rows: Iterable[tuple], schema: pa.Schema, size: int = OUT_ROWS) -> Iterator[pa.RecordBatch]:
    """Arrow batches of at most ``size`` rows."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield batch_of(held, schema)
            held = []
    if held:
        yield batch_of(held, schema)


def batch_of(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, and not again if an executor is lost."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut(df: DataFrame) -> DataFrame:
    """``df`` with its lineage cut by a checkpoint in the shared folder."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def in_large_tasks(df: DataFrame, text: str = "text", size: int = TASK_BYTES) -> DataFrame:
    """Fewer, larger tasks where the input comes in many small splits; never fewer than the cores, no shuffle.

    For work whose cost is in the distinct words of a task.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    total = df.agg(F.sum(F.octet_length(text))).first()[0] or 0
    return df.coalesce(max(cores, -(-total // size)))


def text_key(text: str = "text"):
    """Tells rows of one document id apart by what they say; null differs from empty."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")), F.col(text).isNull())


def unused(df: DataFrame, name: str = "_key") -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    return name if name.lower() not in taken else f"{name}_{uuid.uuid4().hex[:8]}"
