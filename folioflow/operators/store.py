"""Chunk keys, store rows, skip checks, the latest-per-key view and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioflow.functions.text import page_prefix
from folioflow.functions.vectors import check_dim
from folioflow.operators.metadata import metadata_json
from folioflow.schemas import CHUNK_KEY, IMAGE_DIM, TEXT_DIM

MAX_SOURCE_CHARS = 1024
PAGE_MARK = "-page-"


def chunk_id(source_file: str = "source_file", part: str = "part", page_num: str = "page_num") -> Column:
    """A key that stays the same under retry: hash of the chunk key."""
    return F.sha2(F.concat_ws("|", F.col(source_file), F.col(part), F.col(page_num).cast("string")), 256)


def check_store_row(rows: DataFrame, text_dim: int | None = TEXT_DIM, image_dim: int | None = IMAGE_DIM) -> DataFrame:
    """Add ``status``: ``ok``, or the first contract a row breaks.

    A missing vector is allowed, as in a nullable column; a present one must fit.
    """
    source = F.col("source_file")
    status = F.when(source.isNull(), "no_source").when(F.length(source) > MAX_SOURCE_CHARS, "source_too_long")
    for column, dim in (("text_embedding", text_dim), ("multimodal_embedding", image_dim)):
        if dim and column in rows.columns:
            status = status.when(F.col(column).isNotNull() & ~check_dim(F.col(column), dim), f"bad_{column}")
    return rows.withColumn("status", status.otherwise("ok"))


def to_store_row(chunks: DataFrame, batch_id: int = 0) -> DataFrame:
    """The fixed column list of the store, with casts."""
    metadata = F.col("metadata") if dict(chunks.dtypes)["metadata"] == "string" else metadata_json()
    return chunks.select(
        chunk_id().alias("id"),
        "source_file",
        "part",
        F.col("page_num").cast("int").alias("page_num"),
        "chunk_description",
        metadata.alias("metadata"),
        F.col("text_embedding").cast("array<float>").alias("text_embedding"),
        F.col("multimodal_embedding").cast("array<float>").alias("multimodal_embedding"),
        F.current_timestamp().alias("created_at"),
        F.lit(batch_id).cast("long").alias("batch_id"),
        *(["error"] if "error" in chunks.columns else []),
    )


def latest_per_key(rows: DataFrame, key: list[str] | None = None, newest: list[str] | None = None) -> DataFrame:
    """One row per key, the newest. Repeats are thinned out before the shuffle."""
    # Equal times are told apart by the row itself, so that the same one wins on every run.
    order = [*(F.desc(c) for c in (newest or ["created_at", "batch_id"])), F.desc(F.xxhash64(*rows.columns))]
    window = Window.partitionBy(*(key or CHUNK_KEY)).orderBy(*order)
    return rows.withColumn("_n", F.row_number().over(window)).filter(F.col("_n") == 1).drop("_n")


def compact_store(rows: DataFrame, folder: str, max_records_per_file: int = 100_000) -> None:
    """Write the latest rows into a new folder; readers switch when it is complete."""
    latest_per_key(rows).write.option("maxRecordsPerFile", max_records_per_file).mode("errorifexists").parquet(folder)


def done_prefixes(done: DataFrame, object_name: str = "object_name") -> DataFrame:
    """Every leading part of a finished object's name that ends in the page mark.

    These are all the page prefixes such a name can start with, so "some object starts with the
    prefix" becomes equality.
    """
    name = F.col(object_name)
    ends = F.sequence(F.lit(len(PAGE_MARK)), F.length(name))
    marked = F.filter(ends, lambda e: F.substring(name, e - len(PAGE_MARK) + 1, F.lit(len(PAGE_MARK))) == PAGE_MARK)
    prefixes = F.transform(marked, lambda e: F.substring(name, F.lit(1), e))
    long_enough = done.filter(F.length(name) >= len(PAGE_MARK))
    return long_enough.select(F.explode(prefixes).alias("_prefix")).distinct()


def skip_done(files: DataFrame, done: DataFrame, mode: str = "page", key: list[str] | None = None) -> DataFrame:
    """What is still to do.

    ``page`` drops the pages whose key is already there. ``prefix`` drops a file when any
    finished object's name starts with its page prefix; it takes a file with one finished page,
    or one whose name a finished page's name extends, for done.
    """
    if mode == "prefix":
        named = files.withColumn("_prefix", page_prefix(F.col("name")))
        return named.join(done_prefixes(done), "_prefix", "left_anti").drop("_prefix")
    key = key or CHUNK_KEY
    return files.join(done.select(*key), key, "left_anti")


def attach_vectors(pages: DataFrame, text_vectors: DataFrame, image_vectors: DataFrame, key: list[str] | None = None) -> DataFrame:
    """Pages with both vectors, matched by chunk key."""
    key = key or CHUNK_KEY
    return pages.join(text_vectors, key).join(image_vectors, key)


def ingest_report(chunks: DataFrame) -> DataFrame:
    """Counts per file and status."""
    return chunks.groupBy("source_file", "status").agg(F.count("*").alias("n"))
