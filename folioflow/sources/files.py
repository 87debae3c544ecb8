"""Stored objects: listing without content, and content for the survivors only.

Spark's own file index drops names that begin with ``_`` or ``.`` and reads special signs in a
path as patterns. Objects may be called anything, so folders are listed and files opened inside
tasks, by their literal paths.
"""

from __future__ import annotations

import posixpath
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.session import written

LISTING = "bucket string, name string, path string, length long"
BINARY_FILE = "path string, modificationTime timestamp, length long, content binary"
FOUND = pa.schema([("name", pa.string()), ("is_folder", pa.bool_()), ("length", pa.int64())])
# Bytes of object contents handed over at a time; a larger object is a batch of its own.
BATCH_BYTES = 32 * 1024 * 1024


def keep_objects(listing: DataFrame, prefix: str = "", name: str = "name") -> DataFrame:
    """Objects under a prefix; names ending in ``/`` are folder markers and go."""
    kept = listing.filter(~F.col(name).endswith("/"))
    return kept.filter(F.col(name).startswith(prefix)) if prefix else kept


def open_root(root: str) -> tuple[fs.FileSystem, str]:
    """The file system of a root, and the root's path on it."""
    if "://" not in root and not root.startswith("file:"):
        return fs.LocalFileSystem(), root.rstrip("/")
    if root.startswith("file:"):
        return fs.LocalFileSystem(), "/" + root.removeprefix("file:").lstrip("/").rstrip("/")
    found, path = fs.FileSystem.from_uri(root)
    return found, path.rstrip("/")


def _relative_name(path: Column, root: str) -> Column:
    base = root.split("://", 1)[-1].removeprefix("file:").rstrip("/") + "/"
    return F.substring(path, F.instr(path, base) + len(base), F.length(path))


def _list_folders(root: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = open_root(root)
        for batch in batches:
            for folder in batch.column("name").to_pylist():
                selector = fs.FileSelector(f"{base}/{folder}".rstrip("/"), allow_not_found=True)
                infos = system.get_file_info(selector)
                names = [i.path[len(base) :].lstrip("/") for i in infos]
                kinds = [i.type == fs.FileType.Directory for i in infos]
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(kinds), pa.array([i.size for i in infos], pa.int64())], schema=FOUND)

    return run


def list_files(spark: SparkSession, root: str, prefix: str = "", bucket: str | None = None) -> DataFrame:
    """Names and sizes below ``root``, without content.

    One job lists all folders of a depth. The folder part of the prefix narrows the listing
    itself, the rest is a filter. A folder that is not there lists nothing.
    """
    root = root.rstrip("/")
    level = spark.createDataFrame([(prefix[: prefix.rfind("/") + 1].rstrip("/"),)], "name string")
    files: DataFrame | None = None
    while True:
        found = written(level.mapInArrow(_list_folders(root), "name string, is_folder boolean, length long"), "listing")
        here = found.filter(~F.col("is_folder")).select("name", "length")
        files = here if files is None else files.unionByName(here)
        folders = found.filter("is_folder").select("name")
        if folders.isEmpty():
            break
        level = folders.repartition(spark.sparkContext.defaultParallelism)
    named = F.lit(bucket or root.rsplit("/", 1)[-1]).alias("bucket")
    return keep_objects(files.select(named, "name", F.concat(F.lit(f"{root}/"), "name").alias("path"), "length"), prefix)


def read_objects(objects: DataFrame, root: str, name: str = "name") -> DataFrame:
    """``objects`` with the ``content`` of those that exist below ``root``; the others are left out.

    Each task opens its own objects by name. A name that leads out of the root counts as missing.
    """
    root = root.rstrip("/")
    kept = [c for c in objects.columns if c != "content"]
    schema = objects.select(*kept).schema.add("content", "binary")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = open_root(root)
        for batch in batches:
            held, rows, size = [], [], 0
            for i, wanted in enumerate(batch.column(name).to_pylist()):
                path = posixpath.normpath(f"{base}/{wanted}")
                if wanted is None or not path.startswith(f"{base}/") or not system.get_file_info(path).is_file:
                    continue
                with system.open_input_stream(path) as stream:
                    held.append(stream.read())
                rows.append(i)
                size += len(held[-1])
                if size > BATCH_BYTES:
                    yield _with_content(batch, rows, held)
                    held, rows, size = [], [], 0
            if rows:
                yield _with_content(batch, rows, held)

    return objects.select(*kept).mapInArrow(run, schema)


def _with_content(batch: pa.RecordBatch, rows: list[int], contents: list[bytes]) -> pa.RecordBatch:
    part = batch.take(pa.array(rows, pa.int64()))
    return pa.RecordBatch.from_arrays([*part.columns, pa.array(contents, pa.binary())], names=[*part.schema.names, "content"])


def read_binary(spark: SparkSession, root: str) -> DataFrame:
    """Whole objects as bytes: ``name, path, length, content``."""
    return read_objects(list_files(spark, root).select("name", "path", "length"), root)


def watch_files(spark: SparkSession, root: str, bucket: str | None = None, max_files: int | None = None) -> DataFrame:
    """New objects below ``root`` as a stream of ``bucket, name, event_time``, without content.

    The stream is Spark's and does not see names that begin with ``_`` or ``.``; send events for
    such objects, or a backfill over :func:`list_files`.
    """
    root = root.rstrip("/")
    reader = spark.readStream.format("binaryFile").schema(BINARY_FILE).option("recursiveFileLookup", "true")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return reader.load(root).select(
        F.lit(bucket or root.rsplit("/", 1)[-1]).alias("bucket"),
        _relative_name(F.col("path"), root).alias("name"),
        F.col("modificationTime").alias("event_time"),
    )
