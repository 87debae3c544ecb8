"""Ledgers of finished work as sorted runs, of which a batch opens the few files that can hold its keys.

Every append writes a run: rows in key order, cut into files of bounded length. The index has one entry a file: its
smallest and largest key and a Bloom filter of its keys. A batch of keys is held against the index first, and only files
that may have one of them are opened. When there are many runs of one order of size they are merged into one, so a
ledger of n rows has some log(n) runs and a row is rewritten as often. A run counts once it stands in the index; the
index of a merge is a generation of its own that counts once it is whole, so a reader never sees half of one.

A ledger has one writer at a time. A row appended twice may be read twice until its runs are merged.
"""

from __future__ import annotations

import math
import uuid
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioflow.sources.files import open_root

ROWS_A_FILE = 50_000
# Bits of a filter for each key, and how many of them a key sets: one strange key in a hundred passes.
KEY_BITS = 10
KEY_HASHES = 7
# Runs of one order of size, and how much longer the runs of the next one are.
RUNS_A_TIER = 8
# Batches with more keys than that read the whole ledger.
MOST_KEYS = 200_000
# Files that a merge leaves the index in.
INDEX_TASKS = 4

ENTRY = pa.schema([("run", pa.string()), ("file", pa.string()), ("lower", pa.string()), ("upper", pa.string()), ("n", pa.int64()), ("bits", pa.binary())])
ENTRY_DDL = "run string, file string, lower string, upper string, n bigint, bits binary"


def _places(hashes: np.ndarray, size: int) -> np.ndarray:
    """Bit numbers of 64-bit hashes in a filter of ``size`` bits, a power of two: rows x KEY_HASHES."""
    hashes = hashes.astype(np.uint64)
    step = (hashes >> np.uint64(32)) | np.uint64(1)
    return (hashes[:, None] + step[:, None] * np.arange(KEY_HASHES, dtype=np.uint64)) & np.uint64(size - 1)


def bloom_filter(hashes: np.ndarray) -> bytes:
    hashes = np.unique(hashes)
    size = max(64, 1 << (len(hashes) * KEY_BITS - 1).bit_length())
    bits = np.zeros(size, np.uint8)
    bits[_places(hashes, size)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def may_have(bits: bytes, hashes: np.ndarray) -> np.ndarray:
    """True for every hash that the filter was made of, and for few others."""
    known = np.frombuffer(bits, np.uint8)
    at = _places(hashes, len(known) * 8)
    return ((known[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1).all(axis=1)


def _by_file(batch: pa.RecordBatch) -> Iterator[tuple[str, pa.RecordBatch]]:
    """Slices of a batch that come from one file each."""
    ends = pc.run_end_encode(batch.column("file")).run_ends.to_pylist() if batch.num_rows else []
    for first, end in zip([0, *ends], ends):
        yield batch.column("file")[first].as_py(), batch.slice(first, end - first)


class Ledger:
    """Rows of ``schema`` below a folder, found by the string column ``key``."""

    def __init__(self, spark: SparkSession, folder: str, schema: T.StructType, key: str = "source_file", rows_a_file: int = ROWS_A_FILE):
        self.spark, self.folder, self.schema, self.key, self.rows_a_file = spark, folder.rstrip("/"), schema, key, rows_a_file

    def _names(self, folder: str) -> list[str]:
        system, base = open_root(self.folder)
        found = system.get_file_info(pafs.FileSelector(f"{base}/{folder}", allow_not_found=True))
        return [info.base_name for info in found]

    def _generation(self) -> int | None:
        """The newest whole index."""
        whole = [int(name) for name in self._names("index") if name.isdigit() and "_SUCCESS" in self._names(f"index/{name}")]
        return max(whole, default=None)

    def index(self) -> DataFrame:
        """``run, file, lower, upper, n, bits`` of every file that counts."""
        at = self._generation()
        if at is None:
            return self.spark.createDataFrame([], ENTRY_DDL)
        return self.spark.read.schema(ENTRY_DDL).parquet(f"{self.folder}/index/{at}")

    def _write_run(self, rows: DataFrame) -> DataFrame:
        """A new run, and the index entries of its files."""
        run, names, key = uuid.uuid4().hex, [f.name for f in self.schema.fields], self.key
        path = f"{self.folder}/runs/{run}"
        ordered = rows.select(*names).repartitionByRange(*names).sortWithinPartitions(*names)
        ordered.write.option("maxRecordsPerFile", self.rows_a_file).parquet(path)

        def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for file, parts in groupby((part for batch in batches for part in _by_file(batch)), lambda part: part[0]):
                table = pa.Table.from_batches([part for _, part in parts])  # rows_a_file rows at most
                ends = pc.min_max(table["key"]).as_py()
                row = run, file, ends["min"], ends["max"], len(table), bloom_filter(table["hash"].to_numpy())
                yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, ENTRY)], schema=ENTRY)

        written = self.spark.read.schema(self.schema).parquet(path)
        keys = written.select(F.col("_metadata.file_path").alias("file"), F.col(key).alias("key"), F.xxhash64(key).alias("hash"))
        return keys.mapInArrow(describe, ENTRY_DDL)

    def append(self, rows: DataFrame) -> None:
        """Add rows; they can be read when this returns."""
        entries = self._write_run(rows)
        index = f"index/{self._generation() or 0}"
        entries.write.mode("append").parquet(f"{self.folder}/{index}")
        # An append adds a file to the index at least: with fewer there are not too many runs.
        if sum(name.endswith(".parquet") for name in self._names(index)) > RUNS_A_TIER:
            self.merge()

    def runs(self) -> dict[str, int]:
        """Runs and their rows; there are few."""
        return {r.run: r.n for r in self.index().groupBy("run").agg(F.sum("n").alias("n")).collect()}

    def merge(self, every: bool = False) -> None:
        """Make one run of the runs of an order of size that has too many, or of all; rows are kept once each."""
        tiers: dict[int, list[str]] = {}
        for run, n in self.runs().items():
            tiers.setdefault(0 if every else int(math.log(max(n, 1), RUNS_A_TIER)), []).append(run)
        old = [run for runs in tiers.values() if len(runs) > (1 if every else RUNS_A_TIER) for run in runs]
        if not old:
            return
        index, at = self.index(), self._generation()
        files = [r.file for r in index.filter(F.col("run").isin(old)).select("file").collect()]
        entries = self._write_run(self.spark.read.schema(self.schema).parquet(*files).distinct())
        index.filter(~F.col("run").isin(old)).unionByName(entries).coalesce(INDEX_TASKS).write.parquet(f"{self.folder}/index/{at + 1}")

    def clean(self) -> None:
        """Delete runs and indexes that no longer count. Not while others read the ledger."""
        system, base = open_root(self.folder)
        at, known = self._generation(), set(self.runs())
        for name in self._names("runs"):
            if name not in known:
                system.delete_dir(f"{base}/runs/{name}")
        for name in self._names("index"):
            if name.isdigit() and int(name) != at:
                system.delete_dir(f"{base}/index/{name}")

    def files(self, keys: DataFrame | None = None) -> list[str]:
        """The files to open for the ``key`` values of ``keys``; all of them without."""
        index = self.index()
        if keys is None:
            return sorted({r.file for r in index.select("file").collect()})
        wanted = keys.select(F.col(self.key).alias("key")).filter("key IS NOT NULL").distinct().withColumn("hash", F.xxhash64("key"))
        head = wanted.limit(MOST_KEYS + 1).toArrow().sort_by("key")
        if len(head) > MOST_KEYS:
            return self.files()
        shared = self.spark.sparkContext.broadcast((head["key"].to_pylist(), head["hash"].to_numpy()))

        def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            names, hashes = shared.value
            for batch in batches:
                entries = zip(*(batch.column(c).to_pylist() for c in ("file", "lower", "upper", "bits")))
                found = []
                for file, lower, upper, bits in entries:
                    at = slice(bisect_left(names, lower), bisect_right(names, upper)) if lower is not None else slice(0)
                    if len(hashes[at]) and may_have(bits, hashes[at]).any():
                        found.append(file)
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.string())], names=["file"])

        return sorted({r.file for r in index.select("file", "lower", "upper", "bits").mapInArrow(choose, "file string").collect()})

    def read(self, keys: DataFrame | None = None) -> DataFrame:
        """The rows of the files that may hold the ``key`` values of ``keys``: all of those, and others beside them."""
        files = self.files(keys)
        return self.spark.read.schema(self.schema).parquet(*files) if files else self.spark.createDataFrame([], self.schema)
