"""Page records (JSON), the chunk store (parquet), evaluation rows and the quarantine."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioflow.schemas import CHUNK_KEY, EVALUATION, PAGE_RECORD, STORE
from folioflow.sources.ledger import Ledger

CORRUPT = "_corrupt_record"
KEY_FIELDS = [field for field in PAGE_RECORD.fields if field.name in CHUNK_KEY]
KEYS = T.StructType([*KEY_FIELDS, T.StructField("object_name", T.StringType())])
QUARANTINE = "stage string, status string, error string, body string, at timestamp"
FILES = T.StructType([T.StructField("source_file", T.StringType())])


def _read_or_empty(spark: SparkSession, folder: str, schema: T.StructType | str, kind: str) -> DataFrame:
    try:
        return spark.read.schema(schema).format(kind).load(folder)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_page_records(spark: SparkSession, folder: str) -> DataFrame:
    """Page records; lines that are no JSON keep their text in ``_corrupt_record``."""
    schema = T.StructType([*PAGE_RECORD.fields, T.StructField(CORRUPT, T.StringType())])
    reader = spark.read.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    return reader.json(folder)


def write_page_records(pages: DataFrame, folder: str) -> None:
    """Append JSON page records; ``object_name`` carries the name each record would have alone."""
    names = [field.name for field in PAGE_RECORD.fields]
    pages.select(*names).write.mode("append").option("ignoreNullFields", "false").json(folder)


def write_page_keys(pages: DataFrame, folder: str) -> None:
    """The narrow ledger of finished pages, so that a skip check never parses page bodies."""
    Ledger(pages.sparkSession, folder, KEYS).append(pages)


def read_page_keys(spark: SparkSession, folder: str, files: DataFrame | None = None) -> DataFrame:
    """All entries, or those of the ledger's files that may hold a ``source_file`` of ``files``."""
    return Ledger(spark, folder, KEYS).read(files)


def write_done_files(files: DataFrame, folder: str) -> None:
    """The ledger of files of which every page is done, so that a repeat need not even be opened."""
    Ledger(files.sparkSession, folder, FILES).append(files)


def read_done_files(spark: SparkSession, folder: str, files: DataFrame | None = None) -> DataFrame:
    return Ledger(spark, folder, FILES).read(files)


def append_store(rows: DataFrame, folder: str, load: str | None = None) -> None:
    """Add store rows; the job commit makes them visible as one.

    A ``load`` that is written again replaces itself, so a batch that a stream replays leaves
    its rows once.
    """
    names = [field.name for field in STORE.fields]
    rows.select(*names).write.mode("overwrite").parquet(f"{folder}/load={load or uuid.uuid4().hex}")


def upsert_store(rows: DataFrame, folder: str, batch_id: int | None = None, load: str | None = None) -> None:
    """Load rows so that a key loaded before gets its new values.

    Parquet has no merge: the rows are appended under their batch, and
    :func:`folioflow.operators.store.latest_per_key` reads the newest row of each key, until
    :func:`folioflow.operators.store.compact_store` rewrites the table. Loading a batch twice is
    therefore harmless.
    """
    append_store(rows if batch_id is None else rows.withColumn("batch_id", F.lit(batch_id).cast("long")), folder, load)


def read_store(spark: SparkSession, folder: str) -> DataFrame:
    """All appended rows; take :func:`folioflow.operators.store.latest_per_key` for the current ones."""
    return _read_or_empty(spark, folder, STORE, "parquet").select(*[field.name for field in STORE.fields])


def append_eval(rows: DataFrame, folder: str) -> DataFrame:
    """Append graded rows with their load time; returns the rows as stored."""
    names = [field.name for field in EVALUATION.fields]
    stamped = rows.withColumn("timestamp", F.current_timestamp()).select(*names)
    stamped.write.mode("append").parquet(folder)
    return stamped


def refused_rows(rows: DataFrame, stage: str) -> DataFrame:
    """Refused inputs as JSON text with their status, one layout for every stage."""
    error = F.col("error") if "error" in rows.columns else F.lit(None).cast("string")
    body = F.to_json(F.struct(*[c for c in rows.columns if c not in ("status", "error")]))
    return rows.select(F.lit(stage).alias("stage"), F.col("status"), error.alias("error"), body.alias("body"), F.current_timestamp().alias("at"))


def append_quarantine(refused: DataFrame, folder: str) -> None:
    """Append rows of :func:`refused_rows`; nothing if there are none."""
    if not refused.isEmpty():
        refused.write.mode("append").parquet(folder)


def write_quarantine(rows: DataFrame, folder: str, stage: str) -> None:
    append_quarantine(refused_rows(rows, stage), folder)


def read_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    """``stage, status, error, body, at`` of everything refused."""
    return _read_or_empty(spark, folder, QUARANTINE, "parquet")
