"""Event folders: one JSON envelope per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.functions.binary import b64_encode
from folioflow.schemas import ENVELOPE


def read_events_stream(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    """Envelopes as they arrive, with the arrival time of their file."""
    reader = spark.readStream.schema(ENVELOPE).option("recursiveFileLookup", "true")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return reader.json(folder).select("message", F.col("_metadata.file_modification_time").alias("event_time"))


def read_events(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(ENVELOPE).option("recursiveFileLookup", "true").json(folder)


def to_envelopes(files: DataFrame) -> DataFrame:
    """One envelope per object: base64 of ``{"bucket":...,"name":...}``."""
    payload = F.to_json(F.struct("bucket", "name"))
    return files.select(F.struct(b64_encode(F.encode(payload, "UTF-8")).alias("data")).alias("message"))


def emit_backfill_events(files: DataFrame, folder: str) -> DataFrame:
    """Write one event per stored object to the event folder; returns what was written."""
    events = to_envelopes(files)
    events.write.mode("append").json(folder)
    return events
