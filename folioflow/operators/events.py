"""Event decoding, routing, outcomes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.functions.binary import b64_decode_text
from folioflow.functions.json import json_field, parse_json_strict
from folioflow.functions.text import route

# Failures worth a retry, and the answer each outcome gives to the sender.
TRANSIENT_ERRORS = ["DatabaseError", "DeadlineExceeded", "ServiceUnavailable", "ResourceExhausted", "BadAnswer"]
ANSWER = {"ok": 204, "skipped": 204, "unsupported": 204, "permanent": 200, "bad_request": 400, "transient": 503}


def decode_events(envelopes: DataFrame, data: str = "message.data") -> DataFrame:
    """Add ``bucket``, ``name`` and ``status``: ``ok``, or ``bad_request`` when any step fails."""
    payload = parse_json_strict(b64_decode_text(F.col(data)))
    bucket, name = json_field(F.col("_payload"), "bucket"), json_field(F.col("_payload"), "name")
    good = F.coalesce((F.col("bucket") != "") & (F.col("name") != ""), F.lit(False))
    return (
        envelopes.withColumn("_payload", payload)
        .withColumns({"bucket": bucket, "name": name})
        .withColumn("status", F.when(good, "ok").otherwise("bad_request"))
        .drop("_payload")
    )


def route_files(files: DataFrame) -> DataFrame:
    """Add ``route``, and turn ``status`` to ``unsupported`` where no handler takes the file."""
    before = F.col("status") if "status" in files.columns else F.lit("ok")
    kind = route(F.col("name"))
    return files.withColumns(
        {"route": kind, "status": F.when((before == "ok") & (kind == "unsupported"), "unsupported").otherwise(before)}
    )


def classify_error(error: Column, policy: str = "by_type") -> Column:
    """Outcome of a failed step: ``ok`` without an error, else ``transient`` or ``permanent``.

    ``by_type`` looks at the error's leading type name; ``retry_all`` and ``ack_all`` treat
    every failure alike.
    """
    if policy == "retry_all":
        failed = F.lit("transient")
    elif policy == "ack_all":
        failed = F.lit("permanent")
    else:
        kind = F.substring_index(F.substring_index(error, ":", 1), ".", -1)
        failed = F.when(kind.isin(TRANSIENT_ERRORS), "transient").otherwise("permanent")
    return F.when(error.isNull(), "ok").otherwise(failed)


def answer_code(status: Column) -> Column:
    """The acknowledgement a sender gets: 2xx ends redelivery, 4xx and 5xx do not."""
    codes = F.create_map(*[F.lit(x) for pair in ANSWER.items() for x in pair])
    return F.try_element_at(codes, status)


def retry_pending(outcomes: DataFrame, inputs: DataFrame, keys: list[str]) -> DataFrame:
    """The inputs whose latest outcome asks for another try."""
    return inputs.join(outcomes.filter(F.col("status") == "transient").select(*keys).distinct(), keys, "left_semi")


def split_status(rows: DataFrame, good: str = "ok") -> tuple[DataFrame, DataFrame]:
    """(rows to go on with, rows for the quarantine)."""
    fine = F.col("status") == good
    return rows.filter(fine), rows.filter(~fine)


def dedupe_events(events: DataFrame, delay: str = "1 hour", time: str = "event_time") -> DataFrame:
    """Drop redeliveries of one object within ``delay``; state older than that is forgotten."""
    return events.withWatermark(time, delay).dropDuplicatesWithinWatermark(["bucket", "name"])
