"""Delivery of objects to stage 1 with a state of their own: repeats are dropped, failures are sent again when due.

The state of an object holds the generation that was sent last, the tries, and when the next is due; it lies in a shard
with the states of other objects, and a shard's timer runs out when the first of them is due. An event of a generation
that has been sent is a redelivery and goes no further; one of a newer generation is a new upload, sent at once with its
tries counted anew. A transient failure sets a timer, and the stream itself sends the object again when it runs out,
after twice the delay of the try before, until ``max_tries``. Objects of which nothing was heard for ``keep`` are
forgotten. A checkpoint of one state an object, as it was before, cannot be gone on with.

The generation is any number that rises with every upload of a name, such as the time of its last change. Events without
one count as generation 0. Stage 1 may run with ``reprocess`` behind this stream, since it gets no redeliveries.
"""

from __future__ import annotations

import time
from collections.abc import Iterator
from datetime import datetime, timezone

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from folioflow.functions.json import json_field
from folioflow.sources.events import to_envelopes
from folioflow.sources.records import QUARANTINE
from folioflow.streaming.pipeline import MAX_TRIES, _start, quarantine_dir

# The objects of a shard, one entry each, and how many shards there are. A batch reads and writes the shards that it
# has news of: with more of them a small batch writes less, with fewer a large one makes fewer calls.
STATE = "bucket array<string>, name array<string>, generation array<bigint>, tries array<int>, due array<bigint>, heard array<bigint>"
SHARDS = 4096
SENT = "bucket string, name string, generation bigint, try int"
# Timers need this state store; the default one cannot hold them.
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PARTITIONS = "spark.sql.shuffle.partitions"
DAY_MS = 24 * 60 * 60 * 1000
NOT_DUE = 0
TRIGGER = {"processingTime": "10 seconds"}


class Deliveries(StatefulProcessor):
    """What to send of the objects of one shard, from rows ``bucket``, ``name``, ``kind`` (event, failed or refused) and
    ``generation``. The objects come and go as one value, since a call of the state store for each of them takes milliseconds."""

    def __init__(self, delay_ms: int, max_tries: int, keep_ms: int):
        self.delay_ms, self.max_tries, self.keep_ms = delay_ms, max_tries, keep_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.state = handle.getValueState("objects", STATE, self.keep_ms)

    def _known(self, now: int) -> tuple[dict[tuple, tuple[int, int, int, int]], int]:
        """Generation, tries, due and time of the last news of every object that is not forgotten, and when the timer runs out."""
        if not self.state.exists():
            return {}, NOT_DUE
        buckets, names, *told = self.state.get()
        known = dict(zip(zip(buckets, names), zip(*told)))
        timer = self._next(known)
        return {key: told for key, told in known.items() if told[3] + self.keep_ms > now}, timer

    @staticmethod
    def _next(known: dict[tuple, tuple[int, int, int, int]]) -> int:
        """When the first object is due."""
        return min((due for _, _, due, _ in known.values() if due != NOT_DUE), default=NOT_DUE)

    def _keep(self, known: dict[tuple, tuple[int, int, int, int]]) -> None:
        if known:
            self.state.update((*map(list, zip(*known)), *map(list, zip(*known.values()))))
        else:
            self.state.clear()

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentProcessingTimeInMs()
        known, old = self._known(now)
        newest: dict[tuple, int] = {}
        told: dict[str, set[tuple]] = {"failed": set(), "refused": set()}
        for part in rows:
            for bucket, name, kind, generation in zip(part["bucket"], part["name"], part["kind"], part["generation"]):
                if kind == "event":
                    newest[bucket, name] = max(int(generation), newest.get((bucket, name), int(generation)))
                else:
                    told[kind].add((bucket, name))
        sent = []
        for one in {**newest, **dict.fromkeys(told["failed"]), **dict.fromkeys(told["refused"])}:
            generation, tries, due, _ = known.get(one, (None, 0, NOT_DUE, now))
            # Outcomes are of what was sent before this batch.
            if generation is not None and one in told["refused"]:
                due = NOT_DUE
            elif generation is not None and one in told["failed"] and due == NOT_DUE and tries < self.max_tries:
                due = now + self.delay_ms * 2 ** (tries - 1)
            if one in newest and (generation is None or newest[one] > generation):
                generation, tries, due = newest[one], 1, NOT_DUE
                sent.append((*one, generation, tries))
            if generation is not None:
                known[one] = generation, tries, due, now
        first = self._next(known)
        if first != old:
            if old != NOT_DUE:
                self.handle.deleteTimer(old)
            if first != NOT_DUE:
                self.handle.registerTimer(first)
        self._keep(known)
        yield self._rows(sent)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now, end = timerValues.getCurrentProcessingTimeInMs(), expiredTimerInfo.getExpiryTimeInMs()
        known, timer = self._known(now)
        sent = []
        if timer == end:
            for one, (generation, tries, due, _) in known.items():
                if NOT_DUE < due <= max(now, end):
                    known[one] = generation, tries + 1, NOT_DUE, now
                    sent.append((*one, generation, tries + 1))
            first = self._next(known)
            if first != NOT_DUE:
                self.handle.registerTimer(first)
            self._keep(known)
        yield self._rows(sent)

    @staticmethod
    def _rows(sent: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(sent, columns=["bucket", "name", "generation", "try"]).astype({"bucket": object, "name": object, "generation": "int64", "try": "int32"})

    def close(self) -> None:
        pass


def outcomes_stream(spark: SparkSession, out: str) -> DataFrame:
    """``bucket, name, kind, generation`` of the objects that stage 1 refused, as it writes them to the quarantine."""
    told = spark.readStream.schema(QUARANTINE).parquet(quarantine_dir(out)).filter(F.col("stage").isin("fetch", "metadata", "decode"))
    body = F.try_parse_json("body")
    kind = F.when(F.col("status") == "transient", "failed").otherwise("refused")
    return told.select(json_field(body, "bucket").alias("bucket"), json_field(body, "name").alias("name"), kind.alias("kind"), F.lit(None).cast("bigint").alias("generation"))


def deliveries(rows: DataFrame, delay_s: float = 60, max_tries: int = MAX_TRIES, keep_days: float = 30) -> DataFrame:
    """``bucket, name, generation, try`` of what is to be sent, for a stream of ``bucket, name, kind, generation``."""
    known = rows.filter(F.col("bucket").isNotNull() & F.col("name").isNotNull())
    # Without nulls, so that pandas keeps all digits of a generation.
    numbered = known.withColumns({"generation": F.coalesce("generation", F.lit(0)), "shard": F.pmod(F.xxhash64("bucket", "name"), F.lit(SHARDS)).cast("int")})
    processor = Deliveries(int(delay_s * 1000), max_tries, int(keep_days * DAY_MS))
    return numbered.groupBy("shard").transformWithStateInPandas(processor, SENT, "append", "processingTime")


def run_delivery_stream(
    spark: SparkSession, events: DataFrame, out: str, events_dir: str, checkpoint: str, delay_s: float = 60, max_tries: int = MAX_TRIES, keep_days: float = 30,
    trigger: dict | None = None, log: str | None = None, partitions: int | None = None,
) -> StreamingQuery:
    """Events (``bucket, name, generation``) and the failures of stage 1 below ``out`` to envelopes in ``events_dir``.

    Stage 1 reads that folder. A batch that is replayed replaces its envelopes. With ``log``, what was sent is also
    written there, with its generation and try. The state keeps the number of ``partitions`` (as the session's shuffles,
    unless given) that the query first started with. The query goes on until it is stopped, and looks at its timers at every
    trigger; ``availableNow`` would not end either while there is state.
    """
    quarantined = outcomes_stream(spark, out)
    rows = events.select("bucket", "name", F.lit("event").alias("kind"), F.col("generation").cast("bigint").alias("generation")).unionByName(quarantined)

    def batch(sent: DataFrame, batch_id: int) -> None:
        held = sent.persist()
        to_envelopes(held.select("bucket", "name")).write.mode("overwrite").json(f"{events_dir}/delivery-{batch_id}")
        if log:
            held.write.mode("overwrite").parquet(f"{log}/batch={batch_id}")
        held.unpersist()

    settings = {PROVIDER: ROCKSDB} | ({PARTITIONS: str(partitions)} if partitions else {})
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        return _start(deliveries(rows, delay_s, max_tries, keep_days), batch, checkpoint, trigger or TRIGGER)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def read_all(query: StreamingQuery, seconds: float = 600) -> None:
    """Wait until a trigger that began after this call has found nothing new to read."""
    since, end = datetime.now(timezone.utc), time.monotonic() + seconds
    while time.monotonic() < end:
        if query.exception():
            raise query.exception()
        last = query.lastProgress
        if last and last["numInputRows"] == 0 and datetime.fromisoformat(last["timestamp"]) > since:
            return
        time.sleep(0.1)
    raise TimeoutError(f"the stream has not read everything in {seconds} seconds")
