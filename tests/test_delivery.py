"""Delivery with state: redeliveries, new uploads, failures sent again by the stream itself, tries."""

import os
import time

import pandas as pd
from pyspark.sql import functions as F

from folioflow.sources.records import QUARANTINE, read_page_records, write_quarantine
from folioflow.streaming import delivery
from folioflow.streaming import pipeline as sp

EVENTS = "bucket string, name string, generation bigint"


class Feed:
    """Folders of one delivery stream, and what it sent."""

    def __init__(self, spark, folder):
        self.spark, self.folder, self.n = spark, str(folder), 0
        self.out, self.events_dir, self.log = f"{folder}/out", f"{folder}/events", f"{folder}/log"
        spark.createDataFrame([], QUARANTINE).write.parquet(sp.quarantine_dir(self.out))
        self.events()

    def events(self, *rows):
        self.n += 1
        self.spark.createDataFrame([("b", name, g) for name, g in rows], EVENTS).write.parquet(f"{self.folder}/given/{self.n}")

    def fail(self, *names, status="transient"):
        rows = self.spark.createDataFrame([("b", n, status, "e") for n in names], "bucket string, name string, status string, error string")
        write_quarantine(rows, sp.quarantine_dir(self.out), "metadata")

    def start(self, **options):
        given = self.spark.readStream.schema(EVENTS).option("recursiveFileLookup", "true").parquet(f"{self.folder}/given")
        return delivery.run_delivery_stream(self.spark, given, self.out, self.events_dir, f"{self.folder}/checkpoint", log=self.log, **options)

    def step(self, **options):
        query = self.start(trigger={"processingTime": "0 seconds"}, **options)
        try:
            delivery.read_all(query, 100)
        finally:
            query.stop()

    def sent(self):
        if not os.path.isdir(self.log):
            return []
        found = self.spark.read.schema(delivery.SENT).option("recursiveFileLookup", "true").parquet(self.log)
        return sorted((r.name, r.generation, r["try"]) for r in found.collect())


def wait_for(query, done, seconds=60):
    end = time.time() + seconds
    while time.time() < end and not done():
        assert query.exception() is None
        time.sleep(0.3)
    assert done()


def test_redelivery_and_new_upload(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    feed.events(("a", 5), ("a", 5), ("b", None))
    feed.step()
    feed.events(("a", 5), ("a", 4), ("b", None), ("c", 1))
    feed.step()
    feed.events(("a", 6), ("a", 7))
    feed.step()
    assert feed.sent() == [("a", 5, 1), ("a", 7, 1), ("b", 0, 1), ("c", 1, 1)]


def test_failures_are_sent_again_when_due(spark, tmp_path):
    """Nobody calls retry: the stream sends the object after its delay, three times in all."""
    feed = Feed(spark, tmp_path)
    feed.events(("a", 1), ("b", 1), ("c", 1))
    query = feed.start(delay_s=3, max_tries=3, trigger={"processingTime": "1 second"})
    try:
        wait_for(query, lambda: len(feed.sent()) == 3)
        feed.fail("a", "a", "b")  # two pages of one file are one failure
        feed.fail("c", status="permanent")
        failed = time.time()
        wait_for(query, lambda: ("a", 1, 2) in feed.sent() and ("b", 1, 2) in feed.sent())
        assert time.time() - failed > 2.5
        feed.fail("a")
        wait_for(query, lambda: ("a", 1, 3) in feed.sent())
        feed.fail("a")  # no fourth try
        feed.events(("d", 1))
        wait_for(query, lambda: ("d", 1, 1) in feed.sent())
        time.sleep(6)
    finally:
        query.stop()
    assert feed.sent() == [("a", 1, 1), ("a", 1, 2), ("a", 1, 3), ("b", 1, 1), ("b", 1, 2), ("c", 1, 1), ("d", 1, 1)]


def test_stage_1_behind_the_delivery(spark, tmp_path):
    """An object that is not there yet is fetched by a later delivery, without a retry."""
    feed = Feed(spark, tmp_path)
    stored = spark.createDataFrame([("b", "x.pdf", "text of x"), ("b", "y.pdf", "text of y")], "bucket string, name string, text string")

    def parse(files):
        sp.run_parse_stream(spark, feed.events_dir, sp.from_table(files), feed.out, f"{tmp_path}/parse").awaitTermination()
        return sorted(r.source_file for r in read_page_records(spark, sp.records_dir(feed.out)).collect())

    feed.events(("x.pdf", 1), ("y.pdf", 1))
    feed.step(delay_s=0)
    assert parse(stored.filter("name = 'x.pdf'")) == ["gs://b/x.pdf"]
    for _ in range(2):  # the failure is read, then its timer runs out
        feed.events(("other", feed.n))
        feed.step(delay_s=0)
    assert ("y.pdf", 1, 2) in feed.sent()
    assert parse(stored) == ["gs://b/x.pdf", "gs://b/y.pdf"]
    assert spark.read.parquet(sp.quarantine_dir(feed.out)).filter(F.col("stage") == "fetch").count() >= 1


def test_objects_of_one_shard(spark, tmp_path, monkeypatch):
    """Objects that share a state and its timer keep their own generations, to the last digit, tries and delays."""
    monkeypatch.setattr(delivery, "SHARDS", 1)
    late = 2**60 + 1
    feed = Feed(spark, tmp_path)
    feed.events(*[(f"n{i}", late) for i in range(50)], ("n50", None))
    query = feed.start(delay_s=2, max_tries=3, trigger={"processingTime": "0 seconds"}, partitions=2)
    try:
        wait_for(query, lambda: len(feed.sent()) == 51)
        feed.fail("n1")
        wait_for(query, lambda: ("n1", late, 2) in feed.sent())
        feed.fail("n1", "n2")  # one is due after four seconds, one after two
        feed.fail("n3", status="permanent")
        feed.events(("n4", late), ("n5", late + 1), ("n6", late - 1), ("n50", None))
        wait_for(query, lambda: ("n2", late, 2) in feed.sent())
        assert ("n1", late, 3) not in feed.sent()
        wait_for(query, lambda: ("n1", late, 3) in feed.sent())
    finally:
        query.stop()
    again = [("n1", late, 2), ("n1", late, 3), ("n2", late, 2), ("n5", late + 1, 1)]
    assert feed.sent() == sorted([(f"n{i}", late, 1) for i in range(50)] + [("n50", 0, 1)] + again)


def test_a_batch_calls_the_state_store_once_a_shard(spark):
    """Not once an object: that took milliseconds for each of them."""
    calls = []

    class Handle:
        def getValueState(self, *_):
            return self

        def exists(self):
            return False

        def update(self, value):
            calls.append(len(value[0]))

    class Clock:
        def getCurrentProcessingTimeInMs(self):
            return 1

    processor = delivery.Deliveries(0, 3, delivery.DAY_MS)
    processor.init(Handle())
    rows = pd.DataFrame([("b", f"n{i % 500}", "event", 1) for i in range(1000)], columns=["bucket", "name", "kind", "generation"])
    sent = pd.concat(processor.handleInputRows((0,), iter([rows]), Clock()))
    assert len(sent) == 500 and calls == [500]
