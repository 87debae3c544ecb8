"""Two chained streaming queries with their own checkpoints, and the backfill into the first.

Delivery is at least once. What makes a repeat harmless is the chunk key: stage 1 skips pages
whose key is in the ledger, and readers of the store see the newest row per key.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from hashlib import md5

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from folioflow.operators.events import classify_error, decode_events, dedupe_events, route_files, split_status
from folioflow.functions.json import json_field
from folioflow.functions.text import route, source_uri
from folioflow.operators.metadata import drop_failed, extract_metadata
from folioflow.operators.plugins import Plugin
from folioflow.operators.store import chunk_id, skip_done
from folioflow.plans.ingest import build_chunks, embed_pages, to_page_records
from folioflow.schemas import PAGE_RECORD
from folioflow.session import checkpoint_root
from folioflow.sources.events import emit_backfill_events, read_events_stream
from folioflow.sources.files import read_objects
from folioflow.sources.records import (
    CORRUPT,
    append_quarantine,
    read_done_files,
    read_page_keys,
    read_page_records,
    read_quarantine,
    read_store,
    refused_rows,
    upsert_store,
    write_done_files,
    write_page_keys,
    write_page_records,
    write_quarantine,
)

AVAILABLE_NOW = {"availableNow": True}
# Tries of an object or page, the first one included, before a transient failure is left alone.
MAX_TRIES = 5
# Events of a batch that are broadcast to the table of objects.
SHARED_EVENTS = 500_000
# Files of the table of objects that a batch names to open no others.
NAMED_FILES = 1000

# Gets events (bucket, name, ...) and returns those whose object exists, with text and content.
Loader = Callable[[DataFrame], DataFrame]


def records_dir(out: str) -> str:
    return f"{out}/records"


def keys_dir(out: str) -> str:
    return f"{out}/keys"


def files_dir(out: str) -> str:
    return f"{out}/files"


def quarantine_dir(out: str) -> str:
    return f"{out}/quarantine"


def from_table(files: DataFrame) -> Loader:
    """Objects that live in a table ``bucket, name, text`` (and ``content``).

    An inner join. A batch of up to SHARED_EVENTS events is broadcast, so that it does not shuffle the whole table; of a
    table of files, only those are opened in which its objects lie. These may be few, so what is found is spread over the
    cores.
    """

    def load(events: DataFrame) -> DataFrame:
        if events.limit(SHARED_EVENTS + 1).count() > SHARED_EVENTS:
            return files.join(events, ["bucket", "name"])
        found = _in_files(files, events).join(F.broadcast(events), ["bucket", "name"])
        return found.repartition(files.sparkSession.sparkContext.defaultParallelism, "bucket", "name")

    return load


def _in_files(files: DataFrame, events: DataFrame) -> DataFrame:
    """The rows of the stored files in which the objects of ``events`` lie; all rows of a table that is not read from files,
    or if there are more than NAMED_FILES of them. The search reads the names alone."""
    keys, path = ["bucket", "name"], F.col("_metadata.file_path")
    try:
        lying = files.select(*keys, path.alias("_path"))
    except AnalysisException:
        return files
    found = lying.join(F.broadcast(events), keys, "left_semi").select("_path").distinct().limit(NAMED_FILES + 1).collect()
    paths = [row._path for row in found]
    return files if len(paths) > NAMED_FILES or None in paths else files.filter(path.isin(paths))


def from_folder(spark: SparkSession, root: str) -> Loader:
    """Objects in a folder, opened by name inside the tasks; nothing is listed.

    Content that is no UTF-8 text, as that of a codec, gives a null text.
    """
    return lambda events: read_objects(events, root).withColumn("text", F.try_validate_utf8(F.col("content").cast("string")))


def settle(df: DataFrame) -> DataFrame:
    """The rows written to the checkpoint folder, to be read from there."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint()


def parse_events(
    events: DataFrame, load: Loader, out: str, metadata_fn: Plugin | None, page_lines: int | None, reprocess: bool,
    policy: str = "by_type", word_stats: DataFrame | None = None, skip_files: bool = False,
) -> None:
    """One batch of decoded events: refuse, skip, open, split, describe, write.

    Every object ends in one place: its pages are written, or it is refused, or it is done
    already. With ``skip_files``, finished files are not even opened. A model's answers are
    checkpointed, not cached: they are asked for once and outlive the executor that got them.
    The default columns, which can be computed again, are cached.
    """
    spark = events.sparkSession
    held: list[DataFrame] = []
    quarantine = quarantine_dir(out)

    def hold(df: DataFrame) -> DataFrame:
        held.append(df.persist())
        return held[-1]

    try:
        good, refused = split_status(hold(route_files(events)))
        good = good.select("bucket", "name").distinct().withColumn("source_file", source_uri(F.col("bucket"), F.col("name")))
        if skip_files and not reprocess:
            good = good.join(read_done_files(spark, files_dir(out), good), "source_file", "left_anti")
        good = hold(good.select("bucket", "name"))
        files = hold(load(good))
        lost = good.join(files.select("bucket", "name"), ["bucket", "name"], "left_anti")
        not_found = {"status": F.lit("transient"), "error": F.lit("NotFound: no such object")}
        # Pages and sheets are made from text; bytes of a codec wait for one.
        unread = F.col("text").isNull() & route(F.col("name")).isin("pdf", "sheet")
        why = {"status": F.lit("undecoded"), "error": F.lit("Undecoded: the content is no text")}
        kept_out = [(refused, "event"), (lost.withColumns(not_found), "fetch"), (files.filter(unread).select("bucket", "name").withColumns(why), "decode")]
        append_quarantine(reduce(DataFrame.unionByName, [refused_rows(*some) for some in kept_out]), quarantine)
        files = files.filter(~unread)

        todo = build_chunks(files, page_lines)
        if not reprocess:
            named = good.select(source_uri(F.col("bucket"), F.col("name")).alias("source_file"))
            todo = skip_done(todo, read_page_keys(spark, keys_dir(out), named), "page")
        if metadata_fn is None:
            # The default metadata reads the pages more than once.
            todo = hold(todo)
            if word_stats is None:
                # Without a corpus a keyword's weight is its count: that needs no other page.
                word_stats = spark.createDataFrame([], "word string, df bigint, total bigint")
        described = extract_metadata(todo, metadata_fn, stats=word_stats)
        described = hold(described) if metadata_fn is None else settle(described)
        finished = files.select(source_uri(F.col("bucket"), F.col("name")).alias("source_file"))
        if "error" in described.columns:
            failed = described.filter(F.col("error").isNotNull()).withColumn("status", classify_error(F.col("error"), policy))
            write_quarantine(failed.drop("image"), quarantine, "metadata")
            finished = finished.join(failed.select("source_file"), "source_file", "left_anti")
            described = drop_failed(described)
        write_page_records(to_page_records(described), records_dir(out))
        # After the records: a crash in between repeats pages, it never loses one.
        write_page_keys(described, keys_dir(out))
        write_done_files(finished.distinct(), files_dir(out))
    finally:
        for df in held:
            df.unpersist()


def run_parse_stream(
    spark: SparkSession,
    events: str | DataFrame,
    load: Loader,
    out: str,
    checkpoint: str,
    metadata_fn: Plugin | None = None,
    page_lines: int | None = None,
    reprocess: bool = False,
    dedupe_delay: str | None = None,
    max_files: int | None = None,
    trigger: dict | None = None,
    policy: str = "by_type",
    word_stats: DataFrame | None = None,
    skip_files: bool = False,
) -> StreamingQuery:
    """Stage 1: events to page records below ``out``.

    Events come from a folder of envelopes, or as a stream of ``bucket, name, event_time`` such
    as :func:`folioflow.sources.files.watch_files` gives. ``dedupe_delay`` also drops
    redeliveries of one object inside that time, before any work; it does so for a new upload
    under the same name, too. The time is that of the arrival here, so no event comes too late.
    ``word_stats`` (:func:`folioflow.operators.metadata.word_stats`) weighs the default keywords;
    ``policy`` says which failures :func:`retry` sends again. ``skip_files`` leaves files alone
    of which every page is done; an event for a changed object needs it off.
    """
    if isinstance(events, DataFrame):
        decoded = events.select("event_time", "bucket", "name", F.lit("ok").alias("status"))
    else:
        decoded = decode_events(read_events_stream(spark, events, max_files))
        decoded = decoded.select("event_time", F.col("message.data").alias("data"), "bucket", "name", "status")
    if dedupe_delay:
        good, bad = split_status(decoded)
        decoded = dedupe_events(good.withColumn("event_time", F.current_timestamp()), dedupe_delay).unionByName(bad)

    def batch(rows: DataFrame, batch_id: int) -> None:
        parse_events(rows, load, out, metadata_fn, page_lines, reprocess, policy, word_stats, skip_files)

    return _start(decoded, batch, checkpoint, trigger)


def embed_records(
    records: DataFrame, store: str, out: str, batch_id: int, text_fn: Plugin | None, image_fn: Plugin | None, with_text: bool, batch_rows: int | None,
    policy: str = "by_type", load: str | None = None,
) -> None:
    """One batch of page records: vectors, contract checks, append. A ``load`` written again replaces itself."""
    broken = F.col(CORRUPT).isNotNull() | F.col("source_file").isNull() | F.col("page_num").isNull()
    cached = records.persist()
    write_quarantine(cached.filter(broken).withColumn("status", F.lit("bad_record")), quarantine_dir(out), "record")
    readable = cached.filter(~broken).drop(CORRUPT).withColumn("part", F.coalesce("part", F.lit("")))
    # Used for the store and for the quarantine; a model is asked once.
    rows = embed_pages(readable, text_fn, image_fn, with_text, batch_id=batch_id, batch_rows=batch_rows, policy=policy)
    rows = rows.persist() if text_fn is None and image_fn is None else settle(rows)
    try:
        good, refused = split_status(rows)
        upsert_store(good, store, load=load)
        write_quarantine(refused, quarantine_dir(out), "store")
    finally:
        rows.unpersist()
        cached.unpersist()


def run_embed_stream(
    spark: SparkSession,
    out: str,
    store: str,
    checkpoint: str,
    text_fn: Plugin | None = None,
    image_fn: Plugin | None = None,
    with_text: bool = False,
    batch_rows: int | None = None,
    max_files: int | None = None,
    trigger: dict | None = None,
    policy: str = "by_type",
) -> StreamingQuery:
    """Stage 2: new page records of stage 1 to store rows."""
    schema = T.StructType([*PAGE_RECORD.fields, T.StructField(CORRUPT, T.StringType())])
    reader = spark.readStream.schema(schema).option("columnNameOfCorruptRecord", CORRUPT)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))

    def batch(records: DataFrame, batch_id: int) -> None:
        stream = records.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or md5(checkpoint.encode()).hexdigest()
        embed_records(records, store, out, batch_id, text_fn, image_fn, with_text, batch_rows, policy, f"{stream}-{batch_id}")

    return _start(reader.json(records_dir(out)), batch, checkpoint, trigger)


def _start(stream: DataFrame, batch: Callable[[DataFrame, int], None], checkpoint: str, trigger: dict | None) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or AVAILABLE_NOW)).start()


def backfill(
    spark: SparkSession,
    files: DataFrame,
    events_dir: str,
    load: Loader,
    out: str,
    checkpoint: str,
    reprocess: bool = False,
    **options,
) -> StreamingQuery:
    """Send every stored object through stage 1 again.

    Finished pages are skipped unless ``reprocess`` is set; then they get new records under the
    same keys. Files of which every page is done are not opened again (``skip_files``).
    """
    options.setdefault("skip_files", True)
    emit_backfill_events(files.select("bucket", "name"), events_dir)
    return run_parse_stream(spark, events_dir, load, out, checkpoint, reprocess=reprocess, **options)


def retry(spark: SparkSession, out: str, events_dir: str, max_tries: int = MAX_TRIES) -> DataFrame:
    """Send the objects of stage 1 that failed transiently once more; returns them.

    An object is sent as long as it is not done and has been tried less than ``max_tries`` times;
    of a sent file, stage 1 does the pages that are missing.
    """
    told = read_quarantine(spark, quarantine_dir(out)).filter(F.col("stage").isin("fetch", "metadata"))
    named = told.withColumns({c: json_field(F.try_parse_json("body"), c) for c in ("bucket", "name")})
    tries = named.groupBy("bucket", "name").agg(F.countDistinct(F.when(F.col("status") == "transient", F.col("at"))).alias("tries"))
    open_ = tries.filter((F.col("tries") > 0) & (F.col("tries") < max_tries)).withColumn("source_file", source_uri(F.col("bucket"), F.col("name")))
    again = settle(open_.join(read_done_files(spark, files_dir(out)), "source_file", "left_anti").select("bucket", "name"))
    if not again.isEmpty():
        emit_backfill_events(again, events_dir)
    return again


def retry_vectors(
    spark: SparkSession, out: str, store: str, text_fn: Plugin | None = None, image_fn: Plugin | None = None, with_text: bool = False,
    batch_rows: int | None = None, max_tries: int = MAX_TRIES, policy: str = "by_type",
) -> None:
    """Ask the models of stage 2 once more for the pages that failed transiently and are not in the store."""
    told = read_quarantine(spark, quarantine_dir(out)).filter((F.col("stage") == "store") & (F.col("status") == "transient"))
    ids = told.select(json_field(F.try_parse_json("body"), "id").alias("id"), "at").groupBy("id").agg(F.countDistinct("at").alias("tries"))
    wanted = ids.filter(F.col("tries") < max_tries).join(read_store(spark, store).select("id"), "id", "left_anti")
    records = read_page_records(spark, records_dir(out)).withColumn("id", chunk_id())
    embed_records(records.join(wanted, "id", "left_semi").drop("id"), store, out, 0, text_fn, image_fn, with_text, batch_rows, policy)
