"""Both stages with available-now triggers and fresh checkpoints."""

import pandas as pd

from folioflow.operators.plugins import per_page
from folioflow.operators.store import latest_per_key
from folioflow.sources.events import emit_backfill_events
from folioflow.sources.files import list_files, watch_files
from folioflow.sources.records import read_page_keys, read_page_records, read_store
from folioflow.streaming import pipeline as sp


def files_of(spark):
    return spark.createDataFrame(
        [("b", "a.pdf", "One. x\fTwo. y\fThree."), ("b", "s.xlsx", "r1\nr2"), ("b", "t.txt", "no"), ("b", "e.pdf", "")],
        "bucket string, name string, text string",
    )


class Run:
    def __init__(self, spark, base):
        self.spark, self.base, self.out, self.store = spark, base, f"{base}/out", f"{base}/store"

    def stage1(self, load, **options):
        sp.run_parse_stream(self.spark, f"{self.base}/events", load, self.out, f"{self.base}/cp1", **options).awaitTermination()

    def stage2(self, **options):
        sp.run_embed_stream(self.spark, self.out, self.store, f"{self.base}/cp2", **options).awaitTermination()

    def rows(self):
        return {(r.source_file, r.part, r.page_num) for r in read_store(self.spark, self.store).collect()}

    def refused(self):
        return sorted((r.stage, r.status) for r in self.spark.read.parquet(sp.quarantine_dir(self.out)).collect())


KEYS = {("gs://b/a.pdf", "", 1), ("gs://b/a.pdf", "", 2), ("gs://b/a.pdf", "", 3), ("gs://b/s.xlsx", "Sheet1", 1)}


def test_redelivery_gives_one_row_per_page(spark, tmp_path):
    run, files = Run(spark, str(tmp_path)), files_of(spark)
    load = sp.from_table(files)
    twice = files.unionByName(files).select("bucket", "name")
    emit_backfill_events(twice, f"{run.base}/events")
    run.stage1(load)
    run.stage2()
    assert run.rows() == KEYS
    emit_backfill_events(twice, f"{run.base}/events")
    run.stage1(load)
    run.stage2()
    assert run.rows() == KEYS and read_store(spark, run.store).count() == len(KEYS)
    assert set(run.refused()) == {("event", "unsupported"), ("store", "no_summary")}


def test_backfill_and_reprocess(spark, tmp_path):
    run, files = Run(spark, str(tmp_path)), files_of(spark)
    args = (spark, files, f"{run.base}/events")

    def model(word):
        return per_page(lambda text, image: f'{{"summary": "{word}"}}', "metadata_raw")

    def send(word, reprocess):
        sp.backfill(*args, sp.from_table(files), run.out, f"{run.base}/cp1", reprocess=reprocess, metadata_fn=model(word)).awaitTermination()
        run.stage2()
        latest = latest_per_key(read_store(spark, run.store))
        return {summary_of(r.metadata) for r in latest.collect()}, read_store(spark, run.store).count()

    def summary_of(raw):
        import json

        return json.loads(raw)["summary"]

    assert send("old", False) == ({"old"}, 5)
    assert send("newer", False) == ({"old"}, 5)
    assert send("new", True) == ({"new"}, 10)


def test_partly_done_file_is_completed(spark, tmp_path):
    """A stage that stopped after page 1 goes on with the other pages."""
    run, files = Run(spark, str(tmp_path)), files_of(spark)
    only_first = spark.createDataFrame([("b", "a.pdf", "One. x")], "bucket string, name string, text string")
    emit_backfill_events(only_first.select("bucket", "name"), f"{run.base}/events")
    run.stage1(sp.from_table(only_first))
    assert read_page_keys(spark, sp.keys_dir(run.out)).count() == 1
    emit_backfill_events(files.select("bucket", "name"), f"{run.base}/events")
    run.stage1(sp.from_table(files))
    run.stage2()
    assert run.rows() == KEYS and read_store(spark, run.store).count() == len(KEYS)


def test_bad_events_failing_pages_and_lost_objects(spark, tmp_path):
    run, files = Run(spark, str(tmp_path)), files_of(spark)
    (tmp_path / "events").mkdir()
    (tmp_path / "events" / "bad.json").write_text('{"message":{"data":"!!!"}}\n{"other":1}\n{"message":{}}\n')
    lost = spark.createDataFrame([("b", "gone.pdf")], "bucket string, name string")
    emit_backfill_events(files.select("bucket", "name").unionByName(lost), f"{run.base}/events")

    def call(text, image):
        if text.startswith("Two"):
            raise TimeoutError("slow")
        return f'{{"summary": "s{len(text)}"}}'

    run.stage1(sp.from_table(files), metadata_fn=per_page(call, "metadata_raw"))
    assert run.refused() == sorted([("event", "bad_request")] * 3 + [("event", "unsupported"), ("fetch", "transient"), ("metadata", "permanent")])
    keys = {(r.source_file, r.page_num) for r in read_page_keys(spark, sp.keys_dir(run.out)).collect()}
    assert ("gs://b/a.pdf", 2) not in keys and ("gs://b/a.pdf", 3) in keys


def test_deduplicated_stream_keeps_bad_events(spark, tmp_path):
    run, files = Run(spark, str(tmp_path)), files_of(spark)
    (tmp_path / "events").mkdir()
    (tmp_path / "events" / "bad.json").write_text('{"message":{"data":"!!!"}}\n{"message":{"data":"!!!"}}\n')
    emit_backfill_events(files.unionByName(files).select("bucket", "name"), f"{run.base}/events")
    run.stage1(sp.from_table(files), dedupe_delay="1 hour")
    assert [s for s in run.refused() if s[1] == "bad_request"] == [("event", "bad_request")] * 2
    assert read_page_records(spark, sp.records_dir(run.out)).count() == 5


def test_vector_contract_in_stage_two(spark, tmp_path):
    run, files = Run(spark, str(tmp_path)), files_of(spark)
    emit_backfill_events(files.select("bucket", "name"), f"{run.base}/events")
    run.stage1(sp.from_table(files))

    def model(batches):
        for batch in batches:
            yield pd.DataFrame({"text_embedding": [[0.0] * (768 if s == "One" else 3) for s in batch["summary"]]})

    run.stage2(text_fn=model)
    assert run.rows() == {("gs://b/a.pdf", "", 1)}
    assert [s for _, s in run.refused() if s == "bad_text_embedding"] == ["bad_text_embedding"] * 3


def test_objects_from_a_folder(spark, tmp_path):
    root = tmp_path / "objects"
    (root / "d").mkdir(parents=True)
    (root / "d" / "a.pdf").write_text("One.\fTwo.")
    (root / "i.png").write_bytes(b"\x89PNG\xff\x00")
    run = Run(spark, str(tmp_path))
    assert list_files(spark, str(root), bucket="b").count() == 2
    image_model = per_page(lambda text, image: '{"summary": "img"}' if image is not None else '{"summary": "txt"}', "metadata_raw")
    load, watched = sp.from_folder(spark, str(root)), watch_files(spark, str(root), "b")
    sp.run_parse_stream(spark, watched, load, run.out, f"{run.base}/cp1", metadata_fn=image_model).awaitTermination()
    run.stage2()
    got = {r.source_file + str(r.page_num): r for r in read_store(spark, run.store).collect()}
    assert sorted(got) == ["gs://b/d/a.pdf1", "gs://b/d/a.pdf2", "gs://b/i.png0"]
    assert len(got["gs://b/i.png0"].multimodal_embedding) == 1408 and got["gs://b/d/a.pdf1"].multimodal_embedding is None


def test_failures_of_models_are_retried(spark, tmp_path):
    """Unusable answers and models out of service leave nothing in the ledger or the store; a retry does them."""
    run, files = Run(spark, str(tmp_path)), files_of(spark)
    load, events = sp.from_table(files), f"{run.base}/events"

    def metadata(answer):
        return per_page(lambda text, image: answer, "metadata_raw")

    def vectors(works):
        def model(batches):
            for batch in batches:
                if not works:
                    raise type("ServiceUnavailable", (Exception,), {})("later")
                yield pd.DataFrame({"text_embedding": [[0.0] * 768] * len(batch)})

        return model

    emit_backfill_events(files.select("bucket", "name"), events)
    run.stage1(load, metadata_fn=metadata('{"summary": '))
    assert read_page_keys(spark, sp.keys_dir(run.out)).count() == 0
    assert run.refused().count(("metadata", "transient")) == 5
    assert {r.name for r in sp.retry(spark, run.out, events).collect()} == {"a.pdf", "s.xlsx", "e.pdf"}
    run.stage1(load, metadata_fn=metadata('{"summary": "s"}'))
    run.stage2(text_fn=vectors(False))
    assert run.rows() == set() and run.refused().count(("store", "transient")) == 5
    sp.retry_vectors(spark, run.out, run.store, text_fn=vectors(True))
    assert run.rows() == KEYS | {("gs://b/e.pdf", "", 1)}
    sp.retry_vectors(spark, run.out, run.store, text_fn=vectors(True))
    assert read_store(spark, run.store).count() == 5 and sp.retry(spark, run.out, events).count() == 0


def test_finished_files_are_not_opened_again(spark, tmp_path):
    root = tmp_path / "objects"
    root.mkdir()
    (root / "_a[1].pdf").write_text("One.\fTwo.")
    (root / ".x.pdf").write_bytes(b"%PDF\xff\xfe")
    run = Run(spark, str(tmp_path))
    files = list_files(spark, str(root), bucket="b")
    assert {r.name for r in files.collect()} == {"_a[1].pdf", ".x.pdf"}
    opened = []

    def load(events):
        opened.append({r.name for r in events.collect()})
        return sp.from_folder(spark, str(root))(events)

    for _ in range(2):
        sp.backfill(spark, files, f"{run.base}/events", load, run.out, f"{run.base}/cp1").awaitTermination()
    assert opened == [{"_a[1].pdf", ".x.pdf"}, {".x.pdf"}]
    assert read_page_records(spark, sp.records_dir(run.out)).count() == 2
    assert set(run.refused()) == {("decode", "undecoded")}


def test_a_replayed_batch_replaces_its_rows(spark, tmp_path):
    run, files = Run(spark, str(tmp_path)), files_of(spark)
    emit_backfill_events(files.select("bucket", "name"), f"{run.base}/events")
    run.stage1(sp.from_table(files))
    records = read_page_records(spark, sp.records_dir(run.out))
    for _ in range(2):
        sp.embed_records(records, run.store, run.out, 0, None, None, False, None, load="q-0")
    assert read_store(spark, run.store).count() == len(KEYS)
