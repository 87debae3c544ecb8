"""Events, chunks, metadata, plug-ins, store and evaluation on inline rows."""

import json
from base64 import b64encode

import pandas as pd
import pytest
from pyspark.sql import functions as F

from folioflow.operators import chunks as oc, embed as oe, evaluate as ov, events as ev, metadata as om, store as st
from folioflow.operators.plugins import apply_plugin, per_page
from folioflow.operators.ranking import number_rows
from folioflow.operators.skew import attach_by_key
from folioflow.plans.ingest import build_chunks, embed_pages, to_page_records
from folioflow.sources import files as sf, records as sr


def b64(text):
    return b64encode(text.encode()).decode()


def test_decode_events(spark):
    data = [
        b64('{"bucket":"b","name":"n"}'), "!!!", b64('{"bucket":"b"}'), b64('{"bucket":"","name":"n"}'),
        b64('{"bucket":"b","name":"n"} tail'), b64encode(b"\xff").decode(), None, b64("[1]"), b64('{"bucket":"b","name":null}'),
    ]
    rows = [(i, {"data": d}) for i, d in enumerate(data)] + [(len(data), None)]
    df = spark.createDataFrame(rows, "i int, message struct<data:string>")
    got = [r.status for r in ev.decode_events(df).orderBy("i").collect()]
    assert got == ["ok"] + ["bad_request"] * 9


def test_error_classes(column):
    errors = [None, "ServiceUnavailable: x", "api.ResourceExhausted", "DatabaseError: a: b", "ValueError: ServiceUnavailable", "PermissionDenied"]
    assert column(ev.classify_error, errors) == ["ok", "transient", "transient", "transient", "permanent", "permanent"]
    assert column(lambda e: ev.classify_error(e, "retry_all"), errors[3:]) == ["transient"] * 3
    assert column(lambda e: ev.classify_error(e, "ack_all"), errors[:2]) == ["ok", "permanent"]
    assert column(ev.answer_code, ["ok", "bad_request", "transient", "permanent", "other"]) == [204, 400, 503, 200, None]


def test_explode_pages(spark):
    df = spark.createDataFrame([(1, " a \f\f b\f"), (2, "one")], "id int, text string")
    got = [(r.id, r.page_num, r.page_text) for r in oc.explode_pages(df).orderBy("id", "page_num").collect()]
    assert got == [(1, 1, "a"), (1, 2, ""), (1, 3, "b"), (1, 4, ""), (2, 1, "one")]


@pytest.mark.parametrize("rows,labels", [(0, []), (20, ["rows 1-20"]), (21, ["rows 1-20", "rows 21-40"])])
def test_row_block_labels(spark, rows, labels):
    df = spark.range(rows).select(F.lit("s").alias("sheet"), "id")
    assert [r.label for r in oc.row_blocks(df, "sheet", ["id"], ["id"]).orderBy("block").collect()] == labels


def test_nulls_render_empty_and_blank_blocks_go(spark):
    df = spark.createDataFrame([("s", 1, None), ("s", 2, "x"), ("t", 1, None)], "sheet string, n int, v string")
    blocks = oc.row_blocks(df, "sheet", ["n"], ["v"])
    assert {r.sheet: r.text for r in blocks.collect()} == {"s": "\nx", "t": ""}
    assert [r.sheet for r in oc.drop_blank_blocks(blocks).collect()] == ["s"]


def test_number_rows_with_a_hot_group(spark):
    """One group with most rows: slices and plain window agree."""
    df = spark.range(5000).select(F.when(F.col("id") % 10 < 7, "hot").otherwise(F.concat(F.lit("g"), (F.col("id") % 10).cast("string"))).alias("g"), F.xxhash64("id").alias("o"))
    plain = number_rows(df, ["g"], ["o"])
    sliced = number_rows(df, ["g"], ["o"], slices=17)
    assert plain.exceptAll(sliced).count() == 0 and sliced.count() == 5000


def test_number_rows_with_one_order_value(spark):
    df = spark.range(2000).select(F.lit("g").alias("g"), F.lit(1).alias("o"))
    rows = [r.row for r in number_rows(df, ["g"], ["o"], slices=20).collect()]
    assert sorted(rows) == list(range(1, 2001))


def test_attach_by_key_with_a_hot_key(spark):
    rows = spark.range(3000).select(F.when(F.col("id") < 1000, -1).otherwise(F.col("id") % 500).alias("k"), "id")
    stats = rows.groupBy("k").agg(F.count("*").alias("n")).filter("k <> 7")
    got = attach_by_key(rows, stats, "k", "n", F.col("id"))
    want = rows.join(stats, "k", "left").select("k", "id", "n")
    assert got.columns == want.columns and got.exceptAll(want).count() == 0 and got.count() == 3000


def test_batches_are_bounded_and_ordered(spark):
    df = spark.range(1, 12).select(F.lit("f").alias("source_file"), F.col("id").cast("int").alias("page_num"), F.col("id").cast("string").alias("t"))
    got = oc.batch_by_file(df, ["source_file"], size=5).orderBy("batch").collect()
    assert [[p.page_num for p in r.pages] for r in got] == [[1, 2, 3, 4, 5], [6, 7, 8, 9, 10], [11]]


def test_default_metadata(spark):
    text = "  . First sentence! Mail a.b@c.org or 10.0.0.1 on 2024-01-02, $1,200.50 https://x.io/p?q=1 invoice invoice invoice"
    df = spark.createDataFrame([("f", "", 1, text), ("f", "", 2, "")], "source_file string, part string, page_num int, page_text string")
    first, empty = [r.metadata for r in om.extract_metadata(df).orderBy("page_num").collect()]
    assert first.summary == "First sentence"
    assert set(first.extracted_entities) == {"a.b@c.org", "10.0.0.1", "2024-01-02", "$1,200.50", "https://x.io/p?q=1"}
    # Words of any length count.
    assert first.keywords[:2] == ["1", "invoice"] and len(first.keywords) <= 5
    assert empty.summary == "" and empty.keywords == []


def test_metadata_shapes(column):
    raws = ['{"summary":"s","extracted_entities":{"who":"A"},"keywords":"k"}', '{"summary":"s","extracted_entities":["x"]}', '{"summary":""}', "no"]
    got = column(om.metadata_from_text, raws)
    assert (got[0].extracted_entities, got[0].keywords) == (["A"], ["k"])
    assert got[1].extracted_entities == ["x"] and got[1].keywords is None
    assert got[2] is None and got[3] is None


def test_one_failing_page_does_not_stop_the_rest(spark):
    def call(text, image):
        if image is not None:
            return json.dumps({"summary": f"image of {len(image)} bytes"})
        if text == "bad":
            raise ValueError("broken")
        return f'Sure: {{"summary": "{text}"}}'

    df = spark.createDataFrame(
        [("f", "", 1, "", None), ("f", "", 2, "bad", None), ("f", "", 3, "x", bytearray(b"123"))],
        "source_file string, part string, page_num int, page_text string, image binary",
    )
    got = om.extract_metadata(df, per_page(call, "metadata_raw"), batch_rows=2).orderBy("page_num").collect()
    assert [r.metadata.summary if r.metadata else None for r in got] == ["(No text content found on this page)", None, "image of 3 bytes"]
    assert [r.error for r in got] == [None, "ValueError: broken", None]
    assert [r.page_text for r in got] == ["", "bad", "x"]


def test_plugin_with_wrong_row_count_fails(spark):
    def half(batches):
        for batch in batches:
            yield pd.DataFrame({"out": ["x"]})

    with pytest.raises(Exception, match="gave 1 rows"):
        apply_plugin(spark.range(3).repartition(1), half, ["id"], "out string").collect()


def test_text_plugin_and_default_embedding(spark):
    def model(batches):
        for batch in batches:
            yield pd.DataFrame({"text_embedding": [[float(len(t)), 1.0] for t in batch["summary"]]})

    df = spark.createDataFrame([("ab",), ("abc",)], "summary string")
    assert [r.text_embedding for r in oe.embed_text(df, model, batch_rows=1).orderBy("summary").collect()] == [[2.0, 1.0], [3.0, 1.0]]
    texts = spark.createDataFrame([("same words",), ("words same",), ("",), (None,)], "summary string")
    a, b, empty, null = [r.text_embedding for r in oe.embed_text(texts).collect()]
    assert a == b and abs(sum(x * x for x in a) - 1) < 1e-5 and len(a) == 768
    assert set(empty) == {0.0} and null is None


def test_binary_and_multimodal_embedding(spark):
    df = spark.createDataFrame([(bytearray(b"abcabc"), "t"), (None, "t"), (bytearray(b"abcabc"), None), (None, None)], "image binary, page_text string")
    alone = [r.multimodal_embedding for r in oe.embed_binary(df).collect()]
    both = [r.multimodal_embedding for r in oe.embed_multimodal(df).collect()]
    assert alone[1] is None and len(alone[0]) == 1408 and alone[0] == alone[2]
    assert both[3] is None and both[0] != both[2] and both[1] is not None
    assert [round(x, 4) for x in both[2]] == [round(x, 4) for x in alone[0]]


def test_skip_by_prefix_and_by_key(spark):
    done = spark.createDataFrame([("gs://b/a-page-1.pdf", "", 1, "a-page-1-page-1.json")], "source_file string, part string, page_num int, object_name string")
    files = spark.createDataFrame([("a.pdf",), ("b.pdf",), ("a-page-1.pdf",)], "name string")
    assert sorted(r.name for r in st.skip_done(files, done, "prefix").collect()) == ["b.pdf"]
    pages = spark.createDataFrame([("gs://b/a.pdf", "", 1), ("gs://b/b.pdf", "", 1), ("gs://b/a-page-1.pdf", "", 1), ("gs://b/a-page-1.pdf", "", 2)], "source_file string, part string, page_num int")
    got = sorted((r.source_file, r.page_num) for r in st.skip_done(pages, done, "page").collect())
    assert got == [("gs://b/a-page-1.pdf", 2), ("gs://b/a.pdf", 1), ("gs://b/b.pdf", 1)]


def test_prefix_skip_equals_startswith(spark):
    names = ["-page-page-1.json", "-page-1.json", "x-page-y-page-2.json", "plain.json", "é-page-3.json"]
    files = ["", ".pdf", "x", "x-page-y.pdf", "é.pdf", "-page", "plain", "y"]
    done = spark.createDataFrame([(n,) for n in names], "object_name string")
    todo = spark.createDataFrame([(f,) for f in files], "name string")
    want = [f for f in files if not any(n.startswith(f.replace(".pdf", "") + "-page-") for n in names)]
    assert sorted(r.name for r in st.skip_done(todo, done, "prefix").collect()) == sorted(want)


def test_store_contracts(spark):
    rows = [("s", [1.0, 2.0]), (None, [1.0, 2.0]), ("x" * 1025, [1.0, 2.0]), ("s", [1.0]), ("s", [1.0, float("nan")]), ("s", None), ("x" * 1024, [1.0, 2.0])]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, source_file string, text_embedding array<float>")
    got = [r.status for r in st.check_store_row(df, 2).orderBy("i").collect()]
    assert got == ["ok", "no_source", "source_too_long", "bad_text_embedding", "bad_text_embedding", "ok", "ok"]


def test_latest_per_key_with_a_hot_key(spark):
    df = spark.range(1000).select(F.when(F.col("id") < 700, "hot").otherwise(F.col("id").cast("string")).alias("k"), F.col("id").alias("batch_id"))
    got = {r.k: r.batch_id for r in st.latest_per_key(df, ["k"], ["batch_id"]).collect()}
    assert got["hot"] == 699 and len(got) == 301


def test_judge_plugin_checks_scores(spark):
    raws = ['{"score":1,"reason":"a"}', '{"score":5,"reason":"b"}', '{"score":0}', '{"score":6}', '{"score":"x"}', '{"score":4} extra', '{"score":4.5}', "{}"]

    def model(batches):
        for batch in batches:
            yield pd.DataFrame({"grade_raw": list(batch["answer"])})

    df = spark.createDataFrame([(i, "q", "g", raw) for i, raw in enumerate(raws)], "i int, question string, golden_answer string, answer string")
    got = ov.judge(df, model).orderBy("i").collect()
    assert [r.status for r in got] == ["ok", "ok"] + ["bad_score"] * 6
    assert [(r.score, r.reason) for r in got[:2]] == [(1, "a"), (5, "b")]


def test_default_judge(spark):
    df = spark.createDataFrame([("q", "a b c d", "a b c d"), ("q", "a b", "c d"), ("q", "a b", None), ("q", "a b c", "a x")], "question string, golden_answer string, answer string")
    assert [r.score for r in ov.judge(df).collect()] == [5, 1, 1, 3]


def test_answer_plugin_gets_the_context(spark):
    def model(batches):
        for batch in batches:
            yield pd.DataFrame({"answer": batch["question"] + "|" + batch["context"]})

    df = spark.createDataFrame([("1", "why", "because")], "question_id string, question string, context string")
    assert ov.answer(df, fn=model).first().answer == "why|because"


def test_chunks_of_all_routes(spark):
    files = spark.createDataFrame(
        [("b", "d/a.pdf", "one\ftwo", None), ("b", "i.PNG", "", bytearray(b"xy")), ("b", "s.xlsx", "\n".join(map(str, range(25))), None), ("b", "t.txt", "no", None)],
        "bucket string, name string, text string, content binary",
    )
    got = {(r.name, r.part, r.page_num): r for r in build_chunks(files).collect()}
    assert sorted(got) == [("d/a.pdf", "", 1), ("d/a.pdf", "", 2), ("i.PNG", "", 0), ("s.xlsx", "Sheet1", 1), ("s.xlsx", "Sheet1", 2)]
    assert bytes(got["i.PNG", "", 0].image) == b"xy"
    assert got["s.xlsx", "Sheet1", 2].chunk_description == "Content from sheet 'Sheet1', rows 21-40 in file s.xlsx"
    assert got["d/a.pdf", "", 2].object_name == "d/a-page-2.json" and got["d/a.pdf", "", 2].page_text == "two"
    records = to_page_records(om.extract_metadata(build_chunks(files)))
    rows = {r.source_file + str(r.page_num): r for r in embed_pages(records).collect()}
    assert rows["gs://b/i.PNG0"].status == "no_summary" and rows["gs://b/d/a.pdf1"].status == "ok"
    assert len(rows["gs://b/d/a.pdf1"].text_embedding) == 768


def test_list_and_read_files(spark, tmp_path):
    for name in ("pdfs/a.pdf", "pdfs/sub/b.PDF", "pdfs-old/c.pdf", "other/d.txt"):
        target = tmp_path / name
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_text(name)
    names = lambda df: sorted(r.name for r in df.collect())
    assert names(sf.list_files(spark, str(tmp_path))) == ["other/d.txt", "pdfs-old/c.pdf", "pdfs/a.pdf", "pdfs/sub/b.PDF"]
    assert names(sf.list_files(spark, str(tmp_path), "pdfs/")) == ["pdfs/a.pdf", "pdfs/sub/b.PDF"]
    assert names(sf.list_files(spark, str(tmp_path), "pdfs")) == ["pdfs-old/c.pdf", "pdfs/a.pdf", "pdfs/sub/b.PDF"]
    assert names(sf.list_files(spark, str(tmp_path), "none/")) == []
    assert {r.name: bytes(r.content).decode() for r in sf.read_binary(spark, str(tmp_path)).collect()}["pdfs/a.pdf"] == "pdfs/a.pdf"


def test_corrupt_page_records_keep_their_text(spark, tmp_path):
    (tmp_path / "p.json").write_text('{"source_file":"s","page_num":1,"metadata":{"summary":"x","other":1}}\nnot json\n')
    got = sr.read_page_records(spark, str(tmp_path)).collect()
    assert {(r.source_file, r._corrupt_record) for r in got} == {("s", None), (None, "not json")}
