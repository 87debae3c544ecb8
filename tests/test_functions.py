"""Scalars on edge inputs; expected values are what Python's standard library gives."""

import json
from base64 import b64encode

import pytest
from pyspark.sql import functions as F

from folioflow.functions import binary, json as fj, text as ft, vectors as fv
from folioflow.functions.rounding import round_half_up


def test_file_ext(column):
    names = ["a/B.PDF", "pdf", "x.", "a.tar.gz", ""]
    assert column(ft.file_ext, names) == ["pdf", "pdf", "", "gz", ""]


def test_route(column):
    names = ["a.pdf", "a.PDF", "b.Png", "c.xls", "d.xlsx", "e.txt", "f", "pdf", "g.jpeg"]
    assert column(ft.route, names) == ["pdf", "pdf", "image", "sheet", "sheet", "unsupported", "unsupported", "pdf", "image"]


def test_py_strip(column):
    texts = ["　a ", "\x0c a\n", "​a", "\x1ca\x85", "", "   ", " a b ", " x ", "\x0bq\x1f"]
    assert column(ft.py_strip, texts) == [t.strip() for t in texts]


def test_model_text(column):
    assert column(ft.model_text, ["", "x", " "]) == ["(No text content found on this page)", "x", " "]


def test_page_names(column):
    names = ["a.pdf", "a.PDF", "d.pdf.x/a.pdf", "a"]
    assert column(ft.page_prefix, names) == ["a-page-", "a.PDF-page-", "d.x/a-page-", "a-page-"]
    assert column(lambda n: ft.page_object_name(n, F.lit(12)), names)[2] == "d.x/a-page-12.json"


def test_descriptions(column):
    assert column(lambda n: ft.page_description(F.lit(3), n), ["gs://b/d/a.pdf"]) == ["Content from page 3 of file a.pdf"]
    assert column(lambda n: ft.page_description(F.lit(3), n, full_name=True), ["d/a.pdf"]) == ["Content from page 3 of file d/a.pdf"]
    assert column(ft.image_description, ["d/a.png"]) == ["Image file: d/a.png"]
    told = column(lambda n: ft.sheet_description(F.lit("S 1"), F.lit("rows 1-20"), n), ["d/a.xlsx"])
    assert told == ["Content from sheet 'S 1', rows 1-20 in file d/a.xlsx"]


def test_block_label(column):
    first = lambda clip: column(lambda a, b: ft.block_label(a, 20, b, clip), [(0, 20), (20, 21)], "a int, b int")
    assert first(False) == ["rows 1-20", "rows 21-40"]
    assert first(True) == ["rows 1-20", "rows 21-21"]


STRICT = ['{"a":1}', '{"a":1} tail', "{'a':1}", "", " ", '{"a":1}] x', '{"a":1}} x', '{"a":1},{"b":2}', '1,"b":2', "null", "[1]", ' {"a": 1} ', '{"a":', '"x"', "7"]


def test_strict_json(column):
    def parses(raw):
        try:
            json.loads(raw)
        except ValueError:
            return False
        return True

    assert column(lambda c: fj.parse_json_strict(c).isNotNull(), STRICT) == [parses(raw) for raw in STRICT]


def test_repeated_key_takes_the_last(column):
    assert column(lambda c: fj.json_field(fj.parse_json_strict(c), "a"), ['{"a":1,"a":2}']) == ["2"]


def test_lenient_json(column):
    texts = ['x {"summary":"s"} y', '{"a":{"b":1}} {"c":2}', "no brace", "}{", "{", "}", "a } b { c", '{"k":"é"}']
    cut = []
    for t in texts:
        start, end = t.find("{"), t.rfind("}") + 1
        cut.append(None if start == -1 or end == 0 else t[start:end])
    assert column(fj.extract_json_object, texts) == cut
    assert column(lambda c: fj.json_field(fj.parse_json_lenient(c), "summary"), texts)[:2] == ["s", None]


@pytest.mark.parametrize("value", ['"s"', '""', '" "', "0", "0.0", "1", "1.5", "-2", "true", "false", "null", "[]", "[0]", "{}", '{"a":0}', '"0"'])
def test_summary_truth(column, value):
    got = column(lambda c: fj.has_summary(fj.parse_json_strict(c)), [f'{{"summary":{value}}}'])
    assert got == [bool(json.loads(value))]


def test_summary_needs_an_object(column):
    assert column(lambda c: fj.has_summary(fj.parse_json_strict(c)), ["null", "[1]", "{}", "broken"]) == [False] * 4


def test_metadata_json_keeps_unicode_and_nulls(column):
    got = column(lambda c: fj.to_metadata_json(F.struct(c.alias("summary"), F.lit(None).cast("string").alias("document_type"))), ["요약"])
    assert got == ['{"summary":"요약","document_type":null}']


def test_base64(column, spark):
    data = bytes(range(100))
    assert column(binary.b64_encode, [(data,)], "a binary") == [b64encode(data).decode()]
    spark.conf.set("spark.sql.chunkBase64String.enabled", "true")
    try:
        assert column(binary.b64_encode, [(data,)], "a binary") == [b64encode(data).decode()]
    finally:
        spark.conf.set("spark.sql.chunkBase64String.enabled", "false")
    texts = ["eyJhIjoxfQ==", "!!!", "/w==", "e\nyJ hIjoxfQ==", "abc"]
    assert column(binary.b64_decode_text, texts) == ['{"a":1}', "", None, '{"a":1}', None]


def test_vectors(column):
    back = column(lambda c: fv.vector_from_text(c, 2), ["[0.5,1E-7]", "[1]", "[1,null]", "x", "[1,2,3]"])
    assert [None if v is None else [round(x, 9) for x in v] for v in back] == [[0.5, 1e-07], None, None, None, None]
    nan = float("nan")
    vectors = [([1.0, 2.0],), ([1.0],), ([1.0, nan],), ([1.0, None],), (None,)]
    assert column(lambda c: fv.check_dim(c, 2), vectors, "a array<float>") == [True, False, False, False, False]
    assert column(fv.l2_distance, [([0.0, 3.0], [4.0, 0.0])], "a array<float>, b array<float>") == [5.0]


def test_round_half_up():
    import numpy as np

    assert round_half_up(np.array([0.125, -0.125, 2.5]), 2).tolist() == [0.13, -0.13, 2.5]


def test_truncate(column):
    assert [len(x) for x in column(ft.truncate_text, ["x" * 2000, "short"])] == [1024, 5]
