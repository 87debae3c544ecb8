"""Properties on generated text. Each example is one Spark job over a list of values."""

import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from folioflow.functions import json as fj, text as ft, vectors as fv
from folioflow.operators.chunks import row_blocks

FEW = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
TEXT = st.text(st.characters(exclude_categories=["Cs"], exclude_characters="\x00"), max_size=30)
EDGES = st.text(st.sampled_from(list(ft.PY_WHITESPACE) + ["a", ".", "​"]), max_size=12)


@FEW
@given(st.lists(st.one_of(EDGES, TEXT), min_size=20, max_size=40))
def test_strip_equals_python(column, texts):
    assert column(ft.py_strip, texts) == [t.strip() for t in texts]


@FEW
@given(st.lists(st.text(st.sampled_from("aB./pdf"), max_size=12), min_size=20, max_size=40))
def test_names_equal_python(column, names):
    assert column(ft.file_ext, names) == [n.lower().split(".")[-1] for n in names]
    assert column(ft.page_prefix, names) == [n.replace(".pdf", "") + "-page-" for n in names]
    assert column(ft.basename, names) == [n.split("/")[-1] for n in names]


def _valid(raw):
    try:
        json.loads(raw)
    except ValueError:
        return False
    return True


@FEW
@given(st.lists(st.text(st.sampled_from('{}[]",:1a '), max_size=9), min_size=30, max_size=60))
def test_strict_json_equals_python(column, texts):
    assert column(lambda c: fj.parse_json_strict(c).isNotNull(), texts) == [_valid(t) for t in texts]


@FEW
@given(st.lists(st.text(st.sampled_from('{}"a:1 é'), max_size=9), min_size=30, max_size=60))
def test_brace_cut_equals_python(column, texts):
    want = [None if "{" not in t or "}" not in t else t[t.find("{") : t.rfind("}") + 1] for t in texts]
    assert column(fj.extract_json_object, texts) == want


@FEW
@given(st.lists(st.lists(st.floats(width=32, allow_nan=False, allow_infinity=False), min_size=3, max_size=3), min_size=5, max_size=20))
def test_vector_text_round_trip(column, vectors):
    rows = [(v,) for v in vectors]
    assert column(lambda c: fv.vector_from_text(fv.vector_to_text(c), 3), rows, "a array<float>") == vectors


@FEW
@given(st.integers(0, 65), st.integers(1, 7), st.sampled_from([1, 9]))
def test_blocks_partition_the_rows(spark, rows, n, slices):
    df = spark.range(rows).select(F.lit("s").alias("sheet"), "id")
    blocks = row_blocks(df, "sheet", ["id"], ["id"], n, slices=slices).orderBy("block").collect()
    lines = [line for b in blocks for line in b.text.split("\n")]
    assert lines == [str(i) for i in range(rows)]
    assert all(len(b.text.split("\n")) <= n for b in blocks)
    assert [b.first_row for b in blocks] == list(range(1, rows + 1, n))
