"""Blocks of ordered sheets cut out of ranges: against plain lists, for hot, tiny and null sheets."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from folioflow.operators import chunks as oc


def plain(rows, n):
    sheets = defaultdict(list)
    for sheet, at, value in rows:
        sheets[sheet].append((at, value))
    for sheet, lines in sheets.items():
        lines.sort()
        for first in range(0, len(lines), n):
            some = lines[first : first + n]
            yield sheet, first // n, first + 1, first + len(some), "\n".join(v for _, v in some)


def found(blocks):
    return sorted(((r.sheet, r.block, r.first_row, r.last_row, r.text) for r in blocks.collect()), key=repr)


@pytest.mark.parametrize("slices", [None, 1, 7, 40])
@pytest.mark.parametrize("n", [1, 4, 20])
def test_every_shape_of_sheet(spark, slices, n):
    draw = random.Random(n)
    rows = [("hot", i, f"h{i}") for i in range(5000)] + [("long", i, f"l{i}") for i in range(n * oc.RUN_BLOCKS + 3)]
    rows += [(f"s{k:03d}", i, f"{k}.{i}") for k in range(120) for i in range(draw.choice([1, n, n + 1, 2 * n, 3]))]
    rows += [(None, i, f"null {i}") for i in range(2 * n + 1)]
    draw.shuffle(rows)
    df = spark.createDataFrame(rows, "sheet string, at int, value string").repartition(5)
    assert found(oc.row_blocks(df, "sheet", ["at"], ["value"], n, slices=slices)) == sorted(plain(rows, n), key=repr)


def test_one_order_value_spreads_and_loses_nothing(spark):
    df = spark.range(3000).select(F.lit(7).alias("sheet"), F.lit(1).alias("at"), F.col("id").cast("string").alias("v"))
    blocks = oc.row_blocks(df, "sheet", ["at"], ["v"], 20, slices=30).collect()
    assert sorted(int(x) for b in blocks for x in b.text.split("\n")) == list(range(3000)) and len(blocks) == 150


def test_one_shuffle_and_no_window(spark):
    """Of the rows, that is: what follows the written runs shuffles pieces at their edges only."""
    df = spark.range(1000).select((F.col("id") % 3).alias("sheet"), "id")
    plan = oc.row_blocks(df, "sheet", ["id"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and plan.count("Exchange hashpartitioning") <= 1
