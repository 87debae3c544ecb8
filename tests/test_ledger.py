"""Ledgers as sorted runs: what a batch finds, how little it opens, merges, and unfinished writes."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioflow.sources import ledger as le
from folioflow.sources.records import KEYS

NAMES = T.StructType([T.StructField("source_file", T.StringType()), T.StructField("page_num", T.IntegerType())])


def pages(spark, files, n=3, name="f%07d"):
    return spark.createDataFrame([(name % i, p) for i in files for p in range(1, n + 1)], NAMES)


def keys(spark, names):
    return spark.createDataFrame([(n,) for n in names], "source_file string")


def found(ledger, names):
    """Rows of the wanted names, as a skip check sees them."""
    rows = ledger.read(keys(ledger.spark, names)).filter(F.col("source_file").isin(names)).distinct().collect()
    return sorted(tuple(r) for r in rows)


def test_a_batch_finds_its_keys(spark, tmp_path):
    ledger = le.Ledger(spark, str(tmp_path / "l"), NAMES, rows_a_file=40)
    assert ledger.read().count() == 0 and ledger.files(keys(spark, ["a"])) == []
    for at in range(5):
        ledger.append(pages(spark, range(at, 300, 5)))
    ledger.append(pages(spark, []))
    ledger.append(pages(spark, [3], name="_odd [%d] é"))
    ledger.append(spark.createDataFrame([(None, 1)], NAMES))
    assert ledger.read().count() == 904
    for wanted in (["f0000007"], ["f0000000", "f0000299", "none"], ["_odd [3] é"], ["zzz", "A"], []):
        assert found(ledger, wanted) == [(w, p) for w in sorted(wanted) if w[0] in "f_" and w != "none" for p in (1, 2, 3)]
    assert found(ledger, ["f%07d" % i for i in range(300)]) == [("f%07d" % i, p) for i in range(300) for p in (1, 2, 3)]


def test_a_thousand_files_over_ten_million_pages(spark, tmp_path):
    """New files strewn over all names, and a folder sent again, open few of the ledger's files."""
    ledger = le.Ledger(spark, str(tmp_path / "l"), NAMES)
    number = F.floor(F.col("id") / 10)
    ledger.append(spark.range(10_000_000).select(F.format_string("gs://corpus/%08d.pdf", number).alias("source_file"), (F.col("id") % 10).cast("int").alias("page_num")))
    every = ledger.files()
    assert len(every) >= 200
    new = spark.range(1000).select(F.format_string("gs://corpus/%08d-new.pdf", F.col("id") * 997).alias("source_file"))
    assert len(ledger.files(new)) < 0.05 * len(every)
    again = spark.range(1000).select(F.format_string("gs://corpus/%08d.pdf", F.col("id") + 400_000).alias("source_file"))
    opened = ledger.files(again)
    assert 1 <= len(opened) < 0.05 * len(every)
    assert ledger.read(again).join(again, "source_file", "left_semi").count() == 10_000


def test_runs_are_merged_by_size(spark, tmp_path):
    ledger = le.Ledger(spark, str(tmp_path / "l"), NAMES, rows_a_file=50)
    ledger.append(pages(spark, range(1000, 1400)))
    for at in range(12):
        ledger.append(pages(spark, [at]))
        assert len(ledger.runs()) <= 2 + le.RUNS_A_TIER
    ledger.append(pages(spark, [5]))
    assert found(ledger, ["f%07d" % i for i in range(20)]) == [("f%07d" % i, p) for i in range(12) for p in (1, 2, 3)]
    ledger.merge(every=True)
    assert len(ledger.runs()) == 1 and ledger.read().count() == 412 * 3
    ledger.clean()
    assert len(os.listdir(tmp_path / "l" / "runs")) == 1 and ledger.read().count() == 412 * 3


def test_unfinished_writes_do_not_count(spark, tmp_path):
    folder = str(tmp_path / "l")
    ledger = le.Ledger(spark, folder, NAMES)
    ledger.append(pages(spark, [1]))
    ledger._write_run(pages(spark, [2])).collect()  # a run whose index entry was never written
    os.makedirs(f"{folder}/index/7")  # and a merge that died
    assert found(ledger, ["f0000001", "f0000002"]) == [("f0000001", p) for p in (1, 2, 3)]
    ledger.append(pages(spark, [2]))
    assert len(found(ledger, ["f0000001", "f0000002"])) == 6


def test_more_keys_than_are_sent_read_everything(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(le, "MOST_KEYS", 3)
    ledger = le.Ledger(spark, str(tmp_path / "l"), KEYS)
    ledger.append(pages(spark, range(9)).select("source_file", F.lit("").alias("part"), "page_num", F.lit("o").alias("object_name")))
    assert ledger.files(keys(spark, ["a", "b", "c", "d"])) == ledger.files()


@pytest.mark.parametrize("n", [0, 1, 700])
def test_filter(n):
    draw = np.random.default_rng(n)
    inside, outside = draw.integers(-(2**62), 2**62, n), draw.integers(-(2**62), 2**62, 20_000)
    bits = le.bloom_filter(inside)
    assert le.may_have(bits, inside).all() and le.may_have(bits, outside).mean() < 0.02
