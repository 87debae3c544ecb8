"""Every registered query against its SQL on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from verify import compare, oracle_connection

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return oracle_connection(SF)


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(spark, con, name):
    assert compare(spark, con, name, SF) == ""


def test_entry(spark):
    rows = entry.entry(spark)
    assert rows.count() == 5 * spark.read.parquet(f"{entry.FLAGSHIP_DIR}/benchmark.parquet").count()
