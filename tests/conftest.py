import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__  # noqa: E402,F401  registers the package with the workers
from folioflow.session import get_spark  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("checkpoints"))
    session = get_spark("local[8]", 8, **{"spark.checkpoint.dir": folder, "spark.driver.memory": "8g"})
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture
def column(spark):
    """Apply a column function to a list of values (tuples for several columns)."""

    def run(fn, values, schema="a string"):
        rows = [v if isinstance(v, tuple) else (v,) for v in values]
        df = spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], f"i int, {schema}")
        from pyspark.sql import functions as F

        args = [F.col(c) for c in df.columns if c != "i"]
        return [r.out for r in df.select("i", fn(*args).alias("out")).orderBy("i").collect()]

    return run
