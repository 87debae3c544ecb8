"""The trained index: recall at its own settings, equal paths, odd inputs, and how much of the table a search reads."""

import numpy as np
import pytest

from folioflow.operators import cells
from folioflow.operators import search as ks
from folioflow.plans import fixtures as fx


def vectors(spark, rows, kind="bigint"):
    return spark.createDataFrame(rows, f"id {kind}, text_embedding array<float>").repartition(4)


def draws(n, dim=12, seed=2):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(9, dim)) * 3
    return [(i, (centres[i % 9] + draw.normal(size=dim)).astype(np.float32).tolist()) for i in range(n)]


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_recall_at_default_settings(spark):
    stored = fx.vectors(spark, "/root/testdata/sf0.1")
    index = cells.build_index(stored, dim=64)
    assert index.probes < len(index.coder.centroids) and index.shortlist < 500
    exact = ks.knn(stored, stored, 10, "id", "id", dim=64, other_only=True)
    assert ks.recall(index.search(stored, 10, "id", other_only=True), exact).first().recall >= 0.9
    fewer = index.search(stored, 10, "id", other_only=True, probes=1)
    assert ks.recall(fewer, exact).first().recall < 0.9


def test_everything_probed_and_ranked_is_exact(spark):
    stored = vectors(spark, draws(300))
    index = cells.build_index(stored, dim=12, probes=1, shortlist=1)
    found = index.search(stored, 4, "id", probes=1000, shortlist=1000)
    assert rows(found) == rows(ks.knn(stored, stored, 4, "id", "id", dim=12))


@pytest.mark.parametrize("kind", ["bigint", "string"])
def test_paths_agree_on_copies_and_odd_rows(spark, kind):
    same = [(1000 + i, [0.5] * 12) for i in range(150)]
    odd = [(2000, None), (2001, [1.0] * 11), (2002, [float("nan")] * 12), (2003, [None] * 12), (None, [1.0] * 12), (7, [9.0] * 12), (7, [9.0] * 12)]
    given = [(i if i is None or kind == "bigint" else str(i), v) for i, v in draws(200) + same + odd]
    stored = vectors(spark, given, kind)
    index = cells.build_index(stored, dim=12, cells=6, probes=3, shortlist=20)
    near = rows(index.search(stored, 5, "id", other_only=True))
    assert near == rows(index.search(stored, 5, "id", other_only=True, broadcast_bytes=0, block_rows=16))
    of_copy = [r for r in near if str(r[0]) == "1100"]
    assert [r[3] for r in of_copy] == [0.0] * 5 and str(of_copy[0][1]) == "1000"
    again = cells.build_index(stored.repartition(7), dim=12, cells=6, probes=3, shortlist=20)
    assert near == rows(again.search(stored, 5, "id", other_only=True))


@pytest.mark.parametrize("n", [0, 1, 3])
def test_few_chunks(spark, n):
    stored = vectors(spark, draws(n))
    index = cells.build_index(stored, dim=12)
    asked = vectors(spark, draws(5))
    for options in ({}, {"broadcast_bytes": 0}):
        found = rows(index.search(asked, 4, "id", **options))
        assert len(found) <= 5 * n and (not n or len(found) >= 5)


def test_a_search_reads_the_probed_cells(spark):
    stored = vectors(spark, draws(400))
    index = cells.build_index(stored, dim=12, cells=9, probes=1, shortlist=10)
    plan = index.search(stored.limit(1), 3, "id")._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "PushedFilters: [" in plan and "cell" in plan.split("PushedFilters: [")[1].split("]")[0]
