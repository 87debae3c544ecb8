"""Centroid clustering against plain integers and its SQL, with the filter's bound held to what it promises."""

import hashlib
import math
from collections import defaultdict

import duckdb
import numpy as np
import pytest

from folioflow.llm import centroid_clustering
from folioflow.llm.queries import ORACLE, QUERIES

DDL = "vec_id bigint, embedding array<float>, label int, cluster string, ints int"
COLUMNS = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1, "c", 2) for i, v in rows], DDL)


def brute(rows, k=16, rounds=3, dim=64):
    kept = []
    for i, v in rows:
        if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, [math.floor(64 * float(np.float32(x))) for x in v]))
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1]))
    centroids = [v for _, v in order[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        groups = defaultdict(list)
        for _, v in kept:
            groups[nearest(v)[1]].append(v)
        centroids = [[sum(c) // len(groups[n]) for c in zip(*groups[n])] if n in groups else old for n, old in enumerate(centroids)]
    found = [(i, *reversed(nearest(v))) for i, v in kept]
    sums = defaultdict(int)
    for _, n, d in found:
        sums[n] += d
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, n, d, sums[n], sum(sums.values()), names[n]) for i, n, d in found), key=repr)


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=repr)


def draws(n, seed=3, spread=0.2):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(5, 64))
    return [(i, [float(x) for x in (centres[i % 5] + spread * draw.normal(size=64)).astype(np.float32)]) for i in range(n)]


def odd(n=60):
    rows = draws(n)
    unusable = [(900, None), (901, []), (902, [0.5] * 63), (903, [0.5] * 63 + [None]), (904, [float("nan")] * 64), (905, [float("inf")] * 64), (906, [0.5] * 65)]
    copies = [(1000, [0.25] * 64)] * 30 + [(n, [0.25] * 64) for n in range(1001, 1030)] + [(3, rows[8][1]), (None, rows[2][1]), (None, [0.0] * 64)]
    return rows + unusable + copies


def test_odd_rows(spark):
    rows = odd()
    assert rows_of(centroid_clustering.digest(table(spark, rows))) == brute(rows)
    assert rows_of(centroid_clustering.digest(table(spark, rows), k=3, rounds=1, lead=64)) == brute(rows, 3, 1)


def test_few_and_none(spark):
    few = odd()[60:70] + draws(3)
    assert rows_of(centroid_clustering.digest(table(spark, few))) == brute(few)
    assert rows_of(centroid_clustering.digest(table(spark, []))) == []
    assert rows_of(centroid_clustering.digest(table(spark, [(1, None), (2, [1.0])]))) == []


def test_too_large(spark):
    with pytest.raises(Exception, match="smaller scale"):
        centroid_clustering.digest(table(spark, [(1, [3e30] * 64)]))


def test_sql_says_the_same(spark):
    rows = [r for r in odd() if r[0] is not None]
    embeddings = table(spark, rows).toArrow()  # noqa: F841  the SQL reads it by name
    want = duckdb.sql(f"SELECT {', '.join(COLUMNS)} FROM ({ORACLE['op12_centroid_clustering']})").fetchall()
    assert rows_of(centroid_clustering.digest(table(spark, rows))) == sorted(want, key=repr)


def test_bound_is_below_every_distance():
    draw = np.random.default_rng(1)
    for size in (1, 1000, 1 << 25):
        ints = draw.integers(-size, size + 1, (300, 64))
        ints[100:200] = ints[:100] + draw.integers(-1, 2, (100, 64)) * (size > 1)
        axes = centroid_clustering.Axes(300, ints.sum(axis=0).astype(float), ints.astype(float).T @ ints.astype(float), 16)
        lead, rest = axes.rotate(ints)
        near = centroid_clustering.Nearest(ints[:150], axes)
        bound = near.bounds(lead.astype(np.float32), rest.astype(np.float32))
        exact = ((ints[:, None] - ints[None, :150]) ** 2).sum(axis=2)
        assert (bound <= exact).all()


def test_filter_spares_distances():
    ints = np.floor(64 * np.array([v for _, v in draws(2000)])).astype(np.int64)
    axes = centroid_clustering.Axes(2000, ints.sum(axis=0).astype(float), ints.astype(float).T @ ints.astype(float), 16)
    near = centroid_clustering.Nearest(ints[:16], axes)
    near.assign(ints, *(x.astype(np.float32) for x in axes.rotate(ints)))
    assert near.verified < 0.5 * 2000 * 16


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding").collect()]
    assert rows_of(QUERIES["op12_centroid_clustering"](spark, folder)) == brute(rows)
