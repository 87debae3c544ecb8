"""Clusters of vectors around centroids, in integers, with a rotated filter in front of the exact distances.

A vector is the integers floor(scale * x) of its components. The table is read once for the covariance and once more to
be rotated onto the principal axes: a row keeps its integers, its leading rotated coordinates and the norm of what
the other axes hold. The distance of the leading coordinates, squared, plus the squared difference of the two residual
norms is never more than the squared distance, so a centroid beyond the best one found so far by that bound needs no
look at the integers; those within it are verified in integers. Results therefore do not depend on the rotation. The
stored coordinates are rounded, and the bound gives way by more than their rounding.

Each round reads the rotated table once; a task hands on one sum a centroid and component. The driver holds the
covariance (dim x dim numbers), the axes and the centroids, whatever the number of vectors.

Vectors of another size, or with a null or a component that is not finite, take no part, nor does a null vector.
Repeated rows are vectors of their own. Rows of one id have one seed hash and are ordered by their integers; a null id is
no seed unless too few others are left. Fewer vectors than centroids make as many centroids as vectors; an empty table
gives an empty result. Components are limited to 2**26 after scaling, so that squared distances are exact in 64 bits; a
larger one ends the job with a message. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.llm.common import kept

DIM = 64
SCALE = 64
CENTROIDS = 16
ROUNDS = 3
SEED = 1
# Leading rotated coordinates that a row keeps.
LEAD = 16
LARGEST = 1 << 26
# Part of the vectors' norms by which rounded coordinates may be off; theirs are off by less than a tenth of it.
SLACK = 1e-6

ROTATED = pa.schema([("vec_id", pa.int64()), ("ints", pa.list_(pa.int32())), ("lead", pa.list_(pa.float32())), ("rest", pa.float32())])


def integers(batch: pa.RecordBatch, dim: int, scale: int) -> tuple[pa.Array, np.ndarray]:
    """Ids and integers of the usable vectors of a batch."""
    vectors = batch.column("embedding")
    fit = vectors.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False) == dim
    vectors, ids = vectors.filter(pa.array(fit)), batch.column("vec_id").filter(pa.array(fit))
    flat = vectors.flatten()
    x = flat.cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, dim)  # nulls become NaN
    good = np.isfinite(x).all(axis=1)
    whole = np.floor(x[good] * scale)
    if len(whole) and np.abs(whole).max() > LARGEST:
        raise ValueError(f"a component of more than {LARGEST} after scaling by {scale}; use a smaller scale")
    return ids.filter(pa.array(good)), whole.astype(np.int64)


class Axes:
    """Principal axes of the vectors; where a vector lies along the leading ones and how far off them."""

    def __init__(self, n: int, sums: np.ndarray, products: np.ndarray, lead: int):
        self.mean = sums / max(n, 1)
        _, axes = np.linalg.eigh(products / max(n, 1) - np.outer(self.mean, self.mean))
        self.axes = axes[:, ::-1][:, :lead]

    def rotate(self, ints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        moved = ints - self.mean
        lead = moved @ self.axes
        return lead, np.sqrt(np.maximum((moved**2).sum(axis=1) - (lead**2).sum(axis=1), 0))


def principal_axes(vectors: DataFrame, dim: int, scale: int, lead: int) -> Axes:
    """From the sums and products of all vectors, added up by component pair."""

    def moments(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, products, n = np.zeros(dim), np.zeros((dim, dim)), 0
        for batch in batches:
            _, ints = integers(batch, dim, scale)
            ints = ints.astype(np.float64)
            sums, products, n = sums + ints.sum(axis=0), products + ints.T @ ints, n + len(ints)
        # Row `dim` holds the sums and, behind them, the number of vectors.
        values = np.concatenate([np.column_stack([products, np.zeros(dim)]), np.append(sums, n)[None]])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(values.size, dtype=np.int32)), pa.array(values.ravel())], names=["cell", "value"])

    added = vectors.mapInArrow(moments, "cell int, value double").groupBy("cell").agg(F.sum("value").alias("value")).toArrow()
    flat = np.zeros((dim + 1) * (dim + 1))
    flat[added["cell"].to_numpy()] = added["value"].to_numpy()
    flat = flat.reshape(dim + 1, dim + 1)
    return Axes(int(flat[dim, dim]), flat[dim, :dim], flat[:dim, :dim], lead)


def rotated(vectors: DataFrame, axes: Axes, dim: int, scale: int) -> DataFrame:
    """``vec_id, ints, lead, rest`` of the usable vectors."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, ints = integers(batch, dim, scale)
            lead, rest = axes.rotate(ints)
            yield pa.RecordBatch.from_arrays([ids, rows_as_lists(ints.astype(np.int32)), rows_as_lists(lead.astype(np.float32)), pa.array(rest.astype(np.float32))], schema=ROTATED)

    return vectors.mapInArrow(run, "vec_id bigint, ints array<int>, lead array<float>, rest float")


def rows_as_lists(matrix: np.ndarray) -> pa.Array:
    ends = np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1]
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(matrix.ravel()))


def as_matrix(lists: pa.Array, width: int) -> np.ndarray:
    return lists.flatten().to_numpy().reshape(-1, width)


class Nearest:
    """Assigns vectors to centroids; counts the distances that the filter leaves to verify."""

    def __init__(self, centroids: np.ndarray, axes: Axes):
        self.centroids = centroids
        self.lead, self.rest = axes.rotate(centroids)
        self.norm = np.sqrt((self.lead**2).sum(axis=1) + self.rest**2)
        self.verified = 0

    def bounds(self, lead: np.ndarray, rest: np.ndarray) -> np.ndarray:
        """Of every vector and centroid, a number that their squared distance is not below."""
        lead, rest = lead.astype(np.float64), rest.astype(np.float64)
        inside = (lead**2).sum(axis=1)
        flat = inside[:, None] + (self.lead**2).sum(axis=1) - 2 * lead @ self.lead.T + (rest[:, None] - self.rest) ** 2
        give = SLACK * (np.sqrt(inside + rest**2)[:, None] + self.norm + 1)
        return np.maximum(np.sqrt(np.maximum(flat, 0)) - give, 0) ** 2

    def assign(self, ints: np.ndarray, lead: np.ndarray, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest centroid, the smaller one of equals, and the squared distance."""
        bound = self.bounds(lead, rest)
        cluster = bound.argmin(axis=1)
        best = ((ints - self.centroids[cluster]) ** 2).sum(axis=1)
        self.verified += len(ints)
        first = cluster.copy()
        for c in range(len(self.centroids)):
            rows = np.flatnonzero((bound[:, c] <= best) & (first != c))
            exact = ((ints[rows] - self.centroids[c]) ** 2).sum(axis=1)
            closer = (exact < best[rows]) | (exact == best[rows]) & (c < cluster[rows])
            cluster[rows[closer]], best[rows[closer]] = c, exact[closer]
            self.verified += len(rows)
        return cluster, best


def fields(batch: pa.RecordBatch, dim: int, lead: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return as_matrix(batch.column("ints"), dim).astype(np.int64), as_matrix(batch.column("lead"), lead), batch.column("rest").to_numpy()


def moved(store: DataFrame, centroids: np.ndarray, axes: Axes) -> np.ndarray:
    """The floored means of the vectors next to each centroid; a centroid without vectors stays."""
    (k, dim), lead = centroids.shape, axes.axes.shape[1]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        near, sums, sizes = Nearest(centroids, axes), np.zeros((k, dim), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            ints, *filtered = fields(batch, dim, lead)
            cluster, _ = near.assign(ints, *filtered)
            order = np.argsort(cluster, kind="stable")
            found, first = np.unique(cluster[order], return_index=True)
            if len(found):
                sums[found] += np.add.reduceat(ints[order], first, axis=0)
                sizes += np.bincount(cluster, minlength=k)
        cells = np.column_stack([sums, sizes])[sizes > 0]
        numbers = np.arange(k * (dim + 1), dtype=np.int32).reshape(k, dim + 1)[sizes > 0]
        yield pa.RecordBatch.from_arrays([pa.array(numbers.ravel()), pa.array(cells.ravel())], names=["cell", "value"])

    total = F.sum(F.col("value").cast("decimal(38,0)")).alias("value")
    added = {r.cell: int(r.value) for r in store.mapInArrow(run, "cell int, value bigint").groupBy("cell").agg(total).collect()}
    after = centroids.copy()
    for c in range(k):
        at = c * (dim + 1)
        if at + dim in added:
            after[c] = [added[at + d] // added[at + dim] for d in range(dim)]
    return after


def first_centroids(store: DataFrame, k: int, seed: int, dim: int) -> np.ndarray:
    """The ``k`` vectors whose `seed:id` has the smallest sha256."""
    by = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    found = store.orderBy(by.asc_nulls_last(), "ints").limit(k).select("ints").collect()
    return np.array([r.ints for r in found], np.int64).reshape(-1, dim)


class Clustering:
    """Centroids of the usable vectors of a table, after a number of rounds; ``assigned`` deals its vectors to them."""

    def __init__(self, vectors: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, seed: int = SEED, dim: int = DIM, scale: int = SCALE, lead: int = LEAD):
        narrow = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding")
        self.axes = principal_axes(narrow, dim, scale, min(lead, dim))
        self.store = kept(rotated(narrow, self.axes, dim, scale), "rotated")
        self.centroids = first_centroids(self.store, k, seed, dim)
        for _ in range(rounds if len(self.centroids) else 0):
            self.centroids = moved(self.store, self.centroids, self.axes)

    def assigned(self) -> DataFrame:
        """``vec_id, cluster, distance`` (squared)."""
        centroids, axes, dim, lead = self.centroids, self.axes, self.centroids.shape[1], self.axes.axes.shape[1]

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            near = Nearest(centroids, axes)
            for batch in batches:
                cluster, best = near.assign(*fields(batch, dim, lead))
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(cluster.astype(np.int32)), pa.array(best)], names=["vec_id", "cluster", "distance"])

        return self.store.mapInArrow(run, "vec_id bigint, cluster int, distance bigint")


def digest(vectors: DataFrame, **settings: int) -> DataFrame:
    """Every usable vector with its cluster, the inertia of that and of all, and a digest of the centroid."""
    found = Clustering(vectors, **settings)
    rows = kept(found.assigned(), "clusters")
    # One row a centroid.
    inertia = {r.cluster: int(r.inertia) for r in rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("inertia")).collect()}
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in found.centroids.tolist()]
    sums = [(c, inertia.get(c, 0), sum(inertia.values()), name) for c, name in enumerate(names)]
    facts = vectors.sparkSession.createDataFrame(sums, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return rows.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def oracle(k: int = CENTROIDS, rounds: int = ROUNDS, seed: int = SEED, dim: int = DIM, scale: int = SCALE) -> str:
    """The same in SQL: all distances of every round."""
    # The smallest distance * k + number: equal distances go to the smaller number.
    near = "SELECT r, min(list_sum(list_transform(range(1, {dim} + 1), lambda i: (v[i] - w[i]) * (v[i] - w[i])))::BIGINT * {k} + c) AS found FROM kept, c{n} GROUP BY r"
    steps = []
    for n in range(rounds + 1):
        steps.append(f"a{n} AS MATERIALIZED ({near.format(n=n, dim=dim, k=k)})")
        if n < rounds:
            steps.append(f"""s{n} AS (SELECT found % {k} AS c, i, sum(v[i])::BIGINT AS s, count(*) AS m
    FROM a{n} JOIN kept USING (r), range(1, {dim} + 1) AS t(i) GROUP BY 1, 2),
c{n + 1} AS MATERIALIZED (SELECT c, list(((s - ((s % m) + m) % m) // m)::BIGINT ORDER BY i) AS w FROM s{n} GROUP BY c
    UNION ALL SELECT c, w FROM c{n} WHERE c NOT IN (SELECT c FROM s{n}))""")
    return f"""
WITH kept AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY sha256('{seed}:' || vec_id), v) AS r, vec_id, v FROM (
        SELECT vec_id, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS v FROM embeddings
        WHERE len(embedding) = {dim} AND len(list_filter(embedding, lambda x: isfinite(x))) = {dim})),
c0 AS MATERIALIZED (SELECT r - 1 AS c, v AS w FROM kept WHERE r <= {k}),
{",\n".join(steps)},
dealt AS (SELECT vec_id, found % {k} AS c, found // {k} AS distance FROM a{rounds} JOIN kept USING (r))
SELECT vec_id, c::INT AS cluster, distance::BIGINT AS distance, (sum(distance) OVER (PARTITION BY c))::BIGINT AS cluster_inertia,
    (sum(distance) OVER ())::BIGINT AS inertia, sha256(array_to_string(w, ',')) AS centroid_sha256
FROM dealt JOIN c{rounds} USING (c)
"""
