"""Approximate search with trained cells and codes.

An index has coarse centroids, found by k-means on a bounded sample, and a codebook for each run of components of what
a vector differs from its centroid by. A chunk is kept once, in the cell of its nearest centroid, with a short code and
its vector; the table is sorted by cell, so that a search reads the row groups of the cells that it probes. A query
probes the cells of its nearest centroids, estimates distances from codes, and ranks the chunks of the shortest estimates
by their exact distance.

How many cells to probe and how many estimates to rank is measured when the index is built: for a few stored
vectors taken as queries the exact neighbours are searched, and both numbers are set so that the wanted share of these
would be found. Training, codes and estimates are in integers, so that an index does not depend on partitioning.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioflow.functions.rounding import round_half_up
from folioflow.operators.blocks import lay_out, meet_in_blocks, parts_of, sizes_of
from folioflow.operators.search import BLOCK_ROWS, BROADCAST_BYTES, CELL_QUERIES, DIGITS, PAIR_CELLS, _hit_schema, _ids, _knn_broadcast, _matrix, _native, _pick, _settled, _take_best
from folioflow.session import scratch_path, written

# Vectors that centroids and codebooks are trained on: those of smallest id hash.
TRAIN_ROWS = 65_536
# Centroids are broadcast: at most this many, 25 MB at 768 dimensions.
MAX_CELLS = 4096
ROUNDS = 5
CODES = 16
# Components that share a code.
RUN = 4
# Largest component after scaling; others are clipped to four times that. Sums of squares stay exact.
SCALED = 1 << 14
# Vectors that the settings are measured with, and neighbours of each.
ASKED = 128
NEIGHBOURS = 10
TARGET = 0.95
TASK_BYTES = 128 << 20
# Queries and chunks whose estimates are held at a time.
QUERY_ROWS = 256
TILE_ROWS = 4096
# Largest set of queries that is sent to the index.
NEAR_QUERIES = 4096


def hash_order(salt: str = "", id_col: str = "cid") -> list[Column]:
    return [F.md5(F.concat(F.lit(salt), F.col(id_col).cast("string"))), F.col(id_col)]


def squares(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances of integers, exact: all sums stay below 2**53."""
    x, centres = x.astype(np.float64), centres.astype(np.float64)
    return (x * x).sum(axis=1)[:, None] + (centres * centres).sum(axis=1) - 2.0 * (x @ centres.T)


@dataclass
class Coder:
    """The trained part of an index."""

    scale: float
    centroids: np.ndarray  # cells x dim
    books: np.ndarray  # parts x codes x run

    def ints(self, vectors: np.ndarray) -> np.ndarray:
        return np.clip(np.floor(vectors * self.scale), -4 * SCALED, 4 * SCALED).astype(np.int64)

    def parts(self, x: np.ndarray) -> np.ndarray:
        """Rows cut into runs of components: parts x rows x run; the last run is filled with zeros."""
        n, run = len(self.books), self.books.shape[2]
        return np.pad(x, ((0, 0), (0, n * run - x.shape[1]))).reshape(len(x), n, run).transpose(1, 0, 2)

    def cells(self, x: np.ndarray) -> np.ndarray:
        return squares(x, self.centroids).argmin(axis=1)

    def codes(self, x: np.ndarray, cells: np.ndarray) -> np.ndarray:
        """Per row and part the number of the nearest code of what the row differs from its centroid by."""
        rest = self.parts(x - self.centroids[cells])
        return np.stack([squares(r, book).argmin(axis=1) for r, book in zip(rest, self.books)], axis=1).astype(np.uint8)

    def probes(self, x: np.ndarray, n: int | None = None) -> np.ndarray:
        """Numbers of the ``n`` nearest cells per row, nearest first, the smaller of equals first."""
        far = squares(x, self.centroids)
        return np.argsort(far, axis=1, kind="stable")[:, :n]

    def decoded(self, codes: np.ndarray) -> np.ndarray:
        """What the codes stand for: rows x components."""
        return np.concatenate([book[codes[:, p]] for p, book in enumerate(self.books)], axis=1).astype(np.float64)[:, : self.centroids.shape[1]]

    def estimates(self, x: np.ndarray, cell: int, codes: np.ndarray) -> np.ndarray:
        """Queries x chunks of one cell: squared distances to what the codes stand for."""
        return squares(x - self.centroids[cell], self.decoded(codes))


def _floored_means(before: np.ndarray, rows: DataFrame) -> np.ndarray:
    """``before`` (centres x width) with the floored means of ``centre, pos, value, n`` where there are any."""
    after = before.copy()
    added = rows.groupBy("centre", "pos").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value"), F.sum("n").alias("n")).collect()
    for r in added:
        after[r.centre, r.pos] = int(r.value) // r.n
    return after


def _sums(x: np.ndarray, centre: np.ndarray, first: int = 0) -> Iterator[pa.RecordBatch]:
    """``centre, pos, value, n`` of one batch."""
    found, where, n = np.unique(centre, return_inverse=True, return_counts=True)
    total = np.zeros((len(found), x.shape[1]), np.int64)
    np.add.at(total, where, x)
    width = x.shape[1]
    columns = [np.repeat(found + first, width).astype(np.int32), np.tile(np.arange(width, dtype=np.int32), len(found)), total.ravel(), np.repeat(n, width)]
    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["centre", "pos", "value", "n"])


SUMS_DDL = "centre int, pos int, value bigint, n bigint"


def train(stored: DataFrame, dim: int, cells: int, codes: int = CODES, run: int = RUN, rounds: int = ROUNDS, scale: float | None = None, sample: int = TRAIN_ROWS) -> Coder:
    """Centroids and codebooks from the ``sample`` vectors of smallest id hash, each round a job over them."""
    taken = written(stored.orderBy(*hash_order()).limit(sample).select("cid", "vec").repartition(stored.sparkSession.sparkContext.defaultParallelism), "sample")
    if scale is None:
        largest = taken.agg(F.max(F.array_max(F.transform("vec", lambda x: F.abs(x))))).first()[0] or 1.0
        scale = 2.0 ** np.floor(np.log2(SCALED / largest))
    first = _matrix(taken.orderBy(*hash_order()).limit(max(cells, codes)).select("vec").toArrow()["vec"], dim)
    n_parts = -(-dim // run)
    coder = Coder(scale, np.zeros((0, dim)), np.zeros((n_parts, 0, run)))
    start = coder.ints(first)
    coder.centroids = start[:cells]

    def cell_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = coder.ints(_matrix(batch.column("vec"), dim))
            yield from _sums(x, coder.cells(x))

    for _ in range(rounds if len(start) else 0):
        coder.centroids = _floored_means(coder.centroids, taken.mapInArrow(cell_sums, SUMS_DDL))
    coder.books = coder.parts(start[:codes] - coder.centroids[coder.cells(start[:codes])]) if len(start) else coder.books

    def code_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = coder.ints(_matrix(batch.column("vec"), dim))
            cell = coder.cells(x)
            for p, (rest, code) in enumerate(zip(coder.parts(x - coder.centroids[cell]), coder.codes(x, cell).T)):
                yield from _sums(rest, code, p * coder.books.shape[1])

    for _ in range(rounds if len(start) else 0):
        flat = coder.books.reshape(-1, run)
        coder.books = _floored_means(flat, taken.mapInArrow(code_sums, SUMS_DDL)).reshape(coder.books.shape)
    return coder


class Shortest:
    """Per query the ``keep`` chunks of smallest (estimate, id) seen so far, with their exact distances; with ``limits``,
    those of no larger estimate only."""

    def __init__(self, queries: np.ndarray, keep: int, limits: np.ndarray | None = None):
        self.queries, self.keep = queries, keep
        self.bound = np.full(len(queries), np.inf) if limits is None else limits.astype(np.float64)
        # Per span of queries: query, estimate, id and distance, in this order.
        self.found: dict[int, tuple[np.ndarray, ...]] = {}

    def add(self, first: int, estimates: np.ndarray, ids: np.ndarray, vectors: np.ndarray) -> None:
        """``estimates`` of the chunks for the span of queries from ``first`` on; inf leaves a chunk out."""
        rows = slice(first, first + len(estimates))
        limit = self.bound[rows].copy()
        near = (estimates <= limit[:, None]) & np.isfinite(estimates)
        many = np.flatnonzero(np.count_nonzero(near, axis=1) > self.keep)
        if len(many):
            kth = np.partition(estimates[many], self.keep - 1, axis=1)[:, self.keep - 1]
            near[many] &= estimates[many] <= kth[:, None]
        q, at = np.nonzero(near)
        if not len(q):
            return
        new_estimates, new_ids, q = estimates[q, at], np.array(ids[at].tolist()), q + first
        exact, step = np.empty(len(q)), max(1, PAIR_CELLS // vectors.shape[1])
        for i in range(0, len(q), step):
            apart = vectors[at[i : i + step]].astype(np.float64) - self.queries[q[i : i + step]]
            exact[i : i + step] = round_half_up(np.sqrt((apart**2).sum(axis=1)), DIGITS)
        new = q, new_estimates, new_ids, exact
        if first in self.found:
            new = tuple(np.concatenate(pair) for pair in zip(self.found[first], new))
        order = np.lexsort((new[2], new[1], new[0]))
        sorted_q = new[0][order]
        place = np.arange(len(order)) - np.searchsorted(sorted_q, sorted_q)
        self.found[first] = tuple(column[order[place < self.keep]] for column in new)
        last = order[place == self.keep - 1]
        self.bound[new[0][last]] = np.minimum(self.bound[new[0][last]], new[1][last])

    def result(self, query_ids: np.ndarray, schema: pa.Schema) -> pa.Table:
        parts = [
            pa.Table.from_arrays([pa.array(c.tolist(), type=f.type) for c, f in zip((query_ids[q], ids, dist, estimate), schema)], schema=schema)
            for q, estimate, ids, dist in self.found.values()
        ]
        return pa.concat_tables(parts) if parts else schema.empty_table()


def _by_cell(cells: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Cell numbers with the rows of each."""
    order = np.argsort(cells, kind="stable")
    found, first = np.unique(cells[order], return_index=True)
    for cell, rows in zip(found.tolist(), np.split(order, first[1:])):
        yield cell, rows


class CellIndex:
    """Chunks in cells, with codes and settings; made by :func:`build_index`."""

    def __init__(self, table: DataFrame, coder: Coder, dim: int, probes: int, shortlist: int):
        self.table, self.coder, self.dim, self.probes, self.shortlist = table, coder, dim, probes, shortlist

    def search(
        self, queries: DataFrame, k: int, query_id: str = "qid", vec: str = "text_embedding", other_only: bool = False,
        probes: int | None = None, shortlist: int | None = None, broadcast_bytes: int = BROADCAST_BYTES, block_rows: int = BLOCK_ROWS,
    ) -> DataFrame:
        """``qid, cid, rank, dist``. Query sets within ``broadcast_bytes`` and NEAR_QUERIES go to the index; of a larger
        one each query meets the blocks of its nearest cell first, and with the longest estimate that it would keep of
        those it goes on to its other cells, from which only shorter ones come back."""
        probes, keep = max(1, probes or self.probes), max(k, shortlist or self.shortlist)
        asked = _settled(_pick(queries, query_id, vec, "qid"), "qid", self.dim)
        most = max(1, broadcast_bytes // (8 * self.dim))
        # More would leave every task with as many estimates of all of them.
        most = min(most, NEAR_QUERIES)
        head = asked.limit(most + 1).toArrow()
        hits = self._near(asked, head, probes, keep, other_only) if head.num_rows <= most else self._meet(asked, probes, keep, other_only, block_rows)
        best = Window.partitionBy("qid").orderBy("estimate", "cid")
        short = hits.withColumn("_n", F.row_number().over(best)).filter(F.col("_n") <= keep)
        return _take_best(short.select("qid", "cid", "dist"), k)

    def _schema(self, asked: DataFrame):
        schema, arrow = _hit_schema(asked, self.table)
        return schema.add("estimate", "double"), arrow.append(pa.field("estimate", pa.float64()))

    def _near(self, asked: DataFrame, head: pa.Table, probes: int, keep: int, other_only: bool) -> DataFrame:
        schema, arrow = self._schema(asked)
        query_ids, vectors = _ids(head["qid"]), _matrix(head["vec"], self.dim)
        coder, dim = self.coder, self.dim
        asked_cells = coder.probes(coder.ints(vectors), probes) if len(coder.centroids) else np.zeros((len(vectors), 0), np.int64)
        shared = asked.sparkSession.sparkContext.broadcast((query_ids, vectors, asked_cells))
        wanted = np.unique(asked_cells).tolist()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            query_ids, vectors, asked_cells = shared.value
            best, x = Shortest(vectors, keep), coder.ints(vectors)
            for batch in batches:
                for first in range(0, batch.num_rows, TILE_ROWS):
                    part = batch.slice(first, TILE_ROWS)
                    ids, chunks = _ids(part.column("cid")), _native(part.column("vec"), dim)
                    decoded = coder.decoded(_matrix(part.column("codes"), len(coder.books)).astype(np.uint8))
                    here = list(_by_cell(part.column("cell").to_numpy()))
                    for at in range(0, len(x), QUERY_ROWS):
                        who = slice(at, at + QUERY_ROWS)
                        estimates = np.full((len(x[who]), len(ids)), np.inf)
                        for cell, rows in here:
                            probing = np.flatnonzero((asked_cells[who] == cell).any(axis=1))
                            if len(probing):
                                estimates[np.ix_(probing, rows)] = squares(x[who][probing] - coder.centroids[cell], decoded[rows])
                        _offer(best, who, estimates, query_ids, ids, chunks, other_only)
            yield from best.result(query_ids, arrow).to_batches()

        probed = self.table if len(wanted) >= len(coder.centroids) else self.table.filter(F.col("cell").isin(wanted))
        return probed.mapInArrow(run, schema)

    def _meet(self, asked: DataFrame, probes: int, keep: int, other_only: bool, block_rows: int) -> DataFrame:
        schema, arrow = self._schema(asked)
        coder, dim = self.coder, self.dim

        @F.arrow_udf("array<int>")
        def probed(vectors: pa.Array) -> pa.Array:
            rows = coder.ints(_matrix(vectors, dim))
            found = [cells for at in range(0, len(rows), CELL_QUERIES) for cells in coder.probes(rows[at : at + CELL_QUERIES], probes).astype(np.int32)]
            return pa.array(found, type=pa.list_(pa.int32()))

        def meet(left: pa.Table, right: pa.Table) -> pa.Table:
            if not left.num_rows or not right.num_rows:
                return arrow.empty_table()
            vectors, ids, cell = _native(left["vec"], dim), _ids(left["qid"]), right["box"][0].as_py()
            best = Shortest(vectors, keep, left["limit"].to_numpy())
            chunk_ids, chunks = _ids(right["cid"]), _native(right["vec"], dim)
            codes = _matrix(right["codes"], len(coder.books)).astype(np.uint8)
            for first in range(0, len(chunks), TILE_ROWS):
                lot = slice(first, first + TILE_ROWS)
                decoded = coder.decoded(codes[lot])
                for at in range(0, len(vectors), QUERY_ROWS):
                    who = slice(at, at + QUERY_ROWS)
                    x = coder.ints(vectors[who].astype(np.float64)) - coder.centroids[cell]
                    _offer(best, who, squares(x, decoded), ids, chunk_ids[lot], chunks[lot], other_only)
            return best.result(ids, arrow)

        table = self.table.withColumn("box", F.col("cell"))
        laid = lay_out(table, "cid", parts_of(sizes_of(table), block_rows, dim), "chunk-blocks")
        travelling = written(asked.withColumn("cells", probed("vec")), "probes")
        nearest = travelling.select("qid", "vec", F.lit(float("inf")).alias("limit"), F.try_element_at("cells", F.lit(1)).alias("cell"))
        first = written(meet_in_blocks(nearest, table, block_rows, dim, meet, schema, laid), "nearest")
        # The longest estimate that is kept of the nearest cell; of fewer than ``keep`` there is no limit.
        place = F.row_number().over(Window.partitionBy("qid").orderBy("estimate", "cid"))
        limits = first.withColumn("_n", place).filter(F.col("_n") == keep).select("qid", F.col("estimate").alias("limit"))
        limited = travelling.join(limits, "qid", "left").withColumn("limit", F.coalesce("limit", F.lit(float("inf"))))
        others = limited.select("qid", "vec", "limit", F.explode(F.slice("cells", 2, max(1, probes))).alias("cell"))
        return first.unionByName(meet_in_blocks(others, table, block_rows, dim, meet, schema, laid))


def _offer(best: Shortest, who: slice, estimates: np.ndarray, query_ids: np.ndarray, ids: np.ndarray, chunks: np.ndarray, other_only: bool) -> None:
    if other_only:
        estimates[query_ids[who][:, None] == ids[None, :]] = np.inf
    best.add(who.start, estimates, ids, chunks)


def build_index(
    chunks: DataFrame, chunk_id: str = "id", vec: str = "text_embedding", dim: int = 768, cells: int | None = None, codes: int = CODES, run: int = RUN,
    rounds: int = ROUNDS, scale: float | None = None, probes: int | None = None, shortlist: int | None = None, target: float = TARGET, sample: int = TRAIN_ROWS,
) -> CellIndex:
    """An index of the chunks whose vectors fit; each vector is shuffled once, to its cell.

    Unless given, there are about as many cells as chunks in a cell, and ``probes`` and ``shortlist`` are measured for a
    recall of ``target`` among the nearest ``NEIGHBOURS``.
    """
    stored = _settled(_pick(chunks, chunk_id, vec, "cid"), "cid", dim)
    n = stored.count()
    coder = train(stored, dim, min(cells or int(np.ceil(np.sqrt(n))), MAX_CELLS), min(codes, 256), run, rounds, scale, sample)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = coder.ints(_matrix(batch.column("vec"), dim))
            cell = coder.cells(x)
            found = coder.codes(x, cell).astype(np.int16)
            ends = np.arange(len(x) + 1, dtype=np.int32) * found.shape[1]
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(found.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("cid"), pa.array(cell.astype(np.int32)), lists, batch.column("vec")], names=["cid", "cell", "codes", "vec"])

    kind = {f.name: f.dataType.simpleString() for f in stored.schema.fields}
    coded = stored.mapInArrow(encode, f"cid {kind['cid']}, cell int, codes array<smallint>, vec {kind['vec']}")
    # Small tables keep the cores busy as well.
    tasks = max(1, -(-n * dim * 4 // TASK_BYTES), min(chunks.sparkSession.sparkContext.defaultParallelism, n // BLOCK_ROWS))
    path = scratch_path(chunks.sparkSession, "cells")
    coded.repartitionByRange(tasks, "cell", "cid").sortWithinPartitions("cell", "cid").write.parquet(path)
    table = chunks.sparkSession.read.schema(coded.schema).parquet(path)
    index = CellIndex(table, coder, dim, probes or 1, shortlist or 1)
    if n and (probes is None or shortlist is None):
        needed = measure(index, stored, target)
        index.probes, index.shortlist = probes or needed[0], shortlist or needed[1]
    return index


def measure(index: CellIndex, stored: DataFrame, target: float) -> tuple[int, int]:
    """(cells to probe, estimates to rank) with which ``target`` of the true neighbours of a few vectors are found."""
    coder, dim = index.coder, index.dim
    # Not those that training begins with.
    asked = stored.orderBy(*hash_order("asked:")).limit(ASKED).select(F.col("cid").alias("qid"), "vec")
    head = asked.toArrow()
    query_ids, vectors = _ids(head["qid"]), _matrix(head["vec"], dim)
    true = _knn_broadcast(asked, head, stored, NEIGHBOURS, dim, True).select("qid", "cid")
    # ASKED * NEIGHBOURS rows.
    known = index.table.select("cid", "cell", "codes").join(F.broadcast(true), "cid").select("qid", "cell", "codes").collect()
    if not known:
        return 1, 1
    place = {q: n for n, q in enumerate(query_ids.tolist())}
    x = coder.ints(vectors)
    order = coder.probes(x)
    share = np.sqrt(target)
    ranks = [int(np.flatnonzero(order[place[r.qid]] == r.cell)[0]) + 1 for r in known]
    probes = int(np.quantile(ranks, share, method="higher"))
    limits = [[] for _ in query_ids]
    for r in known:
        limits[place[r.qid]].append(float(coder.estimates(x[place[r.qid]][None], r.cell, np.array([r.codes]))[0, 0]))
    shared = stored.sparkSession.sparkContext.broadcast((x, order[:, :probes], [np.sort(v) for v in limits], query_ids))

    def before(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x, probed, limits, query_ids = shared.value
        counts = [np.zeros(len(v), np.int64) for v in limits]
        for batch in batches:
            codes, ids = _matrix(batch.column("codes"), len(coder.books)).astype(np.uint8), _ids(batch.column("cid"))
            for cell, rows in _by_cell(batch.column("cell").to_numpy()):
                for q in np.flatnonzero((probed == cell).any(axis=1)):
                    estimate = np.sort(coder.estimates(x[q][None], cell, codes[rows[ids[rows] != query_ids[q]]])[0])
                    counts[q] += np.searchsorted(estimate, limits[q], "right")
        flat = np.concatenate(counts)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat), dtype=np.int32)), pa.array(flat)], names=["at", "n"])

    wanted = index.table.filter(F.col("cell").isin(np.unique(order[:, :probes]).tolist())) if probes < len(coder.centroids) else index.table
    ranked = [r.n for r in wanted.mapInArrow(before, "at int, n bigint").groupBy("at").agg(F.sum("n").alias("n")).collect()]
    return probes, max(NEIGHBOURS, int(np.quantile(ranked, share, method="higher")) if ranked else 1)
