"""What grows with the input: copies that are sent, memory of a batch, tasks of an index."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from folioflow.operators import blocks, bounds, cells, embed, metadata
from folioflow.operators import search as ks
from folioflow.streaming import pipeline


def peak(run):
    tracemalloc.start()
    try:
        run()
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_large_cells_are_not_sent_block_by_block(spark):
    """2,000 rows on both sides and blocks of 16 made 15,625 groups and 125 copies of each row."""
    def rows(name):
        return spark.range(2000).select(F.lit(1).alias("cell"), F.col("id").alias(name), F.array(F.col("id").cast("float")).alias("vec"))

    schema = "n bigint"

    def meet(left, right):
        return pa.table({"n": [left.num_rows * right.num_rows]})

    met = blocks.meet_in_blocks(rows("qid"), rows("cid"), 16, 1, meet, schema).collect()
    assert len(met) <= blocks.PARTS**2 and sum(r.n for r in met) == 2000**2


def test_blocks_stay_within_bytes(spark):
    parts = spark.range(1).select(blocks.n_parts(F.lit(10_000_000), 64, 768).alias("p"), blocks.n_parts(F.lit(100), 64, 768).alias("q")).first()
    assert 10_000_000 / parts.p * 768 * 4 <= blocks.BLOCK_BYTES and parts.q == 2


@pytest.mark.parametrize("dim", [64, 768])
def test_a_block_of_chunks_takes_little_memory(dim):
    """All queries of a span against all chunks of a batch, in double precision, took 400 MB."""
    draw = np.random.default_rng(1)
    queries, chunks = (draw.normal(size=(n, dim)).astype(np.float32) for n in (2048, 10_000))
    best = ks.BestSoFar(np.arange(2048), queries, 5, True)
    assert peak(lambda: best.add(np.arange(10_000), chunks)) < 120 << 20


def test_screened_pairs_are_those_of_double_precision():
    """Copies, ties in the sixth digit, offsets far from zero and limits from elsewhere."""
    draw = np.random.default_rng(2)
    for offset, spread in ((0, 1), (1000, 1e-2), (0, 1e-5), (0, 1e12)):
        chunks = (offset + spread * draw.normal(size=(3000, 20))).astype(np.float32)
        chunks[50:90] = chunks[50]
        best = ks.BestSoFar(np.arange(200), chunks[:200], 4, True)
        best.add(np.arange(3000), chunks)
        for q in (0, 50, 77, 199):
            dist = ks.round_half_up(np.sqrt(((chunks.astype(np.float64) - chunks[q]) ** 2).sum(axis=1)), 6)
            order = [i for i in np.lexsort((np.arange(3000), dist)) if i != q][:4]
            assert best.found[q][1].tolist() == order and best.found[q][0].tolist() == dist[order].tolist()


def test_own_rows_that_repeat_displace_no_neighbour():
    chunks = np.random.default_rng(5).normal(size=(40, 5))
    ids = np.arange(40) % 39
    chunks[39] = chunks[0] + 1e-3
    best = bounds.BoundedBest(ids[:1], chunks[:1], 3, True, bounds.Axes.fit(chunks))
    best.add_cells(ids, chunks, np.zeros(40, np.int32), lambda rows, found: np.zeros((len(rows), len(found))))
    far = np.sqrt(((chunks[1:39] - chunks[0]) ** 2).sum(axis=1))
    assert best.found[0][1].tolist() == (np.argsort(far)[:3] + 1).tolist()


def test_rows_that_come_twice_count_once_in_any_block(spark):
    data = np.random.default_rng(6).normal(size=(60, 5))
    rows = [(i, data[i].tolist()) for i in range(60)] + [(i, data[i].tolist()) for i in range(0, 60, 3)]
    far = np.sqrt(((data[:, None] - data[None]) ** 2).sum(axis=2))
    np.fill_diagonal(far, np.inf)
    df = spark.createDataFrame(rows, "id bigint, text_embedding array<double>")
    for block_rows in (8, 30, 1000):
        found = ks.knn(df, df, 4, "id", "id", dim=5, other_only=True, broadcast_bytes=0, block_rows=block_rows).collect()
        assert sorted((r.qid, r["rank"], r.cid) for r in found) == [(q, n + 1, int(c)) for q in range(60) for n, c in enumerate(np.argsort(far[q])[:4])]


def test_an_infinite_component_harms_no_other_row():
    chunks = np.random.default_rng(3).normal(size=(50, 6))
    chunks[7, 2] = np.inf
    best = ks.BestSoFar(np.arange(50), chunks, 2, True)
    best.add(np.arange(50), chunks)
    assert all(len(best.found[q][0]) == 2 and np.isfinite(best.found[q][0]).all() for q in range(50) if q != 7)


def test_queries_travel_once_to_a_group_of_cells(spark, monkeypatch):
    """A query that meets all 50 cells was sent 50 times."""
    draw = np.random.default_rng(4)
    df = spark.createDataFrame([(i, draw.normal(size=6).tolist()) for i in range(500)], "id bigint, text_embedding array<double>")
    sent, meet = [], bounds.meet_in_blocks

    def counted(queries, *rest):
        sent.append(queries.count())
        return meet(queries, *rest)

    monkeypatch.setattr(bounds, "meet_in_blocks", counted)
    found = ks.knn(df, df, 3, "id", "id", dim=6, other_only=True, broadcast_bytes=0, block_rows=10)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, ks.knn(df, df, 3, "id", "id", dim=6, other_only=True).collect()))
    assert sum(sent) <= 500 * 8


def test_an_index_has_a_file_for_every_few_thousand_vectors(spark):
    """A table of a few MB was one file, which one task searched for all queries."""
    vectors = spark.range(9000).select("id", F.transform(F.array(*[F.lit(i) for i in range(4)]), lambda i: F.rand(1).cast("float")).alias("text_embedding"))
    index = cells.build_index(vectors, dim=4, cells=6, rounds=1, probes=2, shortlist=8)
    assert len(index.table.inputFiles()) >= 2


def test_a_batch_of_texts_takes_little_more_than_its_vectors():
    """10,000 rows of 1,408 sums in double precision, several times over, took 900 MB."""
    words = pa.array([[f"w{i % 97}", f"v{i % 31}"] for i in range(10_000)])
    raw = pa.array([b"abc%d" % i for i in range(10_000)])
    whole = embed._unit_rows(embed._token_sums(words, 1408))
    found = []

    def run():
        found.append(embed._in_slices(1408, lambda some: embed._unit_rows(embed._token_sums(some, 1408)), words))

    assert peak(run) < 100 << 20
    assert (found[0] == whole).all()
    pairs = embed._in_slices(1408, lambda some: embed._unit_rows(embed._pair_sums(some, 1408)), raw)
    assert (pairs == embed._unit_rows(embed._pair_sums(raw, 1408))).all()


def test_words_are_counted_a_part_of_a_batch_at_a_time(monkeypatch):
    words = pa.array([["a", "b", "a"], None, [], ["c"] * 9, ["b", "a"]], pa.list_(pa.string()))
    sizes = words.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    for items in (1, 3, 4, 100):
        parts = list(embed.row_slices(sizes, 5, items))
        assert [i for s in parts for i in range(s.start, s.stop)] == list(range(5))
        assert all(sizes[s].sum() <= items or s.stop - s.start == 1 for s in parts)
        counted = pa.concat_arrays([metadata._count_words(words.slice(s.start, s.stop - s.start)) for s in parts])
        as_sets = [sorted((e["word"], e["tf"]) for e in row) for row in counted.to_pylist()]
        assert as_sets == [[("a", 2), ("b", 1)], [], [], [("c", 9)], [("a", 1), ("b", 1)]]


def test_common_words_meet_their_statistics_where_they_lie(spark, monkeypatch):
    """Statistics of more words than are shared: the same scores, and only rare words are shuffled to them."""
    rows = [(f"f{i}", "", 1, f"the w{i} of w{i % 3} the") for i in range(30)] + [("e", "", 1, "")]
    pages = spark.createDataFrame(rows, "source_file string, part string, page_num int, page_text string")
    given = spark.createDataFrame([("the", 30, 31), ("of", 30, 31), ("w1", 11, 31), ("w2", 11, 31), ("w7", 1, 31)], "word string, df bigint, total bigint")

    def scores(stats):
        found = metadata.keyword_scores(pages, ["source_file", "part", "page_num"], "page_text", stats)
        return sorted(map(tuple, found.collect()))

    whole = [scores(None), scores(given)]
    monkeypatch.setattr(metadata, "SHARED_WORDS", 2)
    assert [scores(None), scores(given)] == whole


def test_a_small_batch_of_events_does_not_shuffle_the_objects(spark):
    """Whatever Spark takes the batch's size for."""
    objects = spark.range(1000).selectExpr("'b' AS bucket", "concat('n', id) AS name", "'t' AS text")
    events = objects.filter("name < 'n2'").select("bucket", "name")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = pipeline.from_table(objects)(events)
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert found.count() == events.count()
