"""Benchmark decontamination by a positional inverted index.

The documents are indexed in segments: a task collects half a million words, numbers the terms and stores, for each
term, the ascending places of its words (as gaps), next to the places where the documents start. Segments are rows
of a table in the shared folder. A search reads each segment once: of every window of a benchmark item it takes the
rarest term's list and intersects it with the lists of the others, shifted by their offsets, in rising length. What
is left are exact phrases. Anchors of the rarest term that have all other terms within ``reach`` words count as
proximity matches. Benchmark items are searched in blocks of bounded size, so that a block can go to every task.

A null text has no words and no hits; an item without words has no window; items with one id count as one. Repeated
rows are repeated in the result. Empty tables give empty results (or no hits). Other columns are not looked at.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.llm.common import kept, packed, rows_of, scratch_path, text_key, unused

WINDOW = 13
REACH = 20
# Words between two documents that no window or reach gets across.
GAP = 64
SEGMENT_WORDS = 1 << 19
# Benchmark text searched at a time; this much goes to every task.
BLOCK_BYTES = 32 << 20

# Bytes of words stay (A-Z as a-z); all others become spaces. Bytes from 0x80 up are parts of letters.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(WORD_BYTES).split()


SEGMENTS = pa.schema([("doc_ids", pa.list_(pa.int64())), ("text_keys", pa.list_(pa.int64())), ("starts", pa.list_(pa.int32())), ("lengths", pa.list_(pa.int32())), ("terms", pa.binary()), ("counts", pa.binary()), ("gaps", pa.binary())])
SEGMENTS_DDL = "doc_ids array<bigint>, text_keys array<bigint>, starts array<int>, lengths array<int>, terms binary, counts binary, gaps binary"


def build_segments(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows():
        docs, held, at, term_no = [], [], 0, defaultdict(count().__next__)
        for doc_id, key, text in rows_of(batches, "doc_id", "text_key", "text"):
            found = words(text)
            docs.append((doc_id, key, at, len(found)))
            held.append(np.fromiter(map(term_no.__getitem__, found), np.int32, len(found)))
            at += len(found) + GAP
            if at >= SEGMENT_WORDS:
                yield segment(docs, held, term_no)
                docs, held, at, term_no = [], [], 0, defaultdict(count().__next__)
        if docs:
            yield segment(docs, held, term_no)

    yield from packed(rows(), SEGMENTS, 1)


def segment(docs: list[tuple], held: list[np.ndarray], term_no: dict[bytes, int]) -> tuple:
    starts = np.array([d[2] for d in docs], np.int64)
    lengths = np.array([d[3] for d in docs], np.int64)
    terms = np.concatenate(held)
    places = np.arange(len(terms)) + np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)
    order = np.argsort(terms, kind="stable")
    counts = np.bincount(terms, minlength=len(term_no)).astype(np.int32)
    by_term = places[order]
    gaps = np.diff(by_term, prepend=0)
    heads = (np.cumsum(counts) - counts)[counts > 0]
    gaps[heads] = by_term[heads]
    return [d[0] for d in docs], [d[1] for d in docs], starts.tolist(), lengths.tolist(), b" ".join(term_no), counts.tobytes(), gaps.astype(np.int32).tobytes()


def build_index(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Indexes every row of ``df``; the segments are written to the shared folder and read from there."""
    narrow = df.select(F.col(doc_id).cast("bigint").alias("doc_id"), text_key(text).alias("text_key"), F.col(text).cast("string").alias("text"))
    path = scratch_path(df.sparkSession, "postings")
    narrow.mapInArrow(build_segments, SEGMENTS_DDL).write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(SEGMENTS_DDL).parquet(path)


class Segment:
    """One segment's lists, decoded as they are asked for."""

    def __init__(self, terms: bytes, counts: bytes, gaps: bytes, wanted: set[bytes]):
        counts_ = np.frombuffer(counts, np.int32)
        self.gaps, self.ends = np.frombuffer(gaps, np.int32), np.cumsum(counts_)
        self.heads = self.ends - counts_
        self.sizes = counts_.tolist()
        self.term_no = {t: i for i, t in enumerate(terms.split(b" ")) if t in wanted} if terms else {}
        self.lists: dict[int, np.ndarray] = {}

    def places(self, term: int) -> np.ndarray:
        if term not in self.lists:
            self.lists[term] = np.cumsum(self.gaps[self.heads[term] : self.ends[term]], dtype=np.int64)
        return self.lists[term]


def phrase(index: Segment, window: list[int], reach: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the exact occurrences of a window, and anchors of its proximity matches."""
    order = sorted(range(len(window)), key=lambda i: index.sizes[window[i]])
    rarest = order[0]
    anchors = index.places(window[rarest])
    near = anchors
    for i in order[1:] if reach else []:
        if not len(near):
            break
        other = index.places(window[i])
        at = np.searchsorted(other, near - reach)
        near = near[(at < len(other)) & (other[np.minimum(at, len(other) - 1)] <= near + reach)]
    starts = (near if reach >= len(window) else anchors) - rarest
    for i in order[1:]:
        if not len(starts):
            break
        other, sought = index.places(window[i]), starts + i
        at = np.searchsorted(other, sought)
        starts = starts[(at < len(other)) & (other[np.minimum(at, len(other) - 1)] == sought)]
    return starts, near


HITS = pa.schema([("segment", pa.string()), ("doc_no", pa.int32()), ("doc_id", pa.int64()), ("text_key", pa.int64()), ("n_words", pa.int64()), ("hits", pa.binary()), ("items", pa.list_(pa.string())), ("near", pa.list_(pa.string()))])
HITS_DDL = "segment string, doc_no int, doc_id bigint, text_key bigint, n_words bigint, hits binary, items array<string>, near array<string>"


def search_segments(items: list[tuple[str, list[bytes]]], window: int, reach: int):
    """Each document with the places of its hit words and the items found in it."""
    wanted = {w for _, ws in items for w in ws}

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for name, doc_ids, keys, starts, lengths, terms, counts, gaps in rows_of(batches, "segment", *SEGMENTS.names, step=1):
                index = Segment(terms, counts, gaps, wanted)
                starts_, size = np.array(starts, np.int64), (starts[-1] + lengths[-1] + GAP)
                marks = np.zeros(size + 1, np.int32)
                found: dict[int, set[str]] = defaultdict(set)
                close: dict[int, set[str]] = defaultdict(set)
                done: dict[tuple, tuple] = {}
                for item, ws in items:
                    numbers = [index.term_no.get(w, -1) for w in ws]
                    width = min(window, len(ws))
                    missing = np.concatenate([[0], np.cumsum(np.array(numbers) < 0)])
                    for at in np.flatnonzero(missing[width:] == missing[: len(ws) - width + 1]).tolist():
                        asked = tuple(numbers[at : at + width])
                        if asked not in done:
                            at_, near = phrase(index, list(asked), reach)
                            np.add.at(marks, at_, 1)
                            np.add.at(marks, at_ + width, -1)
                            done[asked] = tuple(np.unique(np.searchsorted(starts_, x, "right") - 1).tolist() for x in (at_, near))
                        for d in done[asked][0]:
                            found[d].add(item)
                        for d in done[asked][1]:
                            close[d].add(item)
                hit = np.cumsum(marks) > 0
                for n, (doc_id, key, start, length) in enumerate(zip(doc_ids, keys, starts, lengths)):
                    places = np.flatnonzero(hit[start : start + length]).astype(np.int32) if n in found else np.zeros(0, np.int32)
                    yield name, n, doc_id, key, length, places.tobytes(), sorted(found.get(n, ())), sorted(close.get(n, ()))

        yield from packed(rows(), HITS)

    return run


def blocks_of(items: DataFrame, item_id: str, text: str) -> Iterator[list[tuple[str, list[bytes]]]]:
    """The items with words, in blocks that each fit a task."""
    narrow = items.select(F.col(item_id).cast("string").alias("item"), F.col(text).cast("string").alias("text"))
    total = narrow.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-total // BLOCK_BYTES) or 1
    for k in range(n):
        part = narrow.filter(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == k).collect()
        yield [(r.item or "", ws) for r in part if (ws := words(r.text))]


def find(index: DataFrame, items: DataFrame, window: int = WINDOW, reach: int = REACH, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """doc_id, text_key, n_words, n_hit, items (exact phrases), near (proximity) for every indexed document."""
    if not 0 <= reach < GAP - window:
        raise ValueError(f"reach must be below {GAP - window}")
    named = index.withColumn("segment", F.sha2(F.concat(F.hash("doc_ids", "text_keys").cast("string"), F.lit(":"), F.monotonically_increasing_id().cast("string")), 256))
    parts = [named.mapInArrow(search_segments(block, window, reach), HITS_DDL) for block in blocks_of(items, item_id, text)]
    if len(parts) == 1:
        return parts[0].select("doc_id", "text_key", "n_words", F.expr("octet_length(hits) div 4").alias("n_hit"), "items", "near")
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)

    @F.pandas_udf("bigint")
    def together(lists):
        return lists.map(lambda x: len(np.unique(np.frombuffer(b"".join(x), np.int32))))

    def names(column: str):
        return F.array_sort(F.array_distinct(F.flatten(F.collect_list(column)))).alias(column)

    merged = whole.groupBy("segment", "doc_no").agg(*(F.first(c).alias(c) for c in ("doc_id", "text_key", "n_words")), F.collect_list("hits").alias("hits"), names("items"), names("near"))
    return merged.select("doc_id", "text_key", "n_words", together("hits").alias("n_hit"), "items", "near")


def verdicts(df: DataFrame, items: DataFrame, window: int = WINDOW, reach: int = REACH) -> DataFrame:
    """``find`` over ``df`` with ``contaminated``: hit words are a twentieth of the words or more."""
    found = find(build_index(df), items, window, reach)
    return found.withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def without_contaminated(df: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``df`` that are not contaminated; all their columns."""
    key = unused(df, "_text_key")
    docs = df.withColumn(key, text_key(text))
    named = df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    bad = kept(verdicts(named, items).filter("contaminated").select(F.col("doc_id").alias("_b_doc"), F.col("text_key").alias("_b_key")), "contaminated")
    same = docs[doc_id].cast("bigint").eqNullSafe(bad["_b_doc"]) & (docs[key] == bad["_b_key"])
    return docs.join(bad, same, "left_anti").select(*df.columns)


def digest(df: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every document."""
    n_items, shown = F.size("items").cast("bigint").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256")
    return verdicts(df, items).select("doc_id", "n_words", "n_hit", n_items, shown, "contaminated")


# Proximity matches are left to a brute-force test.
ORACLE = f"""
WITH lowered AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
docs AS (SELECT doc_id, regexp_extract_all(t, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM lowered),
items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
starts AS (SELECT item_id, w, least(len(w), {WINDOW}) AS size, unnest(range(1, len(w) - least(len(w), {WINDOW}) + 2)) AS i FROM items WHERE len(w) > 0),
windows AS (SELECT DISTINCT item_id, size, array_to_string(w[i:i + size - 1], ' ') AS said FROM starts),
sizes AS (SELECT DISTINCT size FROM windows),
places AS (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM docs, sizes WHERE len(w) >= size),
found AS (
  SELECT doc_id, item_id, i, p.size FROM (SELECT doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') AS said FROM places) p
  JOIN windows v ON p.size = v.size AND p.said = v.said),
hit AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS place FROM found) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)"""
