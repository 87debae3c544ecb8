"""Line deduplication by range-partitioned hashes.

Each document hands in the hashes of its distinct lines with the places where they stand. The hashes are dealt out
by range of (hash, document), so that one very common line spreads over many tasks, and sorted by document within
the hash. A task streams each run of a hash: it holds at most ``min_docs`` rows back until the run is known to be
common. Only a run that touches the end of a range is left open; it is settled with the counts of its other parts,
two rows a range. The result is one compressed bitmap a document, saying which lines stay.

A document is a (doc_id, text) pair: rows repeated whole count once and are treated alike; null ids are kept apart
by their texts. Null and empty texts have one empty line. A line whose key is shorter than ``min_chars`` always
stays. An empty table gives an empty result. Columns other than those named are carried along untouched.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.llm.common import kept, packed, rows_of, text_key, unused

# Rows of keys in one range, some 100 MB.
RANGE_LINES = 2_000_000
KEYS = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("high", pa.int64()), ("low", pa.int64()), ("places", pa.binary()), ("n_lines", pa.int32())])
KEYS_DDL = "doc_id bigint, text_key bigint, high bigint, low bigint, places binary, n_lines int"
DROP, ASK, EDGE = 0, 1, 2
JUDGED = pa.schema([("kind", pa.int8()), ("range_no", pa.int32()), ("n_docs", pa.int64()), ("leads", pa.bool_()), *KEYS])
JUDGED_DDL = f"kind tinyint, range_no int, n_docs bigint, leads boolean, {KEYS_DDL}"


def line_key(line: bytes) -> bytes:
    """The line without ASCII white space at both ends, A-Z in lower case."""
    return line.strip(b" \t\n\x0b\x0c\r").lower()


def keys_of_lines(min_chars: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for doc_id, key, text in rows_of(batches, "doc_id", "text_key", "text"):
                lines = (text or "").encode().split(b"\n")
                places: dict[bytes, list[int]] = {}
                for at, line in enumerate(map(line_key, lines)):
                    places.setdefault(line, []).append(at)
                for line, where in places.items():
                    if line and (min_chars <= 1 or len(line.decode()) >= min_chars):
                        high, low = struct.unpack("<qq", xxhash.xxh3_128_digest(line))
                        yield doc_id, key, high, low, np.array(where, np.int32).tobytes(), len(lines)

        yield from packed(rows(), KEYS)

    return run


def judge_runs(min_docs: int, keep_first: bool):
    """Streams the sorted rows of a range and says of each run of a hash which rows lose their lines."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        range_no = TaskContext.get().partitionId()

        def told(kind: int, leads: bool, row: tuple, n: int) -> tuple:
            return (kind, range_no, n, leads, *row)

        def close(hash_: tuple, n: int, waiting: list, edge: bool) -> Iterator[tuple]:
            if edge:
                yield (EDGE, range_no, n, False, None, None, *hash_, None, None)
                for leads, row in waiting:
                    yield told(ASK, leads, row, n)

        def rows():
            current, last, n, first_run, waiting = None, None, 0, True, []
            for row in rows_of(batches, *KEYS.names):
                hash_, document = row[2:4], row[:2]
                if hash_ != current:
                    if current is not None:
                        yield from close(current, n, waiting, first_run)
                        first_run = False
                    current, last, n, waiting = hash_, None, 0, []
                if document == last:
                    continue  # a row repeated whole
                last, n = document, n + 1
                waiting.append((n == 1, row))
                if n >= min_docs:
                    # Whether the first row of a range is the first of all is open, as long as the run is.
                    still = [(leads, r) for leads, r in waiting if leads and keep_first]
                    for leads, r in waiting:
                        if not (leads and keep_first):
                            yield told(DROP, False, r, n)
                    waiting = still
                    if still and not first_run:
                        waiting = []
                        yield told(DROP, True, still[0][1], n)
            if current is not None:
                yield from close(current, n, waiting, True)

        yield from packed(rows(), JUDGED)

    return run


def to_bitmaps(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows():
        for doc_id, key, n_lines, lists in rows_of(batches, "doc_id", "text_key", "n_lines", "lists"):
            stays = np.ones(n_lines, np.uint8)
            stays[np.frombuffer(b"".join(lists), np.int32)] = 0
            yield doc_id, key, n_lines, int(n_lines - stays.sum()), zlib.compress(np.packbits(stays).tobytes())

    yield from packed(rows(), BITMAPS)


BITMAPS = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("n_lines", pa.int32()), ("n_dropped", pa.int32()), ("keep", pa.binary())])
BITMAPS_DDL = "doc_id bigint, text_key bigint, n_lines int, n_dropped int, keep binary"


def stays_of(bitmap: bytes | None, n_lines: int) -> np.ndarray:
    """True for each line that stays; no bitmap keeps all."""
    if bitmap is None:
        return np.ones(n_lines, bool)
    return np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8), count=n_lines).astype(bool)


def keyed(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    return df.select(F.col(doc_id).cast("bigint").alias("doc_id"), text_key(text).alias("text_key"), F.col(text).cast("string").alias("text"))


def line_bitmaps(df: DataFrame, min_docs: int = 10, min_chars: int = 1, keep_first: bool = False, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Keep bitmaps of the documents that lose lines: doc_id, text_key, n_lines, n_dropped, keep (zlib of packed bits).

    A key found in ``min_docs`` documents or more loses its lines in all of them; with ``keep_first`` its first
    line, by document and place, stays.
    """
    lines = kept(keyed(df, doc_id, text).mapInArrow(keys_of_lines(min_chars), KEYS_DDL), "lines")
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-lines.count() // RANGE_LINES))
    order = ["high", "low", "doc_id", "text_key"]
    ranged = lines.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    judged = kept(ranged.mapInArrow(judge_runs(min_docs, keep_first), JUDGED_DDL), "judged")
    edges = judged.filter(F.col("kind") == EDGE).groupBy("high", "low").agg(F.sum("n_docs").alias("total"), F.min("range_no").alias("first_range"))
    asked = judged.filter(F.col("kind") == ASK).join(edges.filter(F.col("total") >= min_docs), ["high", "low"])
    rest = F.expr("substring(places, 5)")
    whole = [F.col(c) for c in ("doc_id", "text_key", "n_lines")]
    dropped = judged.filter(F.col("kind") == DROP).select(*whole, F.when(F.col("leads"), rest).otherwise(F.col("places")).alias("places"))
    settled = asked.select(*whole, F.when(F.lit(keep_first) & F.col("leads") & (F.col("range_no") == F.col("first_range")), rest).otherwise(F.col("places")).alias("places"))
    return dropped.unionByName(settled).groupBy("doc_id", "text_key").agg(F.max("n_lines").alias("n_lines"), F.collect_list("places").alias("lists")).mapInArrow(to_bitmaps, BITMAPS_DDL).filter("n_dropped > 0")


def with_bitmaps(df: DataFrame, bitmaps: DataFrame, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, str]:
    """``df`` with each document's bitmap in a new column, whose name is returned."""
    key, keep = unused(df, "_text_key"), unused(df, "_keep")
    docs = df.withColumn(key, text_key(text))
    mark_doc, mark_key = unused(df, "_m_doc"), unused(df, "_m_key")
    marks = bitmaps.select(F.col("doc_id").alias(mark_doc), F.col("text_key").alias(mark_key), F.col("keep").alias(keep))
    same = docs[doc_id].cast("bigint").eqNullSafe(marks[mark_doc]) & (docs[key] == marks[mark_key])
    return docs.join(marks, same, "left").select(*df.columns, keep), keep


def drop_lines(df: DataFrame, bitmaps: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without the lines that the bitmaps drop; all their columns, in order. Null texts stay null."""
    joined, keep = with_bitmaps(df, bitmaps, doc_id, text)

    @F.pandas_udf("string")
    def rest(texts, keeps):
        return texts.combine(keeps, lambda t, k: t if k is None or t is None else "\n".join(np.array(t.split("\n"), object)[stays_of(k, t.count("\n") + 1)]))

    return joined.withColumn(text, F.when(F.col(keep).isNull(), F.col(text)).otherwise(rest(F.col(text), F.col(keep)))).select(*df.columns)


DIGEST = pa.schema([("doc_id", pa.int64()), ("n_lines", pa.int64()), ("n_dropped", pa.int64()), ("kept_sha256", pa.string())])


def digest(df: DataFrame, min_docs: int = 10, min_chars: int = 1, keep_first: bool = False) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256 of every document."""
    joined, keep = with_bitmaps(df.select("doc_id", "text"), line_bitmaps(df, min_docs, min_chars, keep_first))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for doc_id, text, bitmap in rows_of(batches, "doc_id", "text", keep):
                lines = (text or "").encode().split(b"\n")
                stays = stays_of(bitmap, len(lines))
                left = b"\n".join(line for line, s in zip(lines, stays.tolist()) if s)
                yield doc_id, len(lines), int(len(lines) - stays.sum()), hashlib.sha256(left).hexdigest()

        yield from packed(rows(), DIGEST)

    return joined.mapInArrow(run, "doc_id bigint, n_lines bigint, n_dropped bigint, kept_sha256 string")


ORACLE = """
WITH lines AS (
  SELECT doc_id, generate_subscripts(split, 1) AS n, unnest(split) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS split FROM documents)),
keyed AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
common AS (SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(common.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (WHERE common.key IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN common USING (key) GROUP BY doc_id"""
