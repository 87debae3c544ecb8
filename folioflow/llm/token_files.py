"""Token ids in Simple-8b blocks.

Documents are dealt out by range of doc_id and sorted, tokenised, and written in blocks: rows of a Parquet data set
in a shared folder. A block holds the ids of whole documents as 64-bit words, each a 4-bit selector and 60 bits that
it divides among 1 to 60 ids of equal width. An id of over 60 bits is an escape: a word of its own selector that
points into the block's list of escaped ids. Every ``STRIDE`` words the block notes how many ids come before, so that
a reader can start in the middle; decoding expands all words of one selector at a time.

Ranges are cut by bytes, not rows, and through runs of equal rows. Blocks are numbered by range, and a range's first
id position follows from the sizes of those before it, one row a range. Null and empty texts have the end id only. Documents of one id follow each other by their text; repeated rows
are kept. A document longer than a block is a block of its own. An empty table gives an empty data set.
"""

from __future__ import annotations

import os
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.llm.common import packed, rows_of, scratch_path, text_key

# Selector s packs COUNTS[s] ids of WIDTHS[s] bits; the last stands for an escaped id.
COUNTS = (60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1, 1)
WIDTHS = (1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60, 0)
ESCAPE = len(COUNTS) - 1
BLOCK_IDS = 1 << 15
STRIDE = 256
END_ID = 1
# Text of one range; a range is tokenised by one task, which remembers the words that it has met.
RANGE_BYTES = 112 << 20
PIECES_KEPT = 850_000
ROW_BYTES = 16
# Rows sampled for a range's bounds, and in all: 32 MB on the driver.
SAMPLED = 400
MOST_SAMPLED = 1_000_000


def bit_widths(ids: np.ndarray) -> np.ndarray:
    """Bits that each id needs, one at least."""
    widths = np.ones(len(ids), np.int8)
    for power in (32, 16, 8, 4, 2, 1):
        big = ids >> np.uint64(power) > 0
        widths += np.int8(power) * big.astype(np.int8)
        ids = np.where(big, ids >> np.uint64(power), ids)
    return widths


def pack(ids: np.ndarray) -> tuple[bytes, bytes, bytes]:
    """(words, escaped ids, ids before every STRIDE words) of a block."""
    ids = np.asarray(ids, np.uint64)
    n = len(ids)
    widths = bit_widths(ids).astype(np.int16)
    escaped = widths > 60
    widths[escaped] = 99
    # Widest id among the next COUNTS[s], by running maxima of growing reach.
    choice = np.full(n, ESCAPE - 1, np.int8)
    reach, widest = 1, widths
    for s in range(ESCAPE - 1, -1, -1):
        size = COUNTS[s]
        while reach < size:
            step = min(reach, size - reach)
            ahead = np.concatenate([widest[step:], np.full(min(step, n), 99, np.int16)])[:n]
            widest, reach = np.maximum(widest, ahead), reach + step
        choice[widest <= WIDTHS[s]] = s
    choice[escaped] = ESCAPE
    jump = np.array(COUNTS)[choice].tolist()
    starts, at = [], 0
    while at < n:
        starts.append(at)
        at += jump[at]
    starts = np.array(starts, np.int64)
    picked = choice[starts]
    words = picked.astype(np.uint64) << np.uint64(60)
    for s in np.unique(picked).tolist():
        rows = np.flatnonzero(picked == s)
        if s == ESCAPE:
            words[rows] |= np.arange(len(rows), dtype=np.uint64)
            continue
        group = ids[starts[rows][:, None] + np.arange(COUNTS[s])]
        shifts = (np.arange(COUNTS[s]) * WIDTHS[s]).astype(np.uint64)
        words[rows] |= np.bitwise_or.reduce(group << shifts, axis=1)
    return words.tobytes(), ids[escaped].tobytes(), starts[::STRIDE].astype(np.uint32).tobytes()


def unpack(words: bytes, escapes: bytes, offsets: bytes, start: int = 0, end: int | None = None) -> np.ndarray:
    """Ids ``start`` to ``end`` of a block; words before the nearest offset are not looked at."""
    packed_, marks = np.frombuffer(words, np.uint64), np.frombuffer(offsets, np.uint32)
    if not len(packed_):
        return np.zeros(0, np.uint64)
    skip = max(0, int(np.searchsorted(marks, start, "right")) - 1)
    stop = len(packed_) if end is None else min(len(packed_), int(np.searchsorted(marks, end, "left")) * STRIDE)
    packed_ = packed_[skip * STRIDE : max(stop, skip * STRIDE)]
    selectors = (packed_ >> np.uint64(60)).astype(np.int64)
    sizes = np.array(COUNTS)[selectors]
    ends = np.cumsum(sizes)
    out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint64)
    escaped = np.frombuffer(escapes, np.uint64)
    for s in np.unique(selectors).tolist():
        rows = np.flatnonzero(selectors == s)
        body = packed_[rows] & np.uint64((1 << 60) - 1)
        if s == ESCAPE:
            out[(ends - sizes)[rows]] = escaped[body.astype(np.int64)]
            continue
        shifts = (np.arange(COUNTS[s]) * WIDTHS[s]).astype(np.uint64)
        values = (body[:, None] >> shifts) & np.uint64((1 << WIDTHS[s]) - 1)
        out[(ends - sizes)[rows][:, None] + np.arange(COUNTS[s])] = values
    first = int(marks[skip])
    return out[start - first : None if end is None else end - first]


class Tokens:
    """Ids of texts by a tokenizer that looks at words apart; each distinct word is given to the library once.

    The tokenizer lower-cases and drops white space, and none of its words reaches over white space. So a text can be
    cut at spaces, and the signs between a letter and white space be cut off, without changing any id. A text that may
    hold the literal of an added token, in any case, goes to the library whole; ``special`` maps it to the token's id,
    as the library does when it is loaded, and else it is text.
    """

    LOWER = bytes(32 if b in (9, 10, 11, 12, 13) else b + 32 if 65 <= b <= 90 else b for b in range(256))
    SIGNS = re.compile(rb"(?<=[a-z])[!-/:-@\[-`{-~]+\Z")
    BETWEEN = b"\x00"

    def __init__(self, path: str, kept_pieces: int = PIECES_KEPT, special: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = not special
        self.literals = [t.content.encode().translate(self.LOWER) for t in self.library.get_added_tokens_decoder().values()]
        self.mark = self.library.encode(self.BETWEEN.decode(), add_special_tokens=False).ids
        self.known: dict[bytes, bytes] = {}
        self.signed: list[bytes] = []
        self.limit = kept_pieces

    def meet(self, pieces: set[bytes]) -> None:
        """Knows the ids of all ``pieces`` from here on; those with signs behind a letter are put together of two."""
        known = self.known
        if len(known) + len(pieces) > self.limit:
            for piece in self.signed:
                del known[piece]
            self.signed = []
            if len(known) + len(pieces) > self.limit:
                known.clear()
        new = pieces.difference(known)
        cut = [(p, m.start()) for p, m in zip(new, map(self.SIGNS.search, new)) if m]
        new.difference_update(p for p, _ in cut)
        new.update(part for p, at in cut for part in (p[:at], p[at:]) if part not in known)
        if new:
            self.learn(list(new))
        for piece, at in cut:
            known[piece] = known[piece[:at]] + known[piece[at:]]
            self.signed.append(piece)

    def learn(self, pieces: list[bytes]) -> None:
        odd = [p for p in pieces if self.BETWEEN in p or len(p) > 256]
        plain = [p for p in pieces if not (self.BETWEEN in p or len(p) > 256)] if odd else pieces
        for at in range(0, len(plain), 2000):
            some = plain[at : at + 2000]
            said = (b" " + self.BETWEEN + b" ").join(some).decode()
            ids = np.array(self.library.encode_batch_fast([said], add_special_tokens=False)[0].ids, np.uint32)
            cuts = np.flatnonzero(ids == self.mark[0])
            if len(self.mark) != 1 or len(cuts) != len(some) - 1:
                odd = odd + some
                continue
            raw, start = ids.tobytes(), 0
            for piece, cut in zip(some, [*(cuts * 4).tolist(), len(raw)]):
                self.known[piece] = raw[start:cut]
                start = cut + 4
        for piece in odd:
            self.known[piece] = np.array(self.library.encode(piece.decode(), add_special_tokens=False).ids, np.uint32).tobytes()

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        lowered = [(t or "").encode().translate(self.LOWER) for t in texts]
        special = {i for i, t in enumerate(lowered) if any(x in t for x in self.literals)}
        cut = [[] if i in special else t.split() for i, t in enumerate(lowered)]
        self.meet(set().union(*cut))
        known = self.known
        whole = {i: np.array(self.library.encode(texts[i], add_special_tokens=False).ids, np.uint32).tobytes() for i in special}
        return [whole[i] if i in special else b"".join(map(known.__getitem__, pieces)) for i, pieces in enumerate(cut)]


BLOCKS = pa.schema([("range_no", pa.int32()), ("block_no", pa.int32()), ("start", pa.int64()), ("n_ids", pa.int32()), ("doc_ids", pa.list_(pa.int64())), ("doc_ends", pa.list_(pa.int32())), ("offsets", pa.binary()), ("words", pa.binary()), ("escapes", pa.binary())])
BLOCKS_DDL = "range_no int, block_no int, start bigint, n_ids int, doc_ids array<bigint>, doc_ends array<int>, offsets binary, words binary, escapes binary"


def write_blocks(path: str, end_id: int, special: bool = False):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        range_no, tokens = TaskContext.get().partitionId(), Tokens(path, special=special)
        end = np.array([end_id], np.uint32).tobytes()

        def texts() -> Iterator[tuple]:
            held, size = [], 0
            for row in rows_of(batches, "doc_id", "text"):
                held.append(row)
                size += len(row[1] or "")
                if size > 1 << 20 or len(held) >= 512:
                    yield from zip((d for d, _ in held), tokens.encode([t for _, t in held]))
                    held, size = [], 0
            yield from zip((d for d, _ in held), tokens.encode([t for _, t in held]))

        def rows():
            docs, ends, held, size, start, no = [], [], [], 0, 0, 0
            for doc_id, raw in texts():
                n = len(raw) // 4 + 1
                if docs and size + n > BLOCK_IDS:
                    yield block(range_no, no, start, docs, ends, held)
                    start, no = start + size, no + 1
                    docs, ends, held, size = [], [], [], 0
                size += n
                docs.append(doc_id)
                ends.append(size)
                held += [raw, end]
            if docs:
                yield block(range_no, no, start, docs, ends, held)

        yield from packed(rows(), BLOCKS, 16)

    return run


def block(range_no: int, no: int, start: int, docs: list, ends: list[int], held: list[bytes]) -> tuple:
    words, escapes, offsets = pack(np.frombuffer(b"".join(held), np.uint32).astype(np.uint64))
    return range_no, no, start, ends[-1], docs, ends, offsets, words, escapes


def range_numbers(rows: DataFrame, total: int, n: int, sample: int) -> Column:
    """Which of ``n`` ranges of (doc_id, key, salt) a row lies in; ranges hold about as many bytes each.

    Some ``sample`` rows are drawn, the larger the likelier, and cut into parts of equal bytes. The salt splits a run of
    equal rows.
    """
    step = max(total, 1) / sample
    drawn = rows.where(F.pmod(F.xxhash64("doc_id", "key", "salt"), F.lit(1 << 40)) < F.col("size") / step * float(1 << 40))
    ids, *rest = (c.to_pylist() for c in drawn.select("doc_id", "key", "salt", "size").toArrow().columns)
    order = sorted(zip((d is not None for d in ids), (d or 0 for d in ids), *rest))
    # A row smaller than a step stands for a step, a larger one for itself.
    ends = np.cumsum([max(row[-1], step) for row in order])
    bounds = [order[i][:-1] for i in np.searchsorted(ends, ends[-1] / n * np.arange(1, n))] if order else []
    shared = rows.sparkSession.sparkContext.broadcast((sum(not b[0] for b in bounds), np.array([b[1] for b in bounds], np.int64), bounds))

    @F.arrow_udf("int")
    def number(doc_id: pa.Array, key: pa.Array, salt: pa.Array) -> pa.Array:
        n_null, ids, bounds = shared.value
        known, doc = doc_id.is_valid().to_numpy(zero_copy_only=False), doc_id.fill_null(0).to_numpy(zero_copy_only=False)
        low = np.where(known, n_null + np.searchsorted(ids[n_null:], doc, "left"), 0)
        high = np.where(known, n_null + np.searchsorted(ids[n_null:], doc, "right"), n_null)
        key, salt = key.to_numpy(zero_copy_only=False), salt.to_numpy(zero_copy_only=False)
        for i in np.flatnonzero(low < high):
            low[i] = bisect_right(bounds, (bool(known[i]), int(doc[i]), int(key[i]), int(salt[i])), int(low[i]), int(high[i]))
        return pa.array(low.astype(np.int32))

    return number("doc_id", "key", "salt")


def write(df: DataFrame, tokenizer: str, to: str, end_id: int = END_ID, doc_id: str = "doc_id", text: str = "text", special: bool = False, range_bytes: int = RANGE_BYTES) -> None:
    """Writes the ids of every row of ``df``, in ascending doc_id order, to the folder ``to``."""
    docs = df.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"), text_key(text).alias("key"))
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(df.sparkSession.sparkContext.defaultParallelism, -(-total // range_bytes))
    # A row weighs at least what its place in a block takes.
    weighed = docs.withColumns({"size": F.coalesce(F.octet_length("text"), F.lit(0)) + ROW_BYTES, "salt": F.monotonically_increasing_id()})
    ranged = weighed.withColumn("range", range_numbers(weighed, total, n, min(SAMPLED * n, MOST_SAMPLED)))
    ordered = ranged.select("range", "doc_id", "key", "text").repartitionById(n, "range").sortWithinPartitions("doc_id", "key").select("doc_id", "text")
    ordered.mapInArrow(write_blocks(tokenizer, end_id, special), BLOCKS_DDL).write.option("compression", "uncompressed").parquet(to)


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """The blocks of a folder, with ``base``: the position of the range's first id."""
    blocks = spark.read.schema(BLOCKS_DDL).parquet(path)
    sizes = blocks.groupBy("range_no").agg(F.sum("n_ids").alias("n")).orderBy("range_no").collect()  # a row a range
    bases, total = {}, 0
    for range_no, n in sizes:
        bases[range_no], total = total, total + n
    known = spark.createDataFrame(list(bases.items()), "range_no int, base bigint")
    return blocks.join(F.broadcast(known), "range_no")


DOCS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("ids", pa.list_(pa.int64()))])


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, ids of every document of a folder."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from packed(((d, s, ids.astype(np.int64)) for d, s, ids in documents(batches)), DOCS, 64)

    return read_blocks(spark, path).mapInArrow(run, "doc_id bigint, start bigint, ids array<bigint>")


def documents(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    """(doc_id, start, ids) of the documents of blocks."""
    for base, start, docs, ends, offsets, words, escapes in rows_of(batches, "base", "start", "doc_ids", "doc_ends", "offsets", "words", "escapes", step=8):
        ids, begin = unpack(words, escapes, offsets), 0
        for doc_id, end in zip(docs, ends):
            yield doc_id, base + start + begin, ids[begin:end]
            begin = end


DIGEST = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])


def digest(df: DataFrame, tokenizer: str, special: bool = False) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files that are written first."""
    path = scratch_path(df.sparkSession, "tokens")
    write(df, tokenizer, path, special=special)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from packed(((d, s, len(ids), zlib.crc32(ids.astype("<u4").tobytes())) for d, s, ids in documents(batches)), DIGEST)

    return read_blocks(df.sparkSession, path).mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
