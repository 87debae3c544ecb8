"""SimHash near-duplicates with a hierarchical index over Gray-ordered fingerprints.

Fingerprints are sorted by Gray rank, so that neighbours share many bits. The sorted run is cut into groups and the
groups into groups; an upper node keeps the bits that all below it share (a mask and a pattern), a lower node only
those that its parent does not have already. A search starts at the top with all fingerprints, adds up the
differences to the shared bits on its way down and gives up a whole group once they exceed the limit.

Two fingerprints that differ in at most three of 64 bits agree in two of five bit blocks at least. The index is
therefore kept in ten orders, each with another two blocks in front; the two leading blocks are the top nodes, and a
link is found below one of them. The ten orders are range-partitioned together by (order, Gray rank), so that a very
common leading pattern spreads over tasks; pieces of one top node that lie apart are joined as nodes, unless their
shared bits already differ too much. Only distinct fingerprints are indexed, and only links that join two groups
leave a task, so many near copies cost no list of pairs. Groups grow together over the tasks by alternating stars.

A null or empty text has the fingerprint zero and is linked like any other. Rows of one id are documents of their
own; a component's id is its smallest doc_id (null ids only if it has no other). Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.llm.common import kept, packed, rows_of, text_key, unused

BITS = 3
SHINGLE = 3
SEED = 42
# Widths of the bit blocks. With BITS + 2 blocks, two are equal in any linked pair.
BLOCKS = (13, 13, 13, 13, 12)
LEAD = 2
# Fingerprints of one searched group; longer runs are cut and joined as nodes.
GROUP = 2048
FAN_OUT = 8
SMALL = 16
SIGN = np.uint64(1 << 63)

ORDERS = [(*lead, *(b for b in range(len(BLOCKS)) if b not in lead)) for lead in combinations(range(len(BLOCKS)), LEAD)]
LEAD_BITS = [sum(BLOCKS[b] for b in order[:LEAD]) for order in ORDERS]


def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """The 64-bit SimHash over the word shingles of a text, as a signed number."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = map(b" ".join, zip(*(words[i:] for i in range(size)))) if len(words) >= size else iter([b" ".join(words)])
    hashed = np.frombuffer(b"".join(map(partial(xxhash.xxh64_digest, seed=SEED), shingles)), np.uint8)
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashed), 8 << 15):
        counts += np.unpackbits(hashed[at : at + (8 << 15)].reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.frombuffer(np.packbits(counts * 2 > len(hashed) // 8).tobytes(), ">i8")[0])


PRINTS = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("print", pa.int64())])


def fingerprints(df: DataFrame, size: int = SHINGLE, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, text_key, print of every row, written once."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from packed(((d, k, fingerprint(t, size)) for d, k, t in rows_of(batches, "doc_id", "text_key", "text")), PRINTS)

    narrow = df.select(F.col(doc_id).cast("bigint").alias("doc_id"), text_key(text).alias("text_key"), F.col(text).cast("string").alias("text"))
    return kept(narrow.mapInArrow(run, "doc_id bigint, text_key bigint, print bigint"), "prints")


def reordered(values: np.ndarray, order: tuple[int, ...]) -> np.ndarray:
    """The bit blocks of the values, in another order."""
    shift = dict(zip(range(len(BLOCKS)), np.cumsum(BLOCKS[::-1])[::-1] - np.array(BLOCKS)))
    out = np.zeros_like(values)
    for b in order:
        width = np.uint64(BLOCKS[b])
        out = (out << width) | (values >> np.uint64(shift[b])) & ((np.uint64(1) << width) - np.uint64(1))
    return out


def restored(values: np.ndarray, order: tuple[int, ...]) -> np.ndarray:
    """The inverse of ``reordered``."""
    out, at = np.zeros_like(values), 64
    shift = dict(zip(range(len(BLOCKS)), np.cumsum(BLOCKS[::-1])[::-1] - np.array(BLOCKS)))
    for b in order:
        at -= BLOCKS[b]
        out |= ((values >> np.uint64(at)) & np.uint64((1 << BLOCKS[b]) - 1)) << np.uint64(shift[b])
    return out


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Place of each code in Gray order."""
    ranks = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        ranks ^= ranks >> np.uint64(shift)
    return ranks


def gray_code(ranks: np.ndarray) -> np.ndarray:
    return ranks ^ (ranks >> np.uint64(1))


RANKED = pa.schema([("order_no", pa.int32()), ("rank", pa.int64())])


def in_orders(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each fingerprint's Gray rank in each of the orders; ranks are shifted so that signed numbers sort like them."""
    for batch in batches:
        prints = batch.column("print").to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
        for no, order in enumerate(ORDERS):
            ranks = (gray_rank(reordered(prints, order)) ^ SIGN).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ranks), no, np.int32)), pa.array(ranks)], schema=RANKED)


class Groups:
    """Union of places: every place points at the first of its group."""

    def __init__(self, size: int):
        self.first = np.arange(size)

    def link(self, left: np.ndarray, right: np.ndarray) -> None:
        while len(left):
            a, b = self.first[left], self.first[right]
            low, high = np.minimum(a, b), np.maximum(a, b)
            apart = low < high
            if not apart.any():
                return
            left, right = left[apart], right[apart]
            np.minimum.at(self.first, high[apart], low[apart])
            while not np.array_equal(up := self.first[self.first], self.first):
                self.first = up


def shared(codes: np.ndarray, fan_out: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Levels of (mask, pattern) from the leaves up: the bits that ``fan_out`` neighbours below share."""
    ones, zeros, levels = codes, ~codes, []
    levels.append((ones | zeros, ones))
    while len(ones) > 1:
        heads = np.arange(0, len(ones), fan_out)
        ones, zeros = np.bitwise_and.reduceat(ones, heads), np.bitwise_and.reduceat(zeros, heads)
        levels.append((ones | zeros, ones))
    return levels


def search(queries: np.ndarray, codes: np.ndarray, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (query, code) within ``bits`` differences, found from the top of the codes' index down."""
    levels = shared(codes, FAN_OUT)
    for at in range(0, len(queries), 256):
        block = queries[at : at + 256]
        asks, nodes = np.arange(len(block)), np.zeros(len(block), np.int64)
        mask, pattern = levels[-1]
        off = np.bitwise_count(mask[0] & (block ^ pattern[0])).astype(np.int64)
        for level in range(len(levels) - 1, -1, -1):
            near = off <= bits
            asks, nodes, off = asks[near], nodes[near], off[near]
            if level == 0 or not len(asks):
                break
            below_mask, below_pattern = levels[level - 1]
            mask = levels[level][0]
            kids = (nodes[:, None] * FAN_OUT + np.arange(FAN_OUT)).ravel()
            asks, off, up = np.repeat(asks, FAN_OUT), np.repeat(off, FAN_OUT), np.repeat(nodes, FAN_OUT)
            there = kids < len(below_mask)
            asks, off, up, nodes = asks[there], off[there], up[there], kids[there]
            own = below_mask[nodes] & ~mask[up]
            off = off + np.bitwise_count(own & (block[asks] ^ below_pattern[nodes]))
        yield asks + at, nodes


STARS = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("order_no", pa.int32()), ("lead", pa.int64()), ("node", pa.int64()), ("mask", pa.int64()), ("pattern", pa.int64()), ("codes", pa.binary())])
STARS_DDL = "a bigint, b bigint, order_no int, lead bigint, node bigint, mask bigint, pattern bigint, codes binary"


def star_rows(codes: np.ndarray, orders: np.ndarray, groups: Groups) -> Iterator[tuple]:
    """(fingerprint, first of its group) for all that are not the first themselves."""
    at = np.flatnonzero(groups.first != np.arange(len(codes)))
    for no in np.unique(orders[at]).tolist():
        mine = at[orders[at] == no]
        own = restored(codes[mine], ORDERS[no]).view(np.int64).tolist()
        firsts = restored(codes[groups.first[mine]], ORDERS[no]).view(np.int64).tolist()
        yield from ((a, b, None, None, None, None, None, None) for a, b in zip(own, firsts))


def search_runs(bits: int):
    """Links within the runs of equal leading blocks; runs that may go on elsewhere also come back as nodes."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), 0

        def node(codes: np.ndarray, no: int) -> tuple:
            nonlocal seen
            seen += 1
            ones, zeros = np.bitwise_and.reduce(codes), np.bitwise_and.reduce(~codes)
            lead = int(codes[0] >> np.uint64(64 - LEAD_BITS[no]))
            return (None, None, no, lead, part << 32 | seen, int((ones | zeros).view(np.int64)), int(ones.view(np.int64)), codes.tobytes())

        def solve(orders: np.ndarray, codes: np.ndarray, leads: np.ndarray) -> Iterator[tuple]:
            groups = Groups(len(codes))
            heads = np.flatnonzero(np.concatenate([[True], (orders[1:] != orders[:-1]) | (leads[1:] != leads[:-1])]))
            sizes = np.diff(heads, append=len(codes))
            small = np.repeat(sizes <= SMALL, sizes)
            run_no = np.repeat(np.arange(len(heads)), sizes)
            for step in range(1, int(min(SMALL, sizes.max()))):
                left = np.flatnonzero((run_no[:-step] == run_no[step:]) & small[:-step])
                left = left[np.bitwise_count(codes[left] ^ codes[left + step]) <= bits]
                groups.link(left, left + step)
            for i in np.flatnonzero(sizes > SMALL).tolist():
                own = codes[heads[i] : heads[i] + sizes[i]]
                for left, right in search(own, own, bits):
                    groups.link(left + heads[i], right + heads[i])
            yield from star_rows(codes, orders, groups)

        def rows():
            none = np.zeros(0, np.uint64)
            orders, codes, open_ = np.zeros(0, np.int32), none, True  # open_: the first run may have begun elsewhere

            def leads_of(orders: np.ndarray, codes: np.ndarray) -> np.ndarray:
                return codes >> (64 - np.array(LEAD_BITS, np.uint64)[orders]).astype(np.uint64)

            for batch in batches:
                orders = np.concatenate([orders, batch.column("order_no").to_numpy(zero_copy_only=False)])
                new = batch.column("rank").to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64) ^ SIGN
                codes = np.concatenate([codes, gray_code(new)])
                if not len(codes):
                    continue
                leads = leads_of(orders, codes)
                changes = np.flatnonzero((orders[1:] != orders[:-1]) | (leads[1:] != leads[:-1])) + 1
                if len(changes):
                    last, first = int(changes[-1]), int(changes[0])
                    told, open_ = open_, False
                    if told:
                        yield from (node(codes[at : min(at + GROUP, first)], int(orders[0])) for at in range(0, first, GROUP))
                    yield from pieces(orders[:last], codes[:last], leads[:last], told)
                    orders, codes = orders[last:], codes[last:]
                while len(codes) > GROUP:
                    open_ = True
                    yield node(codes[:GROUP], int(orders[0]))
                    yield from solve(orders[:GROUP], codes[:GROUP], np.zeros(GROUP, np.uint64))
                    orders, codes = orders[GROUP:], codes[GROUP:]
            if len(codes):
                yield node(codes, int(orders[0]))
                yield from solve(orders, codes, np.zeros(len(codes), np.uint64))

        def pieces(orders: np.ndarray, codes: np.ndarray, leads: np.ndarray, told: bool) -> Iterator[tuple]:
            """Whole runs; one too long for a group is cut and its parts are nodes, as those of the first may be already."""
            heads = np.flatnonzero(np.concatenate([[True], (orders[1:] != orders[:-1]) | (leads[1:] != leads[:-1])]))
            sizes = np.diff(heads, append=len(codes))
            done = 0
            for i in np.flatnonzero(sizes > GROUP).tolist():
                start, end = int(heads[i]), int(heads[i] + sizes[i])
                if start > done:
                    yield from solve(orders[done:start], codes[done:start], leads[done:start])
                for at in range(start, end, GROUP):
                    to = min(at + GROUP, end)
                    if start or not told:
                        yield node(codes[at:to], int(orders[at]))
                    yield from solve(orders[at:to], codes[at:to], leads[at:to])
                done = end
            if done < len(codes):
                yield from solve(orders[done:], codes[done:], leads[done:])

        yield from packed(rows(), STARS, 1024)

    return run


def search_nodes(bits: int):
    """Links between the fingerprints of two nodes."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for no, left, right in rows_of(batches, "order_no", "left", "right", step=16):
                a, b = np.frombuffer(left, np.uint64), np.frombuffer(right, np.uint64)
                groups = Groups(len(a) + len(b))
                for x, y in search(a, b, bits):
                    groups.link(x, y + len(a))
                yield from star_rows(np.concatenate([a, b]), np.full(len(a) + len(b), no), groups)

        yield from packed(((a, b) for a, b, *_ in rows()), pa.schema([("a", pa.int64()), ("b", pa.int64())]))

    return run


def links(prints: DataFrame, bits: int = BITS) -> DataFrame:
    """Links (a, b) whose connected groups are those of all pairs of distinct fingerprints within ``bits``."""
    if not 0 <= bits <= len(BLOCKS) - LEAD:
        raise ValueError(f"at most {len(BLOCKS) - LEAD} differing bits")
    parts = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranked = kept(prints.select("print").distinct().mapInArrow(in_orders, "order_no int, rank bigint"), "ranks")
    ordered = ranked.repartitionByRange(parts, "order_no", "rank").sortWithinPartitions("order_no", "rank")
    found = kept(ordered.mapInArrow(search_runs(bits), STARS_DDL), "stars")
    nodes = found.filter(F.col("node").isNotNull())
    heads = nodes.select("order_no", "lead", "node", "mask", "pattern")
    other = heads.select("order_no", "lead", *(F.col(c).alias(f"o_{c}") for c in ("node", "mask", "pattern")))
    apart = F.bit_count(F.col("mask").bitwiseAND(F.col("o_mask")).bitwiseAND(F.col("pattern").bitwiseXOR(F.col("o_pattern"))))
    pairs = heads.join(other, ["order_no", "lead"]).filter((F.col("node") < F.col("o_node")) & (apart <= bits)).select("order_no", "node", "o_node")
    left = nodes.select("node", F.col("codes").alias("left"))
    right = nodes.select(F.col("node").alias("o_node"), F.col("codes").alias("right"))
    dealt = pairs.join(left, "node").join(right, "o_node").repartition(parts, "node", "o_node")
    between = dealt.select("order_no", "left", "right").mapInArrow(search_nodes(bits), "a bigint, b bigint")
    return found.filter(F.col("a").isNotNull()).select("a", "b").unionByName(between).distinct()


def connected(edges: DataFrame) -> DataFrame:
    """a, root: each linked fingerprint with the smallest of its component, by alternating stars."""

    def mark(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a"))).first())

    def star(pairs: DataFrame, large: bool) -> DataFrame:
        """Every place's neighbours are hung on the smallest of them: the larger ones, or it and the smaller ones."""
        ways = pairs.select("a", "b")
        if large:
            ways = ways.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = kept(ways.groupBy("a").agg(F.min("b").alias("least")).withColumn("least", F.least("a", "least")), "least")
        hung = ways.join(least, "a")
        if large:
            return hung.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("least").alias("b"))
        down = hung.filter(F.col("b") != F.col("least")).select(F.col("b").alias("a"), F.col("least").alias("b"))
        return down.unionByName(least.select("a", F.col("least").alias("b")))

    now = kept(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), "links")
    before = mark(now)
    while True:
        hung = kept(star(now, True).filter("a <> b").distinct(), "links")
        now = kept(star(hung, False).filter("a <> b").distinct(), "links")
        after = mark(now)
        if after == before:
            return now.select("a", F.col("b").alias("root"))
        before = after


def components(df: DataFrame, bits: int = BITS, size: int = SHINGLE, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, text_key, print, root and component_id of every row."""
    prints = fingerprints(df, size, doc_id, text)
    roots = connected(links(prints, bits))
    smallest = prints.groupBy("print").agg(F.min("doc_id").alias("least"))
    rooted = smallest.join(roots, smallest["print"] == roots["a"], "left").select("print", "least", F.coalesce("root", "print").alias("root"))
    rooted = kept(rooted, "roots")
    first = kept(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "firsts")
    of_print = kept(rooted.join(first, "root").select("print", "root", "component_id"), "components")
    return prints.join(of_print, "print").select("doc_id", "text_key", "print", "root", "component_id")


def digest(df: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id of every document."""
    return components(df).select("doc_id", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id")


def first_of_each(df: DataFrame, bits: int = BITS, size: int = SHINGLE, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each component: that of the smallest id (and text key); rows repeated whole leave one."""
    found = components(df, bits, size, doc_id, text)
    chosen = found.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("root", "doc_id").agg(F.min("text_key").alias("text_key"))
    # Components without any id are told apart by their root; others by their smallest id.
    chosen = chosen.select(F.col("doc_id").alias("_c_doc"), F.col("text_key").alias("_c_key"))
    key = unused(df, "_text_key")
    docs = df.withColumn(key, text_key(text))
    same = docs[doc_id].cast("bigint").eqNullSafe(chosen["_c_doc"]) & (docs[key] == chosen["_c_key"])
    return docs.join(chosen, same, "left_semi").dropDuplicates([doc_id, key]).select(*df.columns)
