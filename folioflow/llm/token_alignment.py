"""Which tokens of two tokenizers cover the same bytes of a text, and how often each pair of ids meets.

Both token sequences of a text are runs of byte ranges over the same bytes. A batch of documents is merged in lockstep:
one state vector holds a pointer into the A tokens and one into the B tokens of every document, a step emits the link
under each pointer pair, notes a cut where both tokens end, and moves the pointers whose tokens end first. Finished
documents leave the state. A long document takes several places in the state: it is entered at the end of every
``LANE``-th A token, so that the steps of a batch do not grow with its longest text.

Ids are counted in pairs over the whole corpus. A document keeps its distinct pairs; pairs that hold more than one in
``HOT`` of all links, fewer than ``HOT`` of them by that, are looked up from a broadcast array, and the others meet their
counts in a join, in which no key is then frequent.

A text has no tokens if it is null or empty, or if the bytes of its A or of its B tokens are not a space and the text
(a text with U+2581 reads back as a space, for one). It then counts zero everywhere and its digest is ''. Rows are taken
as they come: repeated rows give repeated rows that count each, rows of one id stay apart, a null id stays null. Columns
other than the id and the text are not looked at. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.llm.common import kept, packed, rows_of

# Text merged at a time, in characters; one longer text is a batch of its own.
BATCH_CHARS = 1 << 20
# A tokens between two entries of a long document into the state.
LANE = 256
# A pair with more than 1/HOT of all links is hot, so there are fewer than HOT of them.
HOT = 100_000
# The fast encoder recurses over white space; texts with longer runs of it go to the tokenizers library.
LONG_SPACE = re.compile(r"\s{10000}")

LINKED = pa.schema([("doc_id", pa.int64()), ("a_ids", pa.list_(pa.int32())), ("b_ids", pa.list_(pa.int32())), ("link_a", pa.list_(pa.int32())), ("link_b", pa.list_(pa.int32())), ("cuts", pa.list_(pa.int64()))])
COUNTED = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("pairs", pa.list_(pa.int64())), ("times", pa.list_(pa.int64()))])
LINKED_DDL = "doc_id bigint, a_ids array<int>, b_ids array<int>, link_a array<int>, link_b array<int>, cuts array<bigint>"
COUNTED_DDL = "row bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, pairs array<bigint>, times array<bigint>"


def byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabularies write for each byte: itself if it prints, else one from 256 on."""
    prints = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xFF and b != 0xAD]
    rest = [b for b in range(256) if b not in set(prints)]
    return {chr(b): b for b in prints} | {chr(256 + n): b for n, b in enumerate(rest)}


class ByteLevel:
    """Tokenizer A: a byte-level BPE file of the tokenizers library, whose special tokens are plain text here."""

    def __init__(self, path: str, pattern: str):
        import tiktoken

        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        vocab, letters = model["vocab"], byte_letters()
        bytes_of = {i: bytes(map(letters.__getitem__, t)) for t, i in vocab.items() if set(t) <= letters.keys()}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        made = [vocab["".join(pair)] for pair in pairs]
        merged = set(made)
        usable = {b: i for i, b in bytes_of.items() if len(b) == 1 or i in merged}
        self.path, self.library = path, None
        self.tokens = [bytes_of.get(i, b"") for i in range(max(vocab.values()) + 1)]
        # Where merges come in the order of the ids that they make, ids serve as ranks; the fast encoder takes those.
        ordered = made == sorted(merged) and len(usable) == len(made) + 256
        self.fast = tiktoken.Encoding("a", pat_str=pattern, mergeable_ranks=usable, special_tokens={}) if ordered else None

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [self.slow(t) if self.fast is None or LONG_SPACE.search(t) else self.fast.encode_ordinary(t) for t in texts]

    def slow(self, text: str) -> list[int]:
        if self.library is None:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_file(self.path)
            self.library.encode_special_tokens = True
        return self.library.encode(text, add_special_tokens=False).ids


class Pieces:
    """Tokenizer B: a sentencepiece model, which puts a space in front."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.tokens = [self.bytes_of(i) for i in range(self.model.get_piece_size())]

    def bytes_of(self, token: int) -> bytes:
        piece = self.model.id_to_piece(token)
        return bytes([int(piece[3:5], 16)]) if self.model.is_byte(token) else piece.replace("▁", " ").encode()

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


def merge(ends_a: np.ndarray, ends_b: np.ndarray, n_a: np.ndarray, lane: int = LANE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links (A index, B index) in the order of their bytes, and whether both tokens end there.

    The ends are those of whole documents of ``n_a`` A tokens, one after the other on one axis of bytes; A and B end
    together at the end of every document.
    """
    lanes = -(-n_a // lane)
    first = np.repeat(starts(n_a)[:-1], lanes) + lane * (np.arange(int(lanes.sum())) - np.repeat(starts(lanes)[:-1], lanes))
    stop = np.minimum(first + lane, np.repeat(np.cumsum(n_a), lanes))
    at_b = np.searchsorted(ends_b, np.append(0, ends_a)[first], "right")
    last_b = np.searchsorted(ends_b, ends_a[stop - 1], "left")
    room = stop - first + last_b - at_b + 1
    slot = np.cumsum(room) - room
    found_a = np.full(int(room.sum()), -1, np.int64)
    found_b, cut = np.zeros(len(found_a), np.int64), np.zeros(len(found_a), bool)
    at_a = first
    while len(at_a):
        end_a, end_b = ends_a[at_a], ends_b[at_b]
        found_a[slot], found_b[slot], cut[slot] = at_a, at_b, end_a == end_b
        at_a, at_b, slot = at_a + (end_a <= end_b), at_b + (end_b <= end_a), slot + 1
        live = at_a < stop
        if not live.all():
            at_a, at_b, slot, stop = at_a[live], at_b[live], slot[live], stop[live]
    used = found_a >= 0
    return found_a[used], found_b[used], cut[used]


class Aligned:
    """The tokens, links and cuts of a batch of documents on one axis of bytes."""

    def __init__(self, ids_a: list[list[int]], ids_b: list[list[int]], sizes_a: np.ndarray, sizes_b: np.ndarray):
        self.n_a, self.n_b = np.array([len(x) for x in ids_a], np.int64), np.array([len(x) for x in ids_b], np.int64)
        self.a = np.fromiter(chain.from_iterable(ids_a), np.int64, int(self.n_a.sum()))
        self.b = np.fromiter(chain.from_iterable(ids_b), np.int64, int(self.n_b.sum()))
        self.first_a, self.first_b = starts(self.n_a), starts(self.n_b)
        self.size_a, self.size_b = sizes_a[self.a], sizes_b[self.b]
        self.ends_a, self.ends_b = np.cumsum(self.size_a), np.cumsum(self.size_b)
        self.link_a, self.link_b, self.is_cut = merge(self.ends_a, self.ends_b, self.n_a)
        self.cut_at = self.ends_a[self.link_a[self.is_cut]]
        self.doc_a = np.repeat(np.arange(len(ids_a)), self.n_a)
        self.link_doc = self.doc_a[self.link_a]
        self.n_links = np.bincount(self.link_doc, minlength=len(ids_a))
        self.n_groups = np.bincount(self.link_doc[self.is_cut], minlength=len(ids_a))

    def pairs(self, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct id pairs of every document as a * width + b, their counts, and where each document's begin."""
        key = self.a[self.link_a] * width + self.b[self.link_b]
        order = np.lexsort((key, self.link_doc))
        key, doc = key[order], self.link_doc[order]
        new = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])])) if len(key) else np.zeros(0, np.int64)
        return key[new], np.diff(np.append(new, len(key))), np.searchsorted(doc[new], np.arange(len(self.n_a) + 1))

    def group_digests(self, digits_a: np.ndarray, digits_b: np.ndarray) -> list[str]:
        """sha256 of `a1,a2|b1;a3|b2,b3` per document; '' without tokens."""
        group_a = np.searchsorted(self.cut_at, self.ends_a - self.size_a, "right")
        group_b = np.searchsorted(self.cut_at, self.ends_b - self.size_b, "right")
        place_a = np.arange(len(self.a)) + np.searchsorted(group_b, group_a, "left")
        place_b = np.arange(len(self.b)) + np.searchsorted(group_a, group_b, "right")
        letters = np.zeros((len(self.a) + len(self.b), digits_a.shape[1] + 1), np.uint8)
        letters[place_a, :-1], letters[place_b, :-1] = digits_a[self.a], digits_b[self.b]
        letters[place_a, -1] = np.where(last_of(group_a), ord("|"), ord(","))
        letters[place_b, -1] = np.where(last_of(group_b), ord(";"), ord(","))
        ends = np.cumsum(self.n_a + self.n_b)
        letters[ends[self.n_a > 0] - 1, -1] = 0
        chars = np.append(0, np.cumsum((letters > 0).sum(axis=1)))[np.append(0, ends)].tolist()
        text = memoryview(letters[letters > 0].tobytes())
        return [hashlib.sha256(text[s:e]).hexdigest() if e > s else "" for s, e in zip(chars, chars[1:])]


def starts(sizes: np.ndarray) -> np.ndarray:
    return np.append(0, np.cumsum(sizes))


def last_of(groups: np.ndarray) -> np.ndarray:
    return np.append(groups[1:] != groups[:-1], True)[: len(groups)]


def decimal_letters(n: int, width: int) -> np.ndarray:
    """The digits of every number below ``n``, right-aligned in ``width`` bytes; unused places are 0."""
    numbers = np.arange(n)[:, None] // 10 ** np.arange(width - 1, -1, -1)
    shown = numbers > 0
    shown[:, -1] = True
    return np.where(shown, numbers % 10 + ord("0"), 0).astype(np.uint8)


class Aligner:
    """Both tokenizers with their tables; made once a task."""

    def __init__(self, path_a: str, path_b: str, pattern: str):
        self.a, self.b = ByteLevel(path_a, pattern), Pieces(path_b)
        self.sizes_a, self.sizes_b = (np.array([len(t) for t in x.tokens]) for x in (self.a, self.b))
        self.width = len(self.b.tokens)
        digits = len(str(max(len(self.a.tokens), self.width)))
        self.digits_a, self.digits_b = decimal_letters(len(self.a.tokens), digits), decimal_letters(self.width, digits)

    def align(self, texts: list[str | None]) -> Aligned:
        """Texts that a tokenizer does not give back byte by byte have no tokens."""
        given = [t for t in texts if t]
        found = iter(zip(given, self.a.encode([" " + t for t in given]), self.b.encode(given)))
        ids_a, ids_b = [], []
        for text in texts:
            whole = b""
            if text:
                _, a, b = next(found)
                whole = (" " + text).encode()
            same = text and b"".join(map(self.a.tokens.__getitem__, a)) == whole and b"".join(map(self.b.tokens.__getitem__, b)) == whole
            ids_a.append(a if same else [])
            ids_b.append(b if same else [])
        return Aligned(ids_a, ids_b, self.sizes_a, self.sizes_b)


def by_chars(rows: Iterable[tuple], limit: int = BATCH_CHARS) -> Iterator[list[tuple]]:
    """Rows, the last field of which is a text, in lists of about ``limit`` characters."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[-1] or "") + 16
        if size >= limit:
            yield held
            held, size = [], 0
    if held:
        yield held


def align(docs: DataFrame, path_a: str, path_b: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, a_ids, b_ids, link_a, link_b, cuts`` of every row.

    A link is a place in ``a_ids`` and one in ``b_ids`` (from 0); ``cuts`` are the byte offsets, in a space and the text,
    at which tokens of both end.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = Aligner(path_a, path_b, pattern)

        def rows() -> Iterator[tuple]:
            for held in by_chars(rows_of(batches, "doc_id", "text")):
                got = both.align([r[-1] for r in held])
                links, cuts = starts(got.n_links), starts(got.n_groups)
                byte = np.append(0, got.ends_a)[got.first_a]
                for n, (row_id, _) in enumerate(held):
                    a, b = slice(got.first_a[n], got.first_a[n + 1]), slice(got.first_b[n], got.first_b[n + 1])
                    part = slice(links[n], links[n + 1])
                    yield row_id, got.a[a], got.b[b], got.link_a[part] - a.start, got.link_b[part] - b.start, got.cut_at[cuts[n] : cuts[n + 1]] - byte[n]

        yield from packed(rows(), LINKED, 64)

    return docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, LINKED_DDL)


def count(docs: DataFrame, path_a: str, path_b: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts of every row, with its distinct id pairs (a * size of B + b) and how often it links each."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = Aligner(path_a, path_b, pattern)

        def rows() -> Iterator[tuple]:
            for held in by_chars(rows_of(batches, "row", "doc_id", "text")):
                got = both.align([r[-1] for r in held])
                pairs, times, first = got.pairs(both.width)
                digests = got.group_digests(both.digits_a, both.digits_b)
                counts = zip(got.n_a.tolist(), got.n_b.tolist(), got.n_groups.tolist(), got.n_links.tolist(), digests)
                for n, ((row, row_id, _), numbers) in enumerate(zip(held, counts)):
                    part = slice(first[n], first[n + 1])
                    yield row, row_id, *numbers, pairs[part], times[part]

        yield from packed(rows(), COUNTED, 256)

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, COUNTED_DDL)


def pair_counts(counted: DataFrame, width: int) -> DataFrame:
    """``pair, links, best``: links of every id pair over all rows; whether no other A id has more with that B id."""
    met = counted.select(F.explode(F.arrays_zip("pairs", "times")).alias("_met")).select("_met.pairs", "_met.times")
    links = kept(met.groupBy(F.col("pairs").alias("pair")).agg(F.sum("times").alias("links")), "pair-links")
    of_b = links.withColumn("b", F.pmod("pair", F.lit(width)))
    most = of_b.groupBy("b").agg(F.max("links").alias("most"))
    return of_b.join(most, "b").select("pair", "links", (F.col("links") == F.col("most")).alias("best"))


def digest(docs: DataFrame, path_a: str, path_b: str, pattern: str, hot: int = HOT) -> DataFrame:
    """Per row of ``docs``: its tokens, groups and links, and how its links stand in the counts of the whole corpus."""
    width = len(Pieces(path_b).tokens)
    counted = kept(count(docs, path_a, path_b, pattern), "aligned")
    counts = kept(pair_counts(counted, width), "pair-counts")
    total = counts.agg(F.sum("links")).first()[0] or 0
    top = counts.filter(F.col("links") * hot > total).orderBy("pair").toArrow()
    shared = docs.sparkSession.sparkContext.broadcast(tuple(top[c].to_numpy() for c in ("pair", "links", "best")))

    def look_up(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, links, best = shared.value
        for batch in batches:
            lists = batch.column("pairs")
            edges = np.append(lists.offsets.to_numpy(), 0)[: len(lists) + 1]
            pairs, times = (batch.column(c).values.to_numpy()[edges[0] : edges[-1]] for c in ("pairs", "times"))
            edges = edges - edges[0]
            at = np.minimum(np.searchsorted(known, pairs), max(0, len(known) - 1))
            is_hot = known[at] == pairs if len(known) else np.zeros(len(pairs), bool)
            at, hot_times = at[is_hot], np.where(is_hot, times, 0)[is_hot]
            sums, bests = np.zeros(len(pairs), np.int64), np.zeros(len(pairs), np.int64)
            sums[is_hot], bests[is_hot] = hot_times * links[at], hot_times * best[at]
            left = np.append(0, np.cumsum(~is_hot))[edges].astype(np.int32)
            out = [batch.column(c) for c in ("row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")]
            out += [pa.array(np.diff(np.append(0, np.cumsum(v))[edges])) for v in (bests, sums)]
            out += [pa.ListArray.from_arrays(pa.array(left), pa.array(v[~is_hot])) for v in (pairs, times)]
            yield pa.RecordBatch.from_arrays(out, names=["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "hot_best", "hot_sum", "pairs", "times"])

    seen = kept(counted.mapInArrow(look_up, COUNTED_DDL.replace("pairs", "hot_best bigint, hot_sum bigint, pairs")), "looked-up")
    cold = seen.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("_met")).select("row", F.col("_met.pairs").alias("pair"), "_met.times")
    met = cold.join(counts, "pair").groupBy("row").agg(F.sum(F.col("times") * F.col("best").cast("bigint")).alias("cold_best"), F.sum(F.col("times") * F.col("links")).alias("cold_sum"))
    joined = seen.drop("pairs", "times").join(met, "row", "left")
    n_best = F.col("hot_best") + F.coalesce("cold_best", F.lit(0))
    count_sum = F.col("hot_sum") + F.coalesce("cold_sum", F.lit(0))
    return joined.select("doc_id", "n_a", "n_b", "n_groups", "n_links", n_best.alias("n_best"), count_sum.alias("count_sum"), "groups_sha256")
