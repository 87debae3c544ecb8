"""Byte-level BPE: ranked merges folded over the bytes of distinct words; decoding joins binary pieces.

The ranked merges are folded over the bytes of each distinct word of a task, the rank map being a constant that goes
out with the task; decoding joins the binary pieces of the ids. ``fold_column`` is the fold as a Spark column, of
higher-order functions over byte arrays and a literal rank map. Interpreted as those are, it takes more CPU time than
corpora allow (see the README), so ``encode`` runs the same fold over arrays of words of one length, many at a time.
Nothing is shuffled, and a task that is lost is run again on its own.

Null texts encode like empty ones, to no ids. Repeated rows give repeated rows, an empty table gives an empty
one, and no input column but those named is looked at, so further columns cannot clash.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.llm.common import in_large_tasks, packed, rows_of

# Units of text that a task remembers; when there are more it starts anew. Bounds memory, not results.
UNITS_KEPT = 700_000
BATCH_CHARS = 4 << 20
NEVER = 1 << 30
# A word of more bytes is merged with a heap: folding takes time in the square of a word's length.
FOLD_BYTES = 96
SLOTS = 1 << 18
STEP = 1 << 20  # a merge candidate is rank * STEP + place
NONE = 1 << 40

Merge = list[tuple[int, int, int]]


@lru_cache(maxsize=4)
def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank; rank and id are the same."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def merges(ranks: dict[bytes, int]) -> Merge:
    """All pairs of tokens that together are a token: left, right, whole."""
    found = []
    for token, rank in ranks.items():
        for at in range(1, len(token)):
            left, right = ranks.get(token[:at]), ranks.get(token[at:])
            if left is not None and right is not None:
                found.append((left, right, rank))
    return found


def slots_of(left, right) -> tuple:
    """The two places where a pair may stand in the rank map, for columns and for numbers alike."""
    return (left * 40503 + right * 9176) % SLOTS, (left * 7919 + right * 104729) % SLOTS


def rank_table(pairs: Merge) -> np.ndarray:
    """The merges as an array: an entry holds a pair and the token it makes, in one of its two places."""
    table = [-1] * SLOTS
    for left, right, whole in pairs:
        entry, at = (left * 65536 + right) << 17 | whole, slots_of(left, right)[0]
        for _ in range(500):
            table[at], entry = entry, table[at]
            if entry < 0:
                break
            places = slots_of(entry >> 33, entry >> 17 & 0xFFFF)
            at = places[1] if places[0] == at else places[0]
        else:
            raise ValueError("the rank map is too full")
    return np.array(table, np.int64)


def fold_column(word: Column, ranks: dict[bytes, int]) -> Column:
    """Ids of a word given as an array of byte values, at least two of them.

    The rank map is a literal; each step of the fold merges the leftmost pair of least rank.
    """
    table, first = F.lit(rank_table(merges(ranks))), [ranks[bytes([b])] for b in range(256)]

    def candidate(ids: Column):
        def of(left: Column, i: Column) -> Column:
            right = F.get(ids, i + 1)
            pair = left * 65536 + right
            one, two = (F.get(table, slot.cast("int")) for slot in slots_of(left, right))
            found = F.when(F.shiftright(one, 17) == pair, one).when(F.shiftright(two, 17) == pair, two)
            return F.coalesce(found.bitwiseAND(0x1FFFF), F.lit(NONE // STEP)) * STEP + i

        return F.array_min(F.transform(F.slice(ids, 1, F.size(ids) - 1), of))

    def merged(ids: Column, best: Column) -> Column:
        at = (best % STEP).cast("int")
        whole = F.array(F.shiftright(best, 20))
        return F.concat(F.slice(ids, F.lit(1), at), whole, F.slice(ids, at + 3, F.size(ids)))

    def step(state: Column, _: Column) -> Column:
        ids = state["ids"]
        ended = F.struct(ids.alias("ids"), F.lit(True).alias("done"))
        found = F.transform(
            F.array(candidate(ids)),
            lambda best: F.when(best >= NONE, ended).otherwise(F.struct(merged(ids, best).alias("ids"), F.lit(False).alias("done"))),
        )
        return F.when(state["done"] | (F.size(ids) < 2), state).otherwise(F.get(found, F.lit(0)))

    start = F.transform(word, lambda b: F.get(F.lit(np.array(first, np.int64)), b))
    state = F.struct(start.alias("ids"), F.lit(False).alias("done"))
    return F.aggregate(F.slice(word, 2, F.size(word)), state, step, lambda s: s["ids"])


def merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same merges for a long word: a heap of candidates over a linked list of pieces."""
    size = len(word)
    ends, before = list(range(1, size + 1)), list(range(-1, size - 1))
    heap = []

    def offer(at: int) -> None:
        nxt = ends[at]
        if nxt < size and (rank := ranks.get(word[at : ends[nxt]])) is not None:
            heapq.heappush(heap, (rank, at, ends[nxt]))

    for at in range(size - 1):
        offer(at)
    alive = [True] * size
    while heap:
        _, at, end = heapq.heappop(heap)
        if not alive[at] or ends[at] >= size or not alive[ends[at]] or ends[ends[at]] != end:
            continue
        alive[ends[at]] = False
        ends[at] = end
        if end < size:
            before[end] = at
        offer(at)
        if before[at] >= 0:
            offer(before[at])
    ids, at = [], 0
    while at < size:
        ids.append(ranks[word[at : ends[at]]])
        at = ends[at]
    return ids


def pieces(unit: str, pattern) -> list[str]:
    """Words of a unit by the pattern. Most units are a space and letters, perhaps with one sign behind."""
    body = unit[1:] if unit[0] == " " else unit
    if body.isalpha() and body.isascii():
        return [unit]
    if body[-1:] in (".", ",") and body[:-1].isalpha() and body.isascii():
        return [unit[:-1], unit[-1]]
    return pattern.findall(unit)


# White space of the pattern's \s.
SPACES = "\\t\\n\\x0b\\x0c\\r\\x20\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"


def units(text: str, odd, parts) -> list[str]:
    """The text cut where white space follows something else; no word of the pattern crosses such a place."""
    if odd.search(text):
        return parts.findall(text)
    cut = text.split(" ")
    return [cut[0], *map(" ".__add__, cut[1:])] if cut[0] else list(map(" ".__add__, cut[1:]))


class Encoder:
    """Ids of texts. Words are folded once, many at a time; units of text remember the ids of their words."""

    def __init__(self, ranks: dict[bytes, int], table: np.ndarray, pattern: str, limit: int = UNITS_KEPT):
        self.ranks, self.table, self.limit = ranks, table, limit
        self.first = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.match = regex.compile(pattern)
        self.odd = regex.compile(f"[{SPACES}] ")
        self.parts = regex.compile(f"[{SPACES}]*[^{SPACES}]+|[{SPACES}]+")
        self.known: dict[str, bytes] = {}

    def learn(self, new: list[str]) -> None:
        cut = [pieces(unit, self.match) for unit in new]
        words = list({word for found in cut for word in found})
        ids = dict(zip(words, self.fold([w.encode() for w in words])))
        self.known.update(zip(new, (b"".join(map(ids.__getitem__, found)) for found in cut)))

    def fold(self, words: list[bytes]) -> list[bytes]:
        """Ids of words, as bytes of 32-bit numbers; words of about one length are folded together."""
        out: list[bytes] = [b""] * len(words)
        by_length: dict[int, list[int]] = {}
        for i, word in enumerate(words):
            if (rank := self.ranks.get(word)) is not None:
                out[i] = rank.to_bytes(4, "little")
            elif len(word) > FOLD_BYTES:
                out[i] = np.array(merge_long(word, self.ranks), np.int32).tobytes()
            else:
                by_length.setdefault(len(word), []).append(i)
        for length, at in by_length.items():
            for start in range(0, len(at), 16_384):
                some = at[start : start + 16_384]
                ids, sizes = self.fold_equal(np.frombuffer(b"".join(words[i] for i in some), np.uint8).reshape(-1, length))
                raw, width = ids.tobytes(), length * 4
                for row, (i, size) in enumerate(zip(some, sizes.tolist())):
                    out[i] = raw[row * width : row * width + size * 4]
        return out

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """What each pair makes, or NEVER."""
        left, right = left.astype(np.int64), right.astype(np.int64)
        pair, made = left * 65536 + right, np.full(left.shape, NEVER, np.int32)
        for slot in slots_of(left, right):
            entry = self.table[slot]
            np.copyto(made, (entry & 0x1FFFF).astype(np.int32), where=entry >> 17 == pair)
        return made

    def fold_equal(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of bytes to rows of ids and their numbers: each step merges every row's leftmost pair of least rank."""
        n, length = words.shape
        ids = self.first[words]
        out, sizes = ids.copy(), np.full(n, length, np.int64)
        rows = np.arange(n)
        ranks = self.rank(ids[:, :-1], ids[:, 1:])
        for size in range(length, 1, -1):
            best = ranks.argmin(axis=1)
            made = ranks[np.arange(len(ranks)), best]
            going = made < NEVER
            if not going.all():
                done = rows[~going]
                out[done, :size], sizes[done] = ids[~going], size
                rows, ids, ranks, best, made = rows[going], ids[going], ranks[going], best[going], made[going]
            if not len(rows):
                break
            each, places = np.arange(len(rows)), np.arange(size - 1)
            ids[each, best] = made
            ids = np.take_along_axis(ids, places + (places > best[:, None]), axis=1)
            if size == 2:
                out[rows, :1], sizes[rows] = ids, 1
                break
            places = places[:-1]
            ranks = np.take_along_axis(ranks, places + (places >= best[:, None]), axis=1)
            after = best < size - 2
            ranks[each[after], best[after]] = self.rank(ids[each[after], best[after]], ids[each[after], best[after] + 1])
            before = best > 0
            ranks[each[before], best[before] - 1] = self.rank(ids[each[before], best[before] - 1], ids[each[before], best[before]])
        return out, sizes

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        cut = [units(t, self.odd, self.parts) if t else [] for t in texts]
        new = list({u for found in cut for u in found if u not in self.known})
        if len(self.known) + len(new) > self.limit:
            self.known.clear()
            new = list({u for found in cut for u in found})
        self.learn(new)
        return [np.frombuffer(b"".join(map(self.known.__getitem__, found)), np.int32) for found in cut]


def encoded(df: DataFrame, ranks_path: str, pattern: str, finish, schema: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Documents to what ``finish`` makes of the (doc_id, ids) pairs of a task."""
    ranks = load_ranks(ranks_path)
    entries = rank_table(merges(ranks))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(ranks, entries, pattern)

        def found() -> Iterator[tuple[int | None, np.ndarray]]:
            held, size = [], 0
            for row in rows_of(batches, "doc_id", "text"):
                held.append(row)
                size += len(row[1] or "")
                if size > BATCH_CHARS or len(held) >= 4096:
                    yield from zip((d for d, _ in held), encoder.encode([t for _, t in held]))
                    held, size = [], 0
            yield from zip((d for d, _ in held), encoder.encode([t for _, t in held]))

        yield from finish(found())

    narrow = df.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return in_large_tasks(narrow).mapInArrow(run, schema)


IDS = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])


def encode(df: DataFrame, ranks_path: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Ids of each document: doc_id, ids array<int>."""

    def finish(found):
        yield from packed(((d, ids.astype(np.int32)) for d, ids in found), IDS, 512)

    return encoded(df, ranks_path, pattern, finish, "doc_id bigint, ids array<int>", doc_id, text)


def decode(df: DataFrame, ranks_path: str, ids: str = "ids", to: str = "decoded") -> DataFrame:
    """Adds the bytes of each row's ids: their binary pieces joined. Null ids give null."""
    lookup = {i: token for token, i in load_ranks(ranks_path).items()}
    tokens = [lookup.get(i, b"") for i in range(max(lookup) + 1)]

    @F.pandas_udf("binary")
    def joined(lists):
        return lists.map(lambda x: None if x is None else b"".join(map(tokens.__getitem__, x)))

    return df.withColumn(to, joined(F.col(ids)))


DIGEST = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])


def digest(df: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (decimal ids joined by a space), decoded_sha256 (bytes decoded from the ids)."""
    ranks = load_ranks(ranks_path)
    tokens = [b""] * (max(ranks.values()) + 1)
    for token, i in ranks.items():
        tokens[i] = token
    names = [b"%d" % i for i in range(len(tokens))]

    def finish(found):
        def rows():
            for doc_id, ids in found:
                ids = ids.tolist()
                shown = hashlib.sha256(b" ".join(map(names.__getitem__, ids))).hexdigest()
                yield doc_id, len(ids), shown, hashlib.sha256(b"".join(map(tokens.__getitem__, ids))).hexdigest()

        yield from packed(rows(), DIGEST)

    return encoded(df, ranks_path, pattern, finish, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
