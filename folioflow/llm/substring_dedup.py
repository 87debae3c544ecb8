"""Substring deduplication by sliding spans of sentences and parts of sentences.

A text is cut behind words: of every ``WINDOW`` words in a row, behind the one that ends a sentence or,
among equals, has the smallest hash. So no piece is longer than that, and a passage is cut alike wherever it stands,
up to ``WINDOW`` words from its edges, also if it begins and ends inside sentences. In scripts without spaces each
letter is cut like a word and counts as half of one. Each piece starts a span: the shortest run of at least ``span``
pieces with at least ``min_words`` words; the last such run of a text is one too. With the values below, any passage
of 48 whole words or more has a span in common wherever it stands. Spans are hashed (128 bits, case and white space aside) and joined over
all documents; pieces covered by a span that stands in a document of a smaller id, or earlier in the same one,
are removed.

Within a document repeats are found on the spot, so a document hands in each distinct span once, and only spans of
two or more ids are joined back. A passage of very many documents is counted by partial minima and joined against a
written table, where Spark splits it. Removed spans are gathered by document, whose text bounds their number.

Rows with one doc_id count as one document for the order of spans and are treated alike if repeated whole; null ids
come before all others. Null and empty texts have no sentences. Empty tables give empty results.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.llm.common import kept, packed, rows_of, text_key

SPAN = 2
MIN_WORDS = 15
# One word of so many in a row, at least, has a cut behind it. A passage's first cut that is the same everywhere, the
# words of a span and its end take 4 * WINDOW - 3 + MIN_WORDS words at most.
WINDOW = 9
WORDS_KEPT = 500_000
NO_ID = -(1 << 63)

BREAK = re.compile(r"(?<=[.!?])\s+|(?<=[。！？])|\n+")
WORD = re.compile(r"\S+\s*")
# Thai, Lao, Burmese, Khmer, Japanese and Chinese are written without spaces.
LETTERS = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff"
UNSPACED = re.compile(f"[{LETTERS}]")
UNIT = re.compile(f"[{LETTERS}][\u3001-\u3004\u3008-\u3030\uff01-\uff0f\uff1a-\uff1f]*\\s*|[^\\s{LETTERS}]+\\s*")


class Keys(dict):
    """Hashes of words, odd and of 63 bits; remembers words that it has met."""

    def __missing__(self, word: str) -> int:
        if len(self) > WORDS_KEPT:
            self.clear()
        self[word] = key = xxhash.xxh64_intdigest(word) >> 1 | 1
        return key


KEYS = Keys()


def units_of(text: str) -> tuple[list[str], list[str]]:
    """Words, or letters of scripts without spaces, with what stands behind them; and in lower case without."""
    if UNSPACED.search(text):
        units = UNIT.findall(text)
        return units, [u.strip().lower() for u in units]
    return WORD.findall(text), text.lower().split()


def weights_of(words: list[str]) -> np.ndarray:
    """Twice the words that each unit counts as."""
    return np.fromiter((1 if UNSPACED.match(w) else 2 for w in words), np.int64, len(words))


def over_window(values: np.ndarray, size: int, pick) -> np.ndarray:
    """``pick`` (a minimum or maximum) of every ``size`` values in a row."""
    reach = 1
    while reach < size:
        step = min(reach, size - reach)
        values, reach = pick(values[:-step], values[step:]), reach + step
    return values


def least_of_windows(keys: np.ndarray) -> np.ndarray:
    """True for each key that is the least of some WINDOW keys in a row."""
    if len(keys) < WINDOW:
        return np.zeros(len(keys), bool)
    edge = np.zeros(WINDOW - 1, np.uint64)
    return over_window(np.concatenate([edge, over_window(keys, WINDOW, np.minimum), edge]), WINDOW, np.maximum) == keys


def cut_up(text: str | None) -> tuple[list[str], list[int], list[int]]:
    """Units in lower case; per piece the number of units up to its end, and the place of its end in the text."""
    text = text or ""
    units, words = units_of(text)
    if not units:
        return [], [], []
    ends = len(text) - len(text.lstrip()) + np.cumsum(np.fromiter(map(len, units), np.int64, len(units)))
    keys = np.fromiter(map(KEYS.__getitem__, words), np.uint64, len(words)) | np.uint64(1 << 63)
    # A run of one word has equal keys: places are taken WINDOW apart from its start.
    order = np.arange(len(keys))
    started = np.concatenate([[True], keys[1:] != keys[:-1]])
    taken = (order - np.maximum.accumulate(np.where(started, order, 0))) % WINDOW == 0
    breaks = np.array([g.end() for g in BREAK.finditer(text)], np.int64)
    keys[np.searchsorted(ends, breaks[breaks > ends[0] - len(units[0])])] &= np.uint64((1 << 63) - 1)
    cut = least_of_windows(np.where(taken, keys, np.uint64((1 << 64) - 1))) & taken
    cut[-1] = True
    at = np.flatnonzero(cut)
    return words, (at + 1).tolist(), ends[at].tolist()


def sentences(text: str | None) -> list[str]:
    """Pieces that join to the text, white space behind each included."""
    _, _, ends = cut_up(text)
    if not ends:
        return [text] if text else []
    return [text[a:b] for a, b in zip([0, *ends], ends)]


def spans(parts: list[str], span: int, min_words: int) -> list[tuple[int, int, bytes]]:
    """(first, end, hash) of the span that each piece starts, and of the last one, as far as the text has any."""
    found = [units_of(p)[1] for p in parts]
    real = [i for i, words in enumerate(found) if words]
    ends = np.cumsum([len(found[i]) for i in real]).tolist()
    return [(real[i], real[e - 1] + 1, hashed) for i, e, hashed in spans_of([w for words in found for w in words], ends, span, min_words)]


def spans_of(words: list[str], ends: list[int], span: int, min_words: int) -> list[tuple[int, int, bytes]]:
    """The same for pieces of so many words up to their ends."""
    n = len(ends)
    if n < span:
        return []
    said = [" ".join(words[a:b]).encode() for a, b in zip([0, *ends], ends)]
    if any(map(UNSPACED.match, words)):
        counted = np.concatenate([[0], np.cumsum(weights_of(words))])[[0, *ends]]
    else:
        counted = 2 * np.array([0, *ends], np.int64)
    needed = np.maximum(np.searchsorted(counted, counted[:-1] + 2 * min_words, "left"), np.arange(n) + span)
    runs = [(i, e) for i, e in enumerate(needed.tolist()) if e <= n]
    if runs and runs[-1][1] < n:
        runs.append((runs[-1][0], n))  # the last that starts a span goes to the end of the text too
    whole, places = b" ".join(said), np.concatenate([[0], np.cumsum([len(x) + 1 for x in said])]).tolist()
    return [(i, e, xxhash.xxh3_128_digest(whole[places[i] : places[e] - 1])) for i, e in runs]


# A row without a hash is a row of the document: `end` is the number of its pieces.
SPANS = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("high", pa.int64()), ("low", pa.int64()), ("first", pa.int32()), ("end", pa.int32()), ("again", pa.bool_())])
SPANS_DDL = "doc_id bigint, text_key bigint, high bigint, low bigint, first int, end int, again boolean"
# Bits of the filter in front of the join, and how many a shared hash gets; 16 MB at most are sent to the tasks.
FILTER_BITS = 1 << 27
BITS_A_HASH = 32


def narrow(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    return df.select(F.col(doc_id).cast("bigint").alias("doc_id"), text_key(text).alias("text_key"), F.col(text).cast("string").alias("text"))


def span_rows(span: int, min_words: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for doc_id, key, text in rows_of(batches, "doc_id", "text_key", "text"):
                seen: dict[bytes, int] = {}
                words, ends, _ = cut_up(text)
                yield doc_id, key, None, None, 0, max(len(ends), 1 if text else 0), False
                for first, end, hashed in spans_of(words, ends, span, min_words):
                    before = seen.setdefault(hashed, end)
                    # A span that overlaps its own first occurrence is a run of equal pieces: it goes too.
                    again = before != end
                    yield (doc_id, key, *struct.unpack("<qq", hashed), first, end, again)

        yield from packed(rows(), SPANS)

    return run


def may_be_shared(shared: DataFrame, bits: int = FILTER_BITS) -> Column:
    """False for most hashes that ``shared`` lacks, and true for all that it has: one bit of each is kept in a bitmap.

    The bitmap has ``bits`` bits at most, however many hashes there are; with more of them it spares less.
    """
    n = shared.count()
    size = min(bits, max(1 << 10, 1 << (n * BITS_A_HASH).bit_length()))
    place = F.col("_low").bitwiseAND(F.lit(size - 1))
    words = shared.select(F.shiftright(place, 6).alias("word"), F.expr("shiftleft(1L, int(_low & 63))").alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("set")).toArrow()
    bitmap = np.zeros(size >> 6, np.int64)
    bitmap[words["word"].to_numpy()] = words["set"].to_numpy()
    known = shared.sparkSession.sparkContext.broadcast(bitmap.tobytes())

    @F.arrow_udf("boolean")
    def test(low: pa.Array) -> pa.Array:
        bits, at = np.frombuffer(known.value, np.int64), low.fill_null(0).to_numpy(zero_copy_only=False) & (size - 1)
        return pa.array((bits[at >> 6] >> (at & 63)) & 1 == 1)

    return test("low")


def repeated_spans(df: DataFrame, span: int = SPAN, min_words: int = MIN_WORDS, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(doc_id, text_key, first, end, first_doc_id of every span that is not the first of its kind; doc_id, text_key, n
    of every document, n being the number of its pieces)."""
    found = kept(narrow(df, doc_id, text).mapInArrow(span_rows(span, min_words), SPANS_DDL), "spans")
    order = F.coalesce("doc_id", F.lit(NO_ID))
    hashed = found.filter("high IS NOT NULL")
    of_hash = hashed.groupBy("high", "low").agg(F.min(order).alias("least"), F.max(order).alias("most"))
    shared = kept(of_hash.filter("least < most").select(F.col("high").alias("_high"), F.col("low").alias("_low"), "least"), "shared")
    likely = hashed.filter("not again").filter(may_be_shared(shared))
    outer = likely.join(shared, (F.col("high") == F.col("_high")) & (F.col("low") == F.col("_low")) & (order > F.col("least")))
    ids = ["doc_id", "text_key", "first", "end"]
    elsewhere = outer.select(*ids, F.when(F.col("least") != NO_ID, F.col("least")).alias("first_doc_id"))
    spans = elsewhere.unionByName(found.filter("again").select(*ids, F.col("doc_id").alias("first_doc_id")))
    return spans, found.filter("high IS NULL").select("doc_id", "text_key", F.col("end").alias("n"))


def covered(n: int, ranges: list[tuple[int, int]]) -> np.ndarray:
    marks = np.zeros(n + 1, np.int64)
    for first, end in ranges:
        marks[first] += 1
        marks[end] -= 1
    return np.cumsum(marks)[:n] > 0


RESULT = pa.schema([("doc_id", pa.int64()), ("n_sentences", pa.int64()), ("n_removed", pa.int64()), ("first_doc_ids", pa.list_(pa.int64())), ("text", pa.string())])
RESULT_DDL = "doc_id bigint, n_sentences bigint, n_removed bigint, first_doc_ids array<bigint>, text string"


def remove(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows():
        for doc_id, text, n, ranges, firsts in rows_of(batches, "doc_id", "text", "n", "ranges", "first_doc_ids"):
            if not ranges:
                yield doc_id, n, 0, [], text
                continue
            parts = sentences(text)
            gone = covered(len(parts), [(r["first"], r["end"]) for r in ranges])
            yield doc_id, len(parts), int(gone.sum()), firsts, "".join(p for p, g in zip(parts, gone.tolist()) if not g)

    yield from packed(rows(), RESULT, 512)


def remove_repeats(df: DataFrame, span: int = SPAN, min_words: int = MIN_WORDS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every document with what is left: doc_id, n_sentences, n_removed, first_doc_ids (where its removed spans stand
    first), text. Null texts stay null."""
    spans, sizes = repeated_spans(df, span, min_words, doc_id, text)
    # Every document has a row of its size; those with spans that go are cut up once more.
    one = F.struct("first", "end")
    marked = spans.select("doc_id", "text_key", one.alias("range"), "first_doc_id", F.lit(None).cast("int").alias("n")).unionByName(
        sizes.select("doc_id", "text_key", "n"), allowMissingColumns=True
    )
    ranges = marked.groupBy("doc_id", "text_key").agg(
        F.max("n").alias("n"), F.collect_set("range").alias("ranges"), F.array_sort(F.collect_set("first_doc_id")).alias("first_doc_ids")
    )
    marks = ranges.select(F.col("doc_id").alias("_m_doc"), F.col("text_key").alias("_m_key"), "n", "ranges", "first_doc_ids")
    docs = narrow(df, doc_id, text)
    same = docs["doc_id"].eqNullSafe(marks["_m_doc"]) & (docs["text_key"] == marks["_m_key"])
    return docs.join(marks, same, "left").select("doc_id", "text", "n", "ranges", "first_doc_ids").mapInArrow(remove, RESULT_DDL)
