"""Toxicity by a learned lexicon, misspellings and the context of a hit.

The lexicon is learned: words and word beginnings that stand far more often in documents labelled toxic than in
others, counted by Spark over a bounded sample of labelled rows, each distinct text once. It is held as a trie. A word is looked up by
walking the trie with a Levenshtein automaton of the word (the usual bit-parallel one, a bit vector per error), so
one walk finds all terms within the allowed number of errors. Words that stand in clean documents are no
misspellings. A hit counts less inside quotation marks with nothing said against someone around it, and more beside
other hits. A document's score is logistic in a few sums over its hits, fitted on labelled rows that the lexicon has
not seen. Terms, weights and coefficients are of bounded size and go to every task; texts stay where they are.

A null or empty text has no hits and gets the score of a text without any. Repeated rows are scored each time.
Without toxic or without clean labels the score is the share of toxic ones among labelled texts (0 without labels). Labels that are
null, or of unknown documents, are passed over. No column but the id and the text is an input of a score.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.llm.common import in_large_tasks, kept, packed, rows_of

# Labelled rows that a model is fitted on, at most: those of smallest hash of their id.
TRAIN_ROWS = 40_000
FOLDS = 5
# A lexicon term stands in this many toxic training documents at least, and in this share of them, and its odds are
# this many times as high as in others.
LEAST_TOXIC = 4
LEAST_SHARE = 0.01
LEAST_ODDS = 20.0
LEXICON_TERMS = 5_000
STEM_LENGTHS = (4, 5, 6)
# Errors allowed in a word of at least so many letters. Two errors in long words are possible, but cost more time than
# the corpus allows: a third of a term is found in too many words.
ERRORS = ((5, 1),)
# A word in so many clean training documents is no misspelling.
CLEAN_WORD = 2
CONTEXT = 6
QUOTED = 0.35
WORDS_KEPT = 700_000

WORD = re.compile(r"[^\W_]+")
QUOTES = re.compile("[\"“”«»„]")
END = ""


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def allowed_errors(size: int) -> int:
    return max((k for n, k in ERRORS if size >= n), default=0)


def shortened(word: str, k: int) -> set[str]:
    """The word without any of its letters, up to k."""
    found = last = {word}
    for _ in range(k):
        last = {w[:i] + w[i + 1 :] for w in last for i in range(len(w))}
        found = found | last
    return found


class Trie:
    """Lexicon terms with weights; a stem stands for every word that begins with it. The trie holds every term."""

    def __init__(self, terms: dict[str, float], stems: dict[str, float]):
        self.root: dict = {}
        self.stems = stems
        self.lengths = sorted({len(s) for s in stems}, reverse=True)
        self.terms = terms
        for term in terms:
            node = self.root
            for letter in term:
                node = node.setdefault(letter, {})
            node[END] = term
        # A word with k errors keeps one of the k + 1 parts of a term: its first or last letters in place, or a part between.
        # Parts are held by the length of the word, since a term's length is within k of it.
        self.parts: dict[int, tuple[set[str], set[str], set[str]]] = {}
        for size in range(ERRORS[0][0], max(map(len, terms), default=0) + 3):
            k = allowed_errors(size)
            near = [t for t in terms if abs(len(t) - size) <= k]
            cut = [[t[len(t) * i // (k + 1) : len(t) * (i + 1) // (k + 1)] for i in range(k + 1)] for t in near]
            self.parts[size] = {c[0] for c in cut}, {c[-1] for c in cut}, {p for c in cut for p in c[1:-1]}
        self.sizes = {m: tuple(sorted({len(p) for p in found}) for found in parts) for m, parts in self.parts.items()}
        # A word with k errors and its term become one string when each loses up to k letters; hashes of the terms' ones.
        most = max((k for _, k in ERRORS), default=0)
        self.shortened = {hash(x) for t in terms for x in shortened(t, most)}

    def may_be_close(self, word: str) -> bool:
        """False only if no term is within the errors allowed; spares most words the walk."""
        size = len(word)
        if size not in self.parts:
            return False
        return self.has_part(word) and any(hash(x) in self.shortened for x in shortened(word, allowed_errors(size)))

    def has_part(self, word: str) -> bool:
        size = len(word)
        (heads, tails, middles), (n_heads, n_tails, n_middles) = self.parts[size], self.sizes[size]
        for n in n_heads:
            if word[:n] in heads:
                return True
        for n in n_tails:
            if word[size - n :] in tails:
                return True
        return any(word[i : i + n] in middles for n in n_middles for i in range(size - n + 1))

    def exact(self, word: str) -> tuple[str, float] | None:
        weight = self.terms.get(word)
        found = (word, weight) if weight is not None else None
        for n in self.lengths:
            stem = word[:n]
            if len(stem) == n and (w := self.stems.get(stem)) is not None and (found is None or w >= found[1]):
                found = (stem, w)
        return found

    def close(self, word: str) -> tuple[str, int] | None:
        """The term with fewest errors within what the word's length allows, and the errors."""
        if not self.may_be_close(word):
            return None
        allowed = allowed_errors(len(word))
        masks: dict[str, int] = {}
        for i, letter in enumerate(word):
            masks[letter] = masks.get(letter, 0) | 1 << i
        size, best = len(word), None
        # Bit i of states[k]: i letters of the word are read with k errors.
        stack = [(self.root, tuple((1 << (k + 1)) - 1 for k in range(allowed + 1)))]
        full = (1 << (size + 1)) - 1
        while stack:
            node, states = stack.pop()
            for letter, below in node.items():
                if letter == END:
                    errors = next((k for k, s in enumerate(states) if s >> size & 1), None)
                    if errors and (best is None or (errors, below) < (best[1], best[0])):
                        best = (below, errors)
                    continue
                match, after, last = masks.get(letter, 0), [], 0
                for k, s in enumerate(states):
                    now = (s & match) << 1
                    if k:
                        old = states[k - 1]
                        now |= old | old << 1 | last << 1  # a letter too few, another letter, a letter too many
                    now &= full
                    after.append(now)
                    last = now
                if any(after):
                    stack.append((below, tuple(after)))
        return best


@dataclass
class Model:
    terms: dict[str, float] = field(default_factory=dict)
    stems: dict[str, float] = field(default_factory=dict)
    clean: frozenset[str] = frozenset()
    coefficients: tuple[float, ...] = ()
    base: float = 0.0


class Finder:
    """Hits of texts; remembers words that it has met."""

    def __init__(self, model: Model):
        self.trie, self.clean = Trie(model.terms, model.stems), model.clean
        self.known: dict[str, tuple[str, float] | None] = {}
        self.hits: set[str] = set()

    def learn(self, words: Iterable[str]) -> None:
        if len(self.known) > WORDS_KEPT:
            self.known.clear()
            self.hits.clear()
        for word in words:
            found = self.trie.exact(word)
            if found is None and word not in self.clean and (near := self.trie.close(word)):
                term, weight = self.trie.exact(near[0])
                found = (term, weight * (0.8 if near[1] == 1 else 0.6))
            self.known[word] = found
            if found:
                self.hits.add(word)

    def features(self, text: str | None) -> tuple[float, ...]:
        """Weights of the hits in context, numbers of hits, of different terms, of hits in a thousand words, quoted."""
        words = words_of(text or "")
        some = set(words)
        new = [w for w in some if w not in self.known]
        if new:
            self.learn(some if len(self.known) > WORDS_KEPT else new)
        if self.hits.isdisjoint(some):
            return (0.0,) * 5
        return self.scored(text or "")

    def scored(self, text: str) -> tuple[float, ...]:
        lowered = text.lower()
        marks = [m.start() for m in QUOTES.finditer(lowered)]
        places = [(i, m.start(), self.known.get(m[0])) for i, m in enumerate(WORD.finditer(lowered))]
        found = [(i, at, hit) for i, at, hit in places if hit]
        order = [i for i, _, _ in found]
        total, quoted = 0.0, 0
        for i, at, (term, weight) in found:
            beside = bisect_right(order, i + CONTEXT) - bisect_left(order, i - CONTEXT) - 1
            inside = bisect_left(marks, at) % 2 == 1 and not beside
            quoted += inside
            total += weight * (QUOTED if inside else 1.0 + 0.1 * min(beside, 3))
        terms = {hit[0] for _, _, hit in found}
        return (min(total, 60.0) / 10, math.log1p(len(found)), math.log1p(len(terms)), math.log1p(1000 * len(found) / len(places)), math.log1p(quoted))


def held_out(doc_id):
    """True for the fold that nothing is learned from."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(FOLDS)) == 0


def training(documents: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """fold, toxic, text of the distinct texts among at most ``rows`` labelled documents that are not held out.

    A text counts once however often it is copied, in the fold of its least id; it is toxic if a copy is.
    """
    known = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows).select(F.col("doc_id").cast("bigint").alias("_doc"), F.col("toxic").cast("int").alias("toxic"))
    texts = documents.select(F.col("doc_id").cast("bigint").alias("_id"), F.col("text").cast("string").alias("text"))
    fold = F.pmod(F.crc32(F.col("_id").cast("string").cast("binary")), F.lit(FOLDS)).cast("int")
    joined = texts.join(F.broadcast(chosen), F.col("_id") == F.col("_doc")).select("_id", "toxic", F.coalesce("text", F.lit("")).alias("text"))
    apart = joined.groupBy("text").agg(F.min("_id").alias("_id"), F.max("toxic").alias("toxic"))
    return kept(apart.select(fold.alias("fold"), "toxic", "text"), "labelled")


COUNTS = pa.schema([("term", pa.string()), ("stem", pa.bool_()), ("toxic", pa.int64()), ("clean", pa.int64())])


def term_counts(only: frozenset | None, least: int):
    """Numbers of toxic and clean documents with each word and word beginning, summed up task by task."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = (Counter(), Counter())
        for toxic, text in rows_of(batches, "toxic", "text"):
            words = set(words_of(text))
            terms = {(w, False) for w in words} | {(w[:n], True) for w in words for n in STEM_LENGTHS if len(w) > n}
            counts[bool(toxic)].update(terms if only is None else terms & only)
        keys = counts[0].keys() | counts[1].keys()
        yield from packed(((t, s, counts[1][t, s], counts[0][t, s]) for t, s in keys if counts[0][t, s] + counts[1][t, s] >= least), COUNTS)

    return run


def summed(df: DataFrame, only: frozenset | None = None) -> DataFrame:
    found = df.select("toxic", "text").mapInArrow(term_counts(only, 1), "term string, stem boolean, toxic bigint, clean bigint")
    return found.groupBy("term", "stem").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def lexicon(train: DataFrame) -> tuple[dict[str, float], dict[str, float]]:
    """Weights (log odds) of the terms and stems that speak for a toxic label."""
    sizes = {r.toxic: r.n for r in train.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n_toxic, n_clean = sum(n for t, n in sizes.items() if t), sizes.get(0, 0)
    if not n_toxic or not n_clean:
        return {}, {}
    common = summed(train.filter("toxic <> 0")).filter(F.col("toxic") >= max(LEAST_TOXIC, LEAST_SHARE * n_toxic))
    # A term of even odds stands in few more toxic documents than clean ones; candidates are bounded by the sample.
    seen = {(r.term, r.stem): r.toxic for r in common.select("term", "stem", "toxic").collect()}
    clean = {(r.term, r.stem): r.clean for r in summed(train.filter("toxic = 0"), frozenset(seen)).collect()}
    rated = []
    for (term, stem), k in seen.items():
        odds = (k + 0.5) / (n_toxic + 1) / ((clean.get((term, stem), 0) + 0.5) / (n_clean + 1))
        if odds >= LEAST_ODDS:
            rated.append((stem, len(term), term, math.log(odds), k))
    stems: dict[str, float] = {}
    for _, size, term, weight, k in sorted(r for r in rated if r[0]):
        if not any(term[:n] in stems for n in STEM_LENGTHS if n < size):
            stems[term] = weight
    terms = {t: w for s, _, t, w, _ in rated if not s}
    # A stem that only one word has says no more than the word.
    stems = {s: w for s, w in stems.items() if sum(t.startswith(s) for t in terms) != 1 or s in terms}
    stems = dict(sorted(stems.items(), key=lambda x: (-x[1], x[0]))[:LEXICON_TERMS])
    # A word that a stem stands for has the stem's weight; misspellings are sought of it as of others, whose places it does not take.
    inflected = {t: stems[t[:n]] for t in terms for n in STEM_LENGTHS if t[:n] in stems}
    own = sorted((x for x in terms.items() if x[0] not in inflected), key=lambda x: (-x[1], x[0]))
    return dict(own[:LEXICON_TERMS]) | inflected, stems


def clean_words(train: DataFrame, terms: dict[str, float]) -> frozenset[str]:
    """Words of clean documents that look like misspelled terms; not many are so near to the lexicon."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, near, counts = Trie(terms, {}), {}, Counter()
        for (text,) in rows_of(batches, "text"):
            for word in set(words_of(text)):
                if word not in near:
                    if len(near) > WORDS_KEPT:
                        near.clear()
                    near[word] = word not in terms and trie.close(word) is not None
                if near[word]:
                    counts[word] += 1
        yield from packed(counts.items(), pa.schema([("word", pa.string()), ("n", pa.int64())]))

    if not terms:
        return frozenset()
    found = train.filter("toxic = 0").select("text").mapInArrow(run, "word string, n bigint")
    return frozenset(r.word for r in found.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= CLEAN_WORD).collect())


def features_of(df: DataFrame, model: Model, names: str, columns: list[str]) -> DataFrame:
    """``columns`` (numbers) of ``df`` with the features of its text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(model)
        schema = pa.schema([*((c, pa.int64()) for c in columns), ("x", pa.list_(pa.float64()))])
        yield from packed(((*row[:-1], list(finder.features(row[-1]))) for row in rows_of(batches, *columns, "text")), schema)

    return df.select(*columns, "text").mapInArrow(run, f"{names}, x array<double>")


def fit_logistic(x: np.ndarray, y: np.ndarray, penalty: float = 0.1) -> tuple[float, ...]:
    """Intercept and coefficients by Newton's steps."""
    x = np.hstack([np.ones((len(x), 1)), x])
    weights, ridge = np.zeros(x.shape[1]), np.diag([1e-3] + [penalty] * (x.shape[1] - 1))
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (y - p) - ridge @ weights)
        weights = weights + step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(map(float, weights))


def fit(documents: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    """A model of bounded size, from at most ``rows`` labelled rows outside the held-out fold."""
    train = training(documents, labels, rows)
    terms, stems = lexicon(train.filter(F.col("fold") != FOLDS - 1))
    model = Model(terms, stems, clean_words(train.filter(F.col("fold") != FOLDS - 1), terms))
    told = features_of(train.filter(F.col("fold") == FOLDS - 1).withColumn("toxic", (F.col("toxic") != 0).cast("bigint")), model, "toxic bigint", ["toxic"]).collect()
    y = np.array([r.toxic for r in told], float)
    counted = train.agg(F.avg((F.col("toxic") != 0).cast("double"))).first()[0]
    model.base = float(counted or 0.0)
    if (terms or stems) and 0 < y.sum() < len(y):
        model.coefficients = fit_logistic(np.array([r.x for r in told]), y)
    elif terms or stems:  # too few labels to fit the last step
        model.coefficients = (-3.0, 2.0, 1.0, 1.0, 0.0, -1.0)
    return model


SCORES = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("n_hits", pa.int32())])


def score(df: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted, n_hits of every row."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(model)
        yield from packed(((d, *value(finder, model, t)) for d, t in rows_of(batches, "doc_id", "text")), SCORES)

    narrow = df.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    scored = in_large_tasks(narrow).mapInArrow(run, "doc_id bigint, score double, n_hits int")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"), "n_hits")


def value(finder: Finder, model: Model, text: str | None) -> tuple[float, int]:
    """Score of a text and its number of hits."""
    x = finder.features(text)
    if not model.coefficients:
        return model.base, 0
    z = model.coefficients[0] + sum(a * b for a, b in zip(model.coefficients[1:], x))
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, z)))), round(math.expm1(x[1]))


def without_toxic(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows of ``df`` whose text scores below one half; all their columns."""

    @F.pandas_udf("boolean")
    def clean(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        finder = Finder(model)
        for texts in batches:
            yield texts.map(lambda t: value(finder, model, t)[0] < 0.5).astype(bool)

    return in_large_tasks(df, text).filter(clean(F.col(text)))


def digest(documents: DataFrame, labels: DataFrame) -> DataFrame:
    return score(documents, fit(documents, labels))
