"""Metadata per page: summary, entities, document type, keywords.

The defaults are plain column rules and make no claim to a model's quality.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioflow.functions.json import has_summary, parse_json_lenient, parse_json_strict, to_metadata_json
from folioflow.functions.text import PY_WHITESPACE, model_text, py_strip, tokens
from folioflow.operators.embed import row_slices
from folioflow.operators.plugins import Plugin, apply_plugin
from folioflow.schemas import CHUNK_KEY, METADATA
from folioflow.session import written

# Fixed values of the default rules.
SENTENCE_ENDS = ".!?。！？"
# Name, pattern, and texts of which one must be there before the pattern is tried.
ENTITY_PATTERNS = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", ["@"]),
    "url": (r"https?://[A-Za-z0-9._~:/?#@!$&*+,;=%-]+", ["://"]),
    "ip": (r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}", ["."]),
    "date": (r"[0-9]{4}-[0-9]{2}-[0-9]{2}", ["-"]),
    "amount": (r"[$€£][0-9]+(?:,[0-9]{3})*(?:\.[0-9]+)?", ["$", "€", "£"]),
}
TYPE_RULES = [
    ("contract", ["agreement", "contract", "license", "licence", "copyright"]),
    ("technical report", ["function", "import ", "class ", "http", "error", "version"]),
    ("financial analysis", ["revenue", "profit", "price", "market"]),
    ("news article", ["news", "reported", "said", "today"]),
]
DEFAULT_TYPE = "other"
MAX_KEYWORDS = 5
# Words whose statistics are broadcast: all if there are no more, else at most so many of those that stand in most pages.
SHARED_WORDS = 1_000_000


def lead_summary(text: Column) -> Column:
    """The first sentence that is not blank; empty when there is none. Reads no further than that."""
    first = f"^[{PY_WHITESPACE}{SENTENCE_ENDS}]*([^{SENTENCE_ENDS}]+)"
    return py_strip(F.regexp_extract(text, first, 1))


def _contains_any(text: Column, words: list[str]) -> Column:
    return reduce(Column.__or__, [F.contains(text, F.lit(word)) for word in words])


def pattern_entities(text: Column) -> Column:
    """Distinct e-mail addresses, links, IP addresses, dates and amounts, sorted."""
    none = F.array().cast("array<string>")
    found = [
        F.when(_contains_any(text, marks), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(none)
        for pattern, marks in ENTITY_PATTERNS.values()
    ]
    return F.array_sort(F.array_distinct(F.concat(*found)))


def rule_type(text: Column) -> Column:
    """The first rule of which a word is in the lower-cased text."""
    low = F.lower(text)
    (first, words), *others = TYPE_RULES
    chain = F.when(_contains_any(low, words), first)
    for name, words in others:
        chain = chain.when(_contains_any(low, words), name)
    return chain.otherwise(DEFAULT_TYPE)


def _count_words(words: pa.Array) -> pa.Array:
    lengths = words.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    coded = words.flatten().dictionary_encode()
    n_words = max(len(coded.dictionary), 1)
    row = np.repeat(np.arange(len(words), dtype=np.int64), lengths)
    pairs, tf = np.unique(row * n_words + coded.indices.to_numpy(zero_copy_only=False), return_counts=True)
    entries = pa.StructArray.from_arrays([coded.dictionary.take(pa.array(pairs % n_words)), pa.array(tf)], names=["word", "tf"])
    per_row = np.bincount(pairs // n_words, minlength=len(words))
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(per_row)]).astype(np.int32)), entries)


def token_counts(text: Column, min_chars: int = 1) -> Column:
    """``array<struct<word,tf>>``: the distinct tokens of a text with their counts."""

    @F.arrow_udf("array<struct<word:string,tf:bigint>>")
    def count(words: pa.Array) -> pa.Array:
        sizes = words.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        parts = [_count_words(words.slice(rows.start, rows.stop - rows.start)) for rows in row_slices(sizes, len(sizes))]
        return pa.concat_arrays(parts) if parts else _count_words(words)

    words = tokens(text)
    return count(F.filter(words, lambda w: F.length(w) >= min_chars) if min_chars > 1 else words)


def word_stats(df: DataFrame, text: str) -> DataFrame:
    """``word, df, total``: in how many of the rows a word stands, and of how many rows.

    Made once over a corpus and handed to the streams, so that what a page's keywords are does
    not depend on the batch that it comes in.
    """
    return _stats_of(df.select(F.inline(token_counts(F.col(text)))), df.agg(F.count("*")).scalar())


def _stats_of(counts: DataFrame, total: Column) -> DataFrame:
    return counts.groupBy("word").agg(F.count("*").alias("df")).withColumn("total", total)


def keyword_scores(df: DataFrame, key: list[str], text: str, stats: DataFrame | None = None, min_chars: int = 1) -> DataFrame:
    """``key, word, score``: TF-IDF of the words of each row (one row per key).

    ``stats`` is a table as :func:`word_stats` gives; without it the given rows are the corpus.
    Words are counted once, inside each row, and the counts written, because both the document
    frequencies and the scores come from them. Words found in many pages, which are most of the
    rows, meet their statistics where they lie; only rare ones are shuffled.
    """
    counts = written(df.select(*key, F.inline(token_counts(F.col(text), min_chars))), "words")
    if stats is None:
        # Pages without words count as well.
        stats = written(_stats_of(counts, F.lit(df.count())), "stats")
    weighted = _with_stats(counts, stats)
    score = F.round(F.col("tf") * F.log((F.col("total") + 1) / (F.coalesce("df", F.lit(0)) + 1)), 6)
    return weighted.select(*key, "word", F.coalesce(score, F.col("tf").cast("double")).alias("score"))


def _with_stats(counts: DataFrame, stats: DataFrame) -> DataFrame:
    """``counts`` with ``df`` and ``total`` of their words, null where there are none; both are written tables."""
    # Words by the power of two in their df: some thirty numbers.
    power = F.floor(F.log2("df"))
    n, least = 0, None
    sizes = stats.groupBy(power.alias("power")).agg(F.count("*").alias("n")).orderBy(F.desc_nulls_last("power")).collect()
    for size in sizes:
        n += size.n
        if n <= SHARED_WORDS:
            least = size.power
    if n <= SHARED_WORDS:
        return counts.join(F.broadcast(stats), "word", "left")
    if least is None:
        return counts.join(stats, "word", "left")
    common = stats.filter(power >= least)
    near = counts.join(F.broadcast(common), "word")
    rare = counts.join(F.broadcast(common.select("word")), "word", "left_anti")
    return near.unionByName(rare.join(stats, "word", "left"))


def top_keywords(df: DataFrame, key: list[str], text: str, k: int = MAX_KEYWORDS, stats: DataFrame | None = None, min_chars: int = 1) -> DataFrame:
    """``key, keywords``: the best ``k`` words by score, ties by word; pages without words are absent."""
    # A number leads the sort: keys are long texts that begin alike.
    best = Window.partitionBy(F.xxhash64(*key), *key).orderBy(F.desc("score"), "word")
    ranked = keyword_scores(df, key, text, stats, min_chars).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    listed = F.array_sort(F.collect_list(F.struct("rank", "word")))
    return ranked.groupBy(*key).agg(F.transform(listed, lambda x: x["word"]).alias("keywords"))


def extract_metadata(
    pages: DataFrame, fn: Plugin | None = None, key: list[str] | None = None, text: str = "page_text", batch_rows: int | None = None,
    stats: DataFrame | None = None,
) -> DataFrame:
    """Add ``metadata`` (a struct), and ``error`` with a plug-in.

    The plug-in gets ``model_text`` and ``image`` (null where there is none) and yields
    ``metadata_raw`` (the model's text) and ``error``. Its text is parsed leniently; a text
    without a usable summary gives null metadata and the error ``BadAnswer``. ``stats`` are the
    corpus statistics of the default keywords (:func:`word_stats`).
    """
    key = key or CHUNK_KEY
    if fn is None:
        keywords = top_keywords(pages, key, text, stats=stats)
        built = F.struct(
            lead_summary(F.col(text)).alias("summary"),
            pattern_entities(F.col(text)).alias("extracted_entities"),
            rule_type(F.col(text)).alias("document_type"),
            F.coalesce("keywords", F.array().cast("array<string>")).alias("keywords"),
        )
        return pages.join(keywords, key, "left").withColumn("metadata", built).drop("keywords")

    asked = pages.withColumn("model_text", model_text(F.col(text)))
    if "image" not in asked.columns:
        asked = asked.withColumn("image", F.lit(None).cast("binary"))
    told = apply_plugin(asked, fn, ["model_text", "image"], "metadata_raw string, error string", batch_rows)
    told = told.withColumn("metadata", metadata_from_text(F.col("metadata_raw")))
    unusable = F.when(F.col("metadata").isNull(), F.lit("BadAnswer: no usable summary"))
    return told.withColumn("error", F.coalesce("error", unusable)).drop("model_text", "metadata_raw")


def metadata_from_text(raw: Column, strict: bool = False) -> Column:
    """Typed metadata from a model's text; null when it is no JSON or has no truthy summary.

    A field of another shape than expected is kept as its JSON text, and an entity object as
    one entry per value.
    """
    value = parse_json_strict(raw) if strict else parse_json_lenient(raw)

    def field(name: str, kind: str) -> Column:
        return F.try_variant_get(value, f"$.{name}", kind)

    entities = F.coalesce(
        field("extracted_entities", "array<string>"),
        F.map_values(field("extracted_entities", "map<string,string>")),
        F.when(field("extracted_entities", "string").isNotNull(), F.array(field("extracted_entities", "string"))),
    )
    keywords = F.coalesce(
        field("keywords", "array<string>"), F.when(field("keywords", "string").isNotNull(), F.array(field("keywords", "string")))
    )
    built = F.struct(
        field("summary", "string").alias("summary"),
        entities.alias("extracted_entities"),
        field("document_type", "string").alias("document_type"),
        keywords.alias("keywords"),
    ).cast(METADATA)
    return F.when(has_summary(value), built)


def require_summary(pages: DataFrame, summary: str = "metadata.summary") -> DataFrame:
    """Pages with a summary; null and empty ones go, a blank one stays."""
    return pages.filter(F.coalesce(F.col(summary) != "", F.lit(False)))


def drop_failed(pages: DataFrame) -> DataFrame:
    """Pages whose model call worked."""
    return pages.filter(F.col("error").isNull())


def metadata_json(metadata: str = "metadata") -> Column:
    return to_metadata_json(F.col(metadata))
