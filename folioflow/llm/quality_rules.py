"""Quality rules with host verdicts.

Every document is measured on its own. Failures of the base rules are then counted by host; a host's failure rate is
shrunk towards the rate of all hosts by a beta prior whose two parameters are fitted to the hosts' rates by moments,
so a host of few documents is judged mildly. A document is kept if it passes the base rules and its host does not
fail too often. The measures are written once, without texts; hosts are counted with partial sums and their verdicts
joined back, where Spark splits a host that has very many documents.

A null text counts as empty and fails (no words). A null host is a host of its own. Repeated rows count each time.
With no documents, or hosts that all have one rate, the prior is that rate with the weight ``least_weight``.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.llm.common import kept, packed, rows_of

MIN_WORDS = 20
REPEAT_PERCENT = 30
WINDOW = 8
# A host whose shrunk failure rate is above this loses all its documents.
HOST_LIMIT = 0.5
LEAST_WEIGHT = 10.0
SYMBOLS = b"#*$%&|<>"
CONTINUED = bytes(range(0x80, 0xC0))  # bytes of UTF-8 that begin no character

MEASURES = pa.schema([("doc_id", pa.int64()), ("host", pa.string()), ("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()), ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64())])
MEASURES_DDL = "doc_id bigint, host string, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint"


def repeat_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside windows that stand twice or more in the text, the first of them included."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    numbers: dict[bytes, int] = {}
    fresh = count()
    ids = np.fromiter((numbers[w] if w in numbers else numbers.setdefault(w, next(fresh)) for w in words), np.int64, len(words))
    # Rank of each window by doubling its length: equal ranks are equal windows.
    ranks, length = ids, 1
    while length < window:
        step = min(length, window - length)
        pairs = ranks[: len(ranks) - step] * (int(ranks.max()) + 1) + ranks[step:]
        ranks, length = np.unique(pairs, return_inverse=True)[1], length + step
    twice = np.bincount(ranks)[ranks] > 1
    marks = np.zeros(len(words) + 1, np.int64)
    marks[:n] += twice
    marks[window:] -= twice
    return int((np.cumsum(marks)[:-1] > 0).sum())


def measure(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a text."""
    raw = (text or "").encode()
    words = raw.split()
    lines = [line for line in raw.split(b"\n") if line.strip()]
    starts = b"".join(words).translate(None, CONTINUED)
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    return len(words), len(starts), symbols, len(lines) - len(set(lines)), repeat_words(words)


def measures(df: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from packed(((d, h, *measure(t)) for d, h, t in rows_of(batches, "doc_id", "host", "text")), MEASURES)

    narrow = df.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(host).cast("string").alias("host"), F.col(text).cast("string").alias("text"))
    return narrow.mapInArrow(run, MEASURES_DDL)


def host_verdicts(judged: DataFrame, limit: float = HOST_LIMIT, least_weight: float = LEAST_WEIGHT) -> DataFrame:
    """host, n_docs, n_failed, host_failed from rows of (host, base_failed).

    The prior has the mean of all documents and the weight m(1-m)/v - 1, where v is the variance of the hosts'
    rates less what chance alone would give; the weight is at least ``least_weight``.
    """
    hosts = judged.groupBy("host").agg(F.count("*").alias("n_docs"), F.sum(F.col("base_failed").cast("bigint")).alias("n_failed"))
    rate = F.col("n_failed") / F.col("n_docs")
    total = hosts.agg(F.sum("n_docs").alias("n"), F.sum("n_failed").alias("k"), F.count("*").alias("hosts"), F.sum(rate).alias("r"), F.sum(rate * rate).alias("rr"), F.sum(1 / F.col("n_docs")).alias("inverse")).first()
    mean, weight = prior(total.n or 0, total.k or 0, total.hosts or 0, total.r or 0.0, total.rr or 0.0, total.inverse or 0.0, least_weight)
    shrunk = (F.col("n_failed") + mean * weight) / (F.col("n_docs") + weight)
    return hosts.withColumn("host_failed", shrunk > limit)


def prior(n: int, k: int, hosts: int, rates: float, squares: float, inverse: float, least: float) -> tuple[float, float]:
    """Mean and weight (alpha + beta) of the beta prior, from sums over the hosts."""
    if not n:
        return 0.0, least
    mean = k / n
    spread = mean * (1 - mean)
    own = squares / hosts - 2 * mean * rates / hosts + mean * mean - spread * inverse / hosts
    return mean, max(least, spread / own - 1) if own > 1e-9 else max(least, 1e6 if spread else least)


def judge(df: DataFrame, min_words: int = MIN_WORDS, repeat_percent: int = REPEAT_PERCENT, limit: float = HOST_LIMIT, doc_id: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """The measures of every document with base_failed, host_failed and kept."""
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > repeat_percent * F.col("n_words"))
    measured = kept(measures(df, doc_id, text, host).withColumn("base_failed", failed), "measures")
    hosts = kept(host_verdicts(measured, limit), "hosts").select(F.col("host").alias("_host"), "host_failed")
    return measured.join(hosts, measured["host"].eqNullSafe(hosts["_host"])).drop("_host").withColumn("kept", ~F.col("base_failed") & ~F.col("host_failed"))


def digest(df: DataFrame) -> DataFrame:
    return judge(df).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "host_failed")


ORACLE = f"""
WITH words AS (
  SELECT doc_id, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
lines AS (
  SELECT doc_id, sum(n - 1) AS n_dup_lines FROM (
    SELECT doc_id, line, count(*) AS n FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM words)
    WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id, line) GROUP BY doc_id),
windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + {WINDOW - 1}], ' ') AS said FROM (SELECT doc_id, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM words)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, said) AS n FROM windows) WHERE n > 1),
repeats AS (SELECT doc_id, count(DISTINCT place) AS n_repeat_words FROM (SELECT doc_id, unnest(range(i, i + {WINDOW})) AS place FROM twice) GROUP BY doc_id),
measured AS (
  SELECT doc_id, source, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
  FROM words LEFT JOIN lines USING (doc_id) LEFT JOIN repeats USING (doc_id)),
judged AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {REPEAT_PERCENT} * n_words AS base_failed FROM measured),
hosts AS (SELECT source, count(*) AS n, sum(CAST(base_failed AS INT)) AS k FROM judged GROUP BY source),
moments AS (
  SELECT sum(k) / sum(n) AS mean, sum(k) / sum(n) * (1 - sum(k) / sum(n)) AS spread,
         sum((k / n) * (k / n)) / count(*) AS squares, sum(k / n) / count(*) AS rates, sum(1 / n) / count(*) AS inverse FROM hosts),
fitted AS (SELECT mean, spread, squares - 2 * mean * rates + mean * mean - spread * inverse AS own FROM moments),
prior AS (
  SELECT mean, CASE WHEN own > 1e-9 THEN greatest({LEAST_WEIGHT}, spread / own - 1) WHEN spread > 0 THEN greatest({LEAST_WEIGHT}, 1e6) ELSE {LEAST_WEIGHT} END AS weight FROM fitted),
verdicts AS (SELECT source, (k + mean * weight) / (n + weight) > {HOST_LIMIT} AS host_failed FROM hosts, prior)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT host_failed AS kept, host_failed
FROM judged JOIN verdicts ON judged.source IS NOT DISTINCT FROM verdicts.source"""
