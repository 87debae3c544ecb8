"""URL filter: a weighted vocabulary over host and path, and rules that override it.

An Aho-Corasick automaton finds all vocabulary terms of a URL's host and path in one pass. A term counts only
between boundaries (no ASCII letter or digit before or behind it). One strict term, or ``soft_needed`` distinct soft
terms, reject a URL. Where a rule fits, its verdict stands instead: a rule is a host and a path prefix, fits the
host and its subdomains, and the longest rule (host and path together) wins.

A null URL, or one without ``://``, has an empty host and path, no rule and no hits: it is allowed. Repeated rows
are repeated; an empty table stays empty; other columns are not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.llm.common import packed, rows_of

# Vocabulary of this package: weight 2 is strict, weight 1 soft.
STRICT = ("adult", "casino", "escort", "hentai", "porn", "sex", "viagra", "xxx")
SOFT = ("ads", "bets", "bonus", "cheap", "click", "farm", "free", "jackpot", "pills", "poker", "promo", "spam", "track", "win")
SOFT_NEEDED = 2

# The rules of the registered query, (verdict, host, path).
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)

LOWER = {i: i + 32 for i in range(65, 91)}
PARTS = re.compile(r"://([^/?#]*)([^?#]*)", re.S)
RESULT = pa.schema([("page_id", pa.int64()), ("host", pa.string()), ("path", pa.string()), ("rule", pa.string()), ("verdict", pa.string()), ("strict_hits", pa.int32()), ("soft_hits", pa.int32())])
RESULT_DDL = "page_id bigint, host string, path string, rule string, verdict string, strict_hits int, soft_hits int"


def automaton(strict: Iterable[str], soft: Iterable[str]) -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for weight, terms in ((1, soft), (2, strict)):
        for term in terms:
            found.add_word(term, (term, weight))
    if len(found):
        found.make_automaton()
    return found


def parts(url: str | None) -> tuple[str, str]:
    """Host (A-Z in lower case) and path of a URL."""
    found = PARTS.search(url or "")
    return (found[1].translate(LOWER), found[2]) if found else ("", "")


def bounded(text: str, start: int, end: int) -> bool:
    """No ASCII letter or digit touches text[start:end]."""
    before, after = text[start - 1 : start] if start else "", text[end : end + 1]
    return not (before.isascii() and before.isalnum()) and not (after.isascii() and after.isalnum())


def hits(text: str, terms: ahocorasick.Automaton) -> tuple[int, int]:
    """Numbers of distinct strict and soft terms in ``text``."""
    if not len(terms):
        return 0, 0
    found = {value for last, value in terms.iter(text) if bounded(text, last + 1 - len(value[0]), last + 1)}
    strict = sum(weight == 2 for _, weight in found)
    return strict, len(found) - strict


class Rules:
    """Rules by host; looks at a host's own suffixes only, so the number of rules does not matter."""

    def __init__(self, rules: Iterable[tuple[str, str, str]]):
        self.by_host: dict[str, list[tuple[str, str]]] = {}
        for verdict, host, path in rules:
            self.by_host.setdefault(host, []).append((path, verdict))
        for found in self.by_host.values():
            found.sort(key=lambda r: -len(r[0]))

    def fit(self, host: str, path: str) -> tuple[str, str] | None:
        """(rule, verdict) of the longest rule that fits."""
        best, labels = None, host.split(".")
        for i in range(len(labels)):
            suffix = ".".join(labels[i:])
            rule = next(((p, v) for p, v in self.by_host.get(suffix, ()) if path.startswith(p)), None)
            if rule and (best is None or len(suffix) + len(rule[0]) > len(best[0])):
                best = (suffix + rule[0], rule[1])
        return best


def judge_urls(df: DataFrame, strict=STRICT, soft=SOFT, soft_needed: int = SOFT_NEEDED, rules=RULES, page_id: str = "page_id", url: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict, strict_hits, soft_hits of every row."""
    strict, soft, rules = tuple(strict), tuple(soft), tuple(rules)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, known = automaton(strict, soft), Rules(rules)

        def rows():
            for page, url_ in rows_of(batches, "page_id", "url"):
                host, path = parts(url_)
                n_strict, n_soft = hits(host + path.translate(LOWER), terms)
                own = "block" if n_strict or n_soft >= soft_needed else "allow"
                rule = known.fit(host, path) if host or path else None
                yield page, host, path, rule and rule[0], rule[1] if rule else own, n_strict, n_soft

        yield from packed(rows(), RESULT)

    narrow = df.select(F.col(page_id).cast("bigint").alias("page_id"), F.col(url).cast("string").alias("url"))
    return narrow.mapInArrow(run, RESULT_DDL)


def oracle() -> str:
    """The registered query in SQL."""

    def seen(term: str) -> str:
        return f"CAST(regexp_matches(seen, '(^|[^a-z0-9]){term}([^a-z0-9]|$)') AS INT)"

    def count(terms) -> str:
        return " + ".join(map(seen, terms))

    def fits(host: str, path: str) -> str:
        return f"(host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{path}')"

    longest = sorted(RULES, key=lambda r: -len(r[1] + r[2]))
    rule = " ".join(f"WHEN {fits(h, p)} THEN '{h}{p}'" for _, h, p in longest)
    verdict = " ".join(f"WHEN {fits(h, p)} THEN '{v}'" for v, h, p in longest)
    lower = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
WITH cut AS (
  SELECT page_id, {lower.format("regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1)")} AS host,
         regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
lowered AS (SELECT *, host || {lower.format('path')} AS seen FROM cut),
counted AS (SELECT *, {count(STRICT)} AS strict_hits, {count(SOFT)} AS soft_hits FROM lowered)
SELECT page_id, host, path, CASE {rule} END AS rule,
       CASE {verdict} WHEN strict_hits > 0 OR soft_hits >= {SOFT_NEEDED} THEN 'block' ELSE 'allow' END AS verdict,
       strict_hits, soft_hits
FROM counted"""
