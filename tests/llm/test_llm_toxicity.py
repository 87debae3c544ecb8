"""Toxicity: the automaton against plain edit distance, held-out accuracy, misspellings, quotation, odd rows."""

import math
import random

import pytest

from folioflow.llm import toxicity


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = _next(row, i, x, b)
    return row[-1]


def _next(row, i, x, b):
    out = [i]
    for j, y in enumerate(b, 1):
        out.append(min(row[j] + 1, out[-1] + 1, row[j - 1] + (x != y)))
    return out


@pytest.mark.parametrize("errors", [((5, 1),), ((4, 1), (8, 2))])
def test_automaton(monkeypatch, errors):
    monkeypatch.setattr(toxicity, "ERRORS", errors)
    draw = random.Random(1)
    terms = {t: 1.0 for t in ("idiot", "stupid", "pathetic", "worthless", "scum", "disgusting")}
    trie = toxicity.Trie(terms, {})
    for _ in range(3000):
        word = list(draw.choice(list(terms)))
        for _ in range(draw.randint(0, 3)):
            at = draw.randrange(len(word) + 1)
            word[at : at + draw.randint(0, 1)] = draw.choice(["", "x", "i", "t"])
        word = "".join(word)
        allowed = toxicity.allowed_errors(len(word))
        near = sorted((distance(word, t), t) for t in terms if 0 < distance(word, t) <= allowed)
        found = trie.close(word)
        assert found == ((near[0][1], near[0][0]) if near else None) or word in terms


def made(spark, n, seed):
    draw = random.Random(seed)
    bad, rows, labels = ["moron", "worthless", "pathetic", "vequelle", "vequette"], [], []
    plain = ["".join(draw.choice("abcdefghij") for _ in range(draw.randint(2, 7))) for _ in range(400)]
    for i in range(n):
        words, toxic = [draw.choice(plain) for _ in range(draw.randint(10, 60))], i % 5 == 0
        for _ in range(draw.randint(2, 4) if toxic else 0):
            words.insert(draw.randrange(len(words)), draw.choice(bad))
        rows.append((i, " ".join(words), "src", i, "x"))
        if i % 3:
            labels.append((i, 1, int(toxic)))
    return spark.createDataFrame(rows, "doc_id bigint, text string, source string, toxic int, score string"), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def test_learned_from_labels(spark):
    docs, labels = made(spark, 900, 3)
    model = toxicity.fit(docs, labels)
    got = toxicity.score(docs, model).collect()
    assert sum(r.predicted == int(r.doc_id % 5 == 0) for r in got) >= 0.99 * len(got)
    assert sum(r.held_out for r in got) > 100 and all(0 <= r.score <= 1 for r in got)
    finder = toxicity.Finder(model)
    clean = toxicity.value(finder, model, "abc def ghi")[0]
    assert toxicity.value(finder, model, "abc worthles def morron ghi pathettic")[0] > 0.5 > clean
    said = "abc def ghij bca. " * 3
    plain = f"{said} worthless {said} moron {said}"
    quoted = f'{said} "worthless" {said} "moron" {said}'
    assert toxicity.value(finder, model, quoted)[0] < toxicity.value(finder, model, plain)[0]
    left = toxicity.without_toxic(docs, model)
    assert left.columns == docs.columns and {r.doc_id for r in left.collect()} == {r.doc_id for r in got if not r.predicted}


def test_held_out_labels_are_not_used(spark):
    docs, labels = made(spark, 300, 5)
    from pyspark.sql import functions as F

    turned = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert toxicity.fit(docs, labels) == toxicity.fit(docs, turned)


def test_odd(spark, docs, odd_rows):
    some, labels = made(spark, 300, 6)
    model = toxicity.fit(docs(*odd_rows), labels.limit(0))
    assert {(r.score, r.predicted) for r in toxicity.score(docs(*odd_rows), model).collect()} == {(0.0, 0)}
    odd = labels.selectExpr("doc_id", "toxic").union(spark.sql("SELECT CAST(null AS bigint), 1 UNION ALL SELECT 3, CAST(null AS int) UNION ALL SELECT 99999, 1"))
    model = toxicity.fit(some, odd)
    got = toxicity.score(docs(*odd_rows), model).collect()
    assert len(got) == len(odd_rows) and not any(r.predicted for r in got)
    assert toxicity.score(some.limit(0), model).count() == 0 and toxicity.fit(some.limit(0), labels).terms == {}


def test_every_term_is_spelled():
    draw = random.Random(8)
    terms = {"".join(draw.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(9)): 5.0 - i / 1000 for i in range(400)}
    trie = toxicity.Trie(terms, {})
    assert all(trie.close(t[:4] + "0" + t[5:]) == (t, 1) and trie.close(t[1:]) == (t, 1) for t in terms)


def test_copies_count_once(spark):
    """One toxic text copied over and over does not bring its own words into the lexicon."""
    docs, labels = made(spark, 600, 9)
    rare = " ".join(f"rareword{c}{d}" for c in "abcdefghijklmn" for d in "opqrstuvwxyz")
    copies = [(10_000 + i, rare + " moron", "src", 1, "x") for i in range(300)]
    docs = docs.union(spark.createDataFrame(copies, docs.schema))
    labels = labels.union(spark.createDataFrame([(d, 1, 1) for d, *_ in copies], labels.schema))
    model = toxicity.fit(docs, labels)
    assert "moron" in model.terms and not any(t.startswith("rare") for t in [*model.terms, *model.stems])


def test_quotation_in_long_texts():
    """Hits in quotation marks are told apart however many marks and hits a text has."""
    finder = toxicity.Finder(toxicity.Model({"moron": 5.0}, {}, frozenset(), (0.0,) * 6))
    quoted = "he said that they had once called him a \"moron\" in the street and then went on. "
    plain = quoted.replace('"', "")
    for n in (3, 150, 700):
        x = finder.features(quoted * n)
        assert round(x[1], 9) == round(x[4], 9) == round(math.log1p(n), 9)
        assert finder.features(plain * n)[4] == 0
    assert finder.features('"moron moron" ' * 300)[4] == 0
    assert finder.features(quoted * 3)[0] == pytest.approx(3 * 5.0 * toxicity.QUOTED / 10)


def test_misspelled_beginnings_of_inflected_terms(spark):
    """Terms that share a stem are sought with errors in the stem too."""
    draw = random.Random(10)
    plain = ["".join(draw.choice("abcdefghj") for _ in range(draw.randint(2, 7))) for _ in range(300)]
    rows = [(i, " ".join([*(draw.choice(plain) for _ in range(30)), *(("zwquelt", "zwquelts") if i % 5 == 0 else ())])) for i in range(500)]
    model = toxicity.fit(spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame([(i, int(i % 5 == 0)) for i, _ in rows], "doc_id bigint, toxic int"))
    assert model.stems and {"zwquelt", "zwquelts"} <= model.terms.keys()
    finder = toxicity.Finder(model)
    for word in ("zwquelt", "zwquelts", "zvquelt", "1wquelts", "wquelts"):
        assert finder.features(f"abc def {word} ghi")[1] == math.log1p(1), word
    assert finder.features("zwquelt zvquelts")[2] == math.log1p(1)
