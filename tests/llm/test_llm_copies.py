"""SimHash and substring dedup against brute force, large groups, odd rows."""

import random
import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from folioflow.llm import simhash, substring_dedup


def plain_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_groups(prints, bits):
    """The root of each value, from all pairs."""
    values = sorted(set(prints), key=lambda v: v - (1 << 64) if v >> 63 else v)
    codes, root = np.array(values, np.uint64), {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for i, v in enumerate(values):
        for j in np.flatnonzero(np.bitwise_count(codes[i + 1 :] ^ codes[i]) <= bits).tolist():
            a, b = find(v), find(values[i + 1 + j])
            if a != b:
                root[b] = a
    return {v: find(v) for v in values}


def partition(groups):
    out = defaultdict(set)
    for k, v in groups.items():
        out[v].add(k)
    return sorted(map(sorted, out.values()))


def signed(v):
    return v - (1 << 64) if v >> 63 else v


@pytest.mark.parametrize("parts", [1, 6])
def test_links_are_complete(spark, monkeypatch, parts):
    """Pairs, chains and a group far longer than a leaf, cut over ranges."""
    monkeypatch.setattr(simhash, "GROUP", 64)
    draw = random.Random(5)
    values = [draw.getrandbits(64) for _ in range(800)] + [0, 1, (1 << 64) - 1]
    for v in values[:300]:
        for _ in range(3):
            for b in draw.sample(range(64), draw.randint(1, 4)):
                v ^= 1 << b
            values.append(v)
    center = draw.getrandbits(64)
    values += [center ^ sum(1 << b for b in draw.sample(range(64), draw.randint(0, 2))) for _ in range(700)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        for bits in (3, 1):
            prints = spark.createDataFrame([(signed(v),) for v in values], "print bigint")
            roots = {r.a: r.root for r in simhash.connected(simhash.links(prints, bits)).collect()}
            got = {signed(v): roots.get(signed(v), signed(v)) for v in values}
            want = {signed(k): signed(v) for k, v in plain_groups(values, bits).items()}
            assert partition(got) == partition(want)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_orders_round_trip():
    codes = np.random.default_rng(1).integers(0, 2**64, 500, dtype=np.uint64)
    for order in simhash.ORDERS:
        assert (simhash.restored(simhash.reordered(codes, order), order) == codes).all()
    assert (simhash.gray_code(simhash.gray_rank(codes)) == codes).all()
    assert simhash.gray_rank(np.array([0, 1, 3, 2, 6], np.uint64)).tolist() == [0, 1, 2, 3, 4]


def test_simhash_rows(docs, odd_rows):
    draw = random.Random(2)
    base = [draw.choice("abcdefghij") * draw.randint(1, 4) for _ in range(300)]
    rows = list(odd_rows)
    for i in range(40):
        words = list(base) if i % 2 else [draw.choice("klmnopqrst") * draw.randint(1, 4) for _ in range(80)]
        words[draw.randrange(len(words))] = "changed"
        rows.append((100 + i, " ".join(words)))
    df = docs(*rows)
    got = simhash.digest(df).collect()
    prints = [plain_print(t) for _, t in rows]
    roots = plain_groups(prints, 3)
    least = {}
    for (d, _), p in zip(rows, prints):
        if d is not None:
            least[roots[p]] = min(d, least.get(roots[p], d))
    want = sorted(((d, f"{p:016x}", least.get(roots[p])) for (d, _), p in zip(rows, prints)), key=repr)
    assert sorted(map(tuple, got), key=repr) == want
    left = simhash.first_of_each(df)
    assert left.columns == df.columns
    kept = [(r.doc_id, r.text) for r in left.collect()]
    assert len(kept) == len(set(roots.values())) and len({roots[plain_print(t)] for _, t in kept}) == len(kept)
    assert simhash.digest(df.limit(0)).count() == 0


def plain_removed(rows, span, min_words):
    """Sentences of each document that go, the slow way."""
    at = defaultdict(list)
    for d, t in rows:
        for first, end, hashed in substring_dedup.spans(substring_dedup.sentences(t), span, min_words):
            at[hashed].append((d is not None, d or 0, t, first, end))
    gone = defaultdict(set)
    for places in at.values():
        first = min(p[:2] for p in places)
        for known, d, t, start, end in places:
            inner = min(p[3] for p in places if p[:3] == (known, d, t))
            if (known, d) != first or start != inner:
                gone[(d if known else None, t)].update(range(start, end))
    return {(d, t): len(gone[(d, t)]) for d, t in rows}


def test_substrings(docs, odd_rows):
    draw = random.Random(4)

    def sentence():
        return " ".join(draw.choice("abcdefgh") * draw.randint(1, 5) + draw.choice("xyz") for _ in range(draw.randint(1, 40))) + draw.choice([". ", ".\n", "! ", "? "])

    passages = ["".join(sentence() for _ in range(6)) for _ in range(5)]
    rows = list(odd_rows)
    for i in range(80):
        own = [sentence() for _ in range(6)]
        own.insert(draw.randint(0, 6), passages[0 if i % 3 == 0 else draw.randrange(5)])
        rows.append((100 + i, "".join(own)))
    rows += [(300, passages[0] + passages[0]), (301, "no. copy. at. all. here."), (302, rows[20][1])]
    got = substring_dedup.remove_repeats(docs(*rows)).collect()
    want = plain_removed(rows, substring_dedup.SPAN, substring_dedup.MIN_WORDS)
    assert sorted(((r.doc_id, r.n_removed) for r in got), key=repr) == sorted(((d, want[(d, t)]) for d, t in rows), key=repr)
    for r in got:
        parts = substring_dedup.sentences(next(t for d, t in rows if d == r.doc_id and (t is None) == (r.text is None)))
        assert r.n_removed or r.text is None or r.doc_id in (3, 4, None) or r.text == "".join(parts)
    by = {r.doc_id: r for r in got}
    assert by[302].text == "" and by[302].first_doc_ids and by[301].n_removed == 0
    assert sum(passages[0] in (r.text or "") for r in got) <= 1
    assert substring_dedup.remove_repeats(docs((1, "x")).limit(0)).count() == 0


def own_pieces(text, window=9):
    """Runs of words, cut the slow way: behind the least of any nine words in a row, an end of a sentence before all others."""
    words = text.split()
    ends = [bool(re.search(r"[.!?]$", w)) or after.startswith("\n") or "\n" in after for w, after in re.findall(r"(\S+)(\s*)", text)]
    ends[-1:] = [words[-1][-1] in ".!?" and text[-1].isspace() or "\n" in text[len(text.rstrip()):]] if words else []
    keys = [(not e, xxhash.xxh64_intdigest(w.lower()) >> 1) for w, e in zip(words, ends)]
    cuts = {min(range(at, at + window), key=keys.__getitem__) for at in range(len(words) - window + 1)} | {len(words) - 1} if words else set()
    pieces, start = [], 0
    for cut in sorted(cuts):
        pieces.append([w.lower() for w in words[start : cut + 1]])
        start = cut + 1
    return pieces


def own_spans(pieces):
    """(first, end) of the shortest run of two pieces or more with fifteen words that each piece starts."""
    found = []
    for i in range(len(pieces)):
        for e in range(i + 2, len(pieces) + 1):
            if sum(map(len, pieces[i:e])) >= 15:
                found.append((i, e))
                break
    if found and found[-1][1] < len(pieces):
        found.append((found[-1][0], len(pieces)))
    return found


def test_against_a_version_of_its_own(docs):
    """Cuts, spans, hashes, first documents and covered pieces, none of it by the code under test."""
    draw = random.Random(21)
    names = ["".join(draw.choice("abcdefghijklmnop") for _ in range(draw.randint(2, 9))) for _ in range(4000)]

    def prose(n, stop):
        words = draw.sample(names, n)
        return " ".join(w + (draw.choice([".", "!", "?"]) if draw.random() < stop else "") for w in words).capitalize()

    shared = [prose(draw.randint(20, 90), 0.07) for _ in range(8)]
    rows = []
    for i in range(60):
        parts = [prose(draw.randint(1, 70), draw.choice([0, 0.05, 0.3])) for _ in range(draw.randint(1, 4))]
        if i % 3:
            parts.insert(draw.randint(0, len(parts)), shared[draw.randrange(8)])
        rows.append((i, draw.choice([" ", "\n", "\n\n", ". "]).join(parts)))
    rows += [(70, rows[4][1]), (71, rows[4][1].upper()), (72, shared[0] + " " + shared[0])]
    pieces = {d: own_pieces(t) for d, t in rows}
    first, within = {}, {}
    for d, parts in pieces.items():
        for i, e in own_spans(parts):
            said = " ".join(w for p in parts[i:e] for w in p)
            first.setdefault(said, d)
            within.setdefault((d, said), e)
    want = {}
    for d, parts in pieces.items():
        gone = set()
        for i, e in own_spans(parts):
            said = " ".join(w for p in parts[i:e] for w in p)
            if first[said] != d or within[d, said] != e:
                gone.update(range(i, e))
        want[d] = (len(parts), len(gone), [w for n, p in enumerate(parts) if n not in gone for w in p])
    got = substring_dedup.remove_repeats(docs(*rows)).collect()
    assert {r.doc_id: (r.n_sentences, r.n_removed, r.text.lower().split()) for r in got} == want
    assert sum(n > 0 for _, n, _ in want.values()) > 25


def test_filter_lets_every_shared_hash_through(spark):
    draw = random.Random(22)
    low = [draw.randrange(-(1 << 63), 1 << 63) for _ in range(3000)]
    shared = spark.createDataFrame([(v,) for v in low[:500]], "_low bigint")
    every = spark.createDataFrame([(v,) for v in low], "low bigint")
    for bits in (1 << 27, 1 << 10):
        left = {r.low for r in every.filter(substring_dedup.may_be_shared(shared, bits)).collect()}
        assert set(low[:500]) <= left and (bits == 1 << 10 or len(left) < 700)
    assert every.filter(substring_dedup.may_be_shared(shared.limit(0))).count() == 0


def test_sentences_join_to_the_text():
    draw = random.Random(9)
    for _ in range(300):
        text = "".join(draw.choice(["a", "word ", ". ", "\n", "! ", "中。", "x.y ", "  ", "long" * 9 + " "]) for _ in range(draw.randint(0, 200)))
        assert "".join(substring_dedup.sentences(text)) == text


def test_long_passage_in_unpunctuated_texts(docs):
    draw = random.Random(11)

    def words(n):
        return " ".join("".join(draw.choice("abcdefghijk") for _ in range(5)) for _ in range(n))

    passage = words(120)
    got = substring_dedup.remove_repeats(docs((1, f"{words(37)} {passage} {words(20)}"), (2, f"{words(90)} {passage} {words(31)}"))).orderBy("doc_id").collect()
    assert got[0].n_removed == 0 and got[1].n_removed > 0 and got[1].first_doc_ids == [1]


@pytest.mark.parametrize("lengths", [[51], [15, 15, 15, 15], [18, 18, 18], [24, 30], [20, 20, 20]])
def test_passages_of_over_fifty_words_share_a_span(lengths):
    """Glued to other words inside sentences at both ends, and as paragraphs of their own."""
    draw = random.Random(12)

    def words(n):
        return ["".join(draw.choice("abcdefghijk") for _ in range(draw.randint(2, 8))) for _ in range(n)]

    def hashes(text):
        return {h for _, _, h in substring_dedup.spans(substring_dedup.sentences(text), substring_dedup.SPAN, substring_dedup.MIN_WORDS)}

    for _ in range(300):
        passage = ". ".join(" ".join(words(n)) for n in lengths)
        around = [" ".join(words(draw.randint(3, 40))) for _ in range(4)]
        assert hashes(f"{around[0]}{passage}{around[1]}") & hashes(f"{around[2]}{passage}{around[3]}")
        assert hashes(f"{around[0]}.\n\n{passage}.\n\n{around[1]}") & hashes(f"{around[2]}\n{passage}.\n{around[3]}")


def test_passages_without_spaces(docs):
    draw = random.Random(13)

    def letters(n):
        return "".join(chr(draw.randrange(0x4E00, 0x9000)) + ("，" if draw.random() < 0.1 else "") for _ in range(n))

    passage = letters(110)
    got = substring_dedup.remove_repeats(docs((1, f"{letters(37)}{passage}{letters(20)}。"), (2, f"{letters(90)}{passage}{letters(31)}"))).orderBy("doc_id").collect()
    assert got[0].n_removed == 0 and got[1].first_doc_ids == [1]
    assert len(got[1].text) < 90 * 1.3 + 31 * 1.3 + 50


def test_a_passage_inside_sentences_is_removed(docs):
    draw = random.Random(14)

    def words(n):
        return " ".join("".join(draw.choice("abcdefghijk") for _ in range(6)) for _ in range(n))

    passage = words(51)
    got = substring_dedup.remove_repeats(docs((1, f"{words(9)}{passage}{words(9)}."), (2, f"{words(15)}. {words(5)}{passage}{words(3)}. {words(12)}."))).orderBy("doc_id").collect()
    assert got[0].n_removed == 0 and got[1].n_removed > 0 and got[1].first_doc_ids == [1]
