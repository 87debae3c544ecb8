"""Links between the tokens of two tokenizers, against the libraries and a plain merge."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from folioflow.llm import token_alignment
from folioflow.llm.queries import BYTE_BPE, PIECE_BPE, QUERIES

PATTERN = public_tokenizers.PATTERN
EXTRA = ["<|endoftext|> and <s> </s> <unk>", "a▁b", "a  b\t\n\nc", "don't he'LL", "é 中文字 😀👍🏽 ß İ", "\x00\x1c\x85 ", "x" * 3000, "ab " * 5000, "<0x41>", " lead", "trail "]


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(BYTE_BPE)
    a.encode_special_tokens = True
    letters = token_alignment.byte_letters()
    return a, [bytes(map(letters.__getitem__, a.id_to_token(i))) if i < 50256 else b"" for i in range(50257)], sentencepiece.SentencePieceProcessor(model_file=PIECE_BPE)


def plain(text, libraries):
    """(A ids, B ids, links by place, cuts) of one text, token by token."""
    a_lib, a_bytes, b_lib = libraries
    if not text:
        return [], [], [], []
    a = a_lib.encode(" " + text, add_special_tokens=False).ids
    b = b_lib.encode(text)
    parts_a = [a_bytes[i] for i in a]
    parts_b = []
    for i in b:
        piece = b_lib.id_to_piece(i)
        parts_b.append(bytes([int(piece[3:5], 16)]) if b_lib.is_byte(i) else piece.replace("▁", " ").encode())
    if not b"".join(parts_a) == b"".join(parts_b) == (" " + text).encode():
        return [], [], [], []
    spans = []
    for parts in (parts_a, parts_b):
        ends = np.cumsum([len(p) for p in parts]).tolist()
        spans.append(list(zip([0, *ends], ends)))
    links, j = [], 0
    for i, (s, e) in enumerate(spans[0]):
        while spans[1][j][1] <= s:
            j += 1
        k = j
        while k < len(b) and spans[1][k][0] < e:
            links.append((i, k))
            k += 1
    cuts = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
    return a, b, links, cuts


def brute(rows, libraries):
    every = [(i, *plain(t, libraries)) for i, t in rows]
    counts = Counter((a[x], b[y]) for _, a, b, links, _ in every for x, y in links)
    most = Counter()
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    for doc_id, a, b, links, cuts in every:
        met = [(a[x], b[y]) for x, y in links]
        text, at_a, at_b = [], 0, 0
        ends_a = {x: None for x in range(len(a))}
        group_of_a, group_of_b = {}, {}
        # A group ends where a link's two tokens are each other's last.
        last_of_a, last_of_b = {x: y for x, y in links}, {y: x for x, y in links}
        group = 0
        for x, y in links:
            group_of_a.setdefault(x, group)
            group_of_b.setdefault(y, group)
            group += last_of_a[x] == y and last_of_b[y] == x
        for g in range(group):
            text.append(",".join(str(a[x]) for x in ends_a if group_of_a[x] == g) + "|" + ",".join(str(b[y]) for y in range(len(b)) if group_of_b[y] == g)) if len(a) < 300 else None
        digest = hashlib.sha256(";".join(text).encode()).hexdigest() if a else ""
        yield doc_id, len(a), len(b), len(cuts), len(links), sum(counts[p] == most[p[1]] for p in met), sum(counts[p] for p in met), digest if len(a) < 300 else None


def compare(got, rows, libraries):
    mine = sorted(((*tuple(r)[:7], r.groups_sha256 if r.n_a < 300 else None) for r in got), key=repr)
    assert mine == sorted(brute(rows, libraries), key=repr)


def test_fast_encoder_is_the_librarys(libraries):
    own = token_alignment.ByteLevel(BYTE_BPE, PATTERN)
    assert own.fast is not None and own.tokens[:50256] == libraries[1][:50256]
    texts = [" " + t for t in EXTRA] + [" " * 20_000 + "x", "q" * 20_000]
    assert own.encode(texts) == [libraries[0].encode(t, add_special_tokens=False).ids for t in texts]


def test_merge_in_lanes():
    draw = np.random.default_rng(5)
    for lane in (1, 2, 3, 7, 1000):
        ends_a, ends_b, n_a, base = [], [], [], 0
        for size in (0, 1, 40, 3, 90):
            a, b = (np.unique(np.append(draw.integers(1, size, size // 2), size)) if size else np.zeros(0, int) for _ in "ab")
            ends_a, ends_b, n_a, base = [*ends_a, *(a + base)], [*ends_b, *(b + base)], [*n_a, len(a)], base + size
        ends_a, ends_b = np.array(ends_a), np.array(ends_b)
        got = token_alignment.merge(ends_a, ends_b, np.array(n_a), lane)
        both = np.union1d(ends_a, ends_b)
        assert got[0].tolist() == np.searchsorted(ends_a, both).tolist()
        assert got[1].tolist() == np.searchsorted(ends_b, both).tolist()
        assert both[got[2]].tolist() == np.intersect1d(ends_a, ends_b).tolist()


def test_links_and_cuts(docs, libraries):
    rows = list(enumerate([*EXTRA, None, ""]))
    found = {r.doc_id: r for r in token_alignment.align(docs(*rows), BYTE_BPE, PIECE_BPE, PATTERN).collect()}
    for doc_id, text in rows:
        a, b, links, cuts = plain(text, libraries)
        r = found[doc_id]
        assert (r.a_ids, r.b_ids, list(zip(r.link_a, r.link_b)), r.cuts) == (a, b, links, cuts)
    assert not found[1].a_ids and found[0].a_ids  # U+2581 reads back as a space


@pytest.mark.parametrize("hot", [1, 50, 100_000])
def test_counts(docs, odd_rows, libraries, hot):
    rows = [r for r in odd_rows if len(r[1] or "") < 10_000] + list(enumerate(EXTRA, 100)) + [(200, "the same words")] * 30
    compare(token_alignment.digest(docs(*rows), BYTE_BPE, PIECE_BPE, PATTERN, hot).collect(), rows, libraries)


def test_odd_tables(docs, odd_rows):
    assert token_alignment.digest(docs(), BYTE_BPE, PIECE_BPE, PATTERN).collect() == []
    got = {(r.doc_id, r.n_a): r for r in token_alignment.digest(docs(*odd_rows), BYTE_BPE, PIECE_BPE, PATTERN).collect()}
    assert len(got) == len(odd_rows) - 1  # two rows are alike
    assert [got[1, 0].groups_sha256, got[2, 0].n_links, got[2, 0].count_sum] == ["", 0, 0]


def test_query(spark, libraries):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    compare(QUERIES["op11_token_alignment"](spark, "/root/testdata/sf0.001").collect(), rows, libraries)
