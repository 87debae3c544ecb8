"""Token files and byte-level BPE against the libraries, and their formats in a round trip."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from folioflow.llm import byte_bpe, token_files
from folioflow.llm.queries import BYTE_RANKS, QUERIES, WORD_BPE

SIGNS = [" ", "  ", "\n", "\t", "a", "B", "é", "É", "ß", "1", "23", "'s", "'LL", ".", ",", "...", "|", "—", "中", "\x1c", "\x85", "\u2003", "😀", "Th", "the", "ing", "\r\n", "_", "\x00", "e\u0301", "<|endoftext|>", "İ", "Σ"]


def odd_texts(n):
    draw = random.Random(7)
    return ["".join(draw.choice(SIGNS) for _ in range(draw.randint(0, 25))) for _ in range(n)] + ["a" * 3000, "ab" * 400, " " * 300]


def library():
    ranks = byte_bpe.load_ranks(BYTE_RANKS)
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_byte_bpe_is_the_librarys():
    ranks = byte_bpe.load_ranks(BYTE_RANKS)
    encoder = byte_bpe.Encoder(ranks, byte_bpe.rank_table(byte_bpe.merges(ranks)), public_tokenizers.PATTERN, limit=2000)
    texts, own = odd_texts(3000), library()
    got = [ids for at in range(0, len(texts), 500) for ids in encoder.encode(texts[at : at + 500])]
    assert [ids.tolist() for ids in got] == [own.encode_ordinary(t) for t in texts]
    word = b"the cat and the ing" * 9
    assert byte_bpe.merge_long(word, ranks) == encoder_fold(encoder, word)


def encoder_fold(encoder, word):
    ids, sizes = encoder.fold_equal(np.frombuffer(word, np.uint8).reshape(1, -1))
    return ids[0, : sizes[0]].tolist()


def test_fold_as_a_column(spark):
    ranks = byte_bpe.load_ranks(BYTE_RANKS)
    words = [" the", "thaninwh", "ériou", "zzq", "ab"]
    df = spark.createDataFrame([(w, list(w.encode())) for w in words], "word string, bytes array<int>")
    got = {r.word: r.ids for r in df.select("word", byte_bpe.fold_column(F.col("bytes"), ranks).alias("ids")).collect()}
    assert got == {w: library().encode_ordinary(w) for w in words}


def test_byte_bpe_rows(docs, odd_rows):
    df, own = docs(*odd_rows), library()
    got = sorted((tuple(r) for r in byte_bpe.digest(df, BYTE_RANKS, public_tokenizers.PATTERN).collect()), key=repr)
    want = []
    for doc_id, text in odd_rows:
        ids = own.encode_ordinary(text or "")
        want.append((doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert got == sorted(want, key=repr)
    ids = byte_bpe.encode(df.filter("doc_id = 7"), BYTE_RANKS, public_tokenizers.PATTERN)
    assert byte_bpe.decode(ids, BYTE_RANKS).first().decoded == "é中😀 ß".encode()
    assert byte_bpe.digest(df.limit(0), BYTE_RANKS, public_tokenizers.PATTERN).count() == 0


def test_simple8b_round_trip():
    draw = np.random.default_rng(3)
    cases = [[], [0], [1] * 61, [2**60 - 1], [2**60, 5, 2**64 - 1, 0]]
    cases += [draw.integers(0, 2 ** int(draw.integers(1, 40)), int(draw.integers(1, 3000))).tolist() for _ in range(40)]
    cases.append(np.where(draw.random(5000) < 0.01, 2**63, draw.integers(0, 49408, 5000)).astype(np.uint64).tolist())
    for ids in cases:
        coded = token_files.pack(np.array(ids, np.uint64))
        assert token_files.unpack(*coded).tolist() == ids
        for _ in range(3):
            a, b = sorted(draw.integers(0, len(ids) + 1, 2).tolist())
            assert token_files.unpack(*coded, a, b).tolist() == ids[a:b]


def plain_tokenizer():
    own = Tokenizer.from_file(WORD_BPE)
    own.encode_special_tokens = True
    return own


def test_word_ids_are_the_librarys():
    tokens, own, texts = token_files.Tokens(WORD_BPE, kept_pieces=500), plain_tokenizer(), odd_texts(2000)
    got = [np.frombuffer(x, np.uint32).tolist() for at in range(0, len(texts), 300) for x in tokens.encode(texts[at : at + 300])]
    assert got == [own.encode(t, add_special_tokens=False).ids for t in texts]


def test_token_files(spark, docs, odd_rows, tmp_path):
    own, start = plain_tokenizer(), 0
    rows = odd_rows + [(100 + i, t) for i, t in enumerate(odd_texts(60))]
    got = token_files.digest(docs(*rows), WORD_BPE).orderBy("start").collect()
    ids_of = {}
    for doc_id, text in rows:
        ids = own.encode(text or "", add_special_tokens=False).ids + [1]
        ids_of.setdefault(doc_id, []).append((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    assert [r.doc_id for r in got] == sorted((d for d, _ in rows), key=lambda d: (d is not None, d))
    for r in got:
        assert r.start == start and (r.n_tokens, r.ids_crc32) in ids_of[r.doc_id]
        start += r.n_tokens
    assert len(got) == len(rows)
    path = str(tmp_path / "ids")
    token_files.write(docs(*rows), WORD_BPE, path)
    assert token_files.read_ids(spark, path).filter("doc_id = 3").first().ids == own.encode("a b c", add_special_tokens=False).ids + [1]
    assert token_files.digest(docs((1, "x")).limit(0), WORD_BPE).count() == 0


def test_special_tokens_as_the_library_is_loaded():
    """Against the untouched library; literals glued, in other cases, and beside signs."""
    own, tokens, draw = Tokenizer.from_file(WORD_BPE), token_files.Tokens(WORD_BPE, kept_pieces=500, special=True), random.Random(15)
    signs = [*SIGNS, "<|startoftext|>", "<|ENDOFTEXT|>", "<|endoftext|", "<|"]
    texts = ["hello <|endoftext|> world", "a<|endoftext|><|startoftext|>b.", *("".join(draw.choice(signs) for _ in range(draw.randint(0, 25))) for _ in range(1500))]
    got = [np.frombuffer(x, np.uint32).tolist() for at in range(0, len(texts), 300) for x in tokens.encode(texts[at : at + 300])]
    assert got == [own.encode(t, add_special_tokens=False).ids for t in texts] and got[0] == [3306, 49407, 1002]


def test_op2_maps_special_tokens(spark, docs, tmp_path):
    own = Tokenizer.from_file(WORD_BPE)
    docs((1, "hello <|endoftext|> world")).write.parquet(str(tmp_path / "documents.parquet"))
    got = QUERIES["op2_token_files"](spark, str(tmp_path)).first()
    ids = own.encode("hello <|endoftext|> world", add_special_tokens=False).ids + [1]
    assert (got.n_tokens, got.ids_crc32) == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))


def test_ranges_are_even_in_bytes(spark, docs, tmp_path):
    """A run of very long texts, and one id and text on a third of the rows, spread over tasks; the order stays."""
    draw = random.Random(16)
    long = [(1000 + i, "long text " * 3000 + str(i)) for i in range(60)]
    short = [(i, " ".join(draw.choice("abcdefgh") * 3 for _ in range(40))) for i in range(900)]
    hot = [(None, "the same words again " * 30)] * 2000
    rows = short + hot + long
    path = str(tmp_path / "even")
    token_files.write(docs(*rows).repartition(5), WORD_BPE, path, range_bytes=100_000)
    blocks = token_files.read_blocks(spark, path)
    sizes = [r.n for r in blocks.groupBy("range_no").agg(F.sum("n_ids").alias("n")).collect()]
    assert len(sizes) > 20 and max(sizes) < 4 * sum(sizes) / len(sizes)
    ids = token_files.read_ids(spark, path).orderBy("start").select("doc_id").collect()
    assert [r.doc_id for r in ids] == sorted((d for d, _ in rows), key=lambda d: (d is not None, d))
