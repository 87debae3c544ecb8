"""Vectors of fixed size from text and bytes.

The defaults hash features into buckets, so that pipelines run without a model.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import md5

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.functions.rounding import round_half_up
from folioflow.functions.text import tokens
from folioflow.operators.plugins import Plugin, apply_plugin
from folioflow.schemas import IMAGE_DIM, TEXT_DIM


# Numbers in sums, and words or bytes, that are worked on at a time: a batch of any size takes no more.
SUM_CELLS = 1 << 19
ITEMS = 1 << 20
# Words whose hashes a task keeps.
KNOWN_WORDS = 1 << 17


def row_slices(sizes: np.ndarray, rows: int, items: int = ITEMS) -> Iterator[slice]:
    """The rows of a batch in order, at most ``rows`` at a time and, unless one row alone has more, ``items`` in ``sizes``."""
    ends, at = np.cumsum(sizes), 0
    while at < len(sizes):
        before = ends[at - 1] if at else 0
        end = min(at + rows, max(at + 1, int(np.searchsorted(ends, before + items, "right"))))
        yield slice(at, end)
        at = end


def _sizes(data: pa.Array) -> np.ndarray:
    """Bytes or words of each row."""
    sizes = pc.binary_length(data) if pa.types.is_binary(data.type) or pa.types.is_large_binary(data.type) else data.value_lengths()
    return sizes.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)


def _in_slices(dim: int, unit: Callable[..., np.ndarray], *data: pa.Array) -> np.ndarray:
    """``unit`` of a few rows at a time, as one array of single precision."""
    out = np.empty((len(data[0]), dim), np.float32)
    for rows in row_slices(sum(_sizes(column) for column in data), max(1, SUM_CELLS // dim)):
        out[rows] = unit(*(column.slice(rows.start, rows.stop - rows.start) for column in data))
    return out


def _unit_rows(sums: np.ndarray) -> np.ndarray:
    norms = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
    return round_half_up(sums / np.where(norms == 0, 1.0, norms), 6).astype(np.float32)


def _to_vectors(rows: np.ndarray, nulls: np.ndarray) -> pa.Array:
    """A list per row, null where asked. Null rows take no values."""
    kept = rows[~nulls] if nulls.any() else rows
    lengths = np.where(nulls, 0, rows.shape[1])
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(kept.ravel()), mask=pa.array(nulls))


def _hash(word: str, known: dict[str, int]) -> int:
    found = known.get(word)
    if found is None:
        if len(known) >= KNOWN_WORDS:
            known.clear()
        found = known[word] = int(md5(word.encode()).hexdigest()[:8], 16)
    return found


def _token_sums(words: pa.Array, dim: int, known: dict[str, int] | None = None) -> np.ndarray:
    """Signed bucket counts per row; a distinct word is hashed once, and not again while it is ``known``."""
    known = {} if known is None else known
    coded = words.flatten().dictionary_encode()
    lengths = words.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    hashes = np.array([_hash(w, known) for w in coded.dictionary.to_pylist()], dtype=np.int64)
    codes = coded.indices.to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(words)), lengths)
    cell = row * dim + (hashes % dim)[codes] if len(codes) else row
    sign = (1 - 2 * ((hashes // dim) % 2))[codes] if len(codes) else row
    return np.bincount(cell, weights=sign, minlength=len(words) * dim).reshape(len(words), dim)


def _pair_sums(data: pa.Array, dim: int) -> np.ndarray:
    """Counts of neighbouring byte pairs per row, folded into ``dim`` buckets."""
    sums = np.zeros((len(data), dim))
    for i, item in enumerate(data):
        raw = np.frombuffer(item.as_buffer(), dtype=np.uint8).astype(np.int64) if item.is_valid else np.empty(0, np.int64)
        if len(raw) > 1:
            sums[i] = np.bincount((raw[:-1] * 256 + raw[1:]) % dim, minlength=dim)
    return sums


def _null_mask(data: pa.Array) -> np.ndarray:
    return data.is_null().to_numpy(zero_copy_only=False)


def hash_text(text: Column, dim: int = TEXT_DIM) -> Column:
    """Signed feature hashing of the tokens, scaled to length one; null text gives null.

    Bucket and sign of a token come from the first eight hex digits of its md5.
    """

    known: dict[str, int] = {}

    @F.arrow_udf("array<float>")
    def embed(words: pa.Array) -> pa.Array:
        return _to_vectors(_in_slices(dim, lambda some: _unit_rows(_token_sums(some, dim, known)), words), _null_mask(words))

    return embed(tokens(text))


def hash_binary(data: Column, dim: int = IMAGE_DIM) -> Column:
    """Byte pairs of the whole content in ``dim`` buckets, scaled to length one."""

    @F.arrow_udf("array<float>")
    def embed(raw: pa.Array) -> pa.Array:
        return _to_vectors(_in_slices(dim, lambda some: _unit_rows(_pair_sums(some, dim)), raw), _null_mask(raw))

    return embed(data)


def hash_multimodal(data: Column, text: Column, dim: int = IMAGE_DIM) -> Column:
    """Both of the above added up; either input may be null, both null give null."""

    known: dict[str, int] = {}

    def unit(raw: pa.Array, words: pa.Array) -> np.ndarray:
        both = _unit_rows(_pair_sums(raw, dim)) + _unit_rows(_token_sums(words, dim, known))
        return _unit_rows(both.astype(np.float64))

    @F.arrow_udf("array<float>")
    def embed(raw: pa.Array, words: pa.Array) -> pa.Array:
        return _to_vectors(_in_slices(dim, unit, raw, words), _null_mask(raw) & _null_mask(words))

    return embed(data, tokens(text))


def embed_text(
    df: DataFrame, fn: Plugin | None = None, dim: int = TEXT_DIM, text: str = "summary", out: str = "text_embedding", batch_rows: int | None = None, error: str | None = None
) -> DataFrame:
    """Add the text vector. A plug-in gets the column ``text`` names and yields ``out``."""
    if fn is None:
        return df.withColumn(out, hash_text(F.col(text), dim))
    return apply_plugin(df, fn, [text], f"{out} array<float>", batch_rows, error)


def embed_binary(
    df: DataFrame, fn: Plugin | None = None, dim: int = IMAGE_DIM, data: str = "image", out: str = "multimodal_embedding", batch_rows: int | None = None, error: str | None = None
) -> DataFrame:
    """Add the vector of the bytes alone."""
    if fn is None:
        return df.withColumn(out, hash_binary(F.col(data), dim))
    return apply_plugin(df, fn, [data], f"{out} array<float>", batch_rows, error)


def embed_multimodal(
    df: DataFrame,
    fn: Plugin | None = None,
    dim: int = IMAGE_DIM,
    data: str = "image",
    text: str = "page_text",
    out: str = "multimodal_embedding",
    batch_rows: int | None = None,
    error: str | None = None,
) -> DataFrame:
    """Add the vector of bytes and text together; either may be null."""
    if fn is None:
        return df.withColumn(out, hash_multimodal(F.col(data), F.col(text), dim))
    return apply_plugin(df, fn, [data, text], f"{out} array<float>", batch_rows, error)
