"""The two ingest stages: files to page records, page records to store rows."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.functions.binary import b64_decode, b64_encode
from folioflow.functions.text import (
    block_label,
    chunk_description,
    page_description,
    page_object_name,
    py_strip,
    route,
    source_uri,
)
from folioflow.operators.chunks import BLOCK_ROWS, PAGE_BREAK, blocks_of
from folioflow.operators.embed import embed_binary, embed_multimodal, embed_text
from folioflow.operators.events import classify_error
from folioflow.operators.plugins import Plugin
from folioflow.operators.store import check_store_row, to_store_row
from folioflow.schemas import IMAGE_DIM, TEXT_DIM

SHEET_NAME = "Sheet1"


def build_chunks(files: DataFrame, page_lines: int | None = None, scheme: str = "gs") -> DataFrame:
    """Chunks of all routes in one pass: ``bucket, name, text`` (and ``content``) to page rows.

    PDF text splits at form feeds, or every ``page_lines`` lines; a sheet's lines form blocks of
    20 rows; an image is one chunk. Files of other types give no rows. Everything happens inside
    the row, so a file's pages are there without a shuffle.
    """
    if "content" not in files.columns:
        files = files.withColumn("content", F.lit(None).cast("binary"))
    kept = [c for c in files.columns if c not in ("text", "content")]
    kind, text = F.col("route"), F.col("text")
    lines = F.col("_lines")
    pages = blocks_of(lines, page_lines) if page_lines else F.split(text, re.escape(PAGE_BREAK))
    pieces = F.when(kind == "pdf", pages).when(kind == "sheet", blocks_of(lines, BLOCK_ROWS)).otherwise(F.array(F.lit("")))
    exploded = (
        files.withColumn("route", route(F.col("name")))
        .filter(kind != "unsupported")
        .withColumn("_lines", F.split(text, "\n"))
        .select(*kept, "route", "content", F.posexplode(pieces).alias("_pos", "_piece"))
    )
    chunks = exploded.select(
        *kept,
        "route",
        source_uri(F.col("bucket"), F.col("name"), scheme).alias("source_file"),
        F.when(kind == "sheet", SHEET_NAME).otherwise("").alias("part"),
        F.when(kind == "image", 0).otherwise(F.col("_pos") + 1).alias("page_num"),
        py_strip(F.col("_piece")).alias("page_text"),
        F.when(kind == "image", F.col("content")).alias("image"),
        block_label(F.col("_pos") * BLOCK_ROWS, BLOCK_ROWS).alias("_label"),
    )
    return chunks.select(
        *[c for c in chunks.columns if c != "_label"],
        page_object_name(F.col("name"), F.col("page_num")).alias("object_name"),
        chunk_description(kind, F.col("name"), F.col("page_num"), F.col("part"), F.col("_label")).alias("chunk_description"),
    ).filter((kind != "sheet") | (F.col("page_text") != ""))


def sheet_chunks(blocks: DataFrame, bucket: str, name: str, sheet: str = "sheet", scheme: str = "gs") -> DataFrame:
    """The blocks of an ordered table (:func:`folioflow.operators.chunks.row_blocks`) as chunks of the file ``name``.

    Every sheet goes by its own name; a block's number is its page number.
    """
    file, page = F.lit(name), (F.col("block") + 1).cast("int")
    return blocks.select(
        F.lit(bucket).alias("bucket"),
        file.alias("name"),
        F.lit("sheet").alias("route"),
        source_uri(F.lit(bucket), file, scheme).alias("source_file"),
        F.col(sheet).alias("part"),
        page.alias("page_num"),
        py_strip(F.col("text")).alias("page_text"),
        F.lit(None).cast("binary").alias("image"),
        page_object_name(file, page).alias("object_name"),
        chunk_description(F.lit("sheet"), file, page, F.col(sheet), F.col("label")).alias("chunk_description"),
    ).filter(F.col("page_text") != "")


def to_page_records(chunks: DataFrame) -> DataFrame:
    """Chunks with metadata in the layout of the page record file."""
    return chunks.withColumn("image_base64", b64_encode(F.col("image")))


def embed_pages(
    records: DataFrame,
    text_fn: Plugin | None = None,
    image_fn: Plugin | None = None,
    with_text: bool = False,
    text_dim: int = TEXT_DIM,
    image_dim: int = IMAGE_DIM,
    batch_id: int = 0,
    batch_rows: int | None = None,
    policy: str = "by_type",
) -> DataFrame:
    """Page records to store rows plus ``status``: ``ok``, ``no_summary``, a broken contract, or
    ``transient`` or ``permanent`` (by ``policy``) where a model failed, with its ``error``.

    The text vector is that of the summary. The second vector is that of the image alone, or of
    image and page text with ``with_text``. Pages without a summary skip the models' work: they
    leave with null vectors.
    """
    described = F.coalesce("chunk_description", page_description(F.col("page_num"), F.col("source_file")))
    has_summary = F.coalesce(F.col("metadata.summary") != "", F.lit(False))
    ready = records.withColumns(
        {
            "chunk_description": described,
            "summary": F.when(has_summary, F.col("metadata.summary")),
            "image": F.when(has_summary, b64_decode(F.col("image_base64"))),
            "page_text": F.when(has_summary, F.col("page_text")),
        }
    )
    # Without models there is nothing to spare: one pass, and a null summary gives a null vector.
    no_models = text_fn is None and image_fn is None
    good = ready if no_models else ready.filter(has_summary)
    vectored = embed_text(good, text_fn, text_dim, batch_rows=batch_rows, error="text_error" if text_fn else None)
    embed_second = embed_multimodal if with_text else embed_binary
    vectored = embed_second(vectored, image_fn, image_dim, batch_rows=batch_rows, error="image_error" if image_fn else None)
    if no_models:
        rows = check_store_row(to_store_row(vectored, batch_id), text_dim, image_dim)
        return rows.withColumn("status", F.when(F.col("text_embedding").isNull(), "no_summary").otherwise(F.col("status")))
    # A model that gives no vector has failed, whether it says so or not; such a row is never ok.
    told = [F.col(c) for c in ("text_error", "image_error") if c in vectored.columns]
    asked_image = F.col("image").isNotNull() | (F.lit(with_text) & F.col("page_text").isNotNull())
    silent = F.when(F.col("text_embedding").isNull(), F.lit("BadAnswer: no text vector"))
    if image_fn:
        silent = silent.when(asked_image & F.col("multimodal_embedding").isNull(), F.lit("BadAnswer: no image vector"))
    rows = check_store_row(to_store_row(vectored.withColumn("error", F.coalesce(*told, silent)), batch_id), text_dim, image_dim)
    rows = rows.withColumn("status", F.when(F.col("error").isNotNull(), classify_error(F.col("error"), policy)).otherwise(F.col("status")))
    none = F.lit(None)
    refused = ready.filter(~has_summary).withColumns(
        {"text_embedding": none.cast("array<float>"), "multimodal_embedding": none.cast("array<float>"), "error": none.cast("string")}
    )
    return rows.unionByName(to_store_row(refused, batch_id).withColumn("status", F.lit("no_summary")))
