"""Names, routes, trimming and descriptions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.strip removes, the placeholder shown to a model in
# place of an empty page, and the extensions of each route.
PY_WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
EMPTY_PAGE_TEXT = "(No text content found on this page)"
PDF_EXTENSIONS = ["pdf"]
IMAGE_EXTENSIONS = ["png", "jpg", "jpeg", "gif", "bmp"]
SHEET_EXTENSIONS = ["xls", "xlsx"]

TOKEN_BREAK = r"[^\p{L}\p{N}]+"


def file_ext(name: Column) -> Column:
    """Text after the last dot of the lower-cased name; the whole name when it has no dot."""
    return F.substring_index(F.lower(name), ".", -1)


def route(name: Column) -> Column:
    ext = file_ext(name)
    return (
        F.when(ext.isin(PDF_EXTENSIONS), "pdf")
        .when(ext.isin(IMAGE_EXTENSIONS), "image")
        .when(ext.isin(SHEET_EXTENSIONS), "sheet")
        .otherwise("unsupported")
    )


def py_strip(text: Column) -> Column:
    """Trim as Python does: Unicode white space on both ends. Linear, unlike an anchored regex."""
    return F.btrim(text, F.lit(PY_WHITESPACE))


def model_text(text: Column) -> Column:
    """What a model sees. The stored text stays empty."""
    return F.when(text == "", F.lit(EMPTY_PAGE_TEXT)).otherwise(text)


def truncate_text(text: Column, n: int = 1024) -> Column:
    return F.substring(text, 1, n)


def source_uri(bucket: Column, name: Column, scheme: str = "gs") -> Column:
    return F.concat(F.lit(f"{scheme}://"), bucket, F.lit("/"), name)


def basename(uri: Column) -> Column:
    return F.substring_index(uri, "/", -1)


def page_prefix(name: Column) -> Column:
    """Every ``.pdf`` goes, wherever it stands; other spellings such as ``.PDF`` stay."""
    return F.concat(F.replace(name, F.lit(".pdf"), F.lit("")), F.lit("-page-"))


def page_object_name(name: Column, page_num: Column) -> Column:
    return F.concat(page_prefix(name), page_num.cast("string"), F.lit(".json"))


def block_label(first: Column, n: int = 20, last: Column | None = None, clip: bool = False) -> Column:
    """``rows 21-40`` for the block whose 0-based first row is 20.

    The label runs to the full block length even when the block is short, unless ``clip`` is
    set, which ends it at ``last`` (1-based).
    """
    end = F.least(first + n, last) if clip and last is not None else first + n
    return F.format_string("rows %d-%d", first + 1, end)


def page_description(page_num: Column, uri: Column, full_name: bool = False) -> Column:
    return F.format_string("Content from page %d of file %s", page_num, uri if full_name else basename(uri))


def image_description(name: Column) -> Column:
    return F.concat(F.lit("Image file: "), name)


def sheet_description(sheet: Column, label: Column, name: Column) -> Column:
    return F.format_string("Content from sheet '%s', %s in file %s", sheet, label, name)


def chunk_description(kind: Column, name: Column, page_num: Column, sheet: Column, label: Column) -> Column:
    """Description by route, with the full object name."""
    return (
        F.when(kind == "image", image_description(name))
        .when(kind == "sheet", sheet_description(sheet, label, name))
        .otherwise(page_description(page_num, name, full_name=True))
    )


def tokens(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    # Breaks are as long as they can be, so only the ends can be empty; no lambda, which would be interpreted.
    return F.array_remove(F.split(F.lower(text), TOKEN_BREAK), "")
