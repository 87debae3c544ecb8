"""JSON in and out. Variants keep the parse inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_json_strict(raw: Column) -> Column:
    """VARIANT of one complete JSON value, or null.

    Spark's parser stops after the first value and ignores what follows. Wrapping the text in
    ``[...]`` and in ``{"v":...}`` closes that gap: text that ends one wrapper early leaves the
    other one broken, so only a single whole value passes both.
    """
    listed = F.try_parse_json(F.concat(F.lit("["), raw, F.lit("]")))
    keyed = F.try_parse_json(F.concat(F.lit('{"v":'), raw, F.lit("}")))
    items = F.try_variant_get(listed, "$", "array<variant>")
    return F.when((F.size(items) == 1) & keyed.isNotNull(), F.try_element_at(items, F.lit(1)))


def extract_json_object(text: Column) -> Column:
    """From the first ``{`` to the last ``}``; null when either is missing."""
    start = F.instr(text, "{")
    end = F.length(text) - F.instr(F.reverse(text), "}") + 1
    cut = F.when(end >= start, F.substring(text, start, end - start + 1)).otherwise("")
    return F.when((start > 0) & text.contains("}"), cut)


def parse_json_lenient(text: Column) -> Column:
    return parse_json_strict(extract_json_object(text))


def json_field(value: Column, name: str, kind: str = "string") -> Column:
    return F.try_variant_get(value, f"$.{name}", kind)


def is_truthy(value: Column) -> Column:
    """Python truth of a VARIANT: not null, zero, false or empty."""
    kind = F.schema_of_variant(value)
    as_text = F.try_variant_get(value, "$", "string")
    return F.coalesce(
        F.when(kind == "VOID", False)
        .when(kind == "BOOLEAN", F.try_variant_get(value, "$", "boolean"))
        .when(kind == "STRING", as_text != "")
        .when(kind.startswith("ARRAY"), as_text != "[]")
        .when(kind.startswith("OBJECT"), as_text != "{}")
        .otherwise(F.try_variant_get(value, "$", "double") != 0),
        F.lit(False),
    )


def has_summary(value: Column) -> Column:
    return is_truthy(F.try_variant_get(value, "$.summary", "variant"))


def to_metadata_json(metadata: Column) -> Column:
    """Compact JSON, Unicode kept, empty fields written as null."""
    return F.to_json(metadata, {"ignoreNullFields": "false"})
