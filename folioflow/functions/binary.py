"""Base64 that does not depend on session settings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def b64_encode(data: Column) -> Column:
    """One line of base64, whether or not the session breaks lines."""
    return F.replace(F.base64(data), F.lit("\r\n"), F.lit(""))


def b64_decode(text: Column) -> Column:
    """Bytes, or null when the text is no base64. Characters outside the alphabet are skipped."""
    plain = F.try_to_binary(text, F.lit("base64"))
    clean = F.regexp_replace(text, "[^A-Za-z0-9+/=]", "")
    return F.coalesce(plain, F.try_to_binary(clean, F.lit("base64")))


def b64_decode_text(text: Column) -> Column:
    """Decoded UTF-8 text, or null when either step fails."""
    return F.try_validate_utf8(b64_decode(text).cast("string"))
