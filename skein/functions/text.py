"""Small string helpers for delimited records."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def split_fields(line, sep: str = ",") -> Column:
    """Split a text line on a literal separator, keeping empty fields (limit -1)."""
    line = F.col(line) if isinstance(line, str) else line
    return F.split(line, _regex_literal(sep), -1)


def field_or_null(fields: Column, position: int, null_token: str | None = None,
                  strip_quotes: bool = False) -> Column:
    """1-based field of an array, null when absent or equal to ``null_token``."""
    value = F.try_element_at(fields, F.lit(position))
    if strip_quotes:
        value = F.regexp_replace(value, '"', "")
    if null_token is not None:
        value = F.nullif(value, F.lit(null_token))
    return value


def _regex_literal(sep: str) -> str:
    special = set("\\^$.|?*+()[]{}")
    return "".join("\\" + ch if ch in special else ch for ch in sep)
