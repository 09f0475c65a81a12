"""Text normalisation and display formatting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import NULL_TOKENS


def null_tokens_to_null(c: Column, tokens: list[str] | None = None) -> Column:
    """Text that spells a missing value (``NA``, ``nan``, empty, ...) becomes NULL; padded or blank text is kept."""
    toks = NULL_TOKENS if tokens is None else tokens
    return F.when(c.isin(toks), F.lit(None).cast("string")).otherwise(c)


def dollars(x: Column, decimals: int = 0) -> Column:
    """``$1,234`` (thousands separators, rounded half-even like Python's format)."""
    return F.concat(F.lit("$"), F.format_number(x, decimals))


def thousands(x: Column) -> Column:
    """``1,234`` for integral values."""
    return F.format_number(x, 0)


def minute_text(ts: Column) -> Column:
    """``2024-01-02 03:04``."""
    return F.date_format(ts, "yyyy-MM-dd HH:mm")


def percent_text(x: Column) -> Column:
    """``12.47%`` from a value already rounded to two digits."""
    return F.concat(x.cast("string"), F.lit("%"))
