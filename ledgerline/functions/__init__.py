"""Column-level helpers (all built-in Spark expressions, no Python UDFs)."""

from .dates import date_attributes, year_month_period
from .money import margin_pct, rounded_mean, rounded_ratio
from .text import dollars, minute_text, null_tokens_to_null, percent_text, thousands

__all__ = [
    "date_attributes", "year_month_period", "margin_pct", "rounded_mean", "rounded_ratio",
    "dollars", "minute_text", "null_tokens_to_null", "percent_text", "thousands",
]
