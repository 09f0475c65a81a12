"""Relational building blocks the reference's pipeline needs and Spark lacks by name."""

from .dedup import duplicate_count, keep_first
from .keys import with_surrogate_key
from .lookup import lookup

__all__ = ["duplicate_count", "keep_first", "with_surrogate_key", "lookup"]
