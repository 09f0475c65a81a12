"""Key lookups and size-proven broadcasts.

A side of a join is broadcast only when its size is known and under a limit.
Sizes come from ``TableStats`` measured while the table was written (row count
and the exact UTF-8 bytes of every string column, as ``Observation`` metrics
of the write itself), so the bound is a measurement, not an estimate from
file sizes. The in-memory size of a projection is bounded by
``rows * (8 + 16 * columns) + string bytes`` (row header, one 8-byte slot per
field, up to 8 bytes of word padding per value, plus the string payloads).

Beyond the limit the join is left to the planner: a shuffled sort-merge join,
with AQE free to split skewed partitions of the streamed (fact) side.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class TableStats:
    """Row count and total string bytes per column of a written table."""

    rows: int
    text_bytes: dict[str, int] = field(default_factory=dict)
    text_measured: bool = True   # False: string sizes unknown, so no byte bound can be proven

    def bytes_for(self, columns: list[str]) -> int:
        """Upper bound of the in-memory size of ``columns`` of this table."""
        return self.rows * (8 + 16 * len(columns)) + sum(self.text_bytes.get(c, 0) for c in columns)

    def to_dict(self) -> dict:
        return {"rows": self.rows, "text_bytes": dict(self.text_bytes), "text_measured": self.text_measured}

    @staticmethod
    def from_dict(d: dict) -> "TableStats":
        return TableStats(int(d["rows"]), {k: int(v) for k, v in d.get("text_bytes", {}).items()},
                          bool(d.get("text_measured", True)))


@dataclass(frozen=True)
class BroadcastLimit:
    max_rows: int
    max_bytes: int

    def allows(self, stats: TableStats | None, columns: list[str]) -> bool:
        return (stats is not None and stats.text_measured and stats.rows <= self.max_rows
                and stats.bytes_for(columns) <= self.max_bytes)

    def admit(self, sides: dict[str, tuple[TableStats | None, list[str]]]) -> set[str]:
        """The sides of one plan that are broadcast: smallest first, while all together fit ``max_bytes``.

        An executor holds every broadcast of a plan at once, so the bound is one for their sum.
        """
        admitted, used = set(), 0
        allowed = {name: stats.bytes_for(columns) for name, (stats, columns) in sides.items() if self.allows(stats, columns)}
        for name, size in sorted(allowed.items(), key=lambda side: (side[1], side[0])):
            if used + size <= self.max_bytes:
                admitted.add(name)
                used += size
        return admitted


def stats_metrics(df: DataFrame, text_bytes: bool = True) -> list[Column]:
    """Aggregates to observe on a write: row count and (optionally) string bytes per string column."""
    metrics = [F.count(F.lit(1)).alias("rows")]
    for f in (df.schema.fields if text_bytes else []):
        if isinstance(f.dataType, T.StringType):
            metrics.append(F.coalesce(F.sum(F.octet_length(F.col(f"`{f.name}`"))), F.lit(0))
                           .cast("long").alias(f"bytes:{f.name}"))
    return metrics


def stats_from_metrics(values: dict, text_measured: bool = True) -> TableStats:
    text = {k.split(":", 1)[1]: int(v or 0) for k, v in values.items() if k.startswith("bytes:")}
    return TableStats(int(values["rows"]), text, text_measured)


def lookup(fact: DataFrame, dim: DataFrame, pairs: list[tuple[str, str]], take: list[str], *,
           null_safe: tuple[str, ...] = (), broadcast: bool = False) -> DataFrame:
    """Left join ``fact`` to ``dim`` on ``fact_col == dim_col`` per pair; add the ``take`` columns.

    Fact columns named in ``null_safe`` match NULL to NULL, as a pandas merge
    does; Spark still plans ``<=>`` as a hash-joinable equi-join. Every fact
    row is kept exactly once provided the dimension is unique on its side of
    the pairs. ``broadcast`` must come from a proven size bound.
    """
    right = dim.select(*[F.col(r).alias(f"_lk_{r}") for _, r in pairs], *take)
    if broadcast:
        right = F.broadcast(right)
    cond = None
    for left_col, right_col in pairs:
        l, r = F.col(f"`{left_col}`"), F.col(f"_lk_{right_col}")
        c = l.eqNullSafe(r) if left_col in null_safe else l == r
        cond = c if cond is None else cond & c
    joined = fact.join(right, cond, "left")
    return joined.drop(*[f"_lk_{r}" for _, r in pairs])
