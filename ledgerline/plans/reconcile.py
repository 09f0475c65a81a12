"""Source-to-store reconciliation.

Source totals are taken from the source lines as parsed (unrounded; a sum
over no values counts as 0), store totals from the overall-KPI view of the
written fact. Money matches within a tolerance, counts exactly. The two
one-row aggregates meet through a scalar subquery, never a cross join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from .quality import PARSE_ERRORS

# (position, metric, kind): money matches within the tolerance, counts exactly.
_METRICS = [(i + 1, name, "money" if i < 2 else "count") for i, name in enumerate(S.RECON_METRICS)]
_VALUE = "decimal(38,10)"


def source_metrics(src: DataFrame) -> DataFrame:
    """The four source totals, one row, in ``RECON_METRICS`` order."""
    def q(c):
        return F.col(f"`{c}`")
    values = [
        F.coalesce(F.sum(q(S.SALES)), F.lit(0)),
        F.coalesce(F.sum(q(S.PROFIT)), F.lit(0)),
        F.count(F.lit(1)),
        F.coalesce(F.sum(q(S.QUANTITY)), F.lit(0)),
    ]
    return src.agg(*[v.cast(_VALUE).alias(n) for v, n in zip(values, S.RECON_METRICS)])


def parse_losses(src: DataFrame) -> DataFrame:
    """Per metric: source values whose text did not parse (one row); they are in neither total."""
    def lost(c):
        if PARSE_ERRORS not in src.columns or c is None:
            return F.lit(0).cast("long")
        return F.count_if(F.try_element_at(F.col(PARSE_ERRORS), F.lit(c)).isNotNull())
    columns = [S.SALES, S.PROFIT, None, S.QUANTITY]
    return src.agg(F.count(F.lit(1)).alias("_n"), *[lost(c).alias(n) for c, n in zip(columns, S.RECON_METRICS)]).drop("_n")


def store_metrics(fact: DataFrame) -> DataFrame:
    """The additive columns of the overall-KPI view of the stored fact (one pass, no distincts)."""
    values = [F.sum("sales"), F.sum("profit"), F.count(F.lit(1)), F.sum("quantity")]
    return fact.agg(*[v.cast(_VALUE).alias(n) for v, n in zip(values, S.RECON_METRICS)])


def reconciliation(src: DataFrame, fact: DataFrame, tolerance: float = S.RECON_TOLERANCE) -> DataFrame:
    """Per metric: source value, store value, values lost at parse, match; plus the overall verdict on every row.

    A metric with values lost at parse never matches: the totals cannot show the loss.

    The store totals are one struct-valued scalar subquery next to the one-row
    source aggregate; the four metric rows are unrolled with ``inline``.
    """
    names = [m for _, m, _ in _METRICS]
    store = store_metrics(fact).select(F.struct(*[F.col(f"`{n}`") for n in names])).scalar()
    lost = parse_losses(src).select(F.struct(*[F.col(f"`{n}`") for n in names])).scalar()
    tol = F.lit(tolerance).cast(_VALUE)

    def matched(name: str, kind: str):
        a, b = F.col(f"`{name}`"), store.getField(name)
        ok = F.abs(a - b) < tol if kind == "money" else a == b
        return F.coalesce(ok, F.lit(False)) & (lost.getField(name) == 0)

    rows = F.array(*[
        F.struct(F.lit(pos).alias("position"), F.lit(name).alias("metric"),
                 F.col(f"`{name}`").alias("source_value"), store.getField(name).alias("store_value"),
                 lost.getField(name).alias("parse_loss"),
                 matched(name, kind).alias("matched"))
        for pos, name, kind in _METRICS
    ])
    verdict = matched(names[0], _METRICS[0][2])
    for _, name, kind in _METRICS[1:]:
        verdict = verdict & matched(name, kind)
    return source_metrics(src).select(F.inline(rows), verdict.alias("all_passed"))
