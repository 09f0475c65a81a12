"""A customer holding a third of all lines: the non-broadcast lookup path splits it (AQE skew join)."""

from __future__ import annotations

import contextlib
import io

from ledgerline import schemas as S
from ledgerline.operators.lookup import BroadcastLimit
from ledgerline.plans.dims import build_dimension
from ledgerline.plans.fact import fact_rows

from conftest import make_source

# Skew thresholds scaled down so a small fixture shows what large data would.
SMALL_SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def test_hot_customer_lookup_is_split_and_exact(spark):
    lines = [{S.CUSTOMER_ID: "C-hot" if i % 3 == 0 else f"C-{i % 300}", S.PRODUCT_ID: f"P-{i % 40}",
              S.ORDER_ID: f"O-{i}"} for i in range(12000)]
    src = make_source(spark, lines).repartition(8)
    dims = {n: build_dimension(n, src) for n in ["dim_customer", "dim_product", "dim_location", "dim_date"]}
    expected = sorted(fact_rows(src, dims, {}, BroadcastLimit(0, 0)).collect())   # default AQE sizing
    old = {k: spark.conf.get(k, None) for k in SMALL_SKEW}
    try:
        for k, v in SMALL_SKEW.items():
            spark.conf.set(k, v)
        f = fact_rows(src, dims, {}, BroadcastLimit(0, 0))
        rows = f.collect()
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            f.explain(mode="simple")          # after execution: the final adaptive plan
        plan = buf.getvalue()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "isFinalPlan=true" in plan
    assert any("SortMergeJoin(skew=true) [customer_id" in line for line in plan.splitlines())
    assert len(rows) == 12000 and sorted(rows) == expected
