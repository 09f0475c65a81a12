"""Plan-shape guards for the properties the design relies on at scale."""

from __future__ import annotations

import contextlib
import io
import os

import pytest

from ledgerline import schemas as S
from ledgerline.registry import QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")

# Windows are allowed only over aggregated rows of a small domain.
BOUNDED_WINDOWS = {"month_over_month"}


def _plan(spark, name: str) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        QUERIES[name](spark, SF).explain(mode="simple")
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cartesian_or_nested_loop_joins(spark, name):
    plan = _plan(spark, name)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if name not in BOUNDED_WINDOWS:
        assert "Window [" not in plan


def test_dimension_rollup_is_broadcast_and_one_exchange(spark):
    plan = _plan(spark, "sales_by_category")
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert plan.count("Exchange hashpartitioning") == 1


def test_date_range_reaches_the_fact_scan(spark):
    plan = _plan(spark, "filtered_kpis")
    fact_scans = [line for line in plan.splitlines() if "FileScan parquet [order_date_key" in line]
    assert fact_scans and all("GreaterThanOrEqual(order_date_key" in line for line in fact_scans)


def test_kpis_do_not_expand_measures(spark):
    for line in _plan(spark, "overall_kpis").splitlines():
        assert "Expand [" not in line


def test_fact_scan_is_pruned(spark):
    plan = _plan(spark, "sales_by_region")
    scans = [line for line in plan.splitlines() if "FileScan parquet [" in line and "sales" in line]
    assert scans and all("ship_mode" not in s and "order_id" not in s for s in scans)


@pytest.mark.parametrize("name", ["overall_kpis", "kpi_cards", "filtered_kpis"])
def test_kpis_scan_the_fact_once_and_sort_nothing(spark, name):
    lines = _plan(spark, name).splitlines()
    assert sum("FileScan parquet" in line and "sales" in line for line in lines) == 1
    assert not any(op in line for line in lines for op in ("Sort [", "SortAggregate", "ObjectHashAggregate"))


@pytest.mark.parametrize("name, joined", [("dedup_line_items", "ShuffledHashJoin"), ("dedup_keep_first", "BroadcastHashJoin")])
def test_keep_first_aggregates_numbers_and_sorts_nothing(spark, name, joined):
    plan = _plan(spark, name)
    assert "partial_min(_line_ordinal" in plan and joined in plan
    assert not any(op in plan for op in ("Sort [", "SortAggregate", "ObjectHashAggregate", "min_by"))


@pytest.mark.parametrize("few", [True, False])
def test_dimensions_do_not_sort_the_source(spark, few):
    from ledgerline.operators.lookup import BroadcastLimit
    from ledgerline.plans.dims import build_dimension
    from ledgerline.plans.star import star_for_tables
    source = star_for_tables(spark, SF).source
    for name in ("dim_customer", "dim_product", "dim_location"):
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            build_dimension(name, source, limit=BroadcastLimit(2_000_000, 1 << 28) if few else BroadcastLimit(0, 0)).explain()
        plan = buf.getvalue()
        assert ("BroadcastHashJoin [_line_ordinal" if few else "ShuffledHashJoin [_line_ordinal") in plan
        assert "SortAggregate" not in plan and "Sort [" not in plan


def test_adapter_sorts_no_lines_for_joins_and_none_without_ordinal(spark):
    """The joined rows were shuffled and sorted once more for the parts, and the CSV copy's lines for an order it drops."""
    from ledgerline.sources.tables import read_tables_source
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")        # as for tables beyond it
    try:
        full, plain = read_tables_source(spark, SF), read_tables_source(spark, SF, ordinal=False)
        plans = [df._jdf.queryExecution().executedPlan().toString() for df in (full, plain)]
        assert not any("SortMergeJoin" in line and "l_" in line for p in plans for line in p.splitlines())
        assert "rangepartitioning(" in plans[0] and "rangepartitioning(" not in plans[1]
        assert sorted(map(str, full.drop(S.ORDINAL).collect())) == sorted(map(str, plain.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_checks_of_the_source_build_no_dimension(spark, workdir):
    from ledgerline.config import WAREHOUSE_CONF
    from ledgerline.plans.star import forget_stars, star_for_tables
    from ledgerline.registry import QUERIES
    before = spark.conf.get(WAREHOUSE_CONF, None)
    spark.conf.set(WAREHOUSE_CONF, os.path.join(workdir, "lazy"))
    forget_stars()
    try:
        nulls = sorted(QUERIES["null_counts"](spark, SF).collect())
        tables = {d for _, ds, _ in os.walk(os.path.join(workdir, "lazy", "runs")) for d in ds}
        assert "source" in tables and not tables & set(S.STAR_TABLES)
        forget_stars()                                   # as a new session would start: the staged source is found
        star = star_for_tables(spark, SF)
        assert star.root.rsplit("/", 1)[1] in tables and star.stats["source"].rows == star.stats["fact_orders"].rows
        assert sorted(QUERIES["null_counts"](spark, SF).collect()) == nulls
    finally:
        spark.conf.unset(WAREHOUSE_CONF) if before is None else spark.conf.set(WAREHOUSE_CONF, before)
        forget_stars()


def test_quality_report_waits_for_no_staged_source(spark, workdir):
    """The lines were sorted and written in all their columns before the report read a part of them."""
    from ledgerline.config import WAREHOUSE_CONF
    from ledgerline.plans.star import forget_stars, source_for_tables
    before = spark.conf.get(WAREHOUSE_CONF, None)
    spark.conf.set(WAREHOUSE_CONF, os.path.join(workdir, "unstaged"))
    forget_stars()
    try:
        plain = QUERIES["quality_report"](spark, SF).collect()
        assert not os.path.exists(os.path.join(workdir, "unstaged", "runs"))
        assert source_for_tables(spark, SF, stage=False) is None
        root = source_for_tables(spark, SF).root
        assert QUERIES["quality_report"](spark, SF).collect() == plain           # of the staged source
        assert source_for_tables(spark, SF, stage=False).root == root
    finally:
        spark.conf.unset(WAREHOUSE_CONF) if before is None else spark.conf.set(WAREHOUSE_CONF, before)
        forget_stars()


def test_duplicate_keys_are_dealt_before_they_are_hashed(spark):
    """Hashed on both sides of the shuffle, keys that hardly repeat filled a task's memory twice."""
    from ledgerline.operators import duplicate_count
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (2, None), (None, None), (3, "b")], "k long, t string")
    out = duplicate_count(df, ["k", "t"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    deepest = plan[:plan.rindex("Exchange")]
    assert deepest.count("HashAggregate") == plan.count("HashAggregate") and "REPARTITION_BY_NUM" in plan
    assert out.first().duplicate_rows == 2
