"""Contract validation, quality counters, reconciliation (hand-made rows)."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from ledgerline import schemas as S
from ledgerline.plans import quality
from ledgerline.plans.reconcile import reconciliation

from conftest import make_source


def _failures(df, contract=quality.Contract()):
    return sorted((r.column_name, r.check_name, r.failure_case, r.failure_count)
                  for r in quality.schema_failures(df, contract).collect())


def test_nulls_each_counted_once(spark):
    src = make_source(spark, [{S.ORDER_ID: None}, {S.SALES: None, S.SEGMENT: None}, {S.POSTAL_CODE: None}, {}])
    fails = _failures(src)
    assert ("Order ID", "not_nullable", None, 1) in fails
    assert ("Sales", "not_nullable", None, 1) in fails
    assert ("Segment", "not_nullable", None, 1) in fails
    assert not any(f[0] == "Segment" and f[1] == "isin" for f in fails)      # NULL not counted twice
    assert not any(f[0] == "Postal Code" for f in fails)                     # nullable column
    nulls = {r.column_name: r.null_count for r in quality.null_counts(src).collect()}
    assert nulls["Order ID"] == 1 and nulls["Postal Code"] == 1 and nulls["City"] == 0
    assert quality.critical_nulls(src).first().critical_nulls == 2


def test_ranges_and_bounds(spark):
    src = make_source(spark, [
        {S.SALES: -1}, {S.SALES: 0}, {S.QUANTITY: 0}, {S.QUANTITY: 1},
        {S.DISCOUNT: Decimal("-0.1")}, {S.DISCOUNT: Decimal("1.5")}, {S.DISCOUNT: 0}, {S.DISCOUNT: 1},
        {S.DISCOUNT: None},
    ])
    r = quality.range_violations(src).first()
    assert (r.negative_sales, r.invalid_discount, r.invalid_quantity, r.range_violations) == (1, 2, 1, 4)
    fails = _failures(src)
    assert ("Sales", "greater_than_or_equal_to(0)", "-1.0", 1) in fails
    assert ("Quantity", "greater_than(0)", "0", 1) in fails
    assert ("Discount", "in_range(0, 1)", "1.5", 1) in fails
    assert ("Discount", "in_range(0, 1)", "-0.1", 1) in fails
    assert quality.quality_report(src).first().quality_status == "ISSUES FOUND"


def test_allowed_lists(spark):
    src = make_source(spark, [{S.SEGMENT: "Retail"}, {S.REGION: "North"}, {S.CATEGORY: "Toys"}, {S.CATEGORY: "Toys"}])
    fails = _failures(src)
    assert ("Segment", "isin", "Retail", 1) in fails
    assert ("Region", "isin", "North", 1) in fails
    assert ("Category", "isin", "Toys", 2) in fails
    custom = quality.Contract(segments=("Retail", "Consumer"))
    assert not any(f[0] == "Segment" for f in _failures(src, custom))


def test_duplicates_ship_dates_uniqueness(spark):
    d, ship = dt.date(2024, 1, 1), dt.date(2024, 1, 3)
    src = make_source(spark, [
        {S.ORDER_ID: "A", S.ORDER_DATE: d, S.SHIP_DATE: ship}, {S.ORDER_ID: "A", S.ORDER_DATE: d, S.SHIP_DATE: ship},
        {S.ORDER_ID: "A", S.ORDER_DATE: d, S.SHIP_DATE: ship},
        {S.ORDER_ID: None}, {S.ORDER_ID: None},
        {S.ORDER_ID: "B", S.SHIP_DATE: dt.date(2023, 12, 31)},
        {S.ORDER_ID: "C", S.SHIP_DATE: None},
    ])
    assert quality.duplicate_rows(src).first().duplicate_rows == 3
    v = quality.ship_date_violations(src).first()
    assert (v.ship_date_violations, v.status) == (1, "FAILED (1 violations)")
    u = quality.uniqueness(src).first()
    assert (u.unique_orders, u.total_rows) == (3, 7)
    rep = quality.quality_report(src).first()
    assert rep.duplicate_rows == 3 and rep.ship_date_violations == 1 and rep.unique_orders == 3
    assert rep.total_rows == 7 and rep.schema_valid is False and rep.schema_failures == 3  # 2 ids, 1 ship date


def test_empty_source(spark):
    src = make_source(spark, [{}]).limit(0)
    rep = quality.quality_report(src).first()
    assert rep.total_rows == 0 and rep.duplicate_rows == 0 and rep.schema_valid is True
    assert rep.quality_status == "PASSED"
    assert quality.source_profile(src).first().rows == 0


def test_reconciliation_tolerance(spark):
    src = make_source(spark, [{S.SALES: "1.005", S.PROFIT: "2.004"}, {S.SALES: "10.00"}])
    fact = spark.createDataFrame(
        [(1, Decimal("1.01"), Decimal("2.00"), 1, 1, 1), (2, Decimal("10.00"), Decimal("10.00"), 1, 1, 1)],
        "order_key long, sales decimal(12,2), profit decimal(12,2), quantity int, customer_key long, product_key long")
    rows = {r.metric: r for r in reconciliation(src, fact).collect()}
    assert rows["Total Sales"].matched and rows["Total Profit"].matched
    assert rows["Total Orders"].matched and rows["Total Quantity"].matched
    assert all(r.all_passed for r in rows.values())
    off = fact.limit(1)
    rows = {r.metric: r for r in reconciliation(src, off).collect()}
    assert not rows["Total Orders"].matched and not rows["Total Sales"].all_passed
