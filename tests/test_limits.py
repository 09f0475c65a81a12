"""Values at and beyond the store's types, NULL cities, date conventions, stored layout."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerline import schemas as S
from ledgerline.operators.lookup import BroadcastLimit, TableStats
from ledgerline.plans import etl, marts, quality, reconcile
from ledgerline.plans.star import build_star
from ledgerline.sources import read_orders_csv

from conftest import make_source

HEADER = ",".join(f'"{c}"' for c in S.SOURCE_COLUMNS)


def csv_line(**over):
    line = {S.ORDER_ID: "O-1", S.ORDER_DATE: "1/2/2024", S.SHIP_DATE: "1/4/2024", S.SHIP_MODE: "Standard",
            S.CUSTOMER_ID: "C-1", S.CUSTOMER_NAME: "Ann", S.SEGMENT: "Consumer", S.COUNTRY: "US", S.CITY: "Springfield",
            S.STATE: "Illinois", S.POSTAL_CODE: "62701", S.REGION: "Central", S.PRODUCT_ID: "P-1",
            S.CATEGORY: "Furniture", S.SUB_CATEGORY: "Chairs", S.PRODUCT_NAME: "Chair", S.SALES: "100.00",
            S.QUANTITY: "1", S.DISCOUNT: "0", S.PROFIT: "10.00", **over}
    return ",".join(f'"{line[c]}"' for c in S.SOURCE_COLUMNS)


@pytest.fixture()
def from_csv(spark, workdir):
    def read(*lines):
        with open(f"{workdir}/orders.csv", "w", encoding="latin-1") as f:
            f.write("\n".join([HEADER, *lines]) + "\n")
        return read_orders_csv(spark, f"{workdir}/orders.csv")
    return read


def test_no_value_is_lost_without_a_count(spark, from_csv):
    src = from_csv(csv_line(**{S.DISCOUNT: "1500"}), csv_line(**{S.SALES: "20000000000.00"}),
                   csv_line(**{S.SALES: "1.23456"}), csv_line(**{S.QUANTITY: "3.0"}))
    ranges = quality.range_violations(src).first()
    assert (ranges.invalid_discount, ranges.range_violations) == (1, 1)
    report = quality.quality_report(src).first()
    assert report.quality_status == "ISSUES FOUND"
    totals = reconcile.source_metrics(src).first()
    assert totals["Total Sales"] == Decimal("20000000201.23456")        # unrounded
    cases = {(r.column_name, r.check_name, r.failure_case) for r in quality.schema_failures(src).collect()}
    assert ("Discount", "in_range(0, 1)", "1500.0") in cases and ("Quantity", "dtype('int')", "3.0") in cases
    assert quality.store_overflow(src).first().asDict() == {"sales": 1, "profit": 0, "discount": 1}
    star = build_star(spark, src)
    audit = {r.constraint_name: r.violations for r in quality.constraint_audit(star.tables, star.source).collect()}
    assert audit["numeric_range(sales)"] == 1 and audit["numeric_range(discount)"] == 1
    recon = {r.metric: r for r in reconcile.reconciliation(star.source, star.fact).collect()}
    assert recon["Total Quantity"].parse_loss == 1 and not recon["Total Quantity"].matched
    assert not recon["Total Sales"].matched and recon["Total Orders"].matched


def test_load_beyond_the_store_types_is_refused(spark, workdir):
    ok = make_source(spark, [{}])
    etl.run_etl(spark, ok, base=f"{workdir}/retail")
    with pytest.raises(etl.RefusedLoad):
        etl.run_etl(spark, make_source(spark, [{S.SALES: Decimal("20000000000")}]), base=f"{workdir}/retail")
    assert spark.read.parquet(f"{workdir}/retail/_manifest").count() == 1


def test_null_city_keeps_its_location(spark):
    src = make_source(spark, [{}, {S.CITY: None, S.POSTAL_CODE: "1"}, {S.CITY: None, S.POSTAL_CODE: None, S.REGION: "West"}])
    star = build_star(spark, src)
    assert star.fact.where("location_key is null").count() == 0
    assert {r.region: r.total_orders for r in marts.sales_by_region(star).collect()} == {"Central": 2, "West": 1}


def test_repeated_surrogate_key_is_reported(spark):
    star = build_star(spark, make_source(spark, [{}]))
    tables = {**star.tables, "dim_customer": star.tables["dim_customer"].unionAll(star.tables["dim_customer"])}
    audit = {(r.table_name, r.constraint_name): r.violations for r in quality.constraint_audit(tables).collect()}
    assert audit["dim_customer", "primary_key(customer_key)"] == 1
    assert audit["fact_orders", "references(customer_key)"] == 0


def test_repeated_numbers_are_counted_in_blocks(spark):
    """Integer keys: dense, sparse, negative, beyond 2^33, repeated and NULL ones."""
    keys = [*range(200), 5, 5, -1, -1, -64, -65, (7 << 33) + 1, (7 << 33) + 1, (1 << 62), None, None, None]
    rows = spark.createDataFrame([(k,) for k in keys], "order_key long")
    assert quality._repeated_numbers(rows, "order_key").first()[0] == len(keys) - len(set(keys))
    assert quality._repeated_numbers(rows.limit(0), "order_key").first()[0] == 0


def test_broadcasts_share_one_budget():
    side = lambda mib: (TableStats(1, {"c": mib << 20}), ["c"])
    limit = BroadcastLimit(2_000_000, 256 << 20)
    assert limit.admit({name: side(200) for name in "abcde"}) == {"a"}
    assert limit.admit({"large": side(300), "mid": side(150), "small": side(90), "tiny": side(1)}) == {"tiny", "small", "mid"}
    assert limit.admit({"rows": (TableStats(3_000_000), ["c"]), "unmeasured": (None, ["c"]),
                        "text": (TableStats(1, {}, False), ["c"])}) == set()


def test_dates_are_month_first(from_csv):
    src = from_csv(*[csv_line(**{S.ORDER_DATE: d}) for d in (
        "08-11-2016", "2016-11-08 00:00:00", "11/8/2016", "2016-11-08", "13-08-2016", "11/8/2016 10:30")])
    got = [r[0] for r in src.orderBy(S.ORDINAL).select(F.col(f"`{S.ORDER_DATE}`")).collect()]
    nov8 = dt.date(2016, 11, 8)
    assert got == [dt.date(2016, 8, 11), nov8, nov8, nov8, None, nov8]
    cases = {(r.column_name, r.check_name, r.failure_case) for r in quality.schema_failures(src).collect()}
    assert (S.ORDER_DATE, "dtype('date')", "13-08-2016") in cases


def test_blank_and_padded_text_is_kept(from_csv):
    src = from_csv(csv_line(**{S.CITY: "  "}), csv_line(**{S.CITY: " NA "}), csv_line(**{S.CITY: "NA"}))
    assert [r[0] for r in src.orderBy(S.ORDINAL).select(S.CITY).collect()] == ["  ", " NA ", None]


def test_mart_schemas_do_not_depend_on_size(spark):
    star = build_star(spark, make_source(spark, [{}, {S.CUSTOMER_ID: "C-2"}]))
    small = {n: f.dtypes for n, f in marts.all_marts(star).items()}
    star.limit = BroadcastLimit(0, 0)
    assert small == {n: f.dtypes for n, f in marts.all_marts(star).items()}


def test_one_month_reads_few_fact_files(spark):
    import glob

    import pyarrow.parquet as pq
    lines = [{S.ORDER_ID: f"O-{n}", S.ORDER_DATE: dt.date(2024, 1, 1) + dt.timedelta(days=n % 360)} for n in range(3600)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")      # keep the small files apart
    try:
        star = build_star(spark, make_source(spark, lines))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    month = {r.date_key for r in star.tables["dim_date"].where("year = 2024 and month = 5").collect()}
    files = glob.glob(f"{star.root.removeprefix('file://')}/fact_orders/*.parquet")
    hit = 0
    for f in files:
        meta = pq.ParquetFile(f).metadata
        column = [meta.row_group(0).column(c).path_in_schema for c in range(meta.num_columns)].index("order_date_key")
        hit += any(meta.row_group(g).column(column).statistics.min <= max(month)
                   and meta.row_group(g).column(column).statistics.max >= min(month) for g in range(meta.num_row_groups))
    assert len(files) >= 4 and hit <= len(files) / 2


def test_freshness_cards_and_summary(spark):
    star = build_star(spark, make_source(spark, [{}, {S.DISCOUNT: Decimal("2")}]))
    cards = {r.label: r.value for r in marts.freshness_cards(star, F.lit("2024-03-04 05:06:59").cast("timestamp")).collect()}
    assert cards == {"Latest Order Date": "2024-01-02", "Total Records": "2", "Dashboard Refreshed": "2024-03-04 05:06"}
    row = etl.summary_of(star.source, star.fact).first()
    assert (row.records_processed, row.quality_status, row.reconciliation_status) == (2, "ISSUES FOUND", "PASSED")
