"""Dimensions, fact, marts and the ETL run over hand-made rows."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest

from ledgerline import schemas as S
from ledgerline.plans import etl, marts, quality
from ledgerline.plans.star import build_star, load_published

from conftest import make_source


@pytest.fixture(scope="module")
def star(spark):
    lines = [
        # customers: C-1 appears twice with different names -> first wins
        {S.CUSTOMER_ID: "C-1", S.CUSTOMER_NAME: "Ann", S.ORDER_ID: "O-1", S.PRODUCT_ID: "P-1"},
        {S.CUSTOMER_ID: "C-1", S.CUSTOMER_NAME: "Ann B", S.ORDER_ID: "O-2", S.PRODUCT_ID: "P-2",
         S.PRODUCT_NAME: "Chair", S.DISCOUNT: Decimal("0.10"), S.SALES: 50, S.PROFIT: -5},
        # NULL postal twice with one city; a Sunday; ISO week 1 of 2025
        {S.CUSTOMER_ID: "C-2", S.CUSTOMER_NAME: "Bob", S.SEGMENT: "Corporate", S.POSTAL_CODE: None,
         S.CITY: "Dover", S.REGION: "East", S.ORDER_DATE: dt.date(2024, 12, 29), S.SHIP_DATE: dt.date(2024, 12, 30),
         S.DISCOUNT: Decimal("0.20"), S.SALES: 30, S.PROFIT: 3},
        {S.CUSTOMER_ID: "C-2", S.CUSTOMER_NAME: "Bob", S.SEGMENT: "Corporate", S.POSTAL_CODE: None,
         S.CITY: "Dover", S.REGION: "East", S.DISCOUNT: Decimal("0.21"), S.SALES: 20, S.PROFIT: -4},
        # one (postal, city) with two states -> first wins, audit reports the conflict
        {S.CUSTOMER_ID: "C-3", S.POSTAL_CODE: "02108", S.CITY: "Boston", S.STATE: "MA", S.REGION: "East",
         S.DISCOUNT: None, S.SALES: 0, S.PROFIT: 0, S.CATEGORY: "Technology", S.SUB_CATEGORY: "Phones",
         S.PRODUCT_ID: "P-3", S.PRODUCT_NAME: "Phone"},
        {S.CUSTOMER_ID: "C-3", S.POSTAL_CODE: "02108", S.CITY: "Boston", S.STATE: "XX", S.REGION: "East",
         S.DISCOUNT: Decimal("-0.05"), S.SALES: 0, S.PROFIT: 0, S.CATEGORY: "Technology",
         S.SUB_CATEGORY: "Phones", S.PRODUCT_ID: "P-3", S.PRODUCT_NAME: "Phone"},
        # orphan: no customer id, NULL order date
        {S.CUSTOMER_ID: None, S.ORDER_DATE: None, S.SALES: "1.005", S.PROFIT: "1.004"},
    ]
    src = make_source(spark, lines)
    return build_star(spark, src, num_partitions=3)


def test_dimensions(star):
    cust = {r.customer_id: (r.customer_key, r.customer_name) for r in star.tables["dim_customer"].collect()}
    assert cust == {"C-1": (1, "Ann"), "C-2": (2, "Bob"), "C-3": (3, "Ann")}
    loc = {(r.postal_code, r.city): (r.location_key, r.state) for r in star.tables["dim_location"].collect()}
    assert loc[(None, "Dover")][0] == 1 and loc[("02108", "Boston")] == (2, "MA")
    assert len(loc) == 3
    dates = {r.full_date: r for r in star.tables["dim_date"].collect()}
    sunday, iso = dates[dt.date(2024, 12, 29)], dates[dt.date(2024, 12, 30)]
    assert (sunday.day_name, sunday.day_of_week, sunday.is_weekend) == ("Sunday", 6, True)
    assert (iso.week, iso.year, iso.day_of_week, iso.month_name) == (1, 2024, 0, "December")
    assert None not in dates
    assert [r.date_key for r in star.tables["dim_date"].orderBy("full_date").collect()] == list(range(1, len(dates) + 1))


def test_fact_one_row_per_line(star):
    fact = star.fact
    assert fact.count() == 7 == star.counts["fact_orders"]
    assert fact.filter("location_key IS NULL").count() == 0          # NULL postal matched null-safe
    assert fact.filter("customer_key IS NULL").count() == 1          # orphan kept, key NULL
    assert fact.filter("order_date_key IS NULL").count() == 1
    sales = {r.sales for r in fact.collect()}
    assert Decimal("1.01") in sales                                   # 1.005 rounds half away from zero
    audit = {(r.table_name, r.constraint_name): r.violations
             for r in quality.constraint_audit(star.tables, star.source).collect()}
    assert audit[("dim_location", "conflict(postal_code,city)")] == 1
    assert audit[("fact_orders", "unmatched(customer_key)")] == 1
    assert audit[("dim_customer", "unique(customer_id)")] == 0
    assert audit[("fact_orders", "references(customer_key)")] == 0


def test_views(star):
    k = marts.overall_kpis(star).first()
    assert k.total_orders == 7 and k.unique_customers == 3 and k.total_sales == Decimal("201.01") and k.avg_order_value == Decimal("28.72")
    buckets = {r.discount_bucket: r for r in marts.discount_impact(star).collect()}
    assert buckets["No Discount"].total_orders == 2                  # default 0.00 lines
    assert buckets["Low (1-10%)"].total_orders == 2                  # 0.10 exactly and a negative discount
    assert buckets["Medium (11-20%)"].total_orders == 1              # 0.20 exactly
    assert buckets["High (>20%)"].total_orders == 2                  # 0.21 and NULL
    assert [r.discount_bucket for r in marts.discount_impact(star).collect()] == sorted(buckets)
    cats = {(r.category, r.sub_category): r for r in marts.sales_by_category(star).collect()}
    assert cats[("Technology", "Phones")].profit_margin_pct is None   # zero sales -> NULL margin
    seg = {r.segment: r for r in marts.sales_by_segment(star).collect()}
    assert seg["Consumer"].total_customers == 2
    top = marts.top_customers(star).collect()
    assert [r.customer_name for r in top][:1] == ["Ann"]
    fresh = marts.freshness(star, include_refreshed=False).first()
    assert fresh.total_records == 6
    tree = marts.category_tree(star).collect()
    assert {r.level for r in tree} == {1, 2}
    cards = {r.label: r.value for r in marts.kpi_cards(star).collect()}
    assert cards["Total Sales"] == "$201" and cards["Total Orders"] == "7"
    assert cards["Avg Order Value"] == "$28.72" and cards["Profit Margin"] == "2.49%"


def test_top_k_ties_and_null_first(spark):
    lines = [{S.CUSTOMER_ID: f"C-{i}", S.CUSTOMER_NAME: f"N{i:02d}", S.SALES: 10} for i in range(12)]
    lines.append({S.CUSTOMER_ID: "C-x", S.CUSTOMER_NAME: "Zed", S.SALES: None})
    st = build_star(spark, make_source(spark, lines), num_partitions=2)
    top = marts.top_customers(st).collect()
    assert len(top) == 10
    assert top[0].customer_name == "Zed" and top[0].total_sales is None
    assert [r.customer_name for r in top[1:]] == [f"N{i:02d}" for i in range(9)]


def test_etl_rerun_is_identical(spark, workdir):
    lines = [{S.CUSTOMER_ID: f"C-{i % 5}", S.PRODUCT_ID: f"P-{i % 3}", S.ORDER_ID: f"O-{i}"} for i in range(20)]
    src = make_source(spark, lines)
    a = etl.run_etl(spark, src, base=workdir)
    b = etl.run_etl(spark, src, base=workdir)
    for t in S.STAR_TABLES:
        cols = [c for c in a.star.tables[t].columns if c != "order_key"]
        assert sorted(a.star.tables[t].select(cols).collect()) == sorted(b.star.tables[t].select(cols).collect())
    assert a.summary.first().reconciliation_status == "PASSED"
    current = load_published(spark, workdir)
    assert current.root == b.star.root
    names = etl.register_views(spark, current)
    assert "vw_overall_kpis" in names
    assert spark.sql("SELECT total_orders FROM vw_overall_kpis").first().total_orders == 20


def test_filtered_kpis_date_range_and_dims(spark):
    lines = [{S.ORDER_ID: f"O-{i}", S.ORDER_DATE: dt.date(2024, 1, 1) + dt.timedelta(days=i),
              S.SHIP_DATE: dt.date(2024, 1, 1) + dt.timedelta(days=i + 1),
              S.REGION: "East" if i % 2 else "West", S.CITY: f"City{i % 2}", S.SALES: 10 + i}
             for i in range(30)]
    st = build_star(spark, make_source(spark, lines), num_partitions=3)
    k = marts.filtered_kpis(st, date_from="2024-01-05", date_to="2024-01-09").first()
    assert k.total_orders == 5 and k.total_sales == sum(Decimal(10 + i) for i in range(4, 9))
    k = marts.filtered_kpis(st, regions=["East"], date_from=dt.date(2024, 1, 1), date_to="2024-01-10").first()
    assert k.total_orders == 5                                   # odd days 1..9
    k = marts.filtered_kpis(st, date_from="2030-01-01").first()
    assert k.total_orders == 0 and k.total_sales is None
    everything = marts.filtered_kpis(st).first()
    assert everything == marts.overall_kpis(st).first()


def test_materialise_marts(spark, star, workdir):
    paths = marts.materialise(star, workdir + "/marts")
    assert set(paths) == set(marts.MARTS)
    back = spark.read.parquet(paths["sales_by_region"])
    assert sorted(back.collect()) == sorted(marts.sales_by_region(star).collect())


def test_category_totals_drop_null_category(spark):
    lines = [{S.PRODUCT_ID: "P-1", S.CATEGORY: None, S.SALES: 5}, {S.PRODUCT_ID: "P-2", S.CATEGORY: "Technology"}]
    st = build_star(spark, make_source(spark, lines), num_partitions=2)
    got = {r.category: r.total_sales for r in marts.category_totals(st).collect()}
    assert got == {"Technology": Decimal("100.00")}
    assert len(marts.sales_by_category(st).collect()) == 2          # the view itself keeps the NULL group


def test_written_tables_match_declared_schema(star):
    declared = {"dim_customer": S.DIM_CUSTOMER, "dim_product": S.DIM_PRODUCT, "dim_location": S.DIM_LOCATION,
                "dim_date": S.DIM_DATE, "fact_orders": S.FACT_ORDERS}
    for name, schema in declared.items():
        got = [(f.name, f.dataType) for f in star.tables[name].schema.fields]
        assert got == [(f.name, f.dataType) for f in schema.fields], name


def test_command_line(spark, workdir, capsys):
    from ledgerline.__main__ import main
    assert main(["etl", "--tables", "/root/testdata/sf0.001", "--base", workdir, "--materialise"]) == 0
    assert main(["show", "sales_by_region", "--base", workdir]) == 0
    assert main(["show", "kpi_cards", "--base", workdir]) == 0
    out = capsys.readouterr().out
    assert "reconciliation" in out and "profit_margin_pct" in out and "Unique Products" in out


def test_empty_source_builds_empty_star(spark):
    st = build_star(spark, make_source(spark, [{}]).limit(0))
    assert all(st.tables[t].count() == 0 for t in S.STAR_TABLES)
    k = marts.overall_kpis(st).first()
    assert k.total_orders == 0 and k.total_sales is None and k.unique_customers == 0
    assert k.profit_margin_pct is None and k.avg_order_value is None
    assert marts.discount_impact(st).count() == 0
    f = marts.freshness(st, include_refreshed=False).first()
    assert f.latest_order_date is None and f.total_records == 0


def test_star_for_tables_reuses_published_build(spark):
    from ledgerline.plans.star import forget_stars, star_for_tables
    sf = "/root/testdata/sf0.001"
    first = star_for_tables(spark, sf)
    forget_stars()                                   # as a new session would start
    again = star_for_tables(spark, sf)
    assert again.root == first.root
    assert again.counts == {k: v for k, v in first.counts.items() if k in again.counts}
    assert sorted(again.tables["dim_product"].collect()) == sorted(first.tables["dim_product"].collect())


def test_bundle_equals_its_views_and_reads_the_fact_once(spark, workdir):
    """Views derived from shared partials equal the views of the fact, NULL keys and hot keys included."""
    import contextlib
    import datetime as dt
    import io
    import random
    from decimal import Decimal

    rng = random.Random(11)
    lines = [{S.ORDER_DATE: None if n % 29 == 0 else dt.date(2023, 11, 1) + dt.timedelta(days=rng.randrange(120)),
              S.CUSTOMER_ID: None if n % 31 == 0 else "C-1" if n % 3 == 0 else f"C-{rng.randrange(200)}",
              S.SEGMENT: rng.choice(["Consumer", "Corporate"]), S.REGION: rng.choice(["West", None]),
              S.PRODUCT_ID: None if n % 37 == 0 else f"P-{rng.randrange(90)}", S.PRODUCT_NAME: f"name {rng.randrange(40)}",
              S.CITY: f"city {rng.randrange(9)}", S.SALES: rng.choice([None, Decimal(rng.randrange(9999)) / 100]),
              S.PROFIT: rng.choice([None, Decimal(rng.randrange(-999, 999)) / 100]), S.QUANTITY: rng.choice([None, 1, 7]),
              S.DISCOUNT: rng.choice([None, Decimal("0"), Decimal("0.1"), Decimal("0.3"), Decimal("0.8")])} for n in range(600)]
    for source in (make_source(spark, lines), make_source(spark, lines).limit(0)):
        star = build_star(spark, source)
        paths = marts.materialise(star, f"{workdir}/{source.count()}")
        for name, view in marts.all_marts(star).items():
            served = spark.read.parquet(paths[name])
            assert served.dtypes == view.dtypes, name
            assert sorted(map(str, served.collect())) == sorted(map(str, view.collect())), name
        out = io.StringIO()
        with contextlib.redirect_stdout(out):
            marts.shared_partials(star).explain()
        assert out.getvalue().count("order_key") and sum("FileScan" in x and "sales" in x for x in out.getvalue().splitlines()) == 1
        assert "SortAggregate" not in out.getvalue() and "ObjectHashAggregate" not in out.getvalue()
