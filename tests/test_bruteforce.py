"""Randomised comparisons against plain Python / pandas (one Spark job each)."""

from __future__ import annotations

import random
from decimal import ROUND_HALF_UP, Decimal

import pandas as pd
from pyspark.sql import functions as F

from ledgerline.functions.money import rounded_ratio
from ledgerline.operators import keep_first, with_surrogate_key


def _expected(num: Decimal, den: Decimal, digits: int, factor: int):
    if den == 0:
        return None
    return (Decimal(factor) * num / den).quantize(Decimal(1).scaleb(-digits), rounding=ROUND_HALF_UP)


def test_rounded_ratio_matches_decimal_half_up(spark):
    rnd = random.Random(7)
    rows = []
    for _ in range(4000):
        num = Decimal(rnd.randint(-10**9, 10**9)).scaleb(-2)
        den = Decimal(rnd.choice([0, rnd.randint(-10**6, 10**6), rnd.randint(1, 400)])).scaleb(-2)
        rows.append((num, den))
    # exact ties: n / d ends in 5 at the third digit
    rows += [(Decimal("0.05"), Decimal("2.00")), (Decimal("-0.05"), Decimal("2.00")), (Decimal("1.25"), Decimal("100.00"))]
    df = spark.createDataFrame(rows, "n decimal(22,2), d decimal(22,2)")
    out = df.select("n", "d", rounded_ratio(F.col("n"), F.col("d")).alias("r"),
                    rounded_ratio(F.col("n"), F.col("d"), factor=100).alias("pct")).collect()
    for r in out:
        assert r.r == _expected(r.n, r.d, 2, 1), (r.n, r.d, r.r)
        assert r.pct == _expected(r.n, r.d, 2, 100), (r.n, r.d, r.pct)


def test_keep_first_matches_pandas(spark):
    rnd = random.Random(11)
    data = [(rnd.choice(["a", "b", "c", None]), rnd.randint(0, 5), rnd.random()) for _ in range(3000)]
    pdf = pd.DataFrame(data, columns=["k1", "k2", "v"])
    expected = pdf.drop_duplicates(subset=["k1", "k2"], keep="first")
    rows = [(k1, k2, v, i) for i, (k1, k2, v) in enumerate(data)]
    df = spark.createDataFrame(rows, "k1 string, k2 int, v double, _line_ordinal long").repartition(5)
    got = {(r.k1, r.k2): r.v for r in keep_first(df, ["k1", "k2"], ["v"]).collect()}
    want = {(None if pd.isna(k1) else k1, int(k2)): v for k1, k2, v in expected.itertuples(index=False)}
    assert got == want


def test_dense_keys_match_rank(spark):
    rnd = random.Random(3)
    keys = sorted({f"id-{rnd.randint(0, 10**6):07d}" for _ in range(5000)})
    df = spark.createDataFrame([(k,) for k in rnd.sample(keys, len(keys))], "k string")
    got = {r.k: r.key for r in with_surrogate_key(df, "key", [F.col("k").asc()], num_partitions=6).collect()}
    assert got == {k: i + 1 for i, k in enumerate(keys)}


def test_marts_on_skewed_source_match_pandas(spark):
    import datetime as dt

    from ledgerline import schemas as S
    from ledgerline.plans import marts
    from ledgerline.plans.star import build_star

    from conftest import make_source

    rnd = random.Random(5)
    lines = []
    for i in range(1500):
        hot = i % 3 == 0                       # a third of all lines: one customer, one product
        c = 0 if hot else rnd.randint(1, 40)
        p = 0 if hot else rnd.randint(1, 25)
        lines.append({
            S.ORDER_ID: f"O-{i // 2}", S.CUSTOMER_ID: f"C-{c}", S.CUSTOMER_NAME: f"Name {c}",
            S.SEGMENT: ["Consumer", "Corporate", "Home Office"][c % 3], S.PRODUCT_ID: f"P-{p}",
            S.PRODUCT_NAME: f"Prod {p % 7}", S.CATEGORY: ["Furniture", "Technology"][p % 2],
            S.SUB_CATEGORY: f"Sub {p % 4}", S.REGION: ["East", "West"][c % 2], S.CITY: f"City {c % 5}",
            S.ORDER_DATE: dt.date(2024, 1, 1) + dt.timedelta(days=rnd.randint(0, 60)),
            S.SALES: Decimal(rnd.randint(0, 100000)).scaleb(-2),
            S.PROFIT: Decimal(rnd.randint(-20000, 30000)).scaleb(-2),
            S.QUANTITY: rnd.randint(1, 9),
            S.DISCOUNT: Decimal(rnd.choice([0, 5, 10, 15, 20, 25, 80])).scaleb(-2),
        })
    st = build_star(spark, make_source(spark, lines), num_partitions=4)
    pdf = pd.DataFrame(lines)

    seg = {r.segment: r for r in marts.sales_by_segment(st).collect()}
    for name, g in pdf.groupby(S.SEGMENT):
        r = seg[name]
        assert r.total_orders == len(g) and r.total_customers == g[S.CUSTOMER_ID].nunique()
        assert r.total_sales == sum(g[S.SALES]) and r.total_profit == sum(g[S.PROFIT])
        assert r.avg_sales_per_customer == (sum(g[S.SALES]) / g[S.CUSTOMER_ID].nunique()).quantize(
            Decimal("0.01"), rounding=ROUND_HALF_UP)

    top = marts.top_products(st).collect()
    per = pdf.groupby([S.PRODUCT_NAME, S.CATEGORY, S.SUB_CATEGORY])[S.SALES].sum()
    want = sorted(per.items(), key=lambda kv: (-kv[1], kv[0]))[:10]
    assert [(r.product_name, r.category, r.sub_category, r.total_sales) for r in top] == \
        [(k[0], k[1], k[2], v) for k, v in want]

    daily = {r.full_date: r for r in marts.daily_sales(st).collect()}
    for day, g in pdf.groupby(S.ORDER_DATE):
        r = daily[day]
        assert r.total_orders == len(g) and r.total_quantity == g[S.QUANTITY].sum()
        assert r.avg_discount == (sum(g[S.DISCOUNT]) / len(g)).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)

    k = marts.overall_kpis(st).first()
    assert k.unique_customers == pdf[S.CUSTOMER_ID].nunique() and k.unique_products == pdf[S.PRODUCT_ID].nunique()
    assert k.profit_margin_pct == (100 * sum(pdf[S.PROFIT]) / sum(pdf[S.SALES])).quantize(
        Decimal("0.01"), rounding=ROUND_HALF_UP)
    assert {r.discount_bucket: r.total_orders for r in marts.discount_impact(st).collect()} == {
        "No Discount": int((pdf[S.DISCOUNT] == 0).sum()),
        "Low (1-10%)": int(((pdf[S.DISCOUNT] > 0) & (pdf[S.DISCOUNT] <= Decimal("0.10"))).sum()),
        "Medium (11-20%)": int(((pdf[S.DISCOUNT] > Decimal("0.10")) & (pdf[S.DISCOUNT] <= Decimal("0.20"))).sum()),
        "High (>20%)": int((pdf[S.DISCOUNT] > Decimal("0.20")).sum()),
    }


def test_large_dimension_paths_match_broadcast_paths(spark):
    """With the broadcast bound at zero, lookups are shuffled joins and marts pre-aggregate per key."""
    from ledgerline.config import BROADCAST_ROWS_CONF
    from ledgerline.plans import marts
    from ledgerline.plans.star import build_star
    from ledgerline.registry import report
    from ledgerline.sources.tables import read_tables_source

    src = read_tables_source(spark, "/root/testdata/sf0.001")
    small = build_star(spark, src)
    spark.conf.set(BROADCAST_ROWS_CONF, "0")
    try:
        large = build_star(spark, src)
        assert not large.is_small("dim_product", ["product_key", "category"])
        for t in ["dim_customer", "dim_product", "dim_location", "dim_date"]:
            assert sorted(small.tables[t].collect()) == sorted(large.tables[t].collect()), t
        cols = [c for c in small.fact.columns if c != "order_key"]
        assert sorted(small.fact.select(cols).collect()) == sorted(large.fact.select(cols).collect())
        for name, fn in {**marts.MARTS, "freshness": lambda s: marts.freshness(s, include_refreshed=False),
                         "high_revenue_low_margin": marts.high_revenue_low_margin}.items():
            assert sorted(report(fn(small)).collect()) == sorted(report(fn(large)).collect()), name
        k = marts.filtered_kpis(large, regions=["ASIA"], date_from="1996-01-01").first()
        assert k == marts.filtered_kpis(small, regions=["ASIA"], date_from="1996-01-01").first()
    finally:
        spark.conf.unset(BROADCAST_ROWS_CONF)


def test_display_formats_match_python(spark):
    from ledgerline.functions.text import dollars, percent_text, thousands

    rnd = random.Random(21)
    values = [Decimal(rnd.randint(-10**12, 10**12)).scaleb(-2) for _ in range(2000)]
    values += [Decimal("0.50"), Decimal("1.50"), Decimal("2.50"), Decimal("-0.50"), Decimal("1234.5"),
               Decimal("999.995"), Decimal("0.00")]
    counts = [rnd.randint(0, 10**10) for _ in range(500)]
    df = spark.createDataFrame([(v,) for v in values], "v decimal(22,3)")
    got = df.select("v", dollars(F.col("v")).alias("d0"), dollars(F.col("v"), 2).alias("d2"),
                    percent_text(F.round(F.col("v"), 2).cast("decimal(20,2)")).alias("p")).collect()
    for r in got:
        assert r.d0 == f"${r.v:,.0f}", r.v
        assert r.d2 == f"${r.v:,.2f}", r.v
        assert r.p == f"{r.v.quantize(Decimal('0.01'), rounding=ROUND_HALF_UP)}%", r.v
    cdf = spark.createDataFrame([(c,) for c in counts], "c long")
    for r in cdf.select("c", thousands(F.col("c")).alias("t")).collect():
        assert r.t == f"{r.c:,}"
