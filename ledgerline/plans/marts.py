"""Marts over the star: the nine KPI views, the dashboard datasets, and the
advertised analyses.

Plan shape. Fact rows are never shuffled to meet a dimension. A dimension
whose measured size (rows and string bytes of the columns used) proves it
small is broadcast and joined inside the
fact's scan stage, then the join output is aggregated once (map-side partial
aggregation, so a key holding a third of all rows collapses to one row per
task before the exchange). A dimension beyond the limit is met by the fact's
per-key partial aggregates instead: aggregate on the dimension key first,
join those (one row per key) to the dimension, re-aggregate. Views grouped
by the dimension key itself (daily sales) always aggregate first.

Semantics kept from the views: ``total_orders`` counts order lines; inner
joins drop fact rows without a key; ratios and means are rounded half away
from zero on exact decimals; top-k sorts NULL totals first and breaks ties on
the grouping keys.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import replace
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas as S
from ..config import shuffles_removed
from ..functions.dates import year_month_period
from ..functions.money import margin_pct, rounded_mean, rounded_ratio
from ..functions.text import dollars, minute_text, percent_text, thousands
from .star import Star


def _sum_measures(prefix: str = "") -> list[Column]:
    """Line count and additive measures of the fact (re-aggregatable)."""
    return [
        F.count(F.col("order_key")).alias(f"{prefix}lines"),
        F.sum("sales").alias(f"{prefix}sales"),
        F.sum("profit").alias(f"{prefix}profit"),
        F.sum("quantity").alias(f"{prefix}quantity"),
    ]


def _by_key(star: Star, key: str) -> DataFrame:
    """Fact partials per dimension key; NULL keys are dropped (inner-join semantics)."""
    if star.partials is not None:
        return _part(star, key).filter(F.col("key").isNotNull()).withColumnRenamed("key", key)
    return star.fact.filter(F.col(key).isNotNull()).groupBy(key).agg(
        *_sum_measures("p_"), F.sum("discount").alias("p_discount_sum"), F.count("discount").alias("p_discount_n"))


# ---------------------------------------------------------------------------
# Partials shared by a bundle of views
# ---------------------------------------------------------------------------

_KEY_PARTS = ("order_date_key", "customer_key", "product_key", "location_key")
_BUCKETS = (S.BUCKET_NONE, S.BUCKET_LOW, S.BUCKET_MEDIUM, S.BUCKET_HIGH)


def shared_partials(star: Star) -> DataFrame:
    """All that the nine views need of the fact, in one pass over it: one row per (part, key, month).

    Every fact row gives its measures to its group in each part (the four dimension keys, the discount
    bucket, all rows), and the bit of its customer to the key block of its order month. The parts
    are grouping sets of one hash aggregate, built in each task before the one exchange, so a hot key
    is one row a task. The months come from the date dimension, which holds one row a day.
    """
    bit = F.expr(f"shiftleft(1L, cast(pmod(customer_key, {1 << _KEY_BLOCK_BITS}) as int))")
    none = F.lit(None).cast("long")
    bucket = discount_bucket(F.col("discount"))
    code = F.coalesce(*[F.when(bucket == label, F.lit(n)) for n, label in enumerate(_BUCKETS)]).cast("long")

    def group(part: str, key: Column, month: Column = none, bits: Column = none) -> Column:
        return F.struct(F.lit(part).alias("part"), key.cast("long").alias("key"), month.alias("month"), bits.alias("bits"))

    groups = [group(k, F.col(k)) for k in _KEY_PARTS] + [
        group("bucket", code), group("all", none),
        group("month_customers", F.shiftright("customer_key", _KEY_BLOCK_BITS), F.col("_month"), bit)]
    days = star.dim("dim_date", ["date_key", "year", "month"]).select(
        F.col("date_key").alias("_day"), _month_of(F.col("year"), F.col("month")).alias("_month"))
    rows = (star.fact.join(days, F.col("order_date_key") == F.col("_day"), "left")
            .select("order_key", "sales", "profit", "quantity", "discount", F.explode(F.array(*groups)).alias("g")))
    return rows.groupBy("g.part", "g.key", "g.month").agg(
        *_sum_measures("p_"),
        F.sum("discount").alias("p_discount_sum"), F.count("discount").alias("p_discount_n"),
        F.count("sales").alias("p_sales_n"), F.count("profit").alias("p_profit_n"), F.count(F.lit(1)).alias("p_rows"),
        F.bit_or("g.bits").alias("p_bits"))


def _month_of(year: Column, month: Column) -> Column:
    return (year * 12 + month).cast("long")


def _part(star: Star, part: str) -> DataFrame:
    return star.partials.filter(F.col("part") == part).drop("part")


def _monthly_from_partials(star: Star) -> DataFrame:
    """The monthly trend: sums of its days' partials, distinct customers as bits of its key blocks."""
    d = star.dim("dim_date", ["date_key", "year", "month", "month_name"])
    days = _by_key(star, "order_date_key").drop("month")
    sums = days.join(d, F.col("order_date_key") == F.col("date_key")).groupBy("year", "month", "month_name").agg(
        F.sum("p_lines").alias("total_orders"),
        *[F.sum(f"p_{m}").cast(days.schema[f"p_{m}"].dataType).alias(_TOTALS[m]) for m in ("sales", "profit")])
    seen = _part(star, "month_customers").groupBy(F.col("month").alias("_month")).agg(
        F.coalesce(F.sum(F.bit_count("p_bits")), F.lit(0)).cast("long").alias("unique_customers"))
    return sums.join(seen, _month_of(F.col("year"), F.col("month")) == F.col("_month")).drop("_month")


def _kpis_from_partials(star: Star) -> DataFrame:
    """The overall KPIs; a key's partial is one row, so distinct keys are rows."""
    rows = star.partials.filter(F.col("part").isin("all", "customer_key", "product_key"))
    whole = F.col("part") == "all"

    def total(c: str, t: str) -> Column:
        return F.sum(F.when(whole, F.col(c))).cast(t)

    def distinct(key: str) -> Column:
        return F.count_if((F.col("part") == key) & F.col("key").isNotNull())

    sales, profit = (total(f"p_{m}", _TYPES[m]) for m in ("sales", "profit"))
    sales_n, lines = (F.coalesce(total(c, "long"), F.lit(0)).cast("long") for c in ("p_sales_n", "p_rows"))
    return rows.agg(lines.alias("total_orders"), sales.alias("total_sales"), profit.alias("total_profit"),
                    total("p_quantity", "long").alias("total_quantity"),
                    rounded_mean(sales, sales_n).alias("avg_order_value"), margin_pct(profit, sales).alias("profit_margin_pct"),
                    distinct("customer_key").alias("unique_customers"), distinct("product_key").alias("unique_products"))


_TOTALS = {"lines": "total_orders", "sales": "total_sales", "profit": "total_profit", "quantity": "total_quantity"}


# One result schema, whichever plan computed it.
_TYPES = {"lines": "long", "sales": S.MONEY_SUM, "profit": S.MONEY_SUM, "quantity": "long"}


def rollup_by_dimension(star: Star, dim_name: str, key: str, attrs: list[str],
                        measures: tuple[str, ...] = ("lines", "sales", "profit", "quantity")) -> DataFrame:
    """Fact measures summed per attributes of one dimension (inner-join semantics).

    When the dimension's written row count proves it broadcastable, the fact
    meets it in a broadcast hash join inside the scan stage and is aggregated
    once (one exchange, of partial aggregates). Otherwise the fact is first
    aggregated per dimension key, and only those partials are joined to the
    dimension (shuffled) and re-aggregated: fact rows are never shuffled to
    meet a large dimension.
    """
    dim = star.tables[dim_name].select(key, *attrs)
    if star.partials is None and star.is_small(dim_name, [key, *attrs]):
        joined = star.fact.join(F.broadcast(dim), key)
        aggs = {"lines": F.count(F.col("order_key")), "sales": F.sum("sales"), "profit": F.sum("profit"),
                "quantity": F.sum("quantity")}
    else:
        joined = _by_key(star, key).join(star.dim(dim_name, [key, *attrs]) if star.partials is not None else dim, key)
        aggs = {m: F.sum(f"p_{m}") for m in _TOTALS}
    return joined.groupBy(*attrs).agg(*[aggs[m].cast(_TYPES[m]).alias(_TOTALS[m]) for m in measures])


# ---------------------------------------------------------------------------
# K1-K9: the views
# ---------------------------------------------------------------------------

def daily_sales(star: Star) -> DataFrame:
    """Per order date: lines, sales, profit, quantity, mean discount."""
    parts = _by_key(star, "order_date_key")
    if star.partials is not None:
        parts = parts.drop("month")
    d = star.dim("dim_date", ["date_key", "full_date", "year", "month", "month_name", "day_name", "is_weekend"])
    return parts.join(d, parts.order_date_key == d.date_key).select(
        "full_date", "year", "month", "month_name", "day_name", "is_weekend",
        F.col("p_lines").alias("total_orders"),
        F.col("p_sales").alias("total_sales"),
        F.col("p_profit").alias("total_profit"),
        F.col("p_quantity").alias("total_quantity"),
        rounded_mean(F.col("p_discount_sum"), F.col("p_discount_n")).alias("avg_discount"),
    )


def sales_by_region(star: Star) -> DataFrame:
    agg = rollup_by_dimension(star, "dim_location", "location_key", ["region"], ("lines", "sales", "profit"))
    return agg.select("region", "total_orders", "total_sales", "total_profit",
                      margin_pct(F.col("total_profit"), F.col("total_sales")).alias("profit_margin_pct"))


def sales_by_category(star: Star) -> DataFrame:
    agg = rollup_by_dimension(star, "dim_product", "product_key", ["category", "sub_category"])
    return agg.select("category", "sub_category", "total_orders", "total_sales", "total_profit", "total_quantity",
                      margin_pct(F.col("total_profit"), F.col("total_sales")).alias("profit_margin_pct"))


def sales_by_segment(star: Star) -> DataFrame:
    """Per segment; each customer key is one partial row, so customers = partial rows."""
    parts = _by_key(star, "customer_key")
    cust = star.dim("dim_customer", ["customer_key", "segment"])
    agg = parts.join(cust, "customer_key").groupBy("segment").agg(
        F.count(F.col("customer_key")).alias("total_customers"),
        *[F.sum(f"p_{m}").alias(_TOTALS[m]) for m in ("lines", "sales", "profit")])
    return agg.select(
        "segment", "total_customers", "total_orders", "total_sales", "total_profit",
        rounded_mean(F.col("total_sales"), F.col("total_customers")).alias("avg_sales_per_customer"))


def monthly_trend(star: Star) -> DataFrame:
    """Per calendar month of the order date, with distinct customers."""
    if star.partials is not None:
        return _monthly_from_partials(star)
    d = star.dim("dim_date", ["date_key", "year", "month", "month_name"])
    f = star.fact.select("order_key", "order_date_key", "customer_key", "sales", "profit")
    return (f.join(d, f.order_date_key == d.date_key).groupBy("year", "month", "month_name").agg(
        F.count("order_key").alias("total_orders"),
        F.sum("sales").alias("total_sales"),
        F.sum("profit").alias("total_profit"),
        F.count_distinct("customer_key").alias("unique_customers"),
    ))


def _top(df: DataFrame, keys: list[str], n: int) -> DataFrame:
    order = [F.col("total_sales").desc_nulls_first()] + [F.col(k).asc_nulls_first() for k in keys]
    return df.orderBy(*order).limit(n)


def top_products(star: Star, n: int = S.TOP_K) -> DataFrame:
    """Top ``n`` product names by sales (ids sharing a name, category and sub-category merge)."""
    keys = ["product_name", "category", "sub_category"]
    agg = rollup_by_dimension(star, "dim_product", "product_key", keys, ("sales", "profit", "quantity"))
    return _top(agg, keys, n)


def top_customers(star: Star, n: int = S.TOP_K) -> DataFrame:
    keys = ["customer_name", "segment"]
    agg = rollup_by_dimension(star, "dim_customer", "customer_key", keys, ("lines", "sales", "profit"))
    return _top(agg, keys, n)


#: Keys in a block of a distinct count: the bits of a LONG.
_KEY_BLOCK_BITS = 6
_KPI_SUMS = {"sales": S.MONEY, "profit": S.MONEY, "quantity": "long"}


def kpis_of(fact: DataFrame) -> DataFrame:
    """Overall KPIs of any fact-shaped frame (one row, also for an empty input), in one pass over it.

    Every fact row gives its measures to one group, and a bit for its customer and its product to
    the groups of their key blocks (64 dense keys each). All buffers are numbers, so the groups are hash
    aggregates, built in each task before the one exchange: no sort of the fact, no second scan, and
    no more rows exchanged than a task has key blocks. Distinct counts are exact: the bits that are set.
    """
    none = {m: F.lit(None).cast(t) for m, t in _KPI_SUMS.items()}
    nothing = F.lit(None).cast("long")
    measures = F.struct(F.lit(0).alias("part"), nothing.alias("block"), nothing.alias("bits"), F.lit(1).cast("long").alias("lines"),
                        *[F.col(m).cast(t).alias(m) for m, t in _KPI_SUMS.items()])

    def seen(part: int, key: str) -> Column:
        bit = F.expr(f"shiftleft(1L, cast(pmod({key}, {1 << _KEY_BLOCK_BITS}) as int))")
        return F.struct(F.lit(part).alias("part"), F.shiftright(key, _KEY_BLOCK_BITS).alias("block"), bit.alias("bits"),
                        nothing.alias("lines"), *[c.alias(m) for m, c in none.items()])

    rows = fact.select(F.inline(F.array(measures, seen(1, "customer_key"), seen(2, "product_key"))))
    groups = rows.groupBy("part", "block").agg(
        F.bit_or("bits").alias("bits"), F.count("lines").alias("lines"), F.count("sales").alias("with_sales"),
        *[F.sum(m).alias(m) for m in _KPI_SUMS])
    distinct = lambda part: F.coalesce(F.sum(F.when(F.col("part") == part, F.bit_count("bits"))), F.lit(0)).cast("long")
    total = {m: F.sum(m).cast(S.MONEY_SUM if t == S.MONEY else t) for m, t in _KPI_SUMS.items()}
    lines, with_sales = (F.coalesce(F.sum(c), F.lit(0)).cast("long") for c in ("lines", "with_sales"))
    return groups.agg(
        lines.alias("total_orders"),
        total["sales"].alias("total_sales"),
        total["profit"].alias("total_profit"),
        total["quantity"].alias("total_quantity"),
        rounded_mean(total["sales"], with_sales).alias("avg_order_value"),
        margin_pct(total["profit"], total["sales"]).alias("profit_margin_pct"),
        distinct(1).alias("unique_customers"),
        distinct(2).alias("unique_products"),
    )


def overall_kpis(star: Star) -> DataFrame:
    return kpis_of(star.fact) if star.partials is None else _kpis_from_partials(star)


def discount_bucket(discount: Column) -> Column:
    """Bucket of a decimal discount; NULL falls through to the last bucket."""
    return (F.when(discount == F.lit(Decimal(S.BUCKET_NONE_AT)), S.BUCKET_NONE)
            .when(discount <= F.lit(Decimal(S.BUCKET_LOW_MAX)), S.BUCKET_LOW)
            .when(discount <= F.lit(Decimal(S.BUCKET_MEDIUM_MAX)), S.BUCKET_MEDIUM)
            .otherwise(S.BUCKET_HIGH))


def discount_impact(star: Star) -> DataFrame:
    """Per discount bucket, ordered by bucket label."""
    if star.partials is None:
        parts = star.fact.groupBy(discount_bucket(F.col("discount")).alias("discount_bucket")).agg(
            F.count(F.lit(1)).alias("p_rows"), F.sum("sales").alias("p_sales"), F.sum("profit").alias("p_profit"),
            F.count("profit").alias("p_profit_n"))
    else:
        label = F.element_at(F.array(*[F.lit(b) for b in _BUCKETS]), (F.col("key") + 1).cast("int"))
        parts = _part(star, "bucket").select(label.alias("discount_bucket"), "p_rows", "p_sales", "p_profit", "p_profit_n")
    return parts.select(
        "discount_bucket",
        F.col("p_rows").alias("total_orders"),
        F.col("p_sales").alias("total_sales"),
        F.col("p_profit").alias("total_profit"),
        rounded_mean(F.col("p_profit"), F.col("p_profit_n")).alias("avg_profit_per_order"),
        margin_pct(F.col("p_profit"), F.col("p_sales")).alias("profit_margin_pct"),
    ).orderBy("discount_bucket")


# ---------------------------------------------------------------------------
# K10-K15, P12-P13: dashboard datasets
# ---------------------------------------------------------------------------

def freshness(star: Star, as_of: Column | None = None, include_refreshed: bool = True) -> DataFrame:
    """Latest order date and line count of facts with a known order date."""
    d = star.tables["dim_date"].select(F.col("date_key").alias("order_date_key"), "full_date")
    parts = star.fact.filter(F.col("order_date_key").isNotNull()).groupBy("order_date_key").agg(
        F.count(F.lit(1)).alias("n"))
    out = parts.join(d, "order_date_key").agg(
        F.max("full_date").alias("latest_order_date"),
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("total_records"))
    if include_refreshed:
        out = out.withColumn("last_refreshed", as_of if as_of is not None else F.current_timestamp())
    return out


def freshness_cards(star: Star, as_of: Column | None = None) -> DataFrame:
    """The three freshness card texts: latest order date, records, refresh time (``as_of``, default now)."""
    values = [F.date_format("latest_order_date", "yyyy-MM-dd"), thousands(F.col("total_records")),
              minute_text(F.col("last_refreshed"))]
    arr = F.array(*[F.struct(F.lit(i).alias("position"), F.lit(label).alias("label"), v.alias("value"))
                    for i, (label, v) in enumerate(zip(S.FRESHNESS_CARD_LABELS, values), start=1)])
    return freshness(star, as_of).select(F.inline(arr))


def monthly_period(star: Star) -> DataFrame:
    """Monthly trend with a ``YYYY-MM`` label, in calendar order (the line chart's feed)."""
    return (monthly_trend(star).withColumn("period", year_month_period(F.col("year"), F.col("month")))
            .orderBy("year", "month"))


def category_totals(star: Star) -> DataFrame:
    """Sales per category from the category view; a NULL category is dropped, as a pandas group-by does."""
    return (sales_by_category(star).filter(F.col("category").isNotNull())
            .groupBy("category").agg(F.sum("total_sales").alias("total_sales")))


def region_share(star: Star) -> DataFrame:
    """Each region's share of sales, in percent (the pie chart); the total is a scalar subquery."""
    by_region = sales_by_region(star).select("region", "total_sales")
    total = by_region.agg(F.sum("total_sales")).scalar()
    return by_region.select("region", "total_sales",
                            rounded_ratio(F.col("total_sales"), total, digits=2, factor=100).alias("share_pct"))


def category_tree(star: Star) -> DataFrame:
    """Category -> sub-category tree: sales summed, margin averaged weighted by sales.

    Leaf rows carry the sub-category's margin; parent rows (``sub_category``
    NULL, ``level`` 1) the sales-weighted mean of their children's margins.
    """
    leaves = sales_by_category(star).select(
        "category", "sub_category", "total_sales", "profit_margin_pct",
        (F.col("profit_margin_pct") * F.col("total_sales")).alias("_weighted"))
    tree = leaves.rollup("category", "sub_category").agg(
        F.grouping_id().alias("_gid"),
        F.sum("total_sales").alias("total_sales"),
        F.max("profit_margin_pct").alias("_leaf_margin"),
        rounded_ratio(F.sum("_weighted"), F.sum("total_sales"), digits=2, scale=4).alias("_parent_margin"),
    ).filter(F.col("_gid") < 3)
    return tree.select(
        "category", "sub_category", "total_sales",
        F.when(F.col("_gid") == 0, F.col("_leaf_margin")).otherwise(F.col("_parent_margin"))
        .cast("decimal(20,2)").alias("margin_pct"),
        F.when(F.col("_gid") == 0, F.lit(2)).otherwise(F.lit(1)).alias("level"),
    )


def kpi_cards(star: Star) -> DataFrame:
    """The eight KPI card texts, one row per card."""
    k = overall_kpis(star)
    values = [
        dollars(F.col("total_sales")),
        dollars(F.col("total_profit")),
        thousands(F.col("total_orders")),
        percent_text(F.col("profit_margin_pct")),
        dollars(F.col("avg_order_value"), 2),
        thousands(F.col("total_quantity")),
        thousands(F.col("unique_customers")),
        thousands(F.col("unique_products")),
    ]
    cards = list(zip(S.KPI_CARD_LABELS, values))
    arr = F.array(*[F.struct(F.lit(i).alias("position"), F.lit(lbl).alias("label"), v.alias("value"))
                    for i, (lbl, v) in enumerate(cards, start=1)])
    return k.select(F.inline(arr))


def top_products_display(star: Star) -> DataFrame:
    cols = [F.col("product_name"), F.col("category"), dollars(F.col("total_sales")), dollars(F.col("total_profit"))]
    return top_products(star).select(*[c.alias(h) for c, h in zip(cols, S.TOP_PRODUCTS_HEADERS)])


def top_customers_display(star: Star) -> DataFrame:
    cols = [F.col("customer_name"), F.col("segment"), F.col("total_orders"), dollars(F.col("total_sales"))]
    return top_customers(star).select(*[c.alias(h) for c, h in zip(cols, S.TOP_CUSTOMERS_HEADERS)])


# ---------------------------------------------------------------------------
# X2-X4: advertised analyses
# ---------------------------------------------------------------------------

def month_over_month(star: Star) -> DataFrame:
    """Change of sales and profit against the previous month present in the trend.

    The window runs over the monthly rows (one per calendar month with
    orders), never over fact rows.
    """
    m = monthly_trend(star).select("year", "month", "total_sales", "total_profit")
    w = Window.partitionBy().orderBy("year", "month")
    prev_s, prev_p = F.lag("total_sales").over(w), F.lag("total_profit").over(w)
    m = m.select("*", prev_s.alias("prev_sales"), prev_p.alias("prev_profit"))
    return m.select(
        "year", "month", "total_sales", "total_profit", "prev_sales", "prev_profit",
        rounded_ratio(F.col("total_sales") - F.col("prev_sales"), F.abs(F.col("prev_sales")),
                      digits=2, factor=100).alias("sales_change_pct"),
        rounded_ratio(F.col("total_profit") - F.col("prev_profit"), F.abs(F.col("prev_profit")),
                      digits=2, factor=100).alias("profit_change_pct"),
    )


def high_revenue_low_margin(star: Star) -> DataFrame:
    """Products selling at least the mean product's sales, at a margin below the overall margin.

    Both comparisons are exact: ``sales * n >= S`` and ``p * S < P * s``. The
    totals (n, S, P) are uncorrelated scalar subqueries over the per-product
    rows: evaluated once, then used as values -- no join to a one-row frame.
    """
    parts = _by_key(star, "product_key")
    prod = star.dim("dim_product", ["product_key", "product_id", "product_name", "category", "sub_category"])
    per = parts.join(prod, "product_key").select(
        "product_id", "product_name", "category", "sub_category",
        F.col("p_sales").alias("total_sales"), F.col("p_profit").alias("total_profit"))
    totals = per.select(F.struct(F.count(F.lit(1)).alias("n"), F.sum("total_sales").alias("s"),
                                 F.sum("total_profit").alias("p"))).scalar()
    n, total_s, total_p = totals.getField("n"), totals.getField("s"), totals.getField("p")
    keep = ((F.col("total_sales") * n >= total_s)
            & (F.col("total_sales") > 0) & (total_s > 0)
            & (F.col("total_profit") * total_s < total_p * F.col("total_sales")))
    return per.filter(keep).select(
        "product_id", "product_name", "category", "sub_category", "total_sales", "total_profit",
        margin_pct(F.col("total_profit"), F.col("total_sales")).alias("profit_margin_pct"))


def filtered_fact(star: Star, regions: list[str] | None = None, categories: list[str] | None = None,
                  segments: list[str] | None = None, date_from: _dt.date | str | None = None,
                  date_to: _dt.date | str | None = None) -> DataFrame:
    """Fact rows whose dimensions pass the given filters (semi-joins to filtered dimensions)."""
    f = star.fact

    def semi(frame: DataFrame, dim_name: str, key: str, fact_key: str, cond: Column) -> DataFrame:
        d = star.tables[dim_name].filter(cond).select(F.col(key).alias(f"_sk_{fact_key}"))
        d = F.broadcast(d) if star.is_small(dim_name, [key]) else d
        return frame.join(d, frame[fact_key] == F.col(f"_sk_{fact_key}"), "left_semi")

    if regions is not None:
        f = semi(f, "dim_location", "location_key", "location_key", F.col("region").isin(regions))
    if categories is not None:
        f = semi(f, "dim_product", "product_key", "product_key", F.col("category").isin(categories))
    if segments is not None:
        f = semi(f, "dim_customer", "customer_key", "customer_key", F.col("segment").isin(segments))
    if date_from is not None or date_to is not None:
        cond = F.lit(True)
        if date_from is not None:
            cond = cond & (F.col("full_date") >= F.lit(date_from).cast("date"))
        if date_to is not None:
            cond = cond & (F.col("full_date") <= F.lit(date_to).cast("date"))
        # Date keys are dense and ordered by date, so the date range is a key range:
        # as a literal predicate it reaches the Parquet scan and skips row groups.
        lo, hi = star.tables["dim_date"].filter(cond).agg(F.min("date_key"), F.max("date_key")).first()
        if lo is None:
            return f.limit(0)
        f = f.filter(F.col("order_date_key").between(lo, hi))
        f = semi(f, "dim_date", "date_key", "order_date_key", cond)
    return f


def filtered_kpis(star: Star, **filters) -> DataFrame:
    """Overall KPIs under region / category / segment / order-date filters."""
    return kpis_of(filtered_fact(star, **filters))


MARTS = {
    "daily_sales": daily_sales,
    "sales_by_region": sales_by_region,
    "sales_by_category": sales_by_category,
    "sales_by_segment": sales_by_segment,
    "monthly_trend": monthly_trend,
    "top_products": top_products,
    "top_customers": top_customers,
    "overall_kpis": overall_kpis,
    "discount_impact": discount_impact,
}


# Dashboard datasets and advertised analyses, computed from the star on request.
DATASETS = {
    "freshness": freshness,
    "freshness_cards": freshness_cards,
    "monthly_period": monthly_period,
    "category_totals": category_totals,
    "region_share": region_share,
    "category_tree": category_tree,
    "kpi_cards": kpi_cards,
    "top_products_display": top_products_display,
    "top_customers_display": top_customers_display,
    "month_over_month": month_over_month,
    "high_revenue_low_margin": high_revenue_low_margin,
    "filtered_kpis": filtered_kpis,
}


def all_marts(star: Star) -> dict[str, DataFrame]:
    """The dashboard's bundle of views, keyed by view name without the ``vw_`` prefix."""
    return {name: fn(star) for name, fn in MARTS.items()}


def materialise(star: Star, root: str | None = None) -> dict[str, str]:
    """Write every view as a Parquet mart under ``root`` (default: the star's run folder).

    The fact is read once, into the partials that the views share (``_partials``, a folder a part); the nine
    writes read those, are independent jobs and are submitted together.
    """
    from concurrent.futures import ThreadPoolExecutor

    base = root or f"{star.root}/marts"
    parts = shared_partials(star)

    def write(item: tuple[str, DataFrame]) -> tuple[str, str]:
        name, df = item
        path = f"{base}/{name}"
        df.write.mode("overwrite").parquet(path)   # AQE coalesces the few aggregated rows
        return name, path

    with shuffles_removed(star.fact.sparkSession):
        parts.write.mode("overwrite").partitionBy("part").parquet(f"{base}/_partials")
        star = replace(star, partials=star.fact.sparkSession.read.schema(parts.schema).parquet(f"{base}/_partials"))
        with ThreadPoolExecutor(max_workers=len(MARTS)) as pool:
            return dict(pool.map(write, all_marts(star).items()))
