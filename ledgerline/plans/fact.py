"""Fact build: one row per source line, keyed to the four dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..operators.lookup import BroadcastLimit, TableStats, lookup


def _q(name: str):
    return F.col(f"`{name}`")


def fact_rows(src: DataFrame, dims: dict[str, DataFrame], stats: dict[str, TableStats],
              limit: BroadcastLimit) -> DataFrame:
    """Project the 12 fact columns, look up five keys, keep the 11 stored columns.

    Every source line yields exactly one fact row: all lookups are left joins
    against dimensions unique on their lookup key, the location lookup matches
    a NULL postal code or city to the location with that NULL. Dimensions are broadcast,
    smallest first, while the measured sizes of the columns the lookups need fit ``limit`` together.
    Money is rounded to the store's decimals here (half away from zero); a value that
    the store's type cannot hold is NULL here and counted by ``quality.store_overflow``.
    """
    f = src.select(
        _q(S.ORDER_ID).alias("order_id"),
        _q(S.ORDER_DATE).alias("order_date"),
        _q(S.SHIP_DATE).alias("ship_date"),
        _q(S.CUSTOMER_ID).alias("customer_id"),
        _q(S.PRODUCT_ID).alias("product_id"),
        _q(S.POSTAL_CODE).alias("postal_code"),
        _q(S.CITY).alias("city"),
        _q(S.SALES).try_cast(S.MONEY).alias("sales"),
        _q(S.QUANTITY).alias("quantity"),
        _q(S.DISCOUNT).try_cast(S.RATE).alias("discount"),
        _q(S.PROFIT).try_cast(S.MONEY).alias("profit"),
        _q(S.SHIP_MODE).alias("ship_mode"),
    )

    dates = dims["dim_date"]
    # The key taken: dimension, (fact column, dimension column) pairs, NULL-safe columns.
    lookups = {
        "customer_key": ("dim_customer", dims["dim_customer"], [("customer_id", "customer_id")], ()),
        "product_key": ("dim_product", dims["dim_product"], [("product_id", "product_id")], ()),
        "location_key": ("dim_location", dims["dim_location"], [("postal_code", "postal_code"), ("city", "city")],
                         ("postal_code", "city")),
        "order_date_key": ("dim_date", dates.withColumnRenamed("date_key", "order_date_key"), [("order_date", "full_date")], ()),
        "ship_date_key": ("dim_date", dates.withColumnRenamed("date_key", "ship_date_key"), [("ship_date", "full_date")], ()),
    }
    small = limit.admit({key: (stats.get(name), [key, *[r for _, r in pairs]]) for key, (name, _, pairs, _) in lookups.items()})
    for key, (_, dim, pairs, null_safe) in lookups.items():
        f = lookup(f, dim, pairs, [key], null_safe=null_safe, broadcast=key in small)
    return f.select(
        "order_id", "order_date_key", "ship_date_key", "customer_key", "product_key", "location_key",
        "sales", "quantity", "discount", "profit", "ship_mode",
    )


def with_order_key(fact: DataFrame, first: int = 0) -> DataFrame:
    """Row identity of the stored fact: unique, fixed once written, only ever counted. ``first`` counts the partitions before."""
    return fact.select((F.monotonically_increasing_id() + F.lit(first << 33)).alias("order_key"), "*")
