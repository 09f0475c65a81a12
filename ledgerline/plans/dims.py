"""Dimension builds: customer, product, location, date (with surrogate keys).

From a staged source (one number a row, ``operators.dedup``) the natural keys are aggregated
with the number of their first row and keyed; the attributes are then fetched from the rows of those
numbers alone. The source is hashed and scanned, never sorted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.dates import date_attributes
from ..operators.dedup import FIRST, first_ordinals, keep_first, numbered
from ..operators.keys import counted_surrogate_key, with_surrogate_key
from ..operators.lookup import BroadcastLimit, TableStats


def _q(name: str):
    return F.col(f"`{name}`")


#: Source columns of a dimension's natural key (``keys``) and of its first-seen attributes (``rest``).
_KEEP_FIRST = {
    "dim_customer": ([S.CUSTOMER_ID], [S.CUSTOMER_NAME, S.SEGMENT]),
    "dim_product": ([S.PRODUCT_ID], [S.PRODUCT_NAME, S.CATEGORY, S.SUB_CATEGORY]),
    "dim_location": ([S.POSTAL_CODE, S.CITY], [S.STATE, S.REGION, S.COUNTRY]),
}
_NAMES = {
    S.CUSTOMER_ID: "customer_id", S.CUSTOMER_NAME: "customer_name", S.SEGMENT: "segment",
    S.PRODUCT_ID: "product_id", S.PRODUCT_NAME: "product_name", S.CATEGORY: "category", S.SUB_CATEGORY: "sub_category",
    S.POSTAL_CODE: "postal_code", S.CITY: "city", S.STATE: "state", S.REGION: "region", S.COUNTRY: "country",
}
# A row without a customer or product id cannot be keyed and is left out.
_REQUIRED = {"dim_customer": S.CUSTOMER_ID, "dim_product": S.PRODUCT_ID}


def _keyable(name: str, src: DataFrame) -> DataFrame:
    return src.filter(_q(_REQUIRED[name]).isNotNull()) if name in _REQUIRED else src


def _named(columns: list[str]) -> list:
    return [_q(c).alias(_NAMES[c]) for c in columns]


def first_rows(name: str, src: DataFrame) -> DataFrame:
    """First row per natural key of a dimension.

    Locations are one per (postal code, city), the lookup key: the first (state, region,
    country) seen wins, so the fact lookup can never fan out; conflicting rows are reported by
    the constraint audit. A NULL postal code is a value of its own, as in the fact lookup.
    """
    keys, rest = _KEEP_FIRST[name]
    return keep_first(_keyable(name, src), keys, rest).select(*_named([*keys, *rest]))


def date_rows(src: DataFrame) -> DataFrame:
    """Every order and ship date once, with calendar attributes.

    One scan: both dates are exploded from the same row, then de-duplicated
    (a partial aggregate leaves at most one row per date per task).
    """
    days = (src.select(F.explode(F.array(_q(S.ORDER_DATE), _q(S.SHIP_DATE))).alias("full_date"))
            .filter(F.col("full_date").isNotNull())
            .distinct())
    attrs = date_attributes(F.col("full_date"))
    return days.select("full_date", *[v.alias(k) for k, v in attrs.items()])


# Natural-key order of each dimension's surrogate key.
KEY_ORDER = {
    "dim_customer": ("customer_key", lambda: [F.col("customer_id").asc()]),
    "dim_product": ("product_key", lambda: [F.col("product_id").asc()]),
    "dim_location": ("location_key",
                     lambda: [F.col("postal_code").asc_nulls_first(), F.col("city").asc_nulls_first()]),
    "dim_date": ("date_key", lambda: [F.col("full_date").asc()]),
}

def keyed(name: str, rows: DataFrame, num_partitions: int | None = None) -> DataFrame:
    key, order = KEY_ORDER[name]
    return with_surrogate_key(rows, key, order(), num_partitions)


def build_dimension(name: str, src: DataFrame, num_partitions: int | None = None,
                    limit: BroadcastLimit = BroadcastLimit(0, 0)) -> DataFrame:
    """A dimension with its surrogate keys.

    The (first row, key) pairs are two numbers a row and counted while they are keyed: within
    ``limit`` they are broadcast into the scan that fetches the attributes, beyond it they meet
    the scan by a hash of the row number.
    """
    if name == "dim_date":
        return keyed(name, date_rows(src), num_partitions)
    if not numbered(src):
        return keyed(name, first_rows(name, src), num_partitions)
    keys, rest = _KEEP_FIRST[name]
    key, order = KEY_ORDER[name]
    firsts = first_ordinals(_keyable(name, src).select(*[_q(c) for c in [*keys, S.ORDINAL]]), keys)
    firsts = firsts.select(*_named(keys), FIRST)
    found, count = counted_surrogate_key(firsts, key, order(), num_partitions)
    pairs = found.select(key, FIRST)
    pairs = F.broadcast(pairs) if limit.allows(TableStats(count), pairs.columns) else pairs.hint("shuffle_hash")
    rows = src.select(*[_q(c) for c in [*keys, *rest, S.ORDINAL]]).join(pairs, _q(S.ORDINAL) == F.col(FIRST))
    # The fetched rows lie where their lines do: gathered, so a small dimension is not one file a scan task.
    return rows.select(key, *_named([*keys, *rest])).repartition(key)
