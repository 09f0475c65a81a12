"""Order-line source built from the TPC-H-style tables.

The test tables hold the same facts as the order-line CSV, spread over a
normalised schema. This module joins them back into one row per line, in the
source's column names and types:

==================  =========================================================
Order ID            l_orderkey as text
Order / Ship Date   o_orderdate / l_shipdate as DATE
Ship Mode           o_orderpriority
Customer ...        c_custkey as text, c_name, c_mktsegment
Country/State       n_name
City                n_name, NULL where n_nationkey % 12 = 7
Postal Code         n_nationkey as text, NULL where n_nationkey % 8 = 0
Region              r_name
Product ...         p_partkey as text, p_name, p_type (category), p_brand
Quantity            l_quantity as INT
Discount            l_discount as DECIMAL(5,2) times 3
Sales / Profit      price * (1 - discount) / price * (0.22 - discount), 2 digits
==================  =========================================================

"File order" for keep-first rules is the order of the full line record: the lines are sorted by it
and numbered before they are joined, so every later step carries one number a row. A reader that needs no
file order asks for the rows without it (``ordinal=False``), and no line is sorted.

Join order is chosen for scale: orders are enriched with customer, nation and
region first (orders are a quarter of lineitem), then the lines join the
enriched orders on the order key, then the part. Customers and parts are counted and measured, and
broadcast while both fit the session's broadcast limit, so the joined rows, many times as wide as a line, are
not shuffled and sorted once more for the parts. The other sides are hashed where they meet the lines:
no line is sorted for a join.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..config import broadcast_limit, input_bytes, ranges, slices_for, whole_partitions
from ..operators.lookup import stats_from_metrics, stats_metrics

# Fixed values of the adapter mapping.
DISCOUNT_FACTOR = 3
PROFIT_RATE = Decimal("0.22")
POSTAL_NULL_MODULUS = 8
CITY_NULL_MODULUS, CITY_NULL_REST = 12, 7

LINEITEM_COLUMNS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _sides(spark: SparkSession, **sides: DataFrame) -> dict[str, DataFrame]:
    """Join sides with their strategy: those whose measured sizes fit the broadcast limit together are
    broadcast, the others hashed on the shuffle's reading side."""
    measured = {name: (stats_from_metrics(df.agg(*stats_metrics(df)).first().asDict()), df.columns) for name, df in sides.items()}
    small = broadcast_limit(spark).admit(measured)
    return {name: F.broadcast(df) if name in small else df.hint("shuffle_hash") for name, df in sides.items()}


def read_tables_source(spark: SparkSession, sf_dir: str, ordinal: bool = True) -> DataFrame:
    """One row per line item, in the order-line source shape, plus the ordinal (if ``ordinal``)."""
    return _read(spark, sf_dir, ordinal, 1)[0]


def read_tables_slices(spark: SparkSession, sf_dir: str, ordinal: bool = True) -> list[DataFrame]:
    """The rows of ``read_tables_source``, in as many ranges of the order key as their input needs (one if it is small).

    Who writes the slices one after the other needs the disk of one slice's shuffles. The order key leads the record, so
    the ordinals grow from slice to slice: they are those of one table.
    """
    return _read(spark, sf_dir, ordinal, slices_for(spark, sum(input_bytes(_table(spark, sf_dir, t)) for t in ("lineitem", "orders"))))


def _read(spark: SparkSession, sf_dir: str, ordinal: bool, slices: int) -> list[DataFrame]:
    lines = _table(spark, sf_dir, "lineitem").select(*LINEITEM_COLUMNS)
    orders = _table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    customer = _table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    nation = _table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = _table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    part = _table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type")

    sides = _sides(spark, customer=customer, part=part)
    customer, part = sides["customer"], sides["part"]
    geo = nation.join(region, nation.n_regionkey == region.r_regionkey, "left")
    if slices == 1:
        return [_joined(_numbered(lines, whole_partitions(lines)) if ordinal else lines, orders, customer, geo, part, ordinal)]
    n, out = max(spark.sparkContext.defaultParallelism, -(-whole_partitions(lines) // slices)), []
    for i, within in enumerate(ranges(lines, "l_orderkey", slices)):
        some = lines.where(within(F.col("l_orderkey")))
        some = _numbered(some, n, i * n) if ordinal else some
        out.append(_joined(some, orders.where(within(F.col("o_orderkey"))), customer, geo, part, ordinal))
    return out


def _numbered(lines: DataFrame, partitions: int, first: int = 0) -> DataFrame:
    """``lines`` range-partitioned and sorted, so the generated ids grow with the record (equal records are
    interchangeable); ``first`` counts the partitions of the lines before them."""
    return (lines.repartitionByRange(partitions, *LINEITEM_COLUMNS).sortWithinPartitions(*LINEITEM_COLUMNS)
            .select("*", (F.monotonically_increasing_id() + F.lit(first << 33)).alias(S.ORDINAL)))


def _joined(lines: DataFrame, orders: DataFrame, customer: DataFrame, geo: DataFrame, part: DataFrame, ordinal: bool) -> DataFrame:
    enriched_orders = (
        orders.join(customer, orders.o_custkey == customer.c_custkey, "left")
        .join(geo, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    )
    joined = (
        lines.join(enriched_orders.hint("shuffle_hash"), lines.l_orderkey == enriched_orders.o_orderkey, "left")
        .join(part, F.col("l_partkey") == part.p_partkey, "left")
    )

    discount = (F.col("l_discount").cast(S.RATE) * DISCOUNT_FACTOR).cast(S.RATE)
    price = F.col("l_extendedprice").cast(S.MONEY)
    sales = F.round(price * (F.lit(Decimal(1)) - discount), 2).cast(S.MONEY)
    profit = F.round(price * (F.lit(PROFIT_RATE) - discount), 2).cast(S.MONEY)
    postal = F.when(F.col("n_nationkey") % POSTAL_NULL_MODULUS == 0, F.lit(None).cast("string")) \
        .otherwise(F.col("n_nationkey").cast("string"))

    city = F.when(F.col("n_nationkey") % CITY_NULL_MODULUS != CITY_NULL_REST, F.col("n_name"))

    return joined.select(
        F.col("l_orderkey").cast("string").alias(S.ORDER_ID),
        F.col("o_orderdate").cast("date").alias(S.ORDER_DATE),
        F.col("l_shipdate").cast("date").alias(S.SHIP_DATE),
        F.col("o_orderpriority").alias(S.SHIP_MODE),
        F.col("c_custkey").cast("string").alias(S.CUSTOMER_ID),
        F.col("c_name").alias(S.CUSTOMER_NAME),
        F.col("c_mktsegment").alias(S.SEGMENT),
        F.col("n_name").alias(S.COUNTRY),
        city.alias(S.CITY),
        F.col("n_name").alias(S.STATE),
        postal.alias(S.POSTAL_CODE),
        F.col("r_name").alias(S.REGION),
        F.col("p_partkey").cast("string").alias(S.PRODUCT_ID),
        F.col("p_type").alias(S.CATEGORY),
        F.col("p_brand").alias(S.SUB_CATEGORY),
        F.col("p_name").alias(S.PRODUCT_NAME),
        sales.cast(S.SOURCE_MONEY).alias(S.SALES),
        F.col("l_quantity").cast("int").alias(S.QUANTITY),
        discount.cast(S.SOURCE_RATE).alias(S.DISCOUNT),
        profit.cast(S.SOURCE_MONEY).alias(S.PROFIT),
        *([F.col(S.ORDINAL)] if ordinal else []),
    )
