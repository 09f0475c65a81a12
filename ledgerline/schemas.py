"""Column names, Spark schemas and the validation contract of the order-line source.

The source is one row per order line. Column names are kept exactly as they
appear in the header of the order-line CSV so a user can point the reader at
the same file.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's for equal results)
# ---------------------------------------------------------------------------

# Source header, in file order.
ORDER_ID = "Order ID"
ORDER_DATE = "Order Date"
SHIP_DATE = "Ship Date"
SHIP_MODE = "Ship Mode"
CUSTOMER_ID = "Customer ID"
CUSTOMER_NAME = "Customer Name"
SEGMENT = "Segment"
COUNTRY = "Country"
CITY = "City"
STATE = "State"
POSTAL_CODE = "Postal Code"
REGION = "Region"
PRODUCT_ID = "Product ID"
CATEGORY = "Category"
SUB_CATEGORY = "Sub-Category"
PRODUCT_NAME = "Product Name"
SALES = "Sales"
QUANTITY = "Quantity"
DISCOUNT = "Discount"
PROFIT = "Profit"

SOURCE_COLUMNS = [
    ORDER_ID, ORDER_DATE, SHIP_DATE, SHIP_MODE, CUSTOMER_ID, CUSTOMER_NAME, SEGMENT,
    COUNTRY, CITY, STATE, POSTAL_CODE, REGION, PRODUCT_ID, CATEGORY, SUB_CATEGORY,
    PRODUCT_NAME, SALES, QUANTITY, DISCOUNT, PROFIT,
]

# Allowed values of the contract.
ALLOWED_SEGMENTS = ["Consumer", "Corporate", "Home Office"]
ALLOWED_REGIONS = ["East", "West", "Central", "South"]
ALLOWED_CATEGORIES = ["Furniture", "Office Supplies", "Technology"]

# Columns whose NULLs are "critical" in the quality report.
CRITICAL_COLUMNS = [ORDER_ID, CUSTOMER_ID, PRODUCT_ID, SALES]

# Key of the duplicate-line check.
DUPLICATE_KEY = [ORDER_ID, PRODUCT_ID, CUSTOMER_ID, ORDER_DATE]

# Reconciliation tolerance for money totals, in currency units.
RECON_TOLERANCE = 1.00

# Discount buckets: labels and inclusive upper bounds, compared as decimals.
BUCKET_NONE = "No Discount"
BUCKET_LOW = "Low (1-10%)"
BUCKET_MEDIUM = "Medium (11-20%)"
BUCKET_HIGH = "High (>20%)"
BUCKET_NONE_AT = "0.00"
BUCKET_LOW_MAX = "0.10"
BUCKET_MEDIUM_MAX = "0.20"

# KPI card labels, in card order.
KPI_CARD_LABELS = [
    "Total Sales", "Total Profit", "Total Orders", "Profit Margin",
    "Avg Order Value", "Total Quantity", "Unique Customers", "Unique Products",
]

# Headers of the two display tables.
TOP_PRODUCTS_HEADERS = ["Product", "Category", "Sales", "Profit"]
TOP_CUSTOMERS_HEADERS = ["Customer", "Segment", "Orders", "Sales"]

# Reconciliation metrics, in report order.
RECON_METRICS = ["Total Sales", "Total Profit", "Total Orders", "Total Quantity"]

# Freshness card labels, in card order.
FRESHNESS_CARD_LABELS = ["Latest Order Date", "Total Records", "Dashboard Refreshed"]

# Name prefix of the published views; number of rows in the top-k views.
VIEW_PREFIX = "vw_"
TOP_K = 10

# Column length limits of the star schema (VARCHAR(n)).
LENGTH_LIMITS = {
    "dim_customer": {"customer_id": 20, "customer_name": 100, "segment": 50},
    "dim_product": {"product_id": 20, "product_name": 255, "category": 50, "sub_category": 50},
    "dim_location": {"postal_code": 20, "city": 100, "state": 100, "region": 50, "country": 100},
    "dim_date": {"month_name": 20, "day_name": 20},
    "fact_orders": {"order_id": 20, "ship_mode": 50},
}

# Tokens the CSV reader turns into NULL (pandas' default NA strings).
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# ---------------------------------------------------------------------------
# Contract: (column, expected type, required)
# ---------------------------------------------------------------------------
# "required" means NULL is a failure. Columns declared without an explicit
# nullable flag are required as well; only Postal Code may be NULL.
# Expected types are the logical types the raw text must parse to.
CONTRACT = [
    (ORDER_ID, "string", True),
    (ORDER_DATE, "date", True),
    (SHIP_DATE, "date", True),
    (CUSTOMER_ID, "string", True),
    (CUSTOMER_NAME, "string", True),
    (SEGMENT, "string", True),
    (CITY, "string", True),
    (STATE, "string", True),
    (POSTAL_CODE, None, False),
    (REGION, "string", True),
    (PRODUCT_ID, "string", True),
    (CATEGORY, "string", True),
    (SUB_CATEGORY, "string", True),
    (PRODUCT_NAME, "string", True),
    (SALES, "double", True),
    (QUANTITY, "int", True),
    (DISCOUNT, "double", True),
    (PROFIT, "double", True),
]

# ---------------------------------------------------------------------------
# Spark schemas
# ---------------------------------------------------------------------------

# Store types (star schema) and source types (as parsed; rounded at load).
MONEY = T.DecimalType(12, 2)
RATE = T.DecimalType(5, 2)
# Source numbers keep every digit that a text gives up to 28 before and 10 after the point; the store's
# narrower types are applied at the fact, where values they cannot hold are counted.
SOURCE_MONEY = T.DecimalType(38, 10)
SOURCE_RATE = T.DecimalType(38, 10)
# Sums of money in the marts, whatever plan computed them.
MONEY_SUM = T.DecimalType(32, 2)

# Typed source (after parsing). Money stays decimal from here on.
SOURCE_SCHEMA = T.StructType([
    T.StructField(ORDER_ID, T.StringType()),
    T.StructField(ORDER_DATE, T.DateType()),
    T.StructField(SHIP_DATE, T.DateType()),
    T.StructField(SHIP_MODE, T.StringType()),
    T.StructField(CUSTOMER_ID, T.StringType()),
    T.StructField(CUSTOMER_NAME, T.StringType()),
    T.StructField(SEGMENT, T.StringType()),
    T.StructField(COUNTRY, T.StringType()),
    T.StructField(CITY, T.StringType()),
    T.StructField(STATE, T.StringType()),
    T.StructField(POSTAL_CODE, T.StringType()),
    T.StructField(REGION, T.StringType()),
    T.StructField(PRODUCT_ID, T.StringType()),
    T.StructField(CATEGORY, T.StringType()),
    T.StructField(SUB_CATEGORY, T.StringType()),
    T.StructField(PRODUCT_NAME, T.StringType()),
    T.StructField(SALES, SOURCE_MONEY),
    T.StructField(QUANTITY, T.IntegerType()),
    T.StructField(DISCOUNT, SOURCE_RATE),
    T.StructField(PROFIT, SOURCE_MONEY),
])

# Name of the ordinal column that carries "file order" for keep-first rules.
ORDINAL = "_line_ordinal"

DIM_CUSTOMER = T.StructType([
    T.StructField("customer_key", T.LongType(), False),
    T.StructField("customer_id", T.StringType(), False),
    T.StructField("customer_name", T.StringType()),
    T.StructField("segment", T.StringType()),
])

DIM_PRODUCT = T.StructType([
    T.StructField("product_key", T.LongType(), False),
    T.StructField("product_id", T.StringType(), False),
    T.StructField("product_name", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("sub_category", T.StringType()),
])

DIM_LOCATION = T.StructType([
    T.StructField("location_key", T.LongType(), False),
    T.StructField("postal_code", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("state", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("country", T.StringType()),
])

DIM_DATE = T.StructType([
    T.StructField("date_key", T.LongType(), False),
    T.StructField("full_date", T.DateType(), False),
    T.StructField("year", T.IntegerType()),
    T.StructField("quarter", T.IntegerType()),
    T.StructField("month", T.IntegerType()),
    T.StructField("month_name", T.StringType()),
    T.StructField("week", T.IntegerType()),
    T.StructField("day_of_week", T.IntegerType()),
    T.StructField("day_name", T.StringType()),
    T.StructField("is_weekend", T.BooleanType()),
])

FACT_ORDERS = T.StructType([
    T.StructField("order_key", T.LongType(), False),
    T.StructField("order_id", T.StringType(), False),
    T.StructField("order_date_key", T.LongType()),
    T.StructField("ship_date_key", T.LongType()),
    T.StructField("customer_key", T.LongType()),
    T.StructField("product_key", T.LongType()),
    T.StructField("location_key", T.LongType()),
    T.StructField("sales", MONEY),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("discount", RATE),
    T.StructField("profit", MONEY),
    T.StructField("ship_mode", T.StringType()),
])

STAR_TABLES = ["dim_customer", "dim_product", "dim_location", "dim_date", "fact_orders"]
