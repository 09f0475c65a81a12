"""DuckDB SQL equal to each registered query, written over the flat test tables.

The oracle never goes through the star: it rebuilds the order-line source from
the tables in one CTE and aggregates it directly, so it checks the whole
Spark pipeline (adapter, keys, lookups, marts) independently. Surrogate keys
are ``row_number()`` over the natural key, the numbering the Spark build
promises.

Rounding is done in exact integer form (DuckDB's decimal division yields
DOUBLE): ``round_half_away(factor * n / d, digits)`` with n, d scaled to
integers.
"""

from __future__ import annotations

from . import schemas as S

SRC = """
src AS (
  SELECT
    CAST(l.l_orderkey AS VARCHAR) AS order_id,
    CAST(o.o_orderdate AS DATE) AS order_date,
    CAST(l.l_shipdate AS DATE) AS ship_date,
    o.o_orderpriority AS ship_mode,
    CAST(c.c_custkey AS VARCHAR) AS customer_id,
    c.c_name AS customer_name,
    c.c_mktsegment AS segment,
    n.n_name AS country,
    CASE WHEN n.n_nationkey % 12 <> 7 THEN n.n_name END AS city,
    n.n_name AS state,
    CASE WHEN n.n_nationkey % 8 = 0 THEN NULL ELSE CAST(n.n_nationkey AS VARCHAR) END AS postal_code,
    r.r_name AS region,
    CAST(p.p_partkey AS VARCHAR) AS product_id,
    p.p_type AS category,
    p.p_brand AS sub_category,
    p.p_name AS product_name,
    CAST(ROUND(CAST(l.l_extendedprice AS DECIMAL(12,2))
      * (1 - CAST(CAST(l.l_discount AS DECIMAL(5,2)) * 3 AS DECIMAL(5,2))), 2) AS DECIMAL(12,2)) AS sales,
    CAST(l.l_quantity AS INTEGER) AS quantity,
    CAST(CAST(l.l_discount AS DECIMAL(5,2)) * 3 AS DECIMAL(5,2)) AS discount,
    CAST(ROUND(CAST(l.l_extendedprice AS DECIMAL(12,2))
      * (0.22 - CAST(CAST(l.l_discount AS DECIMAL(5,2)) * 3 AS DECIMAL(5,2))), 2) AS DECIMAL(12,2)) AS profit,
    l.l_orderkey AS o1, l.l_partkey AS o2, l.l_suppkey AS o3, l.l_linenumber AS o4, l.l_quantity AS o5,
    l.l_extendedprice AS o6, l.l_discount AS o7, l.l_tax AS o8, l.l_returnflag AS o9,
    l.l_linestatus AS o10, l.l_shipdate AS o11
  FROM lineitem l
  LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
  LEFT JOIN part p ON l.l_partkey = p.p_partkey
)"""

ORDINAL = "o1, o2, o3, o4, o5, o6, o7, o8, o9, o10, o11"


def ratio(num: str, den: str, digits: int = 2, factor: int = 1, scale: int = 2) -> str:
    """SQL for round_half_away(factor * num / den, digits) as DOUBLE; NULL when den is 0."""
    n = f"CAST(({num}) * {10 ** scale} AS HUGEINT)"
    d = f"CAST(NULLIF({den}, 0) * {10 ** scale} AS HUGEINT)"
    mult = factor * 10 ** digits
    return (f"(sign({n}) * sign({d}) * ((2 * {mult} * abs({n}) + abs({d})) // (2 * abs({d})))"
            f" / {10 ** digits}.0)")


def margin(p: str = "SUM(profit)", s: str = "SUM(sales)") -> str:
    return ratio(p, s, digits=2, factor=100)


def money(expr: str) -> str:
    return f"CAST({expr} AS DOUBLE)"


def with_src(body: str, *ctes: str) -> str:
    extra = "".join(f",\n{c}" for c in ctes)
    return f"WITH {SRC}{extra}\n{body}"


SQL: dict[str, str] = {}

SQL["sales_by_category"] = with_src(f"""
SELECT category, sub_category,
       COUNT(*) AS total_orders,
       {money('SUM(sales)')} AS total_sales,
       {money('SUM(profit)')} AS total_profit,
       CAST(SUM(quantity) AS BIGINT) AS total_quantity,
       {margin()} AS profit_margin_pct
FROM src WHERE product_id IS NOT NULL
GROUP BY category, sub_category""")


# ---------------------------------------------------------------------------
# Dimensions and fact (keys = row_number over the natural key)
# ---------------------------------------------------------------------------

def _first(cols: str, part: str, where: str = "TRUE") -> str:
    return (f"SELECT {cols} FROM (SELECT {cols}, row_number() OVER (PARTITION BY {part} ORDER BY {ORDINAL}) AS rn "
            f"FROM src WHERE {where}) WHERE rn = 1")


DIM_CTES = [
    "dc AS (SELECT row_number() OVER (ORDER BY customer_id) AS customer_key, customer_id, customer_name, segment "
    f"FROM ({_first('customer_id, customer_name, segment', 'customer_id', 'customer_id IS NOT NULL')}))",
    "dp AS (SELECT row_number() OVER (ORDER BY product_id) AS product_key, product_id, product_name, category, "
    f"sub_category FROM ({_first('product_id, product_name, category, sub_category', 'product_id', 'product_id IS NOT NULL')}))",
    "dl AS (SELECT row_number() OVER (ORDER BY postal_code ASC NULLS FIRST, city ASC NULLS FIRST) AS location_key, "
    f"postal_code, city, state, region, country FROM ({_first('postal_code, city, state, region, country', 'postal_code, city')}))",
    """dd AS (SELECT row_number() OVER (ORDER BY full_date) AS date_key, full_date,
       CAST(year(full_date) AS INTEGER) AS year, CAST(quarter(full_date) AS INTEGER) AS quarter,
       CAST(month(full_date) AS INTEGER) AS month, monthname(full_date) AS month_name,
       CAST(weekofyear(full_date) AS INTEGER) AS week, CAST(isodow(full_date) - 1 AS INTEGER) AS day_of_week,
       dayname(full_date) AS day_name, isodow(full_date) IN (6, 7) AS is_weekend
     FROM (SELECT DISTINCT d AS full_date FROM (SELECT order_date AS d FROM src UNION ALL SELECT ship_date FROM src)
           WHERE d IS NOT NULL))""",
]

SQL["dim_customer"] = with_src("SELECT * FROM dc", *DIM_CTES)
SQL["dim_product"] = with_src("SELECT * FROM dp", *DIM_CTES)
SQL["dim_location"] = with_src("SELECT * FROM dl", *DIM_CTES)
SQL["dim_date"] = with_src("SELECT * FROM dd", *DIM_CTES)
SQL["dim_counts"] = with_src("""
SELECT 'dim_customer' AS table_name, COUNT(*) AS row_count FROM dc
UNION ALL SELECT 'dim_product', COUNT(*) FROM dp
UNION ALL SELECT 'dim_location', COUNT(*) FROM dl
UNION ALL SELECT 'dim_date', COUNT(*) FROM dd""", *DIM_CTES)
SQL["fact_orders"] = with_src("""
SELECT s.order_id, d1.date_key AS order_date_key, d2.date_key AS ship_date_key, dc.customer_key,
       dp.product_key, dl.location_key, CAST(s.sales AS DOUBLE) AS sales, s.quantity,
       CAST(s.discount AS DOUBLE) AS discount, CAST(s.profit AS DOUBLE) AS profit, s.ship_mode
FROM src s
LEFT JOIN dc ON s.customer_id = dc.customer_id
LEFT JOIN dp ON s.product_id = dp.product_id
LEFT JOIN dl ON s.postal_code IS NOT DISTINCT FROM dl.postal_code AND s.city IS NOT DISTINCT FROM dl.city
LEFT JOIN dd d1 ON s.order_date = d1.full_date
LEFT JOIN dd d2 ON s.ship_date = d2.full_date""", *DIM_CTES)

SOURCE_AS_HEADER = """order_id AS "Order ID", order_date AS "Order Date", ship_date AS "Ship Date",
  ship_mode AS "Ship Mode", customer_id AS "Customer ID", customer_name AS "Customer Name", segment AS "Segment",
  country AS "Country", city AS "City", state AS "State", postal_code AS "Postal Code", region AS "Region",
  product_id AS "Product ID", category AS "Category", sub_category AS "Sub-Category",
  product_name AS "Product Name", CAST(sales AS DOUBLE) AS "Sales", quantity AS "Quantity",
  CAST(discount AS DOUBLE) AS "Discount", CAST(profit AS DOUBLE) AS "Profit\""""

SQL["dedup_keep_first"] = with_src(f"""
SELECT {SOURCE_AS_HEADER} FROM (
  SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY {ORDINAL}) AS rn FROM src) WHERE rn = 1""")
SQL["dedup_line_items"] = with_src(f"""
SELECT {SOURCE_AS_HEADER} FROM (
  SELECT *, row_number() OVER (PARTITION BY order_id, product_id, customer_id, order_date ORDER BY {ORDINAL}) AS rn
  FROM src) WHERE rn = 1""")

# ---------------------------------------------------------------------------
# Views
# ---------------------------------------------------------------------------

SQL["daily_sales"] = with_src(f"""
SELECT order_date AS full_date, CAST(year(order_date) AS INTEGER) AS year,
       CAST(month(order_date) AS INTEGER) AS month, monthname(order_date) AS month_name,
       dayname(order_date) AS day_name, isodow(order_date) IN (6, 7) AS is_weekend,
       COUNT(*) AS total_orders, {money('SUM(sales)')} AS total_sales, {money('SUM(profit)')} AS total_profit,
       CAST(SUM(quantity) AS BIGINT) AS total_quantity,
       {ratio('SUM(discount)', 'COUNT(discount)')} AS avg_discount
FROM src WHERE order_date IS NOT NULL
GROUP BY order_date""")

SQL["sales_by_region"] = with_src(f"""
SELECT region, COUNT(*) AS total_orders, {money('SUM(sales)')} AS total_sales,
       {money('SUM(profit)')} AS total_profit, {margin()} AS profit_margin_pct
FROM src GROUP BY region""")

SQL["sales_by_segment"] = with_src(f"""
SELECT segment, COUNT(DISTINCT customer_id) AS total_customers, COUNT(*) AS total_orders,
       {money('SUM(sales)')} AS total_sales, {money('SUM(profit)')} AS total_profit,
       {ratio('SUM(sales)', 'COUNT(DISTINCT customer_id)')} AS avg_sales_per_customer
FROM src WHERE customer_id IS NOT NULL GROUP BY segment""")

MONTHLY = """
SELECT CAST(year(order_date) AS INTEGER) AS year, CAST(month(order_date) AS INTEGER) AS month,
       monthname(order_date) AS month_name, COUNT(*) AS total_orders, SUM(sales) AS s, SUM(profit) AS p,
       COUNT(DISTINCT customer_id) AS unique_customers
FROM src WHERE order_date IS NOT NULL GROUP BY 1, 2, 3"""

SQL["monthly_trend"] = with_src(f"""
SELECT year, month, month_name, total_orders, {money('s')} AS total_sales, {money('p')} AS total_profit,
       unique_customers FROM m""", f"m AS ({MONTHLY})")

SQL["monthly_period"] = with_src(f"""
SELECT year, month, month_name, total_orders, {money('s')} AS total_sales, {money('p')} AS total_profit,
       unique_customers, CAST(year AS VARCHAR) || '-' || lpad(CAST(month AS VARCHAR), 2, '0') AS period
FROM m""", f"m AS ({MONTHLY})")

TOP_PRODUCTS = f"""
SELECT product_name, category, sub_category, {money('SUM(sales)')} AS total_sales,
       {money('SUM(profit)')} AS total_profit, CAST(SUM(quantity) AS BIGINT) AS total_quantity
FROM src WHERE product_id IS NOT NULL GROUP BY product_name, category, sub_category
ORDER BY SUM(sales) DESC NULLS FIRST, product_name ASC NULLS FIRST, category ASC NULLS FIRST,
         sub_category ASC NULLS FIRST
LIMIT 10"""

TOP_CUSTOMERS = f"""
SELECT customer_name, segment, COUNT(*) AS total_orders, {money('SUM(sales)')} AS total_sales,
       {money('SUM(profit)')} AS total_profit
FROM src WHERE customer_id IS NOT NULL GROUP BY customer_name, segment
ORDER BY SUM(sales) DESC NULLS FIRST, customer_name ASC NULLS FIRST, segment ASC NULLS FIRST
LIMIT 10"""

SQL["top_products"] = with_src(TOP_PRODUCTS)
SQL["top_customers"] = with_src(TOP_CUSTOMERS)

KPIS = f"""
SELECT COUNT(*) AS total_orders, {money('SUM(sales)')} AS total_sales, {money('SUM(profit)')} AS total_profit,
       CAST(SUM(quantity) AS BIGINT) AS total_quantity, {ratio('SUM(sales)', 'COUNT(sales)')} AS avg_order_value,
       {margin()} AS profit_margin_pct, COUNT(DISTINCT customer_id) AS unique_customers,
       COUNT(DISTINCT product_id) AS unique_products
FROM src"""

SQL["overall_kpis"] = with_src(KPIS)

SQL["discount_impact"] = with_src(f"""
SELECT CASE WHEN discount = {S.BUCKET_NONE_AT} THEN '{S.BUCKET_NONE}'
            WHEN discount <= {S.BUCKET_LOW_MAX} THEN '{S.BUCKET_LOW}'
            WHEN discount <= {S.BUCKET_MEDIUM_MAX} THEN '{S.BUCKET_MEDIUM}' ELSE '{S.BUCKET_HIGH}' END AS discount_bucket,
       COUNT(*) AS total_orders, {money('SUM(sales)')} AS total_sales, {money('SUM(profit)')} AS total_profit,
       {ratio('SUM(profit)', 'COUNT(profit)')} AS avg_profit_per_order, {margin()} AS profit_margin_pct
FROM src GROUP BY 1 ORDER BY 1""")

# ---------------------------------------------------------------------------
# Dashboard datasets
# ---------------------------------------------------------------------------

SQL["freshness"] = with_src("""
SELECT MAX(order_date) AS latest_order_date, COUNT(*) AS total_records FROM src WHERE order_date IS NOT NULL""")

AS_OF = "2024-01-02 03:04:05"
SQL["freshness_cards"] = with_src(f"""
SELECT 1 AS position, 'Latest Order Date' AS label, strftime(d, '%Y-%m-%d') AS value FROM f
UNION ALL SELECT 2, 'Total Records', format('{{:,}}', n) FROM f
UNION ALL SELECT 3, 'Dashboard Refreshed', strftime(TIMESTAMP '{AS_OF}', '%Y-%m-%d %H:%M')""",
    "f AS (SELECT MAX(order_date) AS d, COUNT(*) AS n FROM src WHERE order_date IS NOT NULL)")

SQL["category_totals"] = with_src(f"""
SELECT category, {money('SUM(sales)')} AS total_sales FROM src
WHERE product_id IS NOT NULL AND category IS NOT NULL GROUP BY category""")

SQL["region_share"] = with_src(f"""
SELECT region, {money('s')} AS total_sales, {ratio('s', 'SUM(s) OVER ()', 2, 100)} AS share_pct
FROM (SELECT region, SUM(sales) AS s FROM src GROUP BY region)""")

_LEAF_K = "(sign(pc) * sign(sc) * ((2 * 10000 * abs(pc) + abs(sc)) // (2 * abs(sc))))"
SQL["category_tree"] = with_src(f"""
SELECT category, sub_category, {money('s')} AS total_sales, k / 100.0 AS margin_pct, 2 AS level FROM leafk
UNION ALL
SELECT category, NULL, {money('SUM(s)')}, {ratio('SUM(k * sc)', 'SUM(sc) * 100', 2, 1, 0)}, 1
FROM leafk GROUP BY category""",
    "leaf AS (SELECT category, sub_category, SUM(sales) AS s, CAST(SUM(sales) * 100 AS HUGEINT) AS sc, "
    "CAST(SUM(profit) * 100 AS HUGEINT) AS pc FROM src WHERE product_id IS NOT NULL GROUP BY category, sub_category)",
    f"leafk AS (SELECT *, CASE WHEN sc = 0 THEN NULL ELSE {_LEAF_K} END AS k FROM leaf)")

SQL["kpi_cards"] = with_src("""
SELECT 1 AS position, 'Total Sales' AS label, '$' || format('{:,.0f}', total_sales) AS value FROM k
UNION ALL SELECT 2, 'Total Profit', '$' || format('{:,.0f}', total_profit) FROM k
UNION ALL SELECT 3, 'Total Orders', format('{:,}', total_orders) FROM k
UNION ALL SELECT 4, 'Profit Margin', printf('%.2f', profit_margin_pct) || '%' FROM k
UNION ALL SELECT 5, 'Avg Order Value', '$' || format('{:,.2f}', avg_order_value) FROM k
UNION ALL SELECT 6, 'Total Quantity', format('{:,}', total_quantity) FROM k
UNION ALL SELECT 7, 'Unique Customers', format('{:,}', unique_customers) FROM k
UNION ALL SELECT 8, 'Unique Products', format('{:,}', unique_products) FROM k""", f"k AS ({KPIS})")

SQL["top_products_display"] = with_src("""
SELECT product_name AS "Product", category AS "Category", '$' || format('{:,.0f}', total_sales) AS "Sales",
       '$' || format('{:,.0f}', total_profit) AS "Profit" FROM t""", f"t AS ({TOP_PRODUCTS})")

SQL["top_customers_display"] = with_src("""
SELECT customer_name AS "Customer", segment AS "Segment", total_orders AS "Orders",
       '$' || format('{:,.0f}', total_sales) AS "Sales" FROM t""", f"t AS ({TOP_CUSTOMERS})")

# ---------------------------------------------------------------------------
# Advertised analyses
# ---------------------------------------------------------------------------

SQL["month_over_month"] = with_src(f"""
SELECT year, month, {money('s')} AS total_sales, {money('p')} AS total_profit,
       {money('ps')} AS prev_sales, {money('pp')} AS prev_profit,
       {ratio('s - ps', 'abs(ps)', 2, 100)} AS sales_change_pct,
       {ratio('p - pp', 'abs(pp)', 2, 100)} AS profit_change_pct
FROM (SELECT *, LAG(s) OVER (ORDER BY year, month) AS ps, LAG(p) OVER (ORDER BY year, month) AS pp FROM m)""",
    f"m AS ({MONTHLY})")

SQL["high_revenue_low_margin"] = with_src(f"""
SELECT product_id, product_name, category, sub_category, {money('s')} AS total_sales, {money('p')} AS total_profit,
       {margin('p', 's')} AS profit_margin_pct
FROM per, tot
WHERE CAST(s * 100 AS HUGEINT) * n >= CAST(ts * 100 AS HUGEINT) AND s > 0 AND ts > 0
  AND CAST(p * 100 AS HUGEINT) * CAST(ts * 100 AS HUGEINT) < CAST(tp * 100 AS HUGEINT) * CAST(s * 100 AS HUGEINT)""",
    "per AS (SELECT product_id, product_name, category, sub_category, SUM(sales) AS s, SUM(profit) AS p "
    "FROM src WHERE product_id IS NOT NULL GROUP BY 1, 2, 3, 4)",
    "tot AS (SELECT COUNT(*) AS n, SUM(s) AS ts, SUM(p) AS tp FROM per)")

FILTER_REGIONS = ["AMERICA", "ASIA", "EUROPE"]
FILTER_CATEGORIES = ["ECONOMY", "PROMO", "STANDARD"]
FILTER_SEGMENTS = ["AUTOMOBILE", "BUILDING", "MACHINERY"]
FILTER_FROM, FILTER_TO = "1996-01-01", "1998-12-31"


def _in(values: list[str]) -> str:
    return ", ".join(f"'{v}'" for v in values)


SQL["filtered_kpis"] = with_src(KPIS.replace("FROM src", f"""FROM src
WHERE region IN ({_in(FILTER_REGIONS)})
  AND product_id IS NOT NULL AND category IN ({_in(FILTER_CATEGORIES)})
  AND customer_id IS NOT NULL AND segment IN ({_in(FILTER_SEGMENTS)})
  AND order_date BETWEEN DATE '{FILTER_FROM}' AND DATE '{FILTER_TO}'"""))


# ---------------------------------------------------------------------------
# Source profile and quality checks
# ---------------------------------------------------------------------------

# Allowed lists used by the registered contract queries: each leaves out one
# value that occurs in the test tables, so every isin rule has failures.
TEST_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "MACHINERY"]
TEST_REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE"]
TEST_CATEGORIES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL"]

SOURCE_COLS = [
    ("Order ID", "order_id"), ("Order Date", "order_date"), ("Ship Date", "ship_date"),
    ("Ship Mode", "ship_mode"), ("Customer ID", "customer_id"), ("Customer Name", "customer_name"),
    ("Segment", "segment"), ("Country", "country"), ("City", "city"), ("State", "state"),
    ("Postal Code", "postal_code"), ("Region", "region"), ("Product ID", "product_id"),
    ("Category", "category"), ("Sub-Category", "sub_category"), ("Product Name", "product_name"),
    ("Sales", "sales"), ("Quantity", "quantity"), ("Discount", "discount"), ("Profit", "profit"),
]
_SQL_NAME = dict(SOURCE_COLS)
REQUIRED = ["Order ID", "Order Date", "Ship Date", "Customer ID", "Customer Name", "Segment", "City", "State",
            "Region", "Product ID", "Category", "Sub-Category", "Product Name", "Sales", "Quantity", "Discount",
            "Profit"]


def _failure_union() -> str:
    parts = []
    for col in REQUIRED:
        parts.append(f"SELECT '{col}' AS column_name, 'not_nullable' AS check_name, CAST(NULL AS VARCHAR) AS "
                     f"failure_case FROM src WHERE {_SQL_NAME[col]} IS NULL")
    for col, lst in (("Segment", TEST_SEGMENTS), ("Region", TEST_REGIONS), ("Category", TEST_CATEGORIES)):
        c = _SQL_NAME[col]
        parts.append(f"SELECT '{col}', 'isin', {c} FROM src WHERE {c} IS NOT NULL AND {c} NOT IN ({_in(lst)})")
    parts.append("SELECT 'Sales', 'greater_than_or_equal_to(0)', CAST(CAST(sales AS DOUBLE) AS VARCHAR) "
                 "FROM src WHERE sales < 0")
    parts.append("SELECT 'Quantity', 'greater_than(0)', CAST(quantity AS VARCHAR) FROM src WHERE quantity <= 0")
    parts.append("SELECT 'Discount', 'in_range(0, 1)', CAST(CAST(discount AS DOUBLE) AS VARCHAR) "
                 "FROM src WHERE discount < 0 OR discount > 1")
    return "\nUNION ALL ".join(parts)


FAILURES = f"fails AS ({_failure_union()})"

SQL["src_profile"] = with_src("""
SELECT COUNT(*) AS rows, 20 AS columns, MIN(order_date) AS min_order_date, MAX(order_date) AS max_order_date,
       COUNT(DISTINCT region) AS regions, COUNT(DISTINCT category) AS categories FROM src""")

SQL["schema_failures"] = with_src("""
SELECT column_name, check_name, failure_case, COUNT(*) AS failure_count FROM fails
GROUP BY column_name, check_name, failure_case""", FAILURES)

SQL["null_counts"] = with_src("\nUNION ALL ".join(
    f"SELECT '{col}' AS column_name, COUNT(*) - COUNT({c}) AS null_count FROM src" for col, c in SOURCE_COLS))

SQL["critical_nulls"] = with_src("""
SELECT CAST((COUNT(*) - COUNT(order_id)) + (COUNT(*) - COUNT(customer_id)) + (COUNT(*) - COUNT(product_id))
       + (COUNT(*) - COUNT(sales)) AS BIGINT) AS critical_nulls FROM src""")

DUPS = """SELECT CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) AS duplicate_rows FROM (
  SELECT COUNT(*) AS n FROM src GROUP BY order_id, product_id, customer_id, order_date)"""
SQL["duplicate_rows"] = with_src(DUPS)

SQL["ship_date_violations"] = with_src("""
SELECT n AS ship_date_violations,
       CASE WHEN n = 0 THEN 'PASSED' ELSE 'FAILED (' || CAST(n AS VARCHAR) || ' violations)' END AS status
FROM (SELECT COUNT(*) FILTER (WHERE ship_date < order_date) AS n FROM src)""")

RANGES = """SELECT COUNT(*) FILTER (WHERE sales < 0) AS negative_sales,
       COUNT(*) FILTER (WHERE discount < 0 OR discount > 1) AS invalid_discount,
       COUNT(*) FILTER (WHERE quantity <= 0) AS invalid_quantity FROM src"""
SQL["range_violations"] = with_src(f"""
SELECT negative_sales, invalid_discount, invalid_quantity,
       negative_sales + invalid_discount + invalid_quantity AS range_violations FROM ({RANGES})""")

SQL["uniqueness"] = with_src("SELECT COUNT(DISTINCT order_id) AS unique_orders, COUNT(*) AS total_rows FROM src")

SQL["quality_report"] = with_src(f"""
SELECT f.n = 0 AS schema_valid, f.n AS schema_failures,
       CAST((SELECT (COUNT(*) - COUNT(order_id)) + (COUNT(*) - COUNT(customer_id)) + (COUNT(*) - COUNT(product_id))
                    + (COUNT(*) - COUNT(sales)) FROM src) AS BIGINT) AS critical_nulls,
       d.duplicate_rows,
       (SELECT COUNT(*) FILTER (WHERE ship_date < order_date) FROM src) AS ship_date_violations,
       r.negative_sales + r.invalid_discount + r.invalid_quantity AS range_violations,
       u.unique_orders, u.total_rows,
       CASE WHEN r.negative_sales + r.invalid_discount + r.invalid_quantity = 0 THEN 'PASSED'
            ELSE 'ISSUES FOUND' END AS quality_status
FROM (SELECT COUNT(*) AS n FROM fails) f, ({DUPS}) d, ({RANGES}) r,
     (SELECT COUNT(DISTINCT order_id) AS unique_orders, COUNT(*) AS total_rows FROM src) u""", FAILURES)

# ---------------------------------------------------------------------------
# Constraint audit and reconciliation
# ---------------------------------------------------------------------------

def _fact_cte() -> str:
    body = """SELECT row_number() OVER () AS order_key, s.order_id, d1.date_key AS order_date_key, d2.date_key AS ship_date_key, dc.customer_key,
       dp.product_key, dl.location_key, s.ship_mode
FROM src s
LEFT JOIN dc ON s.customer_id = dc.customer_id
LEFT JOIN dp ON s.product_id = dp.product_id
LEFT JOIN dl ON s.postal_code IS NOT DISTINCT FROM dl.postal_code AND s.city IS NOT DISTINCT FROM dl.city
LEFT JOIN dd d1 ON s.order_date = d1.full_date
LEFT JOIN dd d2 ON s.ship_date = d2.full_date"""
    return f"fo AS ({body})"


_AUDIT_TABLES = [
    ("dim_customer", "dc", ["customer_id"], {"customer_id": 20, "customer_name": 100, "segment": 50},
     ["customer_id"]),
    ("dim_product", "dp", ["product_id"], {"product_id": 20, "product_name": 255, "category": 50,
                                           "sub_category": 50}, ["product_id"]),
    ("dim_location", "dl", [], {"postal_code": 20, "city": 100, "state": 100, "region": 50, "country": 100},
     ["postal_code", "city"]),
    ("dim_date", "dd", ["full_date"], {"month_name": 20, "day_name": 20}, ["full_date"]),
    ("fact_orders", "fo", ["order_id"], {"order_id": 20, "ship_mode": 50}, None),
]
_FKS = [("order_date_key", "dd", "date_key"), ("ship_date_key", "dd", "date_key"),
        ("customer_key", "dc", "customer_key"), ("product_key", "dp", "product_key"),
        ("location_key", "dl", "location_key")]


_PRIMARY = {"dim_customer": ["customer_key"], "dim_product": ["product_key"], "dim_location": ["location_key"],
            "dim_date": ["date_key"], "fact_orders": ["order_key"]}


def _audit_sql() -> str:
    parts = []
    for table, alias, not_null, lengths, unique in _AUDIT_TABLES:
        for c in not_null:
            parts.append(f"SELECT '{table}' AS table_name, 'not_null({c})' AS constraint_name, "
                         f"COUNT(*) FILTER (WHERE {c} IS NULL) AS violations FROM {alias}")
        for c, n in lengths.items():
            parts.append(f"SELECT '{table}', 'max_length({c},{n})', COUNT(*) FILTER (WHERE length({c}) > {n}) "
                         f"FROM {alias}")
        if table == "fact_orders":
            for fk, _, _ in _FKS:
                parts.append(f"SELECT '{table}', 'unmatched({fk})', COUNT(*) FILTER (WHERE {fk} IS NULL) FROM fo")
        for rule, keys in (("unique", unique), ("primary_key", _PRIMARY[table])):
            if keys:
                parts.append(f"SELECT '{table}', '{rule}({','.join(keys)})', COALESCE(SUM(n - 1), 0) FROM "
                             f"(SELECT COUNT(*) AS n FROM {alias} GROUP BY {', '.join(keys)})")
    for c, store in (("sales", "12,2"), ("profit", "12,2"), ("discount", "5,2")):
        parts.append(f"SELECT 'fact_orders', 'numeric_range({c})', COUNT(*) FILTER (WHERE {c} IS NOT NULL AND "
                     f"TRY_CAST({c} AS DECIMAL({store})) IS NULL) FROM src")
    for fk, dim, key in _FKS:
        parts.append(f"SELECT 'fact_orders', 'references({fk})', COUNT(*) FROM fo WHERE {fk} IS NOT NULL "
                     f"AND {fk} NOT IN (SELECT {key} FROM {dim})")
    parts.append("SELECT 'dim_location', 'conflict(postal_code,city)', COUNT(*) FILTER (WHERE v > 1) FROM "
                 "(SELECT COUNT(DISTINCT struct_pack(s := state, r := region, c := country)) AS v FROM src "
                 "GROUP BY postal_code, city)")
    return "SELECT table_name, constraint_name, CAST(violations AS BIGINT) AS violations FROM (\n" + \
        "\nUNION ALL ".join(parts) + ")"


SQL["csv_profile"] = SQL["src_profile"]
SQL["csv_line_breaks"] = with_src(f"""
SELECT product_name, COUNT(*) AS order_lines, CAST(SUM(quantity) AS BIGINT) AS total_quantity,
       {money('SUM(sales)')} AS total_sales
FROM src WHERE product_name LIKE '% %' GROUP BY product_name""")
SQL["csv_quality_report"] = SQL["quality_report"]
SQL["constraint_audit"] = with_src(_audit_sql(), *DIM_CTES, _fact_cte())

SQL["reconciliation"] = with_src("""
SELECT position, metric, CAST(sv AS DOUBLE) AS source_value, CAST(tv AS DOUBLE) AS store_value, CAST(0 AS BIGINT) AS parse_loss, matched,
       bool_and(matched) OVER () AS all_passed
FROM (
  SELECT 1 AS position, 'Total Sales' AS metric, s.a AS sv, t.a AS tv, abs(s.a - t.a) < 1.00 AS matched FROM s, t
  UNION ALL SELECT 2, 'Total Profit', s.b, t.b, abs(s.b - t.b) < 1.00 FROM s, t
  UNION ALL SELECT 3, 'Total Orders', s.c, t.c, s.c = t.c FROM s, t
  UNION ALL SELECT 4, 'Total Quantity', s.d, t.d, s.d = t.d FROM s, t)""",
    "s AS (SELECT COALESCE(SUM(sales), 0) AS a, COALESCE(SUM(profit), 0) AS b, COUNT(*) AS c, "
    "COALESCE(SUM(quantity), 0) AS d FROM src)",
    "t AS (SELECT SUM(sales) AS a, SUM(profit) AS b, COUNT(*) AS c, SUM(quantity) AS d FROM src)")

SQL["etl_summary"] = f"""
SELECT q.total_rows AS records_processed, q.quality_status,
       CASE WHEN (SELECT bool_and(matched) FROM ({SQL["reconciliation"]})) THEN 'PASSED' ELSE 'FAILED' END
         AS reconciliation_status
FROM ({SQL["quality_report"]}) q"""


# ---------------------------------------------------------------------------
# The bundle of the nine views
# ---------------------------------------------------------------------------

_BUNDLE = ["daily_sales", "sales_by_region", "sales_by_category", "sales_by_segment", "monthly_trend", "top_products",
           "top_customers", "overall_kpis", "discount_impact"]
SQL["mart_bundle"] = " UNION ALL ".join(
    f"SELECT '{name}' AS view_name, COUNT(*) AS row_count, "
    f"CAST(SUM(CAST(total_sales AS DECIMAL(28,2))) AS DOUBLE) AS total_sales FROM ({SQL[name]})" for name in _BUNDLE)
