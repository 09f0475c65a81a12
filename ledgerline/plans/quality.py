"""Data-quality checks on the order-line source and constraint audit of the star.

All checks are conditional aggregates. The scalar quality report is one pass, in
which a row's counters travel with its duplicate key, plus a scalar subquery
(distinct orders) -- no cross join.

The contract check lists every failure case (lazy validation): each row gets
an array of the rules it breaks, the array is exploded, and failures are
counted per (column, check, value).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..operators.dedup import duplicate_count

PARSE_ERRORS = "_parse_errors"   # map<column, raw text> of values that did not parse (CSV source)
CORRUPT = "_corrupt_record"      # raw text of a line whose field count does not match the header


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def public_columns(df: DataFrame) -> list[str]:
    """Source columns as a user sees them (internal columns start with ``_``)."""
    return [c for c in df.columns if not c.startswith("_")]


@dataclass(frozen=True)
class Contract:
    """Allowed value lists of the contract (defaults: the reference's lists)."""

    segments: tuple[str, ...] = tuple(S.ALLOWED_SEGMENTS)
    regions: tuple[str, ...] = tuple(S.ALLOWED_REGIONS)
    categories: tuple[str, ...] = tuple(S.ALLOWED_CATEGORIES)


def _number_text(c: Column, dtype: str) -> Column:
    """A failing number as text: as a double for money and rates, so no padding digits."""
    return (c.cast("double") if dtype == "double" else c).cast("string")


def _rules(df: DataFrame, contract: Contract) -> list[tuple[str, str, Column, Column]]:
    """(column, check, fails, failure case) for every rule of the contract.

    Value checks skip NULLs (a NULL fails only ``not_nullable``); a value whose
    text did not parse fails only its ``dtype`` check.
    """
    has_parse = PARSE_ERRORS in df.columns
    allowed = {S.SEGMENT: contract.segments, S.REGION: contract.regions, S.CATEGORY: contract.categories}
    value_checks = {
        S.SALES: ("greater_than_or_equal_to(0)", lambda c: c < 0),
        S.QUANTITY: ("greater_than(0)", lambda c: c <= 0),
        S.DISCOUNT: ("in_range(0, 1)", lambda c: (c < 0) | (c > 1)),
    }
    rules = []
    absent = set(absent_columns(df))
    for column, dtype, required in S.CONTRACT:
        if column not in df.columns or column in absent:
            continue
        c = _q(column)
        raw_bad = F.try_element_at(F.col(PARSE_ERRORS), F.lit(column)) if has_parse else None
        if has_parse and dtype not in (None, "string"):
            rules.append((column, f"dtype('{dtype}')", raw_bad.isNotNull(), raw_bad))
        if required:
            null_fail = c.isNull() if raw_bad is None else (c.isNull() & raw_bad.isNull())
            rules.append((column, "not_nullable", null_fail, F.lit(None).cast("string")))
        if column in allowed:
            rules.append((column, "isin", c.isNotNull() & ~c.isin(list(allowed[column])), c.cast("string")))
        if column in value_checks:
            name, bad = value_checks[column]
            rules.append((column, name, c.isNotNull() & bad(c), _number_text(c, dtype)))
    if CORRUPT in df.columns:
        rules.append(("<line>", "field_count", F.col(CORRUPT).isNotNull(), F.col(CORRUPT)))
    return rules


def absent_columns(df: DataFrame, contract_only: bool = True) -> list[str]:
    """Columns the reader found missing from the file header (schema metadata).

    ``contract_only``: only columns of the contract (each is one failure case);
    otherwise every source column the reader had to fill with NULL.
    """
    if S.ORDINAL not in df.columns:
        return []
    key = "missing_columns" if contract_only else "absent_columns"
    return list(df.schema[S.ORDINAL].metadata.get(key, []))


def _absent_cases(df: DataFrame) -> DataFrame | None:
    """One failure case per absent column (bounded by the contract's size), or None."""
    absent = absent_columns(df)
    if not absent:
        return None
    return df.sparkSession.createDataFrame(
        [(c, "column_in_dataframe", c) for c in absent],
        "column_name string, check_name string, failure_case string")


def contract_failures(df: DataFrame, contract: Contract = Contract()) -> DataFrame:
    """Every failure case: one row per (line, broken rule), with the line's ordinal when present.

    A contract column missing from the file is one case of its own (no ordinal),
    not a NULL failure on every line.
    """
    cases = F.array(*[
        F.when(fails, F.struct(F.lit(col).alias("column_name"), F.lit(check).alias("check_name"),
                               case.alias("failure_case")))
        for col, check, fails, case in _rules(df, contract)
    ])
    keep = [F.col(S.ORDINAL)] if S.ORDINAL in df.columns else []
    rows = (df.select(*keep, F.filter(cases, lambda x: x.isNotNull()).alias("_cases"))
            .select(*keep, F.explode("_cases").alias("_c"))
            .select(*keep, "_c.column_name", "_c.check_name", "_c.failure_case"))
    absent = _absent_cases(df)
    return rows if absent is None else rows.unionByName(absent, allowMissingColumns=True)


def schema_failures(df: DataFrame, contract: Contract = Contract()) -> DataFrame:
    """Failure cases counted per (column, check, value)."""
    return (contract_failures(df, contract).groupBy("column_name", "check_name", "failure_case")
            .agg(F.count(F.lit(1)).alias("failure_count")))


def _failure_total(df: DataFrame, contract: Contract) -> Column:
    """Number of rules a row breaks (0..n), as an int expression."""
    total = F.lit(0)
    for _, _, fails, _ in _rules(df, contract):
        total = total + F.when(fails, 1).otherwise(0)
    return total


def missing(df: DataFrame, column: str) -> Column:
    """The value is absent in the source (a value that failed to parse is present, just invalid)."""
    c = _q(column).isNull()
    if PARSE_ERRORS in df.columns:
        c = c & F.try_element_at(F.col(PARSE_ERRORS), F.lit(column)).isNull()
    return c


def null_counts(df: DataFrame) -> DataFrame:
    """NULLs per column present in the source, one row per column (a single aggregate, unpivoted)."""
    absent = set(absent_columns(df, contract_only=False))
    cols = [c for c in public_columns(df) if c not in absent]
    wide = df.agg(*[F.count_if(missing(df, c)).alias(c) for c in cols])
    return wide.unpivot([], [_q(c) for c in cols], "column_name", "null_count")


def critical_nulls(df: DataFrame) -> DataFrame:
    return df.agg(sum(F.count_if(missing(df, c)) for c in S.CRITICAL_COLUMNS).cast("long").alias("critical_nulls"))


def duplicate_rows(df: DataFrame, sums: dict[str, Column] | None = None) -> DataFrame:
    """Lines repeating an earlier line's (Order ID, Product ID, Customer ID, Order Date); the totals of ``sums`` beside."""
    return duplicate_count(df, S.DUPLICATE_KEY, sums)


def _ship_violation(df: DataFrame) -> Column:
    return _q(S.SHIP_DATE) < _q(S.ORDER_DATE)


def ship_status(n: Column) -> Column:
    return F.when(n == 0, F.lit("PASSED")).otherwise(F.concat(F.lit("FAILED ("), n.cast("string"),
                                                              F.lit(" violations)")))


def ship_date_violations(df: DataFrame) -> DataFrame:
    n = F.count_if(_ship_violation(df))
    return df.agg(n.alias("ship_date_violations")).select(
        "ship_date_violations", ship_status(F.col("ship_date_violations")).alias("status"))


def _range_counters(df: DataFrame) -> dict[str, Column]:
    return {
        "negative_sales": _q(S.SALES) < 0,
        "invalid_discount": (_q(S.DISCOUNT) < 0) | (_q(S.DISCOUNT) > 1),
        "invalid_quantity": _q(S.QUANTITY) <= 0,
    }


STORE_TYPES = {"sales": (S.SALES, S.MONEY), "profit": (S.PROFIT, S.MONEY), "discount": (S.DISCOUNT, S.RATE)}


def _overflows(column: str, store) -> Column:
    return _q(column).isNotNull() & _q(column).try_cast(store).isNull()


def store_overflow(df: DataFrame) -> DataFrame:
    """Per stored number: source values that the store's type cannot hold (one row)."""
    return df.agg(*[F.count_if(_overflows(c, t)).alias(name) for name, (c, t) in STORE_TYPES.items()])


def range_violations(df: DataFrame) -> DataFrame:
    counters = _range_counters(df)
    out = df.agg(*[F.count_if(v).alias(k) for k, v in counters.items()])
    return out.select("*", sum(F.col(k) for k in counters).alias("range_violations"))


def uniqueness(df: DataFrame) -> DataFrame:
    return df.agg(F.count_distinct(_q(S.ORDER_ID)).alias("unique_orders"),
                  F.count(F.lit(1)).alias("total_rows"))


def quality_report(df: DataFrame, contract: Contract = Contract()) -> DataFrame:
    """The seven-field quality report plus the failure-case count and the run status.

    The counters and the duplicate count are one pass, which shuffles the four
    key columns and five small numbers a row; the distinct orders (partially
    aggregated order ids) are an uncorrelated scalar subquery, which Spark runs
    concurrently and uses as a value.
    """
    flag = lambda fails: F.when(fails, 1).otherwise(0)
    counters = duplicate_rows(df, {
        "schema_failures": _failure_total(df, contract),
        "critical_nulls": sum(flag(missing(df, c)) for c in S.CRITICAL_COLUMNS),
        "ship_date_violations": flag(_ship_violation(df)),
        "range_violations": sum(flag(v) for v in _range_counters(df).values()),
        "total_rows": F.lit(1),
    })
    failures = F.col("schema_failures") + F.lit(len(absent_columns(df)))
    orders = df.agg(F.count_distinct(_q(S.ORDER_ID))).scalar()
    return counters.select(
        (failures == 0).alias("schema_valid"),
        failures.cast("long").alias("schema_failures"), "critical_nulls",
        "duplicate_rows",
        "ship_date_violations", "range_violations",
        orders.alias("unique_orders"),
        "total_rows",
        F.when(F.col("range_violations") == 0, "PASSED").otherwise("ISSUES FOUND").alias("quality_status"),
    )


# ---------------------------------------------------------------------------
# Constraint audit of the star (NOT NULL, UNIQUE, REFERENCES, VARCHAR(n))
# ---------------------------------------------------------------------------

_UNIQUE = {
    "dim_customer": ["customer_id"],
    "dim_product": ["product_id"],
    "dim_location": ["postal_code", "city"],
    "dim_date": ["full_date"],
}
_PRIMARY = {
    "dim_customer": ["customer_key"],
    "dim_product": ["product_key"],
    "dim_location": ["location_key"],
    "dim_date": ["date_key"],
    "fact_orders": ["order_key"],
}
_NOT_NULL = {
    "dim_customer": ["customer_id"],
    "dim_product": ["product_id"],
    "dim_date": ["full_date"],
    "fact_orders": ["order_id"],
}
_REFERENCES = [
    ("order_date_key", "dim_date", "date_key"),
    ("ship_date_key", "dim_date", "date_key"),
    ("customer_key", "dim_customer", "customer_key"),
    ("product_key", "dim_product", "product_key"),
    ("location_key", "dim_location", "location_key"),
]


def _rows(table: str, wide: DataFrame) -> DataFrame:
    """One-row frame of named counters -> (table_name, constraint_name, violations) rows."""
    return wide.unpivot([], wide.columns, "constraint_name", "violations").select(
        F.lit(table).alias("table_name"), "constraint_name", F.col("violations").cast("long").alias("violations"))


def _repeated_numbers(df: DataFrame, key: str) -> DataFrame:
    """One row: how many rows repeat an integer key (NULL is a value), exactly.

    Keys are counted in blocks of 64: a block's count beyond its distinct bits is what repeats. A written
    key is dense within its file, so a task exchanges one row per 64 of its rows instead of every key.
    """
    bit = F.expr(f"shiftleft(1L, cast(pmod({key}, 64) as int))")
    blocks = df.groupBy(F.shiftright(F.col(key), 6).alias("_block")).agg(
        F.count(F.lit(1)).alias("_n"), F.bit_or(bit).alias("_bits"))
    distinct = F.coalesce(F.bit_count("_bits"), F.lit(1))           # the block of NULL keys is one value
    return blocks.agg(F.coalesce(F.sum(F.col("_n") - distinct), F.lit(0)).cast("long").alias("repeated"))


def constraint_audit(tables: dict[str, DataFrame], source: DataFrame | None = None) -> DataFrame:
    """Violations per table and constraint; all zero for a clean load.

    ``unique`` and ``primary_key`` count rows beyond the first per key; ``references`` counts fact
    rows whose non-NULL key has no dimension row; ``numeric_range`` counts source values that the
    store's type cannot hold (they are NULL in the fact); ``unmatched`` counts fact rows whose lookup found no key;
    ``conflict`` counts (postal code, city) pairs of the source with more than
    one (state, region, country).
    """
    parts = []
    for table, df in tables.items():
        counters = {}
        for c in _NOT_NULL.get(table, []):
            counters[f"not_null({c})"] = F.count_if(F.col(c).isNull())
        for c, n in S.LENGTH_LIMITS.get(table, {}).items():
            counters[f"max_length({c},{n})"] = F.count_if(F.length(F.col(c)) > n)
        if table == "fact_orders":
            for fk, _, _ in _REFERENCES:
                counters[f"unmatched({fk})"] = F.count_if(F.col(fk).isNull())
        parts.append(_rows(table, df.agg(*[v.alias(k) for k, v in counters.items()])))
        for rule, key in [("unique", _UNIQUE.get(table)), ("primary_key", _PRIMARY.get(table))]:
            if key is None:
                continue
            beyond = _repeated_numbers(df, key[0]) if rule == "primary_key" else duplicate_count(df, key)
            parts.append(_rows(table, beyond.toDF(f"{rule}({','.join(key)})")))
    fact = tables.get("fact_orders")
    if fact is not None:
        # All references in one pass over the fact: each dimension's keys joined once, hits counted.
        seen, counters = fact.select(*[fk for fk, _, _ in _REFERENCES]), {}
        for fk, dim, key in _REFERENCES:
            if dim not in tables:
                continue
            hit = f"_hit_{fk}"
            keys = tables[dim].select(F.col(key).alias(f"_ref_{fk}"), F.lit(True).alias(hit)).distinct()
            seen = seen.join(keys, F.col(fk) == F.col(f"_ref_{fk}"), "left")
            counters[f"references({fk})"] = F.count_if(F.col(fk).isNotNull() & F.col(hit).isNull())
        parts.append(_rows("fact_orders", seen.agg(*[v.alias(k) for k, v in counters.items()])))
    if source is not None:
        per_pair = source.groupBy(_q(S.POSTAL_CODE), _q(S.CITY)).agg(
            F.count_distinct(F.struct(_q(S.STATE), _q(S.REGION), _q(S.COUNTRY))).alias("_v"))
        ranges = store_overflow(source)
        parts.append(_rows("fact_orders", ranges.select(*[F.col(c).alias(f"numeric_range({c})") for c in ranges.columns])))
        parts.append(_rows("dim_location", per_pair.agg(F.count_if(F.col("_v") > 1).alias("conflict(postal_code,city)"))))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def source_profile(df: DataFrame) -> DataFrame:
    """Rows, columns, order-date range, distinct regions and categories of the source.

    Each distinct count is its own scalar subquery (no ``Expand`` of the rows).
    """
    regions = df.agg(F.count_distinct(_q(S.REGION))).scalar()
    categories = df.agg(F.count_distinct(_q(S.CATEGORY))).scalar()
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.lit(len(public_columns(df))).alias("columns"),
        F.min(_q(S.ORDER_DATE)).alias("min_order_date"),
        F.max(_q(S.ORDER_DATE)).alias("max_order_date"),
    ).select("*", regions.alias("regions"), categories.alias("categories"))
