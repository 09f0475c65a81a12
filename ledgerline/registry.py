"""Named queries over the test tables: one per operator of the pipeline.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame. Queries over the
star share one build per session and table folder (``star_for_tables``);
the build itself is the ETL (stage, dimensions, fact) and is what the
``fact_orders`` and ``dim_*`` queries expose. Checks of the source read the staged source alone
(``source_for_tables``), the first step of that build; the quality report waits for none to be staged.

Reports leave the library with money as DOUBLE (``report``): decimal widths
differ between engines, values do not.
"""

from __future__ import annotations

import os
import threading
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import oracle as O
from . import schemas as S
from .config import (checkpoint_dir, input_bytes, join_path, new_run_id, shuffle_partitions, shuffle_partitions_for, shuffles_removed,
                     warehouse_dir)
from .operators.dedup import keep_first
from .plans import etl, marts, quality, reconcile
from .plans.star import DIMENSIONS, Star, source_for_tables, star_for_tables
from .sources.csv import read_orders_csv
from .sources.tables import read_tables_slices, read_tables_source

Query = Callable[[SparkSession, str], DataFrame]


def report(df: DataFrame) -> DataFrame:
    """Decimal columns to DOUBLE, everything else unchanged."""
    cols = []
    for f in df.schema.fields:
        c = df[f"`{f.name}`"]
        cols.append(c.cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else c)
    return df.select(*cols)


def _star_query(fn: Callable[[Star], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return report(fn(star_for_tables(spark, sf_dir)))
    run.__name__ = getattr(fn, "__name__", "query")
    run.__doc__ = fn.__doc__
    return run


def _table(name: str) -> Callable[[Star], DataFrame]:
    def fn(star: Star) -> DataFrame:
        return star.tables[name]
    fn.__name__ = name
    return fn


def _fact_orders(star: Star) -> DataFrame:
    """The keyed fact as stored, without its row identity."""
    return star.fact.drop("order_key")


def _dim_counts(star: Star) -> DataFrame:
    """Row count of each dimension, counted over the written tables."""
    frames = [star.tables[n].agg(F.count(F.lit(1)).alias("row_count"))
              .select(F.lit(n).alias("table_name"), "row_count") for n in DIMENSIONS]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _dedup_keep_first(star: Star) -> DataFrame:
    """First line (file order) of every product id, all source columns."""
    rest = [c for c in S.SOURCE_COLUMNS if c != S.PRODUCT_ID]
    few = star.is_small("dim_product", ["product_key", "product_id"])     # as many keys, but for a NULL one
    return keep_first(star.source, [S.PRODUCT_ID], rest, few=few).select(*[F.col(f"`{c}`") for c in S.SOURCE_COLUMNS])


def _dedup_line_items(source: DataFrame) -> DataFrame:
    """Exact line-item duplicates removed: first line per duplicate key."""
    rest = [c for c in S.SOURCE_COLUMNS if c not in S.DUPLICATE_KEY]
    return keep_first(source, S.DUPLICATE_KEY, rest).select(*[F.col(f"`{c}`") for c in S.SOURCE_COLUMNS])


def _freshness(star: Star) -> DataFrame:
    return marts.freshness(star, include_refreshed=False)


def _filtered_kpis(star: Star) -> DataFrame:
    return marts.filtered_kpis(star, regions=O.FILTER_REGIONS, categories=O.FILTER_CATEGORIES,
                               segments=O.FILTER_SEGMENTS, date_from=O.FILTER_FROM, date_to=O.FILTER_TO)


TEST_CONTRACT = quality.Contract(segments=tuple(O.TEST_SEGMENTS), regions=tuple(O.TEST_REGIONS),
                                 categories=tuple(O.TEST_CATEGORIES))


def _source_query(fn: Callable[[DataFrame], DataFrame], stage: bool = True) -> Query:
    """A check of the source. With ``stage`` false it stages none: where none is staged yet it reads the adapter's rows, unsorted.

    The joins of those rows are sized as for staging, so the check (a few rows) runs at once.
    """
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        staged = source_for_tables(spark, sf_dir, stage)
        if staged is not None:
            return report(fn(staged.source))
        source = read_tables_source(spark, sf_dir, ordinal=False)
        checkpoint_dir(spark)
        with shuffle_partitions(spark, shuffle_partitions_for(spark, input_bytes(source))):
            return report(fn(source)).checkpoint(eager=True)
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def _constraint_audit(star: Star) -> DataFrame:
    return quality.constraint_audit(star.tables, star.source)


def _reconciliation(star: Star) -> DataFrame:
    return reconcile.reconciliation(star.source, star.fact)


def _csv_source(spark: SparkSession, sf_dir: str, line_breaks: bool = False) -> DataFrame:
    """The adapter's rows written as CSV files, once a session, and read by the CSV reader.

    The rows go from the joins straight to the files: the copy has no file order to keep, so nothing is
    sorted or staged for it. The files are compressed, for the text is some nine times as large as the tables; each
    is read by one task, and so holds a bounded number of rows. With ``line_breaks`` every space of a product name is a line break in the files.
    """
    key = (spark.sparkContext.applicationId, os.path.abspath(sf_dir), line_breaks)
    with _CSV_LOCK:
        if key not in _CSV_WRITTEN:
            path = join_path(warehouse_dir(spark), "runs", f"source_csv-{new_run_id()}")       # no other session reads or writes it
            slices = read_tables_slices(spark, sf_dir, ordinal=False)
            source = slices[0]
            shown = {S.PRODUCT_NAME: F.replace(F.col(f"`{S.PRODUCT_NAME}`"), F.lit(" "), F.lit("\n"))} if line_breaks else {}
            plain = [(F.date_format(F.col(f"`{f.name}`"), "M/d/yyyy") if isinstance(f.dataType, T.DateType)
                      else shown.get(f.name, F.col(f"`{f.name}`"))).alias(f.name) for f in source.schema.fields]
            size = -(-input_bytes(source) // len(slices))
            with shuffle_partitions(spark, shuffle_partitions_for(spark, size)), shuffles_removed(spark):
                for some in slices:
                    (some.select(*plain).write.mode("append").option("header", True).option("encoding", "ISO-8859-1")
                     .option("escape", '"').option("compression", "gzip").option("maxRecordsPerFile", _CSV_ROWS).csv(path))
            _CSV_WRITTEN[key] = path
    return read_orders_csv(spark, _CSV_WRITTEN[key])


_CSV_ROWS = 1_000_000
_CSV_LOCK = threading.Lock()
_CSV_WRITTEN: dict[tuple[str, str, bool], str] = {}


def _csv_query(fn: Callable[[DataFrame], DataFrame], line_breaks: bool = False) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return report(fn(_csv_source(spark, sf_dir, line_breaks)))
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def _csv_profile(src: DataFrame) -> DataFrame:
    """Source profile of the CSV copy."""
    return quality.source_profile(src)


def _csv_quality_report(src: DataFrame) -> DataFrame:
    """Quality report of the CSV copy."""
    return quality.quality_report(src, TEST_CONTRACT)


def _csv_line_breaks(src: DataFrame) -> DataFrame:
    """Sales per product name, from a CSV copy in whose files the spaces of the names are line breaks."""
    name = F.col(f"`{S.PRODUCT_NAME}`")
    return src.where(name.contains("\n")).groupBy(F.replace(name, F.lit("\n"), F.lit(" ")).alias("product_name")).agg(
        F.count("*").alias("order_lines"), F.sum(S.QUANTITY).alias("total_quantity"),
        F.sum(S.SALES).cast(S.MONEY_SUM).alias("total_sales"))


def _mart_bundle(star: Star) -> DataFrame:
    """The nine views, materialised from one scan of the fact and read back: rows and sales of each."""
    spark, key = star.source.sparkSession, star.root
    with _BUNDLE_LOCK:
        if key not in _BUNDLES:            # a folder of this session's own: no other session reads it
            _BUNDLES[key] = marts.materialise(star, f"{star.root}/marts-{new_run_id()}")
    views = [spark.read.parquet(path).agg(F.count(F.lit(1)).alias("row_count"), F.sum("total_sales").cast(S.MONEY_SUM).alias("total_sales"))
             .select(F.lit(name).alias("view_name"), "row_count", "total_sales") for name, path in sorted(_BUNDLES[key].items())]
    return reduce(DataFrame.unionByName, views)


_BUNDLE_LOCK = threading.Lock()
_BUNDLES: dict[str, dict[str, str]] = {}


def _etl_summary(star: Star) -> DataFrame:
    return etl.summary_of(star.source, star.fact, TEST_CONTRACT)


def _freshness_cards(star: Star) -> DataFrame:
    return marts.freshness_cards(star, as_of=F.lit(O.AS_OF).cast("timestamp"))


QUERIES: dict[str, Query] = {
    # source profile and quality checks
    "src_profile": _source_query(quality.source_profile),
    "schema_failures": _source_query(lambda df: quality.schema_failures(df, TEST_CONTRACT)),
    "null_counts": _source_query(quality.null_counts),
    "critical_nulls": _source_query(quality.critical_nulls),
    "duplicate_rows": _source_query(quality.duplicate_rows),
    "ship_date_violations": _source_query(quality.ship_date_violations),
    "range_violations": _source_query(quality.range_violations),
    "uniqueness": _source_query(quality.uniqueness),
    "quality_report": _source_query(lambda df: quality.quality_report(df, TEST_CONTRACT), stage=False),
    "csv_profile": _csv_query(_csv_profile),
    "csv_quality_report": _csv_query(_csv_quality_report),
    "csv_line_breaks": _csv_query(_csv_line_breaks, line_breaks=True),
    "constraint_audit": _star_query(_constraint_audit),
    "reconciliation": _star_query(_reconciliation),
    # dimensions and fact (the ETL)
    "dim_customer": _star_query(_table("dim_customer")),
    "dim_product": _star_query(_table("dim_product")),
    "dim_location": _star_query(_table("dim_location")),
    "dim_date": _star_query(_table("dim_date")),
    "dim_counts": _star_query(_dim_counts),
    "dedup_keep_first": _star_query(_dedup_keep_first),
    "fact_orders": _star_query(_fact_orders),
    "etl_summary": _star_query(_etl_summary),
    "mart_bundle": _star_query(_mart_bundle),
    # views
    "daily_sales": _star_query(marts.daily_sales),
    "sales_by_region": _star_query(marts.sales_by_region),
    "sales_by_category": _star_query(marts.sales_by_category),
    "sales_by_segment": _star_query(marts.sales_by_segment),
    "monthly_trend": _star_query(marts.monthly_trend),
    "top_products": _star_query(marts.top_products),
    "top_customers": _star_query(marts.top_customers),
    "overall_kpis": _star_query(marts.overall_kpis),
    "discount_impact": _star_query(marts.discount_impact),
    # dashboard datasets
    "freshness": _star_query(_freshness),
    "freshness_cards": _star_query(_freshness_cards),
    "monthly_period": _star_query(marts.monthly_period),
    "category_totals": _star_query(marts.category_totals),
    "region_share": _star_query(marts.region_share),
    "category_tree": _star_query(marts.category_tree),
    "kpi_cards": _star_query(marts.kpi_cards),
    "top_products_display": _star_query(marts.top_products_display),
    "top_customers_display": _star_query(marts.top_customers_display),
    # advertised analyses
    "dedup_line_items": _source_query(_dedup_line_items),
    "month_over_month": _star_query(marts.month_over_month),
    "high_revenue_low_margin": _star_query(marts.high_revenue_low_margin),
    "filtered_kpis": _star_query(_filtered_kpis),
}
