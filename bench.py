"""Benchmark: ETL refresh plus the dashboard queries over the built star.

Prints one JSON line:
  {"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

``etl`` is the median of three full refreshes (stage source, quality report,
four keyed dimensions, keyed fact, reconciliation, publish) over the test tables.
``etl_sf0.001`` is the same over the smallest tables. Every other entry is the median wall time of ``BENCH_REPEAT`` warm runs of a
registered query, executed to completion through the ``noop`` sink.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (8),
BENCH_REPEAT (5).
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerline.config import build_session  # noqa: E402
from ledgerline.plans import etl  # noqa: E402
from ledgerline.plans.star import remember_star  # noqa: E402
from ledgerline.registry import QUERIES  # noqa: E402
from ledgerline.sources.tables import read_tables_source  # noqa: E402

HEADLINE = [
    "daily_sales", "sales_by_region", "sales_by_category", "sales_by_segment", "monthly_trend",
    "top_products", "top_customers", "overall_kpis", "discount_impact", "freshness", "monthly_period",
    "category_totals", "region_share", "category_tree", "kpi_cards", "top_products_display",
    "top_customers_display", "fact_orders", "quality_report",
    "constraint_audit", "dedup_line_items", "dedup_keep_first", "reconciliation", "filtered_kpis",
    "high_revenue_low_margin",
]
# The size next to the reference's published run (6,000 lines against 9,994 records), beside BENCH_SF_DIR.
SMALL_SF = "sf0.001"


def _run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "5"))
    m = re.search(r"sf([0-9.]+)$", sf_dir)
    sf = float(m.group(1)) if m else None

    extra = {"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")}
    spark = build_session(f"local[{cpus}]", app_name="ledgerline-bench", shuffle_partitions=cpus * 2, extra=extra)
    if not spark.sparkContext.getCheckpointDir() and not spark.sparkContext.getConf().get("spark.checkpoint.dir", None):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerline-bench-"))

    # ETL: median of three full refreshes (the first also warms the JVM).
    etl_times = []
    stage_runs = []
    result = None
    for _ in range(3):
        t0 = time.time()
        result = etl.run_etl(spark, read_tables_source(spark, sf_dir))
        etl_times.append(time.time() - t0)
        stage_runs.append(result.stage_sec)
        print("etl stages:", result.stage_sec, file=sys.stderr)
    etl_sec = statistics.median(etl_times)
    median_run = stage_runs[etl_times.index(etl_sec)] if etl_sec in etl_times else stage_runs[-1]
    lines = int(result.quality["total_rows"])

    # Serve the registry from the star just built.
    remember_star(spark, sf_dir, result.star)

    timings = {"etl": round(etl_sec, 3)}
    for name in HEADLINE:
        runs = []
        for _ in range(repeat):
            t0 = time.time()
            _run(QUERIES[name](spark, sf_dir))
            runs.append(time.time() - t0)
        timings[name] = round(statistics.median(runs), 3)

    # The small ETL, warm: median of three.
    small, small_times = os.path.join(os.path.dirname(sf_dir), SMALL_SF), []
    if os.path.isdir(small):
        for _ in range(3):
            t0 = time.time()
            etl.run_etl(spark, read_tables_source(spark, small))
            small_times.append(time.time() - t0)
        timings["etl_sf0.001"] = round(statistics.median(small_times), 3)

    total = round(sum(timings.values()), 3)
    print(json.dumps({
        "metric": "total_sec", "value": total, "unit": "sec", "queries": timings, "sf": sf,
        "lines": lines, "etl_lines_per_sec": round(lines / etl_sec, 1), "etl_stages": median_run,
        "cpus": cpus, "repeat": repeat,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
