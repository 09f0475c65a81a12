"""The CSV path and the table path give the same star and the same views."""

from __future__ import annotations

import os

import pytest

from ledgerline import schemas as S
from ledgerline.plans import marts
from ledgerline.plans.star import build_star, star_for_tables
from ledgerline.registry import report
from ledgerline.sources.csv import read_orders_csv
from ledgerline.sources.tables import read_tables_source

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")

VIEWS = ["daily_sales", "sales_by_region", "sales_by_category", "sales_by_segment", "monthly_trend",
         "top_products", "top_customers", "overall_kpis", "discount_impact"]


def test_csv_path_equals_table_path(spark, workdir):
    path = os.path.join(workdir, "orders_csv")
    (read_tables_source(spark, SF).select(*[f"`{c}`" for c in S.SOURCE_COLUMNS]).repartition(4)
     .write.option("header", True).option("escape", '"').option("encoding", "ISO-8859-1").csv(path))
    from_csv = build_star(spark, read_orders_csv(spark, path, date_formats=("yyyy-MM-dd",)))
    from_tables = star_for_tables(spark, SF)
    assert from_csv.counts["fact_orders"] == from_tables.counts["fact_orders"] == 6000
    for t in ["dim_customer", "dim_product", "dim_location", "dim_date"]:
        assert sorted(from_csv.tables[t].collect()) == sorted(from_tables.tables[t].collect()), t
    for name in VIEWS:
        a = sorted(report(marts.MARTS[name](from_csv)).collect())
        b = sorted(report(marts.MARTS[name](from_tables)).collect())
        assert a == b, name
