from __future__ import annotations

import datetime as dt
import os
import sys
import tempfile
from decimal import Decimal

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from ledgerline import schemas as S  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (SparkSession.builder.master("local[*]")
               .config("spark.sql.shuffle.partitions", "8")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.ui.enabled", "false")
               .getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture()
def workdir():
    return tempfile.mkdtemp(prefix="ledgerline-test-")


DEFAULT_LINE = {
    S.ORDER_ID: "O-1", S.ORDER_DATE: dt.date(2024, 1, 2), S.SHIP_DATE: dt.date(2024, 1, 4),
    S.SHIP_MODE: "Standard", S.CUSTOMER_ID: "C-1", S.CUSTOMER_NAME: "Ann", S.SEGMENT: "Consumer",
    S.COUNTRY: "United States", S.CITY: "Springfield", S.STATE: "Illinois", S.POSTAL_CODE: "62701",
    S.REGION: "Central", S.PRODUCT_ID: "P-1", S.CATEGORY: "Furniture", S.SUB_CATEGORY: "Chairs",
    S.PRODUCT_NAME: "Chair", S.SALES: Decimal("100.00"), S.QUANTITY: 1, S.DISCOUNT: Decimal("0.00"),
    S.PROFIT: Decimal("10.00"),
}

SOURCE_WITH_ORDINAL = T.StructType(list(S.SOURCE_SCHEMA.fields) + [T.StructField(S.ORDINAL, T.LongType())])


def _dec(v, scale):
    return None if v is None else Decimal(str(v)).quantize(Decimal(1).scaleb(-scale))


def make_source(spark, lines: list[dict]):
    """Typed source rows; unspecified columns take DEFAULT_LINE values; ordinal = list position."""
    rows = []
    for i, over in enumerate(lines):
        r = {**DEFAULT_LINE, **over}
        r[S.SALES] = _dec(r[S.SALES], 4)
        r[S.PROFIT] = _dec(r[S.PROFIT], 4)
        r[S.DISCOUNT] = _dec(r[S.DISCOUNT], 4)
        rows.append(tuple(r[c] for c in S.SOURCE_COLUMNS) + (i,))
    return spark.createDataFrame(rows, SOURCE_WITH_ORDINAL)
