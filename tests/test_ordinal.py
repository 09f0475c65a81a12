"""File order packed into one number: order, metadata, uniqueness, keep-first equal to the struct's."""

from __future__ import annotations

import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline import schemas as S
from ledgerline.operators.dedup import keep_first, numbered
from ledgerline.plans.star import stage_source
from ledgerline.sources import read_orders_csv
from ledgerline.sources.ordinal import with_row_number


@pytest.fixture()
def source(spark, workdir):
    rng = random.Random(5)
    for name in ("b ü.csv", "a.csv", "c%20.csv"):
        with open(os.path.join(workdir, name), "w", encoding="latin-1") as f:
            f.write("Order ID,Product ID,Product Name\n")
            f.writelines(f"{name[0]}{i},{rng.choice(['', 'P-1', 'P-2', f'P-{rng.randrange(60)}'])},{name[0]}-{i}\n"
                         for i in range(400))
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")          # several splits a file, several a task
    try:
        yield read_orders_csv(spark, workdir)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)


def test_number_sorts_as_the_struct(source):
    frame = source.select(S.ORDER_ID, F.col(S.ORDINAL).alias("was"), S.ORDINAL)
    rows = with_row_number(frame).collect()
    assert len({r[S.ORDINAL] for r in rows}) == len(rows) == 1200
    assert [r[S.ORDER_ID] for r in sorted(rows, key=lambda r: r[S.ORDINAL])] == \
        [r[S.ORDER_ID] for r in sorted(rows, key=lambda r: tuple(r["was"]))]
    order = [r[S.ORDER_ID] for r in sorted(rows, key=lambda r: r[S.ORDINAL])]
    assert order == [f"{name}{i}" for name in "abc" for i in range(400)]


def test_staged_source_keeps_first_rows_and_header_metadata(spark, source, workdir):
    staged, stats = stage_source(source, os.path.join(workdir, "out"))
    assert stats.rows == 1200 and numbered(staged) and not numbered(source)
    assert staged.schema[S.ORDINAL].metadata == source.schema[S.ORDINAL].metadata
    first = lambda df, few: {tuple(r) for r in keep_first(df, [S.PRODUCT_ID], [S.PRODUCT_NAME], few=few).collect()}
    assert first(staged, True) == first(staged, False) == first(source, False)
    assert any(product is None for product, _ in first(staged, True))        # a missing id is a group of its own


def test_other_ordinals_and_no_files(spark):
    longs = spark.range(3).withColumnRenamed("id", S.ORDINAL)
    assert with_row_number(longs) is longs
    kind = T.StructType([T.StructField(S.ORDINAL, T.StructType([
        T.StructField("file", T.StringType()), T.StructField("split", T.LongType()), T.StructField("row", T.LongType())]))])
    assert with_row_number(spark.createDataFrame([], kind)).collect() == []
