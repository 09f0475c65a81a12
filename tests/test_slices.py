"""Builds in slices: the rows, order and keys of one build, on the disk of one slice's shuffles."""

from __future__ import annotations

import contextlib
import datetime as dt
import os
import time

import pytest
from pyspark.sql import functions as F

from ledgerline import registry
from ledgerline import schemas as S
from ledgerline.config import (BROADCAST_BYTES_CONF, BYTES_PER_SLICE_CONF, SHUFFLE_CLEANUP_CONF, WAREHOUSE_CONF, ranges,
                               shuffles_removed)
from ledgerline.operators import keep_first
from ledgerline.plans import marts
from ledgerline.plans.star import build_star, forget_stars, source_for_tables, stage_slices, stage_source
from ledgerline.sources.tables import read_tables_slices, read_tables_source

_DAY = dt.datetime(2024, 1, 1)


@contextlib.contextmanager
def conf(spark, **settings):
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def sliced(spark, size):
    """Slices of ``size`` bytes of input, or one slice (None)."""
    return conf(spark, **{BYTES_PER_SLICE_CONF: str(size or 1 << 40)})


def shuffle_files(spark) -> int:
    held = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
    return sum("/shuffle_" in f for f in held.split("\n"))


def left_behind(spark, before: int) -> int:
    """Shuffle files more than ``before``; they are removed in the background, so for some seconds there may be some."""
    for _ in range(50):
        if shuffle_files(spark) <= before:
            return 0
        time.sleep(0.2)
    return shuffle_files(spark) - before


@pytest.fixture()
def tables(spark, workdir):
    """60 orders of 1 to 4 lines, one of 40; missing keys, lines without an order, a line and an order that come twice."""
    def line(order, n):
        day = None if (order or 0) % 17 == 5 else _DAY + dt.timedelta(days=(order or 0) % 23 + n)
        return (order, n % 7 if n % 6 else None, n % 3, n, float(n % 9 + 1), 100.0 + n, 0.05, 0.01, "A", "F", day)
    lines = [line(o, n) for o in range(-3, 60) for n in range(o % 4 + 1)] + [line(30, n) for n in range(40)]
    lines += [line(None, n) for n in range(5)] + [line(7, 1)] * 3
    orders = [(o, o % 11 if o % 10 else None, "F", 1.0, _DAY + dt.timedelta(days=o % 23), "1-URGENT") for o in [*range(58), 12]]
    orders.append((None, 1, "F", 1.0, _DAY, "5-LOW"))
    rows = {
        "lineitem": (lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double,"
                            " l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"),
        "orders": (orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz,"
                           " o_orderpriority string"),
        "customer": ([(c, f"Customer {c}", c % 4, 1.0, "MACHINERY") for c in range(11)],
                     "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"),
        "part": ([(p, f"big\" red {p}" if p % 2 else f"ring{p}", "Brand#1", "SMALL", 1, 1.0) for p in range(7)],
                 "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"),
        "nation": ([(n, f"N{n}", 0) for n in range(4)], "n_nationkey int, n_name string, n_regionkey int"),
        "region": ([(0, "R")], "r_regionkey int, r_name string"),
    }
    for name, (data, schema) in rows.items():
        spark.createDataFrame(data, schema).coalesce(1).write.parquet(f"{workdir}/tables/{name}.parquet")
    with conf(spark, **{WAREHOUSE_CONF: f"{workdir}/warehouse"}):
        forget_stars()
        yield f"{workdir}/tables"
    forget_stars()


def _rows(df) -> list[str]:
    return sorted(map(str, df.collect()))


def test_ranges_hold_every_value_once(spark):
    df = spark.createDataFrame([(v,) for v in [None, None, *range(50), *[20] * 80]], "v int")
    tests = ranges(df, "v", 6)
    assert 1 < len(tests) <= 6
    parts = [df.where(t(F.col("v"))).collect() for t in tests]
    assert sum(map(len, parts)) == df.count() and sum(r.v is None for r in parts[0]) == 2
    seen = [[r.v for r in p if r.v is not None] for p in parts]
    assert all(max(a) < min(b) for a, b in zip(seen, seen[1:]) if a and b)
    assert len(ranges(df, "v", 1)) == len(ranges(df.where("v is null"), "v", 4)) == 1


def test_source_in_slices_is_the_source(spark, tables, workdir):
    """All lines were sorted and joined at once, and the shuffle files of every step stayed on disk together."""
    with sliced(spark, 1500):
        slices = read_tables_slices(spark, tables)
        assert len(slices) > 2
        before = shuffle_files(spark)
        got, stats = stage_slices(slices, f"{workdir}/sliced")
        assert left_behind(spark, before) == 0
    want, one = stage_source(read_tables_source(spark, tables), f"{workdir}/one")
    assert stats == one
    order = lambda df: [str(r) for r in df.orderBy(S.ORDINAL, *[F.col(f"`{c}`") for c in S.SOURCE_COLUMNS]).drop(S.ORDINAL).collect()]
    assert order(got) == order(want)
    assert got.select(S.ORDINAL).distinct().count() == want.select(S.ORDINAL).distinct().count()
    with sliced(spark, None):
        assert len(read_tables_slices(spark, tables)) == 1


def test_setting_outlives_no_block(spark):
    before = spark.conf.get(SHUFFLE_CLEANUP_CONF)
    with shuffles_removed(spark), shuffles_removed(spark):
        assert spark.conf.get(SHUFFLE_CLEANUP_CONF) == "true"
    assert spark.conf.get(SHUFFLE_CLEANUP_CONF) == before


@pytest.mark.parametrize("number", ["long", "decimal(38,0)"])
def test_keep_first_of_a_large_source_moves_bits_not_rows(spark, workdir, number):
    """The whole rows were dealt by their number to meet the first numbers."""
    first = "9" * 30 if number != "long" else str(5 << 33)
    at = F.lit(first).cast(number) + F.col("id").cast(number)
    df = spark.range(9000).select(F.when(F.col("id") % 13 != 0, F.col("id") * 7 % 1500).alias("k"), (F.col("id") % 2).alias("p"),
                                  F.concat(F.lit("row "), "id").alias("v"), at.cast(number).alias(S.ORDINAL))
    df.repartition(3).write.parquet(f"{workdir}/rows")
    df = spark.read.parquet(f"{workdir}/rows")
    with sliced(spark, None):
        want = _rows(keep_first(df, ["k", "p"], ["v"]))
    assert 1500 < len(want) < 9000
    with sliced(spark, 2000):
        out = keep_first(df, ["k", "p"], ["v"])
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
        assert out.columns == ["k", "p", "v"] and _rows(out) == want
        with conf(spark, **{BROADCAST_BYTES_CONF: "100"}):          # bits beyond the limit
            out = keep_first(df, ["k", "p"], ["v"])
            assert "ShuffledHashJoin" in out._jdf.queryExecution().executedPlan().toString() and _rows(out) == want


def test_line_items_of_a_large_source(spark, tables):
    with sliced(spark, None):
        want = _rows(registry.QUERIES["dedup_line_items"](spark, tables))
    forget_stars()
    with sliced(spark, 1500):
        assert _rows(registry.QUERIES["dedup_line_items"](spark, tables)) == want
    assert len(want) < source_for_tables(spark, tables).source.count()


def test_star_in_slices_is_the_star(spark, tables, workdir):
    """The fact's lookups and layout shuffled all lines at once; every step's shuffle files stayed until the last view."""
    source, _ = stage_source(read_tables_source(spark, tables), f"{workdir}/staged")
    with sliced(spark, None):
        want = build_star(spark, source, f"{workdir}/one", stage=False)
    with sliced(spark, 2500):
        before = shuffle_files(spark)
        star = build_star(spark, source, f"{workdir}/sliced", stage=False)
        assert len({f.rsplit("-", 2)[0].split("-", 2)[2] for f in star.fact.inputFiles()}) > 1           # several writes
        paths = marts.materialise(star, f"{workdir}/marts")
        assert left_behind(spark, before) == 0
    assert star.stats["fact_orders"] == want.stats["fact_orders"]
    assert _rows(star.fact.drop("order_key")) == _rows(want.fact.drop("order_key"))
    assert star.fact.select("order_key").distinct().count() == star.fact.count()
    days = star.fact.groupBy(F.input_file_name()).agg(F.min("order_date_key").alias("a"), F.max("order_date_key").alias("b")).collect()
    spans = sorted((r.a, r.b) for r in days if r.a is not None)
    assert all(x[1] <= y[0] for x, y in zip(spans, spans[1:]))
    plain = marts.all_marts(want)
    for name, path in paths.items():
        assert _rows(spark.read.parquet(path)) == _rows(plain[name])


@pytest.mark.parametrize("line_breaks", [False, True])
def test_csv_copy_in_slices_is_the_copy(spark, tables, line_breaks):
    """The copy's files were plain text, written by one join of all lines."""
    want = read_tables_source(spark, tables, ordinal=False)
    if line_breaks:
        want = want.withColumn(S.PRODUCT_NAME, F.replace(S.PRODUCT_NAME, F.lit(" "), F.lit("\n")))
    with sliced(spark, 1500):
        got = registry._csv_source(spark, tables, line_breaks)
    path = registry._CSV_WRITTEN[spark.sparkContext.applicationId, os.path.abspath(tables), line_breaks]
    files = [f for f in os.listdir(path) if f.startswith("part-")]
    assert len({f.split("-", 2)[2] for f in files}) > 2 and all(f.endswith(".csv.gz") for f in files)
    columns = [F.col(f"`{c}`") for c in S.SOURCE_COLUMNS]
    assert _rows(got.select(*columns)) == _rows(want.select(*columns))
