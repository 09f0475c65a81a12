"""Surrogate keys, keep-first, duplicate counting, size-checked lookups."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerline.operators import duplicate_count, keep_first, lookup, with_surrogate_key


def test_surrogate_key_equals_row_number(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5003).cast("string").alias("k")).distinct()
    keyed = with_surrogate_key(df, "key", [F.col("k").asc()], num_partitions=7)
    expected = df.select(F.row_number().over(Window.orderBy("k")).cast("long").alias("key"), "k")
    assert sorted(keyed.collect()) == sorted(expected.collect())
    keys = [r.key for r in keyed.select("key").collect()]
    assert sorted(keys) == list(range(1, len(keys) + 1))


def test_surrogate_key_default_partitioning(spark):
    df = spark.range(0, 20000).select((F.col("id") * 31 % 20011).alias("k"))
    keyed = with_surrogate_key(df, "key", [F.col("k").desc()])
    got = {r.k: r.key for r in keyed.collect()}
    ordered = sorted(got, reverse=True)
    assert [got[k] for k in ordered] == list(range(1, len(ordered) + 1))


def test_surrogate_key_nulls_first_and_stable(spark):
    df = spark.createDataFrame([(None, "b"), ("1", "a"), (None, "a"), ("0", "z")], "p string, c string")
    order = [F.col("p").asc_nulls_first(), F.col("c").asc_nulls_first()]
    a = {(r.p, r.c): r.key for r in with_surrogate_key(df, "key", order, 3).collect()}
    b = {(r.p, r.c): r.key for r in with_surrogate_key(df, "key", order, 2).collect()}
    assert a == b == {(None, "a"): 1, (None, "b"): 2, ("0", "z"): 3, ("1", "a"): 4}


def test_surrogate_key_empty(spark):
    df = spark.createDataFrame([], "k string")
    assert with_surrogate_key(df, "key", [F.col("k").asc()], 4).count() == 0


def test_keep_first_follows_ordinal_not_storage_order(spark):
    rows = [("C1", "first", 2), ("C1", "second", 5), ("C2", "x", 9), ("C1", "zero", 1)]
    df = spark.createDataFrame(rows, "id string, name string, _line_ordinal long").repartition(3)
    got = {r.id: r.name for r in keep_first(df, ["id"], ["name"]).collect()}
    assert got == {"C1": "zero", "C2": "x"}
    # the other file order wins the other way round
    rows2 = [("C1", "first", 1), ("C1", "zero", 2)]
    df2 = spark.createDataFrame(rows2, "id string, name string, _line_ordinal long")
    assert keep_first(df2, ["id"], ["name"]).first().name == "first"


def test_keep_first_groups_null_keys(spark):
    df = spark.createDataFrame([(None, "a", 3), (None, "b", 1), ("k", "c", 2)], "id string, v string, _line_ordinal long")
    got = {r.id: r.v for r in keep_first(df, ["id"], ["v"]).collect()}
    assert got == {None: "b", "k": "c"}


def test_duplicate_count_with_null_in_key(spark):
    df = spark.createDataFrame([("a", None), ("a", None), ("a", None), ("a", "x"), ("b", "x")], "k1 string, k2 string")
    assert duplicate_count(df, ["k1", "k2"]).first().duplicate_rows == 2
    assert duplicate_count(df.limit(0), ["k1", "k2"]).first().duplicate_rows == 0


def test_lookup_null_safe_no_fanout(spark):
    fact = spark.createDataFrame([(None, "X"), ("1", "X"), ("2", "Y"), (None, "Z")], "postal string, city string")
    dim = spark.createDataFrame([(None, "X", 10), ("1", "X", 11), ("2", "Y", 12)], "postal string, city string, key long")
    for bc in (True, False):
        out = lookup(fact, dim, [("postal", "postal"), ("city", "city")], ["key"], null_safe=("postal",), broadcast=bc)
        got = [(r.postal, r.city, r.key) for r in out.collect()]
        assert len(got) == 4
    got = [(r.postal, r.city, r.key) for r in out.collect()]
    assert len(got) == 4
    assert set(got) == {(None, "X", 10), ("1", "X", 11), ("2", "Y", 12), (None, "Z", None)}


def test_table_stats_bound(spark):
    from ledgerline.operators.lookup import BroadcastLimit, TableStats
    st = TableStats(1000, {"name": 50_000})
    assert st.bytes_for(["key"]) == 1000 * 24
    assert st.bytes_for(["key", "name"]) == 1000 * 40 + 50_000
    assert BroadcastLimit(1000, 10**6).allows(st, ["key", "name"])
    assert not BroadcastLimit(999, 10**6).allows(st, ["key"])
    assert not BroadcastLimit(1000, 80_000).allows(st, ["key", "name"])
    assert not BroadcastLimit(1000, 10**6).allows(None, ["key"])
    assert not BroadcastLimit(1000, 10**6).allows(TableStats(10, {}, text_measured=False), ["key"])


def test_shuffle_partitions_sizing(spark):
    from ledgerline.config import (BYTES_PER_PARTITION_CONF, MAX_PARTITIONS_CONF, shuffle_partitions,
                                   shuffle_partitions_for)
    current = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert shuffle_partitions_for(spark, 10) == current                      # never fewer than configured
    spark.conf.set(BYTES_PER_PARTITION_CONF, "100")
    try:
        assert shuffle_partitions_for(spark, 100 * current * 3 + 1) == current * 3 + 1
        spark.conf.set(MAX_PARTITIONS_CONF, str(current * 2))
        assert shuffle_partitions_for(spark, 10**15) == current * 2          # bounded
    finally:
        spark.conf.unset(BYTES_PER_PARTITION_CONF)
        spark.conf.unset(MAX_PARTITIONS_CONF)
    with shuffle_partitions(spark, current + 5):
        assert spark.conf.get("spark.sql.shuffle.partitions") == str(current + 5)
    assert spark.conf.get("spark.sql.shuffle.partitions") == str(current)


def test_input_bytes_are_the_files_sizes(spark, workdir):
    import glob
    import os

    from ledgerline.config import input_bytes
    spark.range(1000).repartition(3).write.parquet(f"{workdir}/a")
    spark.range(10).write.parquet(f"{workdir}/b")
    want = sum(os.path.getsize(f) for f in glob.glob(f"{workdir}/a/*.parquet"))
    assert input_bytes(spark.read.parquet(f"{workdir}/a")) == want
    assert input_bytes(spark.createDataFrame([(1,)], "a int")) == 0
