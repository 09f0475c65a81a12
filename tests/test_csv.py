"""CSV reader: encoding, quoting, NULL tokens, bad values, file order."""

from __future__ import annotations

import datetime as dt
import os
from decimal import Decimal

from ledgerline import schemas as S
from ledgerline.plans import quality
from ledgerline.sources.csv import csv_header, missing_columns, read_orders_csv

HEADER = ("Row ID,Order ID,Order Date,Ship Date,Ship Mode,Customer ID,Customer Name,Segment,Country,City,State,"
          "Postal Code,Region,Product ID,Category,Sub-Category,Product Name,Sales,Quantity,Discount,Profit")


def _write(workdir, lines, name="orders.csv"):
    path = os.path.join(workdir, name)
    with open(path, "wb") as f:
        f.write(("\n".join([HEADER] + lines) + "\n").encode("latin-1"))
    return path


def test_latin1_quotes_tokens_and_types(spark, workdir):
    path = _write(workdir, [
        '1,CA-1,11/8/2016,11/11/2016,Second,C-1,Ren\xe9e,Consumer,US,Henderson,KY,04240,South,P-1,Furniture,'
        'Chairs,"Chair, ""big""",261.96,2,0,41.9136',
        '2,CA-2,2016-11-09,11/12/2016,Second,C-2,NA,Consumer,US,Henderson,KY,,South,P-2,Furniture,Tables,'
        'Table,abc,x,0.45,nan',
        '3,CA-3,not a date,11/12/2016,Second,C-3,Bo,Consumer,US,Henderson,KY,NULL,South,P-2,Furniture,Tables,'
        'Table,1.005,3,0.2,-1',
    ])
    df = read_orders_csv(spark, path)
    rows = {r[S.ORDER_ID]: r for r in df.collect()}
    r1, r2, r3 = rows["CA-1"], rows["CA-2"], rows["CA-3"]
    assert r1[S.CUSTOMER_NAME] == "Ren\xe9e"
    assert r1[S.PRODUCT_NAME] == 'Chair, "big"'
    assert r1[S.POSTAL_CODE] == "04240"                       # leading zero kept
    assert r1[S.ORDER_DATE] == dt.date(2016, 11, 8)
    assert r1[S.PROFIT] == Decimal("41.9136")
    assert r2[S.ORDER_DATE] == dt.date(2016, 11, 9)
    assert r2[S.CUSTOMER_NAME] is None and r2[S.POSTAL_CODE] is None and r2[S.PROFIT] is None
    assert r2[S.SALES] is None and r2["_parse_errors"] == {"Sales": "abc", "Quantity": "x"}
    assert r3[S.ORDER_DATE] is None and r3["_parse_errors"] == {"Order Date": "not a date"}
    assert r3[S.POSTAL_CODE] is None
    fails = {(r.column_name, r.check_name, r.failure_case) for r in quality.schema_failures(df).collect()}
    assert ("Sales", "dtype('double')", "abc") in fails
    assert ("Quantity", "dtype('int')", "x") in fails
    assert ("Order Date", "dtype('date')", "not a date") in fails
    assert ("Customer Name", "not_nullable", None) in fails
    assert ("Profit", "not_nullable", None) in fails
    assert not any(f[0] == "Sales" and f[1] == "not_nullable" for f in fails)
    nulls = {r.column_name: r.null_count for r in quality.null_counts(df).collect()}
    assert nulls["Sales"] == 0 and nulls["Profit"] == 1 and nulls["Postal Code"] == 2
    assert quality.source_profile(df).first().columns == 21     # Row ID is kept, as the header has it


def test_file_order_ordinal(spark, workdir):
    lines = [f"{i},O-{i},1/1/2020,1/2/2020,S,C-1,Name{i},Consumer,US,X,Y,1,East,P,Furniture,S,N,1,1,0,1"
             for i in range(200)]
    df = read_orders_csv(spark, _write(workdir, lines))
    ordered = [r[S.CUSTOMER_NAME] for r in df.orderBy(S.ORDINAL).collect()]
    assert ordered == [f"Name{i}" for i in range(200)]


def test_missing_columns(spark, workdir):
    path = os.path.join(workdir, "thin.csv")
    with open(path, "w") as f:
        f.write("Order ID,Sales\nA,1\n")
    assert "Customer ID" in missing_columns(csv_header(spark, path))
    df = read_orders_csv(spark, path)
    assert df.first()[S.CUSTOMER_ID] is None
    fails = {(r.column_name, r.check_name): r.failure_count for r in quality.schema_failures(df).collect()}
    assert fails[("Customer ID", "column_in_dataframe")] == 1
    assert ("Customer ID", "not_nullable") not in fails          # reported once, not per line
    assert ("Sales", "column_in_dataframe") not in fails
    assert {r.column_name for r in quality.null_counts(df).collect()} == {"Order ID", "Sales"}
    rep = quality.quality_report(df).first()
    assert rep.schema_valid is False and rep.schema_failures == len(missing_columns(["Order ID", "Sales"]))
    from ledgerline.plans.star import stage_source
    staged, _ = stage_source(df, os.path.join(workdir, "staged"))       # metadata survives the Parquet copy
    assert quality.absent_columns(staged) == quality.absent_columns(df) != []


def test_malformed_lines_are_reported(spark, workdir):
    good = "1,CA-1,1/1/2020,1/2/2020,S,C-1,Ann,Consumer,US,X,Y,1,East,P,Furniture,S,N,1,1,0,1"
    path = _write(workdir, [good, "2,CA-2,1/1/2020,too,few", good.replace("1,CA-1", "3,CA-3") + ",extra"],
                  name="bad.csv")
    df = read_orders_csv(spark, path)
    rows = {r[S.ORDER_ID]: r for r in df.collect()}
    assert rows["CA-1"]["_corrupt_record"] is None
    assert rows["CA-2"]["_corrupt_record"] == "2,CA-2,1/1/2020,too,few"
    assert rows["CA-3"]["_corrupt_record"] is not None
    malformed = [r for r in quality.schema_failures(df).collect() if r.check_name == "field_count"]
    assert sum(r.failure_count for r in malformed) == 2
    assert {r.column_name for r in malformed} == {"<line>"}


def test_random_text_round_trip(spark, workdir):
    import csv
    import random

    rnd = random.Random(9)
    alphabet = "abcXYZ ,\"'\xe9\xfc\xdf;|"
    names = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 12))).strip() or "x" for _ in range(300)]
    path = os.path.join(workdir, "rt.csv")
    with open(path, "w", encoding="latin-1", newline="") as f:
        w = csv.writer(f)                                   # doubled quotes, quotes only where needed
        w.writerow(HEADER.split(","))
        for i, n in enumerate(names):
            w.writerow([i, f"O-{i}", "1/1/2020", "1/2/2020", "S", f"C-{i}", n, "Consumer", "US", "X", "Y",
                        "1", "East", "P", "Furniture", "S", n, "1", "1", "0", "1"])
    got = {r[S.ORDER_ID]: (r[S.CUSTOMER_NAME], r[S.PRODUCT_NAME], r["_corrupt_record"])
           for r in read_orders_csv(spark, path).collect()}
    tokens = {"NA", "NULL", "nan", "N/A", "None", "null", "n/a"}
    for i, n in enumerate(names):
        want = None if n in tokens else n
        assert got[f"O-{i}"] == (want, want, None), n


def test_multiline_fields(spark, workdir):
    path = os.path.join(workdir, "ml.csv")
    with open(path, "w", encoding="latin-1") as f:
        f.write(HEADER + "\n")
        f.write('1,O-1,1/1/2020,1/2/2020,S,C-1,"two\nlines",Consumer,US,X,Y,1,East,P,Furniture,S,N,1,1,0,1\n')
    rows = read_orders_csv(spark, path, multiline=True).collect()
    assert len(rows) == 1 and rows[0][S.CUSTOMER_NAME] == "two\nlines" and rows[0]["_corrupt_record"] is None


def test_files_with_different_headers_are_rejected(spark, workdir):
    import pytest as _pytest
    d = os.path.join(workdir, "mixed")
    os.makedirs(d)
    with open(os.path.join(d, "a.csv"), "w") as f:
        f.write("Order ID,Sales\nA,1\n")
    with open(os.path.join(d, "b.csv"), "w") as f:
        f.write("Sales,Order ID\n2,B\n")
    with _pytest.raises(Exception):
        read_orders_csv(spark, d).collect()


def _with_breaks(path: str, n: int, seed: int = 4) -> None:
    import csv
    import random

    rnd = random.Random(seed)
    words = ["a", "two\nlines", 'say "so"', "x, y", "\r\nframed\r\n", "\n\n", '5" pipe', "é", "long\n" * 40]
    with open(path, "w", encoding="latin-1", newline="") as f:
        w = csv.writer(f, lineterminator=rnd.choice(["\n", "\r\n"]))
        w.writerow(HEADER.split(","))
        for i in range(n):
            name = " ".join(rnd.choice(words) for _ in range(rnd.randint(1, 4)))
            w.writerow([i, f"O-{i}", "1/1/2020", "1/2/2020", "S", f"C-{i}", name.strip() or "x", "Consumer", "US", "X", "Y",
                        "1", "East", "P", "Furniture", "S", "N", "1", "1", "0", "1"])


def test_line_breaks_in_fields_equal_pandas_in_many_splits(spark, workdir):
    import pandas as pd

    d = os.path.join(workdir, "breaks")
    os.makedirs(d)
    for k, seed in enumerate((4, 5)):
        _with_breaks(os.path.join(d, f"{k}.csv"), 100, seed)
    want = {}
    for k in range(2):
        frame = pd.read_csv(os.path.join(d, f"{k}.csv"), encoding="latin-1", dtype=str, keep_default_na=False)
        for order, name in zip(frame["Order ID"], frame["Customer Name"]):
            want.setdefault(order, []).append(name)
    before = {c: spark.conf.get(c) for c in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for size in ("400", "1024"):                 # splits shorter than a record, and of some records
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "1")
            df = read_orders_csv(spark, d)
            assert df.rdd.getNumPartitions() > 10
            rows = df.collect()
            assert all(r["_corrupt_record"] is None for r in rows)
            got = {}
            for r in sorted(rows, key=lambda r: tuple(r[S.ORDINAL])):
                got.setdefault(r[S.ORDER_ID], []).append(r[S.CUSTOMER_NAME])
            assert got == want
            firsts = [r[S.ORDER_ID] for r in sorted(rows, key=lambda r: tuple(r[S.ORDINAL]))]
            assert firsts == [f"O-{i}" for i in range(100)] * 2       # file order
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)


def test_open_quotes_by_state(workdir):
    from ledgerline.sources.records import ends_inside
    assert ends_inside(b'a,"b', False) and not ends_inside(b'a,"b"', False) and not ends_inside(b'a,b"c', False)
    assert ends_inside(b'x""y', True) and not ends_inside(b'x",y', True) and ends_inside(b'x","y', True)
    assert not ends_inside(b'5" pipe,7', False) and ends_inside(b'"', False) and not ends_inside(b'"', True)


def test_unclosed_quote_and_line_breaks_with_other_headers(spark, workdir):
    import pytest as _pytest
    path = os.path.join(workdir, "open.csv")
    with open(path, "w") as f:
        f.write('Order ID,Sales\nA,1\nB,"2\n3')
    rows = read_orders_csv(spark, path).collect()
    assert {r[S.ORDER_ID] for r in rows} == {"A", "B"}
    d = os.path.join(workdir, "mixed_breaks")
    os.makedirs(d)
    for name, text in (("a.csv", 'Order ID,Sales\n"A\nB",1\n'), ("b.csv", "Sales,Order ID\n2,B\n")):
        with open(os.path.join(d, name), "w") as f:
            f.write(text)
    with _pytest.raises(Exception):
        read_orders_csv(spark, d).collect()


def _odd_lines(seed, n=400):
    import random
    rnd = random.Random(seed)
    quotes = ('"', '""', '"a"', 'a"b', '"a,b', ',"', '",', '"\r', "", "\r", "\r\r", "x", ",", ',"x"y"z')
    plain = ('"a ""b"" c",1', "x,y", '"p', 'q",2', "", "\r", '"",', 'mid')
    pool = quotes if seed % 2 else plain
    return ["".join(rnd.choice(pool) for _ in range(rnd.randint(0, 3))).encode() for _ in range(n)]


def test_quotes_of_whole_batches_equal_line_by_line():
    import numpy as np
    from ledgerline.sources.records import _after, _lines, _whole, ends_inside
    for seed in range(40):
        lines = _odd_lines(seed)[:1 + seed * 10]
        edges = np.append(0, np.cumsum([len(x) for x in lines]))
        data = np.frombuffer(b"".join(lines), np.uint8)
        for begin in (False, True):
            state, want = begin, []
            for x in lines:
                state = ends_inside(x, state)
                want.append(state)
            after = _after(data, edges, begin)
            assert after.tolist() == want
        assert _lines(data, edges, 0, len(lines)) == lines
        stops = np.flatnonzero(~after)
        if len(stops):
            want, pending = [], []
            for x, inside in zip(lines, after.tolist()):
                pending.append(x)
                if not inside:
                    if len(pending) > 1 or x.strip(b"\r"):
                        want.append(b"\n".join(pending))
                    pending = []
            texts, kept = _whole(data, edges, after, 0, stops)
            assert texts.to_pylist() == want and kept == len(want)


def test_records_of_a_file_read_in_one_pass_for_the_splits_and_one_for_the_records(spark, workdir):
    """An ordered list of the splits read all lines once more, and fragments once more although there were none."""
    from ledgerline.sources.records import file_lines, records, splits_inside
    d = os.path.join(workdir, "one_split")
    os.makedirs(d)
    _with_breaks(os.path.join(d, "0.csv"), 50, 7)
    assert splits_inside(file_lines(spark, d)) == ({}, [])
    plan = records(spark, d)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1
