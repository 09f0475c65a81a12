from __future__ import annotations

import pytest
from pyspark.sql import Row
from pyspark.sql import types as T

DOC = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                    T.StructField("n_chars", T.LongType())])
SF = "/root/testdata/sf0.001"


@pytest.fixture()
def make_docs(spark):
    from ledgerline.llm.common import importable
    importable(spark)

    def make(rows, sources=None):
        return spark.createDataFrame(
            [(i, t, "en", (sources or {}).get(n, "s0"), None if t is None else len(t)) for n, (i, t) in enumerate(rows)], DOC)

    return make


#: Nulls, empty texts, ties, repeated rows, one long text.
ODD = [(1, None), (2, ""), (None, "a b c"), (None, None), (3, "Same text here, five words and more."),
       (4, "Same text here, five words and more."), (4, "Same text here, five words and more."), (5, "x" * 30_000),
       (6, "word " * 20_000), (7, "tab\tand  two\n\n lines \r\n é 漢字 \U0001f600"), (8, "one")]


@pytest.fixture()
def odd(make_docs):
    return make_docs(ODD)


@pytest.fixture()
def none(make_docs):
    return make_docs([])


@pytest.fixture()
def clashing(odd):
    """The odd rows with extra columns named like those that the operators use."""
    from pyspark.sql import functions as F
    for name in ("r", "n", "row", "digest", "h", "score", "kept", "band", "node", "label", "y", "x", "ids", "__digest",
                 "toxic", "segment", "class_id", "start", "own", "next", "part"):
        odd = odd.withColumn(name, F.lit(name))
    return odd


def rows(df) -> list[Row]:
    return df.collect()
