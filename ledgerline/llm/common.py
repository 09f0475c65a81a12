"""Helpers shared by the training-data operators: shared-folder staging and batch handling."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import checkpoint_dir, shared_root

#: Characters of text that a Python task holds as split-up pieces at a time.
SLICE_CHARS = 1 << 20


_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def importable(spark: SparkSession) -> None:
    """Let Python workers that share this machine's files import the package from where the driver did."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", _ROOT)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, label: str) -> str:
    """A new folder under the shared folder of ``spark.checkpoint.dir``."""
    return f"{shared_root(spark)}/ledgerline-llm/{label}-{uuid.uuid4().hex[:12]}"


def written(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read again (cuts lineage, fixes row ids)."""
    path = scratch(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def settled(spark: SparkSession, df: DataFrame) -> DataFrame:
    """A reliable checkpoint: kept in the shared folder, dropped by Spark once unreferenced."""
    checkpoint_dir(spark)
    return df.checkpoint(eager=True)


#: A key with this share of all rows is hot: there are at most 1 / HOT_SHARE of them.
HOT_SHARE = 1 / 2048


def attached(spark: SparkSession, rows: DataFrame, values: DataFrame, key: str, weight: str) -> DataFrame:
    """``rows`` inner joined with ``values`` (one row per ``key``; ``weight``: how many of ``rows`` have it).

    Rows of hot keys get their values by a broadcast of ``1 / HOT_SHARE`` rows at most, the others by a shuffle.
    """
    values = settled(spark, values)
    total = values.agg(F.sum(weight).alias("n"))
    hot = settled(spark, values.where(F.col(weight) >= F.greatest(F.lit(2.0), total.scalar() * F.lit(HOT_SHARE))))
    often = rows.join(F.broadcast(hot), key)
    others = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(values, key)
    return often.unionAll(others.select(*often.columns))


def doc_texts(docs: DataFrame) -> DataFrame:
    """``doc_id`` and whole ``text`` (null: empty); other columns, whatever their names, are left out."""
    return docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))


def wrapped(docs: DataFrame, **more) -> DataFrame:
    """Each row as one struct ``r`` beside the columns ``more``, so that no name of ``docs`` can clash."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("r"), *[c.alias(k) for k, c in more.items()])


def text_of() -> F.Column:
    return F.coalesce(F.col("text"), F.lit(""))


def held_out(doc_id) -> F.Column:
    """The fixed fifth of rows that no classifier learns from: crc32 of the id's text mod 5 is 0."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def slices(batches, text_column: str = "text", chars: int = SLICE_CHARS) -> Iterator[pa.RecordBatch]:
    """Record batches cut so that each holds about ``chars`` bytes of text (one row at least)."""
    for batch in batches:
        col = batch.column(batch.schema.get_field_index(text_column))
        lens = pa.compute.binary_length(col).to_pylist()
        start = total = 0
        for i, n in enumerate(lens):
            if i > start and total + (n or 0) > chars:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += n or 0
        if start < len(lens):
            yield batch.slice(start)
