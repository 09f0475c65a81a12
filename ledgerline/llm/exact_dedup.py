"""Exact deduplication with a heavy-hitter split, in DataFrame operations only.

Misra-Gries summaries (Spark's mergeable ``approx_top_k`` sketch) of the text digests,
one for each group of tasks, name every digest that one row in ``TRACKED / 4`` or more
has, and maybe some others. Their exact counts and winners are aggregated, and those
that are frequent indeed (``TOP`` at most) are broadcast: rows of a frequent text are
decided where they are read and never shuffled. All other digests go through an
ordinary shuffle, pre-aggregated.

Rows: a null text counts as empty; among equal texts the largest ``doc_id`` stays
(null ids are smaller than all others), and of rows that repeat that id too, one;
an empty table gives none. Only the columns named ``doc_id`` and ``text`` decide;
other columns may have any name. Texts are digested whole (SHA-256).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import settled, text_of, wrapped

#: Digests that a summary tracks: any that fills a share of 4 / TRACKED of a group's rows is found.
TRACKED = 2048
#: Candidates taken from a summary: no more than TRACKED / 4 digests can have that share.
TOP = TRACKED // 4
#: Groups of tasks that have a summary each.
GROUPS = 16
#: A digest is frequent from this share of all rows on.
FREQUENT_SHARE = 4 / TRACKED

_D, _R, _KEEP, _KEEP_ROW, _SIZE = "__digest", "__row", "__keep_id", "__keep_row", "__size"


def text_digest() -> F.Column:
    return F.sha2(text_of(), 256)


def frequent_digests(rows: DataFrame, digest: str = _D) -> DataFrame:
    """Candidates for frequent digests: ``GROUPS * TOP`` at most, from the Misra-Gries summary of each group of tasks.

    A digest that is frequent among all rows is frequent in one of the groups at least.
    """
    by_group = rows.groupBy((F.spark_partition_id() % GROUPS).alias("g")).agg(
        F.expr(f"approx_top_k({digest}, {TOP}, {TRACKED})").alias("top"))
    return (by_group.select(F.explode("top.item").alias(digest)).where(F.col(digest).isNotNull()).distinct())


def _winners(rows: DataFrame) -> DataFrame:
    """Per digest: the id and row that stay, and the number of rows."""
    return rows.groupBy(_D).agg(
        F.max("doc_id").alias(_KEEP),
        F.coalesce(F.max_by(_R, "doc_id"), F.max(_R)).alias(_KEEP_ROW),
        F.count("*").alias(_SIZE))


def exact_groups(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``."""
    rows = settled(spark, docs.select("doc_id", text_digest().alias(_D),
                                      F.monotonically_increasing_id().alias(_R)))
    frequent = settled(spark, _verified(rows))
    hot = rows.join(F.broadcast(frequent), _D)
    cold = rows.join(F.broadcast(frequent.select(_D)), _D, "left_anti")
    cold = cold.join(_winners(cold), _D)
    return hot.select(*cold.columns).unionAll(cold).select(
        "doc_id", F.col(_KEEP).alias("keep_id"), F.col(_SIZE).alias("group_size"),
        (F.col(_R) == F.col(_KEEP_ROW)).alias("kept"), F.col(_D).alias("text_sha256"))


def _verified(rows: DataFrame) -> DataFrame:
    """Winners of the digests that are frequent by their exact counts; ``TOP`` rows at most."""
    exact = _winners(rows.join(F.broadcast(frequent_digests(rows)), _D, "left_semi"))
    total = rows.agg(F.count("*").alias("n"))
    return exact.where(F.col(_SIZE) >= F.greatest(F.lit(2.0), total.scalar() * F.lit(FREQUENT_SHARE)))


def drop_copies(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``docs`` without exact copies: of equal texts, a row with the largest ``doc_id`` stays.

    Losing rows of frequent texts are removed map-side; what is left is numbered per digest after one
    shuffle. Rows that repeat both a frequent text and its winning id are merged by a partial aggregate.
    """
    plain = [F.col(f"`{f.name}`") for f in docs.schema.fields
             if "map<" not in f.dataType.simpleString() and f.dataType.simpleString() != "variant"]
    rows = wrapped(docs, doc_id=F.col("doc_id"), **{_D: text_digest(), _R: F.xxhash64(*plain)})
    frequent = settled(spark, _verified(rows.select("doc_id", _D, _R)))
    hot = (rows.join(F.broadcast(frequent.select(_D, _KEEP)), _D)
           .where(F.col("doc_id").eqNullSafe(F.col(_KEEP)))
           .groupBy(_D).agg(F.max_by("r", _R).alias("r")).select("r.*"))
    cold = rows.join(F.broadcast(frequent.select(_D)), _D, "left_anti")
    order = Window.partitionBy(_D).orderBy(F.col("doc_id").desc_nulls_last(), F.col(_R))
    cold = cold.withColumn("n", F.row_number().over(order)).where(F.col("n") == 1).select("r.*")
    return hot.unionAll(cold)
