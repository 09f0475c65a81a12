"""Cross-site boilerplate lines: distinct sites per line by HyperLogLog sketches.

Every line of at least ``MIN_CHARS`` characters (trimmed of spaces) is hashed; the sites
it occurs on go into one HyperLogLog sketch per line, built in each task and merged by
aggregation, so a line on every page costs one small sketch a task. Lines whose
estimate is clearly above ``SITES`` are boilerplate, lines clearly below are not, and
those within ``MARGIN`` of it get an exact count of distinct sites. Documents are then
rebuilt without their boilerplate lines.

Rows: a null text counts as empty (one empty line, never removed); a null site counts
as one site of its own; copies of a text are cleaned alike; null and repeated ids pass
through, one result row per input row; an empty table gives none; only ``doc_id``,
``text`` and the site column are read. Lines end at ``\\n``; texts are read whole.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import settled, slices

#: Distinct sites from which a line is boilerplate, and the shortest line considered.
SITES, MIN_CHARS = 6, 20
#: log2 of a sketch's registers (standard error 1.04 / 2^(LG_K / 2)), and the share of SITES that counts as near.
LG_K, MARGIN = 9, 0.35


def _lines(docs: DataFrame, site: str) -> DataFrame:
    """``digest, pos, a, b, site``: each line worth counting, by a 96-bit hash, and where it stands."""
    src = docs.select(F.coalesce(F.col("text"), F.lit("")).alias("text"),
                      F.coalesce(F.col(site).cast("string"), F.lit("\0")).alias("site"))
    src = src.select(F.md5("text").alias("digest"), "site", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    line = F.trim("line")
    return src.where(F.length(line) >= MIN_CHARS).select(
        "digest", "pos", F.xxhash64(line).alias("a"), F.hash(line).alias("b"), "site")


def boilerplate(spark: SparkSession, docs: DataFrame, site: str = "source", sites: int = SITES) -> DataFrame:
    """Hashes (``a, b``) of the lines on ``sites`` distinct sites or more."""
    lines = _lines(docs, site)
    spread = lines.groupBy("a", "b").agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", LG_K)).alias("sites"))
    low, high = sites * (1 - MARGIN), sites * (1 + MARGIN)
    spread = settled(spark, spread.where(F.col("sites") >= low))
    near = spread.where(F.col("sites") <= high).select("a", "b")
    exact = (lines.join(near, ["a", "b"], "left_semi").select("a", "b", "site").distinct()
             .groupBy("a", "b").agg(F.count("*").alias("n")).where(F.col("n") >= sites))
    return settled(spark, spread.where(F.col("sites") > high).select("a", "b").unionAll(exact.select("a", "b")))


def clean_documents(spark: SparkSession, docs: DataFrame, site: str = "source", sites: int = SITES) -> DataFrame:
    """``doc_id, n_lines, removed_lines, text`` (the text without boilerplate lines)."""
    found = boilerplate(spark, docs, site, sites)
    gone = (_lines(docs, site).join(found, ["a", "b"], "left_semi").groupBy("digest").agg(F.collect_set("pos").alias("gone")))
    src = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    src = src.withColumn("digest", F.md5("text")).join(gone, "digest", "left").select("doc_id", "text", "gone")

    def run(batches):
        for b in slices(batches):
            total, removed, texts = [], [], []
            for text, positions in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                lines, drop = text.split("\n"), set(positions or ())
                total.append(len(lines))
                removed.append(len(drop))
                texts.append("\n".join(x for k, x in enumerate(lines) if k not in drop) if drop else text)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(total, pa.int64()), pa.array(removed, pa.int64()),
                                              pa.array(texts, pa.string())], ["doc_id", "n_lines", "removed_lines", "text"])

    kind = src.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(run, f"doc_id {kind}, n_lines long, removed_lines long, text string")

