"""Document fingerprints by winnowing, in DataFrame operations only.

The lower-cased text is cut into runs of at most ``TOKEN_CHARS`` characters that
are no white space (counted from the start of each such run). Every ``K`` adjacent tokens get a polynomial hash below 2^31
(built by doubling: pairs, then pairs of pairs). Of each ``WINDOW`` adjacent
hashes the smallest is chosen, the rightmost among equals; chosen ones are kept
once each with their position (of the first token). Hash and position share one
long, hash above inverted position, so one minimum settles ties.

Guarantee: two texts that share ``K + WINDOW - 1`` adjacent tokens share a chosen
hash, and no match is shorter than ``K`` tokens. A text of fewer than ``K`` tokens
has one hash, of the whole text, at position 0; a text without tokens has none.

Not for text without spaces: there a token begins at every ``TOKEN_CHARS``-th character
of the run, so a shared passage is found only at the same offset modulo ``TOKEN_CHARS``;
one character inserted at the front can leave two such texts nothing in common.

Rows: a null text counts as empty; the document after the last (by ``doc_id``, nulls
first, ties by a hash of the text) is the first; rows that repeat id and text have
the same neighbours and each its own result row; a table of one document has itself
as next; an empty table gives none. Two empty fingerprints are alike (1.0), an empty
and a non-empty one are not (0.0).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import settled

#: Tokens of a gram; grams of a window: both powers of two.
K, WINDOW = 4, 8
TOKEN_CHARS = 16
#: Fixed values of the hash: modulus 2^31 - 1 and base.
_MOD, _BASE = (1 << 31) - 1, 1_000_003
_LOW = 1 << 31


def _shifted(col: str, by: int):
    return F.slice(F.col(col), by + 1, F.greatest(F.size(col) - by, F.lit(0)))


def _joined(base: int):
    """Hash of two adjacent token runs from theirs."""
    return lambda a, b: (a * F.lit(base) % F.lit(_MOD) + b) % F.lit(_MOD)


def with_fingerprint(df: DataFrame, text: str, out: str, k: int = K, window: int = WINDOW) -> DataFrame:
    """``df`` with ``out``: chosen (hash << 31 | 2^31 - 1 - position) of ``text``, in text order."""
    c, m = f"__{out}_g", f"__{out}_m"
    df = df.withColumn(c, F.regexp_extract_all(F.lower(text), F.lit(rf"\S{{1,{TOKEN_CHARS}}}"), F.lit(0)))
    df = df.withColumn(c, F.transform(c, lambda t: F.pmod(F.xxhash64(t), F.lit(_MOD))))
    df = df.withColumn(m, F.size(c))
    step = 1
    while step < k:
        df = df.withColumn(c, F.zip_with(c, _shifted(c, step), _joined(pow(_BASE, step, _MOD))))
        step *= 2
    grams = F.slice(F.col(c), 1, F.greatest(F.col(m) - (k - 1), F.lit(0)))
    short = F.when(F.col(m) > 0, F.array(F.pmod(F.xxhash64(F.lower(text)), F.lit(_MOD)))).otherwise(
        F.array().cast("array<bigint>"))
    df = df.withColumn(c, F.when(F.col(m) < k, short).otherwise(grams))
    df = df.withColumn(c, F.transform(c, lambda g, i: g * F.lit(_LOW) + (F.lit(_LOW - 1) - i)))
    df = df.withColumn(m, F.size(c))
    step = 1
    while step < window:
        df = df.withColumn(c, F.zip_with(c, _shifted(c, step), lambda a, b: F.least(a, b)))
        step *= 2
    windows = F.when(F.col(m) == 0, F.lit(0)).otherwise(F.greatest(F.col(m) - (window - 1), F.lit(1)))
    return df.withColumn(out, F.array_distinct(F.slice(F.col(c), 1, windows))).drop(c, m)


def hashes(chosen) -> F.Column:
    """Distinct chosen hashes, without positions."""
    return F.array_distinct(F.transform(chosen, lambda v: F.shiftright(v, 31).cast("int")))


def as_text(chosen) -> F.Column:
    """``hash@position`` of each chosen gram, hash in hexadecimal."""
    return F.concat_ws(" ", F.transform(chosen, lambda v: F.concat(
        F.lower(F.hex(F.shiftright(v, 31))), F.lit("@"), (F.lit(_LOW - 1) - v % F.lit(_LOW)).cast("string"))))


def likeness(a: str, b: str) -> F.Column:
    """Shared hashes over all hashes of two fingerprints."""
    both = F.size(F.array_intersect(a, b)).cast("double")
    either = F.size(a) + F.size(b) - both
    return F.when(either == 0, F.lit(1.0)).otherwise(both / F.nullif(either, F.lit(0.0)))


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the chosen grams of every whole text."""
    df = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return with_fingerprint(df, "text", "fingerprint").select("doc_id", as_text("fingerprint").alias("fingerprint"))


def neighbours(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Each distinct (doc_id, text hash ``h``) with the one before it: ``p_id``, ``p_h``, ``p_n`` (its characters).

    Ids are range-partitioned; each partition finds its own neighbours, and only its last row crosses
    to the next partition (one row per partition).
    """
    ids = docs.select("doc_id", "h", F.length("text").alias("n")).groupBy("doc_id", "h").agg(F.first("n").alias("n"))
    ids = settled(spark, ids.repartitionByRange("doc_id", "h").withColumn("part", F.spark_partition_id()))
    within = Window.partitionBy("part").orderBy(F.col("doc_id").asc_nulls_first(), "h")
    own = F.struct("doc_id", "h", "n")
    last = ids.groupBy("part").agg(F.max(own).alias("last"))
    edges = last.select("part", F.lag("last").over(Window.orderBy("part")).alias("before"),
                        F.last("last").over(Window.orderBy("part").rowsBetween(
                            Window.unboundedPreceding, Window.unboundedFollowing)).alias("end"))
    edges = edges.select("part", F.coalesce("before", "end").alias("edge"))
    return (ids.withColumn("p", F.lag(own).over(within)).join(F.broadcast(edges), "part")
            .withColumn("p", F.coalesce("p", "edge"))
            .select("doc_id", "h", F.col("p.doc_id").alias("p_id"), F.col("p.h").alias("p_h"), F.col("p.n").alias("p_n")))


def edited_fingerprints(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, whose last quarter is the next document's beginning.

    Texts are shuffled once, by id and text hash: that exchange feeds both the documents and what each
    document hands to the one before it (its beginning and its fingerprint).
    """
    docs = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    docs = docs.withColumn("h", F.xxhash64("text"))
    links = neighbours(spark, docs)
    handed = docs.join(links, docs["doc_id"].eqNullSafe(links["doc_id"]) & (docs["h"] == links["h"]))
    handed = handed.select("p_id", "p_h", docs["text"], F.expr("left(text, p_n div 4)").alias("head"))
    handed = with_fingerprint(handed, "text", "next").select("p_id", "p_h", "head", hashes("next").alias("next"))
    handed = handed.groupBy("p_id", "p_h").agg(F.first(F.struct("head", "next")).alias("f")).select("p_id", "p_h", "f.*")
    out = docs.join(handed, docs["doc_id"].eqNullSafe(handed["p_id"]) & (docs["h"] == handed["p_h"]), "left")
    out = out.select("doc_id", "text", "next", F.length("text").alias("n_chars"),
                     F.expr("concat(left(text, length(text) - length(text) div 4), head)").alias("edited"))
    out = with_fingerprint(with_fingerprint(out, "text", "own"), "edited", "changed")
    out = out.select("doc_id", F.col("n_chars").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
                     as_text("own").alias("fingerprint"), as_text("changed").alias("edited_fingerprint"),
                     hashes("own").alias("a"), hashes("changed").alias("b"), "next")
    return out.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                      likeness("a", "b").alias("near_edited"), likeness("a", "next").alias("near_next"))
