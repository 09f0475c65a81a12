"""Keep-first de-duplication and duplicate counting.

"First" means first in file order, carried by an ordinal column. A staged source numbers its
rows with one number (``sources.ordinal``): keep-first is then a hash aggregate of that number
per key, and only the rows whose numbers came out are fetched (late materialisation); of a large
source the numbers travel as bits and the rows not at all. No row is
sorted, and a key that holds a third of all rows is one number per task before the shuffle.

A source that is not staged may carry its ordinal as a struct; ``min_by`` over whole rows serves it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import (broadcast_limit, checkpoint_dir, input_bytes, shuffle_partitions, shuffle_partitions_for, shuffles_removed,
                      slices_for, whole_partitions)
from ..schemas import ORDINAL
from .lookup import TableStats

FIRST = "_first"
#: Ordinals in a block of ``kept_bits``: so many LONGs of 64 bits.
_WORDS = 64
_BLOCK, _WORD, _BITS = "_kept_block", "_kept_word", "_kept_bits"


def _q(name: str):
    return F.col(f"`{name}`")


def numbered(df: DataFrame, ordinal: str = ORDINAL) -> bool:
    """The ordinal is one number, unique to its row, that fits a hash aggregate's buffer."""
    return isinstance(df.schema[ordinal].dataType, (T.IntegralType, T.DecimalType))


def first_ordinals(df: DataFrame, subset: list[str], ordinal: str = ORDINAL) -> DataFrame:
    """Every distinct ``subset`` value with the ordinal of its first row, as ``_first``."""
    return df.groupBy(*[_q(c) for c in subset]).agg(F.min(_q(ordinal)).alias(FIRST))


def keep_first(df: DataFrame, subset: list[str], columns: list[str] | None = None,
               ordinal: str = ORDINAL, few: bool = False) -> DataFrame:
    """First row (by ``ordinal``) of every distinct ``subset`` value.

    Like ``drop_duplicates(subset, keep='first')``: NULL keys form a group.
    ``columns`` are the non-key columns to keep (default: all others).
    A numeric ordinal must be unique to its row. ``few`` says that the number of distinct values
    is proven small: their ordinals are broadcast into the scan. Otherwise rows and ordinals meet
    by a hash of the ordinal, which spreads evenly, in a hash join without a sort. Rows that take more than one slice
    (``config.slices_for``) stay where they are, as long as one bit a row fits the broadcast limit: the
    first ordinals are found at once and broadcast as bits.
    """
    rest = columns if columns is not None else [c for c in df.columns if c not in subset and c != ordinal]
    if numbered(df, ordinal):
        firsts = first_ordinals(df, subset, ordinal).select(FIRST)
        rows = df.select(*[_q(c) for c in [*subset, *rest, ordinal]])
        if not few and slices_for(df.sparkSession, size := input_bytes(df)) > 1:
            bits = kept_bits(firsts, size)
            if bits is not None:
                return _with_bit(rows, bits, ordinal).drop(ordinal)
        firsts = F.broadcast(firsts) if few else firsts.hint("shuffle_hash")
        return rows.join(firsts, _q(ordinal) == F.col(FIRST), "left_semi").drop(ordinal)
    first = df.groupBy(*[_q(c) for c in subset]).agg(
        F.min_by(F.struct(*[_q(c) for c in rest]), _q(ordinal)).alias(FIRST))
    return first.select(*[_q(c) for c in subset], *[F.col(FIRST).getField(c).alias(c) for c in rest])


def kept_bits(firsts: DataFrame, size: int) -> DataFrame | None:
    """The ordinals in ``_first`` as written blocks of bits, ``_kept_block`` (its first ordinal) and ``_kept_bits``
    (LONGs); None where the blocks are beyond the broadcast limit. ``size`` is that of the input, in bytes.

    Only the ordinals are shuffled. Ordinals are dense in a task of their numbering, so a block of 4,096 is some 0.5 KB.
    """
    spark, each = firsts.sparkSession, 64 * _WORDS
    checkpoint_dir(spark)
    at = F.pmod(F.col(FIRST), F.lit(each)).cast("int")
    bit = F.expr(f"shiftleft(1L, {_WORD} & 63)")
    word = F.shiftright(_WORD, 6)
    with shuffle_partitions(spark, n := shuffle_partitions_for(spark, size)), shuffles_removed(spark):
        placed = firsts.select((F.col(FIRST) - at).cast(firsts.schema[FIRST].dataType).alias(_BLOCK), at.alias(_WORD))
        words = placed.repartition(n, _BLOCK).groupBy(_BLOCK, word.alias(_WORD)).agg(F.bit_or(bit).alias(_BITS))
        found = F.map_from_entries(F.collect_list(F.struct(_WORD, _BITS)))
        dense = F.transform(F.sequence(F.lit(0), F.lit(_WORDS - 1)), lambda i: F.coalesce(F.try_element_at("_words", i), F.lit(0).cast("long")))
        blocks = words.groupBy(_BLOCK).agg(found.alias("_words")).select(_BLOCK, dense.alias(_BITS)).checkpoint(eager=True)
    stats = TableStats(rows := blocks.count(), {_BITS: rows * (8 * _WORDS + 16)})
    return blocks if broadcast_limit(spark).allows(stats, blocks.columns) else None


def _with_bit(rows: DataFrame, blocks: DataFrame, ordinal: str) -> DataFrame:
    """The rows whose ordinal has its bit in ``blocks``: a broadcast join in the scan of the rows."""
    at = F.pmod(_q(ordinal), F.lit(64 * _WORDS)).cast("int")
    placed = rows.select("*", (_q(ordinal) - at).cast(rows.schema[ordinal].dataType).alias(_BLOCK), at.alias(_WORD))
    joined = placed.join(F.broadcast(blocks), _BLOCK)
    word = F.element_at(_BITS, F.shiftright(_WORD, 6) + 1)
    kept = word.bitwiseAND(F.expr(f"shiftleft(1L, {_WORD} & 63)")) != 0
    return joined.where(kept).select(*[_q(c) for c in rows.columns])


def duplicate_count(df: DataFrame, subset: list[str], sums: dict[str, Column] | None = None) -> DataFrame:
    """One row: how many rows repeat an earlier row's ``subset`` values, and the totals of ``sums`` (0 without rows).

    ``sums`` are whole numbers of a row; they are added up per key and travel with it, so that ``df`` is read once for all.

    Such keys hardly repeat, so hashing them before the shuffle would only hold (and spill) all of a task's
    keys: they are dealt first and counted once, in partitions sized from the input. A key that many rows share is
    one entry of its task's table.
    """
    sums = sums or {}
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    keys = df.select(*[_q(c) for c in subset], *[c.alias(name) for name, c in sums.items()])
    groups = (keys.repartition(whole_partitions(df), *[_q(c) for c in subset]).groupBy(*[_q(c) for c in subset])
              .agg(F.count(F.lit(1)).alias("_n"), *[F.sum(name).alias(name) for name in sums]))
    return groups.agg(total(F.col("_n") - 1).alias("duplicate_rows"), *[total(F.col(name)).alias(name) for name in sums])
