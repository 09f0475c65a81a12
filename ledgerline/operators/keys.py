"""Dense surrogate keys (1..n) without a single-partition window.

``row_number() over (order by k)`` with no partition moves every row through
one task. Here the rows are range-partitioned on the natural key and sorted
inside each partition; each row's position inside its partition comes from
``monotonically_increasing_id`` (partition index in the upper bits, row
number in the lower 33 bits). The numbered frame is checkpointed to the
shared checkpoint folder so that the per-partition counts and the numbering
see the same partitioning, and so a lost executor does not renumber rows.

The only data that reaches the driver is one count per partition (bounded by
the partition count, never by the data); the running offsets go back as a
broadcast frame of one row per partition, joined on the partition index.

The result equals ``row_number() over (order by natural key)``, so keys are
the same on every re-run over the same data.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import checkpoint_dir

_PART = "_key_part"
_MONO = "_key_mono"
_OFFSET = "_key_offset"


def with_surrogate_key(df: DataFrame, key_name: str, order_by: list[Column],
                       num_partitions: int | None = None) -> DataFrame:
    """``df`` with a dense ``key_name`` column numbered in ``order_by`` order, first column."""
    return counted_surrogate_key(df, key_name, order_by, num_partitions)[0]


def counted_surrogate_key(df: DataFrame, key_name: str, order_by: list[Column],
                          num_partitions: int | None = None) -> tuple[DataFrame, int]:
    """``with_surrogate_key`` and the number of rows, known from the numbering itself."""
    spark = df.sparkSession
    checkpoint_dir(spark)
    # Without an explicit count AQE may coalesce adjacent range partitions (order
    # is kept), so a small dimension does not become many near-empty files.
    ranged = (df.repartitionByRange(num_partitions, *order_by) if num_partitions
              else df.repartitionByRange(*order_by)).sortWithinPartitions(*order_by)
    tagged = ranged.select(
        "*",
        F.spark_partition_id().alias(_PART),
        F.monotonically_increasing_id().alias(_MONO),
    ).checkpoint(eager=True)

    sizes = sorted((int(p), int(n)) for p, n in tagged.groupBy(_PART).count().collect())
    starts = [0] + list(accumulate(n for _, n in sizes))[:-1]
    offsets = spark.createDataFrame([(p, s) for (p, _), s in zip(sizes, starts)],
                                    f"{_PART} int, {_OFFSET} long")

    position = F.col(_MONO) - F.shiftleft(F.col(_PART).cast("long"), 33)
    key = (F.col(_OFFSET) + position + F.lit(1)).cast("long").alias(key_name)
    keyed = tagged.join(F.broadcast(offsets), _PART).select(key, *[F.col(f"`{c}`") for c in df.columns])
    return keyed, sum(n for _, n in sizes)
