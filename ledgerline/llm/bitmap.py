"""A bitmap of hashes that tasks filter by: bounded in size, it lets all of its hashes pass and few others."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import settled

#: Bits for each hash, and in all (powers of two between); beyond the most, more others pass.
BITS, LEAST_BITS, MOST_BITS = 16, 1 << 16, 1 << 29


class Bitmap:
    def __init__(self, spark: SparkSession, hashes: DataFrame, each: int = BITS):
        """``hashes`` has one column of longs that are spread evenly; ``each`` has so many bits, if there is room."""
        hashes = settled(spark, hashes.toDF("hash"))
        size = LEAST_BITS
        while size < min(MOST_BITS, each * hashes.count()):
            size *= 2
        self.shift = 64 - (size.bit_length() - 1)
        place = F.shiftrightunsigned("hash", self.shift) + 1
        parts = (hashes.select(F.bitmap_bucket_number(place).alias("bucket"), F.bitmap_bit_position(place).alias("bit"))
                 .groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits")))
        bits = bytearray(size // 8)
        for bucket, part in parts.collect():          # MOST_BITS / 8 bytes in all, at most
            bits[(bucket - 1) * len(part):bucket * len(part)] = part
        self.held = spark.sparkContext.broadcast(bytes(bits))

    def test(self) -> Callable[[np.ndarray], np.ndarray]:
        """For use in a task: whether each hash (uint64) passes."""
        bits, shift = np.frombuffer(self.held.value, np.uint8), np.uint64(self.shift)

        def passes(h: np.ndarray) -> np.ndarray:
            place = (h >> shift).astype(np.int64)
            return bits[place >> 3] >> (place & 7).astype(np.uint8) & 1 == 1

        return passes
