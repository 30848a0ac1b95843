"""A filter of known size for picking rows out of a large scan by a hash."""

from __future__ import annotations

import numpy as np
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Bits for each wanted hash, and the most bits of a filter (32 MB whatever the input).
BITS_EACH = 16
MOST_BITS = 1 << 28


class Picker:
    """Tells for 64-bit hashes whether they may be wanted: always for those that are.

    Two bits are set for each wanted hash. Past MOST_BITS more rows get through, and the
    exact join that follows drops them.
    """

    def __init__(self, wanted: DataFrame):
        """``wanted`` has one column of longs; its bits are put together by Spark."""
        spark = wanted.sparkSession
        n = wanted.count()
        self.shift = 64 - min(max(10, (n * BITS_EACH).bit_length()), MOST_BITS.bit_length() - 1)
        hashed = wanted.toDF("h")
        places = hashed.select(
            F.explode(
                F.array(
                    F.shiftrightunsigned("h", self.shift),
                    F.shiftrightunsigned(F.xxhash64("h"), self.shift),
                )
            ).alias("bit")
        )
        words = places.groupBy(F.expr("bit >> 6").alias("at")).agg(
            F.expr("bit_or(shiftleft(1L, cast(bit & 63 as int)))").alias("word")
        )
        table = np.zeros(1 << max(0, 64 - self.shift - 6), dtype=np.int64)
        found = words.toArrow()
        table[found["at"].to_numpy()] = found["word"].to_numpy()
        self.table: Broadcast = spark.sparkContext.broadcast(table)

    def may_want(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """``first`` are the hashes and ``second`` their xxhash64, both as longs."""
        kept = np.ones(len(first), dtype=bool)
        for x in (first, second):
            bit = x.view(np.uint64) >> np.uint64(self.shift)
            word = self.table.value[(bit >> np.uint64(6)).astype(np.int64)].view(np.uint64)
            kept &= (word >> (bit & np.uint64(63)) & np.uint64(1)).astype(bool)
        return kept
