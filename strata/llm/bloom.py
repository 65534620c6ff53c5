"""A Bloom filter of fixed size over 64-bit hashes, for tasks to skip rows that a later join would drop.

Its size does not depend on the number of keys, so it may be broadcast; with
too many keys it lets more rows through, and the join that follows decides.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits of the filter (1 MB), whatever the data.
BITS = 1 << 23


class HashFilter:
    """Which hashes may be among the encoded ones."""

    def __init__(self, words: np.ndarray):
        self.words = words

    def may_hold(self, h: np.ndarray) -> np.ndarray:
        """Of unsigned 64-bit hashes: False for those that surely were not encoded."""
        found = np.ones(len(h), dtype=bool)
        for shift in (0, 32):
            bit = (h >> np.uint64(shift)) & np.uint64(BITS - 1)
            found &= (self.words[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1) == 1
        return found


def hash_filter(keys: DataFrame, column: str) -> HashFilter:
    """Filter of a column of hashes (longs). The driver gets at most ``BITS / 64`` numbers."""
    bit = F.explode(F.array(*(F.shiftrightunsigned(column, s).bitwiseAND(F.lit(BITS - 1)) for s in (0, 32)))).alias("bit")
    word = F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit").bitwiseAND(F.lit(63)).cast("int")))
    rows = keys.select(bit).groupBy(F.shiftright("bit", 6).alias("at")).agg(word.alias("word")).toPandas()
    words = np.zeros(BITS // 64, dtype=np.uint64)
    words[rows["at"].to_numpy(dtype=np.int64)] = rows["word"].to_numpy(dtype=np.int64).view(np.uint64)
    return HashFilter(words)
