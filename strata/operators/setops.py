"""Set operations (SET1, SET2, LIM1)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """SET1: UNION ALL by column name; columns missing in a frame become NULL.

    A narrow operation: partitions are concatenated, nothing is shuffled.
    """
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def head_sample(df: DataFrame, n: int = 5) -> DataFrame:
    """LIM1: the first ``n`` rows, used for cheap header/shape validation only."""
    return df.limit(n)
