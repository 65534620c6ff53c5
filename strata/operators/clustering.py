"""Clustering over several columns (SNK10): Z-order values by built-in functions.

Each column is cut into ``2**bits`` ranges of about as many rows, by quantiles of
one aggregate over the table (a fixed number of bounds comes to the driver).
The bits of the ranges' numbers, in turn, make one value; rows in order of it lie
close in all columns at once. Skewed values cost resolution, never rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, BooleanType, DataType, DateType, NumericType, StringType, TimestampNTZType, TimestampType

BITS = 6


def _as_number(col: Column, kind: DataType) -> Column:
    """A number in the order of the column's values, for texts by their first seven bytes."""
    if isinstance(kind, NumericType):
        return col.cast("double")
    if isinstance(kind, (DateType, TimestampType, TimestampNTZType)):
        return F.unix_micros(col.cast("timestamp"))
    if isinstance(kind, BooleanType):
        return col.cast("int")
    if isinstance(kind, (StringType, BinaryType)):
        return F.conv(F.rpad(F.hex(F.substring(col.cast("binary"), 1, 7)), 14, "0"), 16, 10).cast("long")
    raise ValueError(f"cannot cluster by {kind.simpleString()}")


def z_value(df: DataFrame, cols: Sequence[str], bits: int = BITS) -> Column:
    """The Z-order value of a row of ``df``; NULLs count as less than all values."""
    numbers = [_as_number(F.col(c), df.schema[c].dataType) for c in cols]
    shares = [i / 2 ** bits for i in range(1, 2 ** bits)]
    bounds = df.agg(*(F.percentile_approx(n, shares).alias(f"b{i}") for i, n in enumerate(numbers))).first()
    ranks = []
    for i, n in enumerate(numbers):
        over = [F.when(n >= F.lit(b), 1).otherwise(0) for b in bounds[f"b{i}"] or ()]
        ranks.append(reduce(Column.__add__, over, F.lit(0)))
    parts = [F.shiftleft(F.shiftright(r, k).bitwiseAND(F.lit(1)).cast("long"), k * len(cols) + j)
             for j, r in enumerate(ranks) for k in range(bits)]
    return reduce(Column.bitwiseOR, parts)


def clustered(df: DataFrame, cols: Sequence[str], within: Sequence[str] = (), files: int | None = None) -> DataFrame:
    """``df`` dealt out and sorted so that files hardly overlap in any of ``cols``.

    ``within`` are partition columns, which come first. Without ``files`` AQE
    sizes the files.
    """
    value = z_value(df, cols) if len(cols) > 1 else F.col(cols[0])
    order = [*within, "__z", *cols]
    keyed = df.withColumn("__z", value)
    dealt = keyed.repartitionByRange(files, *order) if files else keyed.repartitionByRange(*order)
    return dealt.sortWithinPartitions(*order).drop("__z")
