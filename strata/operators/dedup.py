"""Deterministic keep-one-row-per-key deduplication (WIN1-WIN5, FLT2).

Plan shape: ``Filter(rn = 1)`` directly over ``Window(row_number)``. Catalyst's
``InferWindowGroupLimit`` turns that into a *partial* ``WindowGroupLimit``
before the shuffle and a final one after it, so every map task already keeps
only its best row per key. A hot key holding a third of the table therefore
ships at most one row per map partition through the exchange, never the whole
group -- the pre-aggregation the task asks for, done by the optimizer.

Ties are always broken by every remaining orderable column, so the surviving
row is a function of the data alone, never of partitioning or task timing
(D9 / N3).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StructType, DataType, ArrayType

_RN = "__strata_rn"


def _orderable(dt: DataType) -> bool:
    if isinstance(dt, MapType):
        return False
    if isinstance(dt, StructType):
        return all(_orderable(f.dataType) for f in dt.fields)
    if isinstance(dt, ArrayType):
        return _orderable(dt.elementType)
    return True


def _order_col(spec) -> Column:
    """'col' means latest first (DESC NULLS LAST); a Column is used as given."""
    if isinstance(spec, str):
        return F.col(spec).desc_nulls_last()
    return spec


def tie_break_columns(df: DataFrame, exclude: Sequence[str]) -> list[Column]:
    """Every other orderable column, DESC NULLS LAST, in schema order."""
    skip = set(exclude)
    return [F.col(f"`{f.name}`").desc_nulls_last() for f in df.schema.fields
            if f.name not in skip and _orderable(f.dataType)]


def keep_first(df: DataFrame, keys: Sequence[str], order_by: Sequence = (),
               *, drop_null_keys: Sequence[str] | None = None,
               tie_break: bool = True) -> DataFrame:
    """One row per ``keys``: the first under ``order_by`` + total tie-break.

    ``order_by`` items: a column name means "largest first, NULLs last";
    pass a Column (e.g. ``F.col('x').asc_nulls_last()``) for another order.
    ``drop_null_keys`` (FLT2) filters rows whose listed key columns are NULL
    before ranking; NULL keys not listed group together, like SQL PARTITION BY.
    With no ``order_by`` (WIN5) the pick is still deterministic, which that of
    ``dropDuplicates`` is not: it keeps whichever row arrives first.
    """
    keys = list(keys)
    if drop_null_keys:
        cond = None
        for k in drop_null_keys:
            c = F.col(k).isNotNull()
            cond = c if cond is None else cond & c
        df = df.where(cond)
    orders = [_order_col(o) for o in order_by]
    named = {o for o in order_by if isinstance(o, str)}
    if tie_break:
        orders += tie_break_columns(df, exclude=set(keys) | named)
    if not orders:
        # row_number requires an ORDER BY; with nothing orderable the pick is arbitrary.
        orders = [F.lit(1)]
    w = Window.partitionBy(*[F.col(k) for k in keys]).orderBy(*orders)
    return df.withColumn(_RN, F.row_number().over(w)).where(F.col(_RN) == 1).drop(_RN)


def keep_latest(df: DataFrame, keys: Sequence[str], ts_col: str, **kw) -> DataFrame:
    """WIN1 / WIN3 / WIN4: latest ``ts_col`` per key."""
    return keep_first(df, keys, [ts_col], **kw)


def keep_most_authoritative(df: DataFrame, keys: Sequence[str], weight_col: str,
                            ts_col: str, **kw) -> DataFrame:
    """WIN2: highest ``weight_col`` (e.g. votes), then latest ``ts_col``."""
    return keep_first(df, keys, [weight_col, ts_col], **kw)
