"""Row filters (FLT1-FLT4, FLT9-FLT11).

Filters are plain ``where`` clauses so Catalyst pushes them into the parquet
scan (``PushedFilters``) or, on a partition column, prunes whole directories
(``PartitionFilters``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def since(df: DataFrame, col: str, start) -> DataFrame:
    """FLT3 / FLT10: ``col >= start``, open above; on a partition column this
    prunes partitions. ``start`` is mandatory: there is no unbounded read."""
    if start is None:
        raise ValueError(f"a lower bound on {col!r} is required (partition filter guard)")
    c = F.col(col)
    if isinstance(start, str):
        start_lit = F.lit(start).cast(df.schema[col].dataType)
    else:
        start_lit = F.lit(start)
    return df.where(c >= start_lit)


def within_recent(df: DataFrame, col: str, as_of, days: int) -> DataFrame:
    """FLT11: ``col >= as_of - days`` with the reference instant passed in (replayable)."""
    bound = F.date_sub(F.lit(as_of).cast("date"), days)
    return df.where(F.col(col) >= bound)


def plausible_range(df: DataFrame, col: str, low_exclusive: float, high_inclusive: float) -> DataFrame:
    """FLT4: keep ``low < col <= high``; NULL is rejected. Apply *after* dedup."""
    c = F.col(col)
    return df.where((c > low_exclusive) & (c <= high_inclusive))


def not_null(df: DataFrame, *cols: str) -> DataFrame:
    """FLT2."""
    cond = None
    for name in cols:
        c = F.col(name).isNotNull()
        cond = c if cond is None else cond & c
    return df if cond is None else df.where(cond)


def filter_with_counts(df: DataFrame, predicate: Column, name: str = "filter"):
    """FLT1: filter and report kept / dropped without a second pass.

    Returns ``(filtered_df, observation)``. The counts are gathered by an
    ``Observation`` on the unfiltered rows and become available after the
    first action on ``filtered_df`` (``observation.get``).
    """
    obs = Observation(name)
    pred = F.coalesce(predicate, F.lit(False))
    observed = df.observe(obs, F.count(F.lit(1)).alias("total_rows"),
                          F.count_if(pred).alias("rows_kept"))
    return observed.where(pred), obs


def within_extent(df: DataFrame, values_df: DataFrame, cols) -> DataFrame:
    """Rows of ``df`` between the least and the largest value of ``values_df`` in each of ``cols``.

    One row of bounds comes to the driver, whatever the number of values, and
    the literals become ``PartitionFilters`` / ``PushedFilters`` of the scan.
    Rows with a NULL pass where ``values_df`` has a NULL in that column.
    """
    cols = [cols] if isinstance(cols, str) else list(cols)
    found = values_df.agg(*(f(c).alias(f"{n}{i}") for i, c in enumerate(cols)
                            for n, f in (("lo", F.min), ("hi", F.max), ("nulls", lambda c: F.count_if(F.col(c).isNull()))))).first()
    for i, c in enumerate(cols):
        kind = values_df.schema[c].dataType
        inside = F.col(c).between(F.lit(found[f"lo{i}"]).cast(kind), F.lit(found[f"hi{i}"]).cast(kind))
        df = df.where(inside | F.col(c).isNull() if found[f"nulls{i}"] else inside)
    return df


def restrict_to_values(df: DataFrame, values_df: DataFrame, cols, nulls_match: bool = False) -> DataFrame:
    """Rows of ``df`` whose ``cols`` take a combination of values present in ``values_df`` (SRC9).

    One plan at every size: the extent of the values prunes the scan, and a
    semi-join on the distinct values (reduced map-side) decides. With
    ``nulls_match`` a NULL matches a NULL, as when partitions are rewritten.
    """
    cols = [cols] if isinstance(cols, str) else list(cols)
    values = values_df.select(*cols).distinct()
    if not nulls_match:
        values = not_null(values, *cols)
    near = within_extent(df, values_df, cols)
    wanted = values.select(*(F.col(c).alias(f"__v_{c}") for c in cols))
    same = F.lit(True)
    for c in cols:
        same = same & (F.col(c).eqNullSafe(F.col(f"__v_{c}")) if nulls_match else F.col(c) == F.col(f"__v_{c}"))
    return near.join(wanted, same, "left_semi")
