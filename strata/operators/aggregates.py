"""Aggregations (AGG1-AGG12).

All are hash aggregates with a map-side partial step, so a key that holds a
third of the rows is pre-reduced in every map task before the exchange. Whole
-table scalars (totals, extents) are single-row aggregates; where a per-row
value needs a grand total it is referenced as a scalar subquery rather than a
window with no partition (which would pull every row into one task) or a
cross join.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, keys: Sequence[str], count_name: str = "n_rows") -> DataFrame:
    """AGG2 / DQ2 / DQ8: key values that occur more than once (NULL keys ignored)."""
    cond = None
    for k in keys:
        c = F.col(k).isNotNull()
        cond = c if cond is None else cond & c
    return (df.where(cond).groupBy(*keys).agg(F.count(F.lit(1)).alias(count_name))
            .where(F.col(count_name) > 1))


def frequency(df: DataFrame, cols: Sequence[str] | str, count_name: str = "n_rows") -> DataFrame:
    """AGG5: value counts, largest first (ties by value, so the order is total)."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    return (df.groupBy(*cols).agg(F.count(F.lit(1)).alias(count_name))
            .orderBy(F.col(count_name).desc(), *[F.col(c).asc_nulls_first() for c in cols]))


def share_of_total(counts: DataFrame, count_col: str, share_name: str = "share") -> DataFrame:
    """AGG6: ``count / sum(count)`` using a scalar subquery for the total.

    The total is a one-row partial/final aggregate computed once; rows are
    never gathered into one partition.
    """
    total = counts.select(F.sum(F.col(count_col)).cast("double")).scalar()
    return counts.withColumn(share_name, F.col(count_col).cast("double") / total)


def top_value(counts: DataFrame, value_col: str, count_col: str, name: str = "top_value") -> DataFrame:
    """AGG6 idxmax: the value with the largest count; ties go to the largest value.

    ``max(struct(count, value))`` is a deterministic arg-max (``max_by`` is not
    on ties).
    """
    return counts.agg(F.max(F.struct(F.col(count_col), F.col(value_col)))[value_col].alias(name))


def conditional_counts(df: DataFrame, predicates: Mapping[str, Column],
                       group_by: Sequence[str] = ()) -> DataFrame:
    """AGG8: ``count_if`` per named predicate (NULL predicate counts as false)."""
    aggs = [F.count_if(F.coalesce(p, F.lit(False))).alias(n) for n, p in predicates.items()]
    return df.groupBy(*group_by).agg(*aggs) if group_by else df.agg(*aggs)


def sorted_distinct(df: DataFrame, col: str) -> DataFrame:
    """AGG9 / SRT2: distinct values in ascending order."""
    return df.select(col).distinct().orderBy(F.col(col).asc_nulls_first())


# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for identical results.
# Source freshness thresholds in hours: (warn_after, error_after or None);
# a source mapped to None is not checked.
FRESHNESS_THRESHOLDS_HOURS: dict[str, tuple[float, float | None] | None] = {
    "raw_orders": (24.0, 48.0),
    "raw_weather": (72.0, None),
    "raw_ipl_schedule": (168.0, None),
    "raw_festival_calendar": (168.0, None),
    "raw_restaurants": None,
}
# Loaded-at column per source, and the look-back filter (days) on orders.
FRESHNESS_LOADED_AT: dict[str, str] = {
    "raw_orders": "_generated_at",
    "raw_weather": "_fetched_at",
    "raw_ipl_schedule": "_ingested_at",
    "raw_festival_calendar": "_ingested_at",
}
ORDERS_FRESHNESS_LOOKBACK_DAYS = 90
# ---------------------------------------------------------------------------


def _status(max_col: Column, as_of, warn_hours: float, error_hours: float | None):
    as_of_ts = F.lit(str(as_of)).cast("timestamp")  # interpreted in the session zone (UTC)
    age_h = (F.unix_micros(as_of_ts) - F.unix_micros(max_col.cast("timestamp"))) / F.lit(3.6e9)
    status = F.when(max_col.isNull(), F.lit("error"))
    if error_hours is not None:
        status = status.when(age_h > error_hours, F.lit("error"))
    return age_h, status.when(age_h > warn_hours, F.lit("warn")).otherwise(F.lit("pass"))


def freshness(df: DataFrame, loaded_at: str, as_of, warn_hours: float,
              error_hours: float | None = None, source: str | None = None) -> DataFrame:
    """AGG10 / DQ13: ``max(loaded_at)`` age against warn / error thresholds.

    ``as_of`` is passed in (not ``current_timestamp``) so runs replay. An
    empty table has no max and is reported as ``error``.
    """
    latest = df.agg(F.max(F.col(loaded_at)).alias("max_loaded_at"))
    age_h, status = _status(F.col("max_loaded_at"), as_of, warn_hours, error_hours)
    out = latest.select(F.col("max_loaded_at"), F.round(age_h, 6).alias("age_hours"), status.alias("status"))
    if source is not None:
        out = out.select(F.lit(source).alias("source"), "*")
    return out


def freshness_by(df: DataFrame, source_col: str, loaded_at: str, as_of, warn_hours: float,
                 error_hours: float | None = None) -> DataFrame:
    """AGG10 per source value: one partial/final max per group, then the status."""
    latest = df.groupBy(F.col(source_col).alias("source")).agg(F.max(F.col(loaded_at)).alias("max_loaded_at"))
    age_h, status = _status(F.col("max_loaded_at"), as_of, warn_hours, error_hours)
    return latest.select("source", "max_loaded_at", F.round(age_h, 6).alias("age_hours"),
                         status.alias("status"))


def ingest_summary(parts: Mapping[str, DataFrame], city_col: str | None = None) -> DataFrame:
    """AGG11: rows per source, distinct cities and ``days = rows // cities``.

    One single-row aggregate per source, unioned; division guarded (0 cities
    gives 0 days).
    """
    frames = []
    for source, df in parts.items():
        cities = F.count_distinct(F.col(city_col)) if city_col and city_col in df.columns else F.lit(0)
        frames.append(df.agg(F.lit(source).alias("source"), F.count(F.lit(1)).alias("n_rows"),
                             cities.cast("long").alias("n_cities")))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    days = F.when(F.col("n_cities") > 0, F.expr("n_rows div n_cities")).otherwise(F.lit(0))
    return out.withColumn("n_days", days.cast("long"))
