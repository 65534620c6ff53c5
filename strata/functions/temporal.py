"""Date/time column functions (FN9-FN13, FN22, FN23, FN27)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from strata.functions._util import as_col

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for identical results.
# Order status flags derived from upper(order_status).
ORDER_STATUS_FLAGS: dict[str, str] = {
    "is_cancelled": "CANCELLED",
    "is_delivered": "DELIVERED",
    "is_refund_requested": "REFUND_REQUESTED",
}
WEEKEND_FIRST_DAY = 5  # Monday = 0, so 5 and 6 are Saturday and Sunday
# ---------------------------------------------------------------------------


def hour_of(ts) -> Column:
    """FN9: hour of the timestamp (session time zone UTC; NTZ taken as is)."""
    return F.hour(as_col(ts))


def day_of_week_mon0(ts) -> Column:
    """FN10: Monday = 0 .. Sunday = 6, i.e. ``mod(dayofweek + 5, 7)``."""
    return F.weekday(as_col(ts))


def is_weekend(ts) -> Column:
    """FN11: CASE WHEN dow >= 5 THEN true ELSE false; NULL timestamp -> false."""
    return F.when(day_of_week_mon0(ts) >= WEEKEND_FIRST_DAY, F.lit(True)).otherwise(F.lit(False))


def status_flags(status, flags: Mapping[str, str] = ORDER_STATUS_FLAGS) -> dict[str, Column]:
    """FN13: one boolean per flag name, ``upper(status) = value``, NULL -> false."""
    up = F.upper(as_col(status))
    return {name: F.when(up == F.lit(value), F.lit(True)).otherwise(F.lit(False))
            for name, value in flags.items()}


def to_date_strict(c, fmt: str = "yyyy-MM-dd") -> Column:
    """FN23: parse text to DATE; unparsable text gives NULL (``try_to_date``)."""
    return F.try_to_date(as_col(c).cast("string"), fmt)


def month_start(c) -> Column:
    """SNK12: month partition value for a date column."""
    return F.trunc(as_col(c), "MM")


def shift_days(c, days: int) -> Column:
    """FN27: ``date + days`` (negative allowed)."""
    return F.date_add(as_col(c), days)
