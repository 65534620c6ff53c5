"""Numeric column functions (FN14-FN16, FN25, FLT5, N1 NaN cleaning)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from strata.functions._util import as_col, case_map

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for identical results.
# Price bucket (1..4) to tier name; anything else is NULL.
PRICE_TIERS: dict[int, str] = {1: "BUDGET", 2: "AFFORDABLE", 3: "PREMIUM", 4: "LUXURY"}
# Rating bands, checked top-down with >=; a non-NULL value below all is POOR.
RATING_TIERS: tuple[tuple[float, str], ...] = (
    (4.5, "EXCELLENT"),
    (4.0, "GOOD"),
    (3.5, "AVERAGE"),
    (3.0, "BELOW_AVERAGE"),
)
RATING_FLOOR_TIER = "POOR"
# Order amount rounding: nearest 10 (half-even), clamped to [80, 3500];
# a base of zero or less falls back to 300.
ORDER_AMOUNT_MIN = 80.0
ORDER_AMOUNT_MAX = 3500.0
ORDER_AMOUNT_FALLBACK_BASE = 300.0
# ---------------------------------------------------------------------------


def nan_to_null(c) -> Column:
    """N1: Spark orders NaN above every number, so clean it before comparisons."""
    c = as_col(c)
    return F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(c.cast("double"))


def safe_divide(numerator, denominator) -> Column:
    """FN16: NULL when the denominator is 0 or NULL, else n / d (never raises)."""
    n, d = as_col(numerator), as_col(denominator)
    return F.when((d == 0) | d.isNull(), F.lit(None)).otherwise(F.try_divide(n, d))


def between_or_null(c, low, high) -> Column:
    """FLT5: value as double when ``low <= c <= high``, else NULL."""
    c = as_col(c)
    return F.when(c.between(low, high), c.cast("double"))


def price_tier(c) -> Column:
    """FN14: simple CASE over the price bucket."""
    return case_map(c, PRICE_TIERS)


def tier_by_floor(c, bands: Sequence[tuple[float, str]] = RATING_TIERS,
                  floor_label: str | None = RATING_FLOOR_TIER) -> Column:
    """FN15: first band whose floor ``<=`` value; non-NULL rest get ``floor_label``."""
    c = as_col(c)
    out = None
    for floor, label in bands:
        cond = c >= F.lit(floor)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    if floor_label is not None:
        out = out.when(c.isNotNull(), F.lit(floor_label))
    return out


def rating_tier(c) -> Column:
    return tier_by_floor(c)


def round_half_even_clamp(c, step: float = 10.0, low: float = ORDER_AMOUNT_MIN,
                          high: float = ORDER_AMOUNT_MAX) -> Column:
    """FN25: round to the nearest ``step`` with banker's rounding, then clamp.

    ``bround`` is half-even like Python's ``round``; ``round`` would be half-up.
    """
    c = as_col(c).cast("double")
    rounded = F.bround(c / F.lit(step), 0) * F.lit(step)
    return F.greatest(F.least(rounded, F.lit(high)), F.lit(low))


def order_amount(base, factor) -> Column:
    """FN25 as used for order amounts: non-positive base falls back to 300."""
    b = as_col(base).cast("double")
    b = F.when(F.coalesce(b, F.lit(0.0)) <= 0, F.lit(ORDER_AMOUNT_FALLBACK_BASE)).otherwise(b)
    return round_half_even_clamp(b * as_col(factor))
