"""Expected-demand tables (MD13, MD14, JN8, JN9).

The reference's generator draws random orders from a rate formula; only the
rate is reproduced here, deterministically: entity x date spine x multipliers.

The spine is a generator, not a join: each entity row explodes into the dates
of ``[start, end]`` (bounds are parameters, as in the reference), so the plan
is a narrow ``Generate`` with output linear in entities x days and no
cross-product operator. Multipliers are literal-map lookups inside codegen.
The optional rainy flag is one left join against a per-(city, date) table that
is first reduced to distinct keys, so it can never fan rows out.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.keys import lookup
from strata.functions.temporal import day_of_week_mon0
from strata.functions.text import first_list_item

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for identical results.
BASE_ORDERS_PER_DAY = 3.5
CUISINE_ORDER_MULTIPLIERS: dict[str, float] = {
    "indian": 2.5,
    "north indian": 2.5,
    "chinese": 1.8,
    "south indian": 2.0,
    "pizza": 1.4,
    "biryani": 2.2,
    "fast food": 1.6,
    "others": 1.0,
}
CITY_DAILY_ORDER_MULTIPLIERS: dict[str, float] = {
    "Delhi": 1.8,
    "New Delhi": 1.8,
    "Mumbai": 2.0,
    "Bangalore": 2.2,
    "Chennai": 1.4,
    "Hyderabad": 1.6,
    "Pune": 1.5,
}
CITY_MULTIPLIER_DEFAULT = 1.0
WEEKEND_MULTIPLIER = 1.35
RAINY_MULTIPLIER = 1.25
# Hour-of-day weights: every hour 1, lunch 12-13 at 3, dinner 19-21 at 4.
PEAK_HOUR_WEIGHTS: dict[int, float] = {12: 3.0, 13: 3.0, 19: 4.0, 20: 4.0, 21: 4.0}
OFF_PEAK_WEIGHT = 1.0
# ---------------------------------------------------------------------------


def hour_weights() -> list[tuple[int, float]]:
    """The 24 (hour, weight) pairs; derived from the rule above."""
    return [(h, PEAK_HOUR_WEIGHTS.get(h, OFF_PEAK_WEIGHT)) for h in range(24)]


def _as_date(d):
    return _dt.date.fromisoformat(d) if isinstance(d, str) else d


def date_spine(entities: DataFrame, start, end, date_col: str = "order_date") -> DataFrame:
    """JN8: every entity row repeated for each date in ``[start, end]``."""
    return entities.withColumn(date_col, F.explode(F.sequence(F.lit(_as_date(start)), F.lit(_as_date(end)))))


def cuisine_category(cuisines_col) -> F.Column:
    """First listed cuisine, or 'others' when the list is NULL or empty."""
    first = first_list_item(cuisines_col)
    return F.when(F.coalesce(F.length(first), F.lit(0)) == 0, F.lit("others")).otherwise(first)


def expected_demand(entities: DataFrame, start, end, *, city_col: str = "city",
                    cuisine_col: str = "cuisine_category", rainy: DataFrame | None = None,
                    rainy_on=(("city", "city"), ("order_date", "weather_date")),
                    rate: float = BASE_ORDERS_PER_DAY,
                    city_multipliers: Mapping[str, float] = CITY_DAILY_ORDER_MULTIPLIERS,
                    cuisine_multipliers: Mapping[str, float] = CUISINE_ORDER_MULTIPLIERS,
                    city_default: float = CITY_MULTIPLIER_DEFAULT,
                    date_col: str = "order_date", out_col: str = "expected_orders") -> DataFrame:
    """MD13: ``rate x city x cuisine x weekend x rainy`` per entity and date.

    City lookup is exact with a default; cuisine lookup is case-insensitive
    with the 'others' multiplier as default. ``rainy`` (optional) holds
    ``is_rainy`` keyed by ``rainy_on`` -- (spine column, rainy column) pairs,
    by default (city, weather_date) of the cleaned weather table.
    """
    spine = date_spine(entities, start, end, date_col)
    city_m = lookup(F.col(city_col), city_multipliers, default=city_default)
    cuisine_m = lookup(F.col(cuisine_col), cuisine_multipliers,
                       default=cuisine_multipliers.get("others", 1.0), case_insensitive=True)
    weekend_m = F.when(day_of_week_mon0(F.col(date_col)) >= 5, F.lit(WEEKEND_MULTIPLIER)).otherwise(F.lit(1.0))
    rainy_m = F.lit(1.0)
    if rainy is not None:
        lo, hi = _as_date(start), _as_date(end)
        date_pairs = [(sp, r) for sp, r in rainy_on if sp == date_col]
        wet = rainy
        for _, r in date_pairs:  # only the requested days can ever match
            wet = wet.where(F.col(r).between(F.lit(lo), F.lit(hi)))
        wet = (wet.groupBy(*[F.col(r).alias(sp) for sp, r in rainy_on])
               .agg(F.max(F.coalesce(F.col("is_rainy"), F.lit(False))).alias("_is_rainy")))
        if [sp for sp, _ in rainy_on] == [date_col]:
            # Keyed by date alone, the table has at most (end - start + 1) rows:
            # a proven bound, so broadcast it instead of shuffling the spine on
            # a key with only that many values.
            wet = F.broadcast(wet)
        spine = spine.join(wet, [sp for sp, _ in rainy_on], "left")
        rainy_m = F.when(F.coalesce(F.col("_is_rainy"), F.lit(False)), F.lit(RAINY_MULTIPLIER)).otherwise(F.lit(1.0))
    out = spine.withColumn(out_col, F.lit(rate) * city_m * cuisine_m * weekend_m * rainy_m)
    return out.drop("_is_rainy") if rainy is not None else out


def hourly_profile(daily: DataFrame, value_col: str = "expected_orders",
                   hour_col: str = "order_hour", out_col: str = "expected_orders_hour") -> DataFrame:
    """MD14: split a daily value over 24 hours by weight / sum(weights).

    The 24 (hour, share) pairs are an inline literal array exploded per row
    -- a narrow generator, not a join.
    """
    weights = hour_weights()
    total = sum(w for _, w in weights)
    pairs = F.array(*[F.struct(F.lit(h).alias("h"), F.lit(w / total).alias("s")) for h, w in weights])
    return (daily.withColumn("_hs", F.explode(pairs))
            .withColumn(hour_col, F.col("_hs.h"))
            .withColumn(out_col, F.col(value_col) * F.col("_hs.s"))
            .drop("_hs"))
