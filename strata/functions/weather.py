"""Weather and season column functions (FN2-FN8, JN10)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from strata.functions._util import as_col


@dataclass(frozen=True)
class WeatherThresholds:
    """One parametrised classifier serves both threshold sets (D1)."""

    heavy_rain_mm: float
    rain_mm: float
    extreme_heat_c: float
    hot_c: float | None
    default_label: str


# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for identical results.
# Silver classification: strict '>' comparisons, first match wins.
SILVER_THRESHOLDS = WeatherThresholds(heavy_rain_mm=15.0, rain_mm=2.5, extreme_heat_c=40.0,
                                      hot_c=35.0, default_label="normal")
# Ingest-time classification (no 'hot' band, 'clear' otherwise).
INGEST_THRESHOLDS = WeatherThresholds(heavy_rain_mm=10.0, rain_mm=2.5, extreme_heat_c=40.0,
                                      hot_c=None, default_label="clear")
RAINY_THRESHOLD_MM = 2.5
EXTREME_CATEGORIES: tuple[str, ...] = ("heavy_rain", "extreme_heat")
MONSOON_MONTHS: tuple[int, ...] = (6, 7, 8, 9, 10)
SEASON_BY_MONTHS: tuple[tuple[tuple[int, ...], str], ...] = (
    ((12, 1, 2), "WINTER"),
    ((3, 4, 5), "SPRING"),
    ((6, 7, 8, 9), "MONSOON"),
    ((10, 11), "POST_MONSOON"),
)
# WMO weather codes to description; unknown codes give NULL.
WMO_WEATHER_CODES: dict[int, str] = {
    0: "Clear sky",
    1: "Mainly clear",
    2: "Partly cloudy",
    3: "Overcast",
    45: "Foggy",
    48: "Icy fog",
    51: "Light drizzle",
    53: "Moderate drizzle",
    61: "Slight rain",
    63: "Moderate rain",
    65: "Heavy rain",
    80: "Slight showers",
    81: "Moderate showers",
    82: "Violent showers",
    95: "Thunderstorm",
    96: "Thunderstorm with hail",
    99: "Severe thunderstorm",
}
# ---------------------------------------------------------------------------


def classify_weather(precip, tmax, thresholds: WeatherThresholds = SILVER_THRESHOLDS) -> Column:
    """FN2 / FN3: chained CASE; a NULL comparison falls through to the default (N7)."""
    p, t = as_col(precip), as_col(tmax)
    out = (F.when(p > thresholds.heavy_rain_mm, F.lit("heavy_rain"))
           .when(p > thresholds.rain_mm, F.lit("light_rain"))
           .when(t > thresholds.extreme_heat_c, F.lit("extreme_heat")))
    if thresholds.hot_c is not None:
        out = out.when(t > thresholds.hot_c, F.lit("hot"))
    return out.otherwise(F.lit(thresholds.default_label))


def is_rainy(precip, threshold: float = RAINY_THRESHOLD_MM) -> Column:
    """FN4: strict ``>``; a missing value is not rainy."""
    return F.coalesce(as_col(precip) > F.lit(threshold), F.lit(False))


def is_extreme_weather(category) -> Column:
    """FN5: category in the extreme set; never NULL."""
    return F.coalesce(as_col(category).isin(list(EXTREME_CATEGORIES)), F.lit(False))


def season(date_col) -> Column:
    """FN6: Indian meteorological season by month; NULL date gives NULL."""
    m = F.month(as_col(date_col))
    out = None
    for months, label in SEASON_BY_MONTHS:
        cond = m.isin(list(months))
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out


def monsoon_month(date_col) -> Column:
    """FN7: month in Jun..Oct; NULL date gives false (CASE ... ELSE false)."""
    return F.coalesce(F.month(as_col(date_col)).isin(list(MONSOON_MONTHS)), F.lit(False))


def temperature_range(tmax, tmin) -> Column:
    """FN8: max - min on doubles (NULL-propagating)."""
    return as_col(tmax).cast("double") - as_col(tmin).cast("double")


def weather_description(code) -> Column:
    """JN10: WMO code lookup through a literal map; unknown codes are NULL.

    A map literal is a constant inside the generated code, so the lookup needs
    neither a join nor a broadcast.
    """
    mapping = F.create_map(*[x for k, v in WMO_WEATHER_CODES.items() for x in (F.lit(k), F.lit(v))])
    return F.try_element_at(mapping, as_col(code).cast("int"))
