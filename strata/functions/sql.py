"""The reusable macros as SQL-language functions (UDF1), for ``spark.sql`` users.

``CREATE TEMPORARY FUNCTION ... RETURN <expr>`` bodies are inlined by the
analyzer, so a call compiles to the same generated code as the Column
functions in this package -- no Python runs per row. Tests assert both forms
agree. The existence macros (festival day, match day) look up a table or view,
named when they are registered, by a scalar subquery that Catalyst turns into one
left join on the table's distinct keys, as the DataFrame operators do.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from strata.functions.keys import SURROGATE_KEY_NULL
from strata.functions.text import CITY_CANONICAL_NAMES
from strata.functions.weather import SILVER_THRESHOLDS


def _city_case() -> str:
    t = "upper(trim(c))"
    whens = " ".join(f"WHEN {t} = '{k}' THEN '{v}'" for k, v in CITY_CANONICAL_NAMES.items())
    return (f"CASE {whens} ELSE concat(upper(substr(trim(c), 1, 1)), lower(substr(trim(c), 2))) END")


def sql_function_ddl() -> dict[str, str]:
    th = SILVER_THRESHOLDS
    return {
        "safe_divide": ("safe_divide(n DOUBLE, d DOUBLE) RETURNS DOUBLE RETURN "
                        "CASE WHEN d = 0 OR d IS NULL THEN NULL ELSE n / d END"),
        "classify_weather": (
            "classify_weather(precip DOUBLE, tmax DOUBLE) RETURNS STRING RETURN "
            f"CASE WHEN precip > {th.heavy_rain_mm} THEN 'heavy_rain' "
            f"WHEN precip > {th.rain_mm} THEN 'light_rain' "
            f"WHEN tmax > {th.extreme_heat_c} THEN 'extreme_heat' "
            f"WHEN tmax > {th.hot_c} THEN 'hot' ELSE '{th.default_label}' END"),
        "standardise_city": f"standardise_city(c STRING) RETURNS STRING RETURN {_city_case()}",
        "indian_season": (
            "indian_season(d DATE) RETURNS STRING RETURN "
            "CASE WHEN month(d) IN (12, 1, 2) THEN 'WINTER' WHEN month(d) IN (3, 4, 5) THEN 'SPRING' "
            "WHEN month(d) IN (6, 7, 8, 9) THEN 'MONSOON' WHEN month(d) IN (10, 11) THEN 'POST_MONSOON' END"),
        "day_of_week_mon0": "day_of_week_mon0(t TIMESTAMP_NTZ) RETURNS INT RETURN weekday(t)",
        "surrogate_key": ("surrogate_key(fields ARRAY<STRING>) RETURNS STRING RETURN "
                          f"md5(array_join(transform(fields, f -> coalesce(f, '{SURROGATE_KEY_NULL}')), '-'))"),
    }


def existence_ddl(festivals: str, matches: str) -> dict[str, str]:
    """Existence macros over a festival calendar and a match schedule (names of tables or views); a NULL date or city is no such day."""
    return {
        "is_festival_day": ("is_festival_day(d DATE, major_only BOOLEAN) RETURNS BOOLEAN RETURN "
                            f"coalesce((SELECT max(if(f.is_major, 2, 1)) FROM {festivals} f WHERE f.festival_date = d), 0) >= if(major_only, 2, 1)"),
        "is_match_day": ("is_match_day(d DATE, city STRING) RETURNS BOOLEAN RETURN coalesce("
                         f"(SELECT max(m.is_service_city) FROM {matches} m WHERE m.match_date = d AND m.venue_city = city), false)"),
    }


def register_sql_functions(spark: SparkSession, festivals: str | None = None, matches: str | None = None) -> list[str]:
    """Create (or replace) the temporary SQL functions in this session; the existence macros where their tables are named."""
    names = []
    both = existence_ddl(festivals, matches) if festivals and matches else {}
    for name, ddl in {**sql_function_ddl(), **both}.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {ddl}")
        names.append(name)
    return names
