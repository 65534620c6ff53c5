"""Column -> Column functions. All built-in expressions; no UDFs."""

from strata.functions.keys import lookup, surrogate_key
from strata.functions.numeric import (
    between_or_null,
    nan_to_null,
    order_amount,
    price_tier,
    rating_tier,
    round_half_even_clamp,
    safe_divide,
    tier_by_floor,
)
from strata.functions.temporal import (
    day_of_week_mon0,
    hour_of,
    is_weekend,
    month_start,
    shift_days,
    status_flags,
    to_date_strict,
)
from strata.functions.text import (
    blank_to_null,
    clean_string_columns,
    contains_any,
    first_list_item,
    in_folded,
    is_indian_cuisine,
    is_knockout,
    pair_label,
    replace_values,
    snake_case,
    snake_case_columns,
    standardise_city,
    strip_whitespace,
    text_to_bool,
    upper_trim,
)
from strata.functions.weather import (
    INGEST_THRESHOLDS,
    SILVER_THRESHOLDS,
    WeatherThresholds,
    classify_weather,
    is_extreme_weather,
    is_rainy,
    monsoon_month,
    season,
    temperature_range,
    weather_description,
)

__all__ = [name for name in dir() if not name.startswith("_")]
