"""Silver models over the bronze tables (MD1-MD6, MD12, JN3, JN4, DQ suites).

Each model is the same linear chain the reference's SQL uses --
source -> key-not-null -> keep-one-per-key -> rename/cast/derive [-> final
filter] -- written with this package's operators, so Catalyst sees one plan:
filters on partition columns prune the scan, the dedup pre-limits per map
task, and all derivations stay in one codegen stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata import functions as X
from strata.operators import dedup, filters, joins, quality
from strata.operators.aggregates import (FRESHNESS_LOADED_AT, FRESHNESS_THRESHOLDS_HOURS,
                                         ORDERS_FRESHNESS_LOOKBACK_DAYS, freshness)

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for identical results.
START_DATE = "2020-01-01"          # project start: orders lower bound, ratings valid_from
ORDER_AMOUNT_FLOOR_EXCLUSIVE = 0.0
ORDER_AMOUNT_CEILING = 10000.0
RATING_MIN, RATING_MAX = 0, 5
ORDER_STATUSES = ("DELIVERED", "CANCELLED", "REFUND_REQUESTED", "PENDING", "IN_TRANSIT", "PLACED")
PRICE_TIER_NAMES = ("BUDGET", "AFFORDABLE", "PREMIUM", "LUXURY")
RATING_TIER_NAMES = ("EXCELLENT", "GOOD", "AVERAGE", "BELOW_AVERAGE", "POOR")
WEATHER_CATEGORIES = ("heavy_rain", "light_rain", "extreme_heat", "hot", "normal")
SEASONS = ("WINTER", "SPRING", "MONSOON", "POST_MONSOON")
MATCH_TYPES = ("league", "qualifier", "eliminator", "final")
FESTIVAL_TYPES = ("NATIONAL", "RELIGIOUS", "REGIONAL", "SEASONAL")
FESTIVAL_REGIONS = ("ALL", "NORTH", "SOUTH", "WEST", "EAST")
# ---------------------------------------------------------------------------


def dedup_restaurants(raw: DataFrame) -> DataFrame:
    """Shared WIN2 step of MD1 and MD2 (compute once, reuse; persist if both are written)."""
    return dedup.keep_most_authoritative(raw, ["restaurant_id"], "votes", "_ingested_at",
                                         drop_null_keys=["restaurant_id"])


def stg_restaurants(raw: DataFrame, deduped: DataFrame | None = None) -> DataFrame:
    """MD1."""
    d = deduped if deduped is not None else dedup_restaurants(raw)
    rating = X.between_or_null(F.col("aggregate_rating").try_cast("double"), RATING_MIN, RATING_MAX)
    return d.select(
        "restaurant_id",
        F.trim("restaurant_name").alias("restaurant_name"),
        X.standardise_city("city").alias("city"),
        "address", "locality", "longitude", "latitude",
        F.col("cuisines").alias("cuisine_list"),
        X.first_list_item("cuisines").alias("cuisine_primary"),
        X.is_indian_cuisine("cuisines").alias("cuisine_is_indian"),
        "average_cost_for_two", "currency",
        X.safe_divide(F.col("average_cost_for_two").cast("double"), F.lit(2.0)).alias("cost_per_person"),
        "has_table_booking", "has_online_delivery",
        F.col("has_online_delivery").try_cast("boolean").alias("is_delivery_available"),
        "price_range",
        X.price_tier("price_range").alias("price_tier"),
        rating.alias("aggregate_rating"),
        "rating_text", "votes", "country_code", "_ingested_at", "_source_file",
    )


def stg_restaurant_ratings(raw: DataFrame, deduped: DataFrame | None = None,
                           start_date: str = START_DATE) -> DataFrame:
    """MD2: SCD1-shaped current rating per restaurant."""
    d = deduped if deduped is not None else dedup_restaurants(raw)
    rated = d.select(
        "restaurant_id",
        X.between_or_null(F.col("aggregate_rating").try_cast("double"), RATING_MIN, RATING_MAX)
        .alias("aggregate_rating"),
        "rating_text", "votes")
    return rated.select(
        "restaurant_id", "aggregate_rating", "rating_text", "votes",
        X.rating_tier("aggregate_rating").alias("rating_tier"),
        F.lit(start_date).cast("date").alias("valid_from"),
        F.lit(None).cast("date").alias("valid_to"),
        F.lit(True).alias("is_current"))


def stg_orders(raw: DataFrame, start_date: str = START_DATE, standardise_city: bool = False) -> DataFrame:
    """MD3: FLT3 -> FLT2 -> WIN1 -> FN9-11, FN13 -> FLT4 (after the dedup).

    ``standardise_city`` fixes D3 (orders keep the raw city by default).
    """
    src = filters.since(raw, "order_date", start_date)
    latest = dedup.keep_latest(src, ["order_id"], "_generated_at", drop_null_keys=["order_id"])
    ts = F.col("order_datetime").cast("timestamp")
    flags = X.status_flags("order_status")
    city = X.standardise_city("city") if standardise_city else F.col("city")
    shaped = latest.select(
        "order_id", "restaurant_id", "customer_id", city.alias("city"),
        F.col("order_date").cast("date").alias("order_date"),
        ts.alias("order_datetime"),
        X.hour_of(ts).alias("order_hour"),
        X.day_of_week_mon0(ts).alias("order_day_of_week"),
        X.is_weekend(ts).alias("is_weekend"),
        "order_amount_inr", "payment_method", "platform",
        F.upper("order_status").alias("order_status"),
        *[c.alias(n) for n, c in flags.items()],
        "delivery_time_mins", "customer_rating", "cuisine_category", "_generated_at",
    )
    return filters.plausible_range(shaped, "order_amount_inr", ORDER_AMOUNT_FLOOR_EXCLUSIVE,
                                   ORDER_AMOUNT_CEILING)


def stg_weather(raw: DataFrame) -> DataFrame:
    """MD4. The dedup partitions on the raw city, standardising after (D4)."""
    latest = dedup.keep_latest(raw, ["city", "weather_date"], "_fetched_at",
                               drop_null_keys=["city", "weather_date"])
    precip = X.nan_to_null("precipitation_sum")
    tmax = X.nan_to_null("temperature_max")
    tmin = X.nan_to_null("temperature_min")
    category = X.classify_weather(precip, tmax)
    return latest.select(
        X.standardise_city("city").alias("city"),
        F.col("weather_date").cast("date").alias("weather_date"),
        tmax.alias("temperature_max"), tmin.alias("temperature_min"),
        precip.alias("precipitation_sum"),
        X.nan_to_null("windspeed_max").alias("windspeed_max"),
        F.col("weather_code").cast("long").alias("weather_code"),
        "weather_description",
        F.col("is_rainy").try_cast("boolean").alias("is_rainy"),
        category.alias("weather_category"),
        X.temperature_range(tmax, tmin).alias("temperature_range"),
        X.monsoon_month("weather_date").alias("monsoon_month"),
        X.is_extreme_weather(category).alias("is_extreme_weather"),
        X.season("weather_date").alias("season"),
        "_fetched_at",
    )


def stg_ipl_schedule(raw: DataFrame) -> DataFrame:
    """MD5 (4-key dedup on the raw venue, D4; the ingest flag is kept, D5)."""
    latest = dedup.keep_latest(raw, ["match_date", "venue_city", "team1", "team2"], "_ingested_at",
                               drop_null_keys=["match_date", "venue_city"])
    return latest.select(
        F.col("match_date").cast("date").alias("match_date"),
        F.col("season").cast("long").alias("season"),
        F.col("match_number").cast("long").alias("match_number"),
        "team1", "team2",
        X.standardise_city("venue_city").alias("venue_city"),
        F.lower(F.trim("match_type")).alias("match_type"),
        "winner",
        F.col("is_service_city").try_cast("boolean").alias("is_service_city"),
        X.pair_label("team1", "team2").alias("match_label"),
        X.is_knockout("match_type").alias("is_knockout"),
        "_ingested_at",
    )


def stg_festival_calendar(raw: DataFrame) -> DataFrame:
    """MD6: many festivals per date are kept; only exact (date, name) repeats go."""
    latest = dedup.keep_latest(raw, ["festival_date", "festival_name"], "_ingested_at",
                               drop_null_keys=["festival_date", "festival_name"])
    return latest.select(
        F.col("festival_date").cast("date").alias("festival_date"),
        "festival_name",
        X.upper_trim("festival_type").alias("festival_type"),
        X.upper_trim("region").alias("region"),
        F.col("is_major").try_cast("boolean").alias("is_major"),
        F.year("festival_date").alias("festival_year"),
        F.month("festival_date").alias("festival_month"),
        "_ingested_at",
    )


def weather_coverage(orders: DataFrame, weather: DataFrame) -> DataFrame:
    """MD12: (city, order_date) order counts with no weather row."""
    return joins.coverage_gap(orders, weather, [("city", "city"), ("order_date", "weather_date")],
                              "orders_without_weather")


def is_festival_day(df: DataFrame, date_col: str, festivals: DataFrame, major_only: bool = False,
                    flag: str = "is_festival_day") -> DataFrame:
    """JN3: EXISTS a festival on the date (optionally a major one); no fan-out."""
    where = F.coalesce(F.col("is_major"), F.lit(False)) if major_only else None
    return joins.exists_flag(df, festivals, [(date_col, "festival_date")], flag, right_where=where)


def is_ipl_match_day(df: DataFrame, date_col: str, city_col: str, ipl: DataFrame,
                     flag: str = "is_ipl_match_day") -> DataFrame:
    """JN4: EXISTS a match hosted in the city on the date, in a service city."""
    return joins.exists_flag(df, ipl, [(date_col, "match_date"), (city_col, "venue_city")], flag,
                             right_where=F.coalesce(F.col("is_service_city"), F.lit(False)))


def silver_checks(restaurants: DataFrame) -> dict[str, list[quality.Check]]:
    """The declared test suite per silver model (DQ1-DQ12)."""
    q = quality
    bools = (True, False)
    return {
        "stg_restaurants": [
            q.unique("restaurant_id"), q.not_null("restaurant_id"), q.not_null("city"),
            q.not_null("cuisine_is_indian"), q.accepted_values("cuisine_is_indian", bools),
            q.accepted_values("is_delivery_available", bools),
            q.accepted_values("price_tier", PRICE_TIER_NAMES),
            q.between("aggregate_rating", 0, 5, "aggregate_rating is not null"),
            q.row_count_between(0), q.unique("restaurant_id", "expect_unique_restaurant_id"),
            q.expression("assert_rating_within_range",
                         "aggregate_rating is not null and not (aggregate_rating between 0 and 5)"),
        ],
        "stg_orders": [
            q.unique("order_id"), q.not_null("order_id"),
            q.relationships("restaurant_id", restaurants, "restaurant_id"),
            q.not_null("order_date"),
            q.between("order_hour", 0, 23, "order_hour is not null"),
            q.between("order_day_of_week", 0, 6, "order_day_of_week is not null"),
            q.accepted_values("is_weekend", bools), q.not_null("order_amount_inr"),
            q.proportion_unique_between("payment_method", 0.0, 0.5),
            q.not_null("order_status"), q.accepted_values("order_status", ORDER_STATUSES),
            q.accepted_values("is_cancelled", bools), q.accepted_values("is_delivered", bools),
            q.accepted_values("is_refund_requested", bools),
            q.expression("assert_delivery_time_positive_for_delivered",
                         "is_delivered and (delivery_time_mins is null or delivery_time_mins <= 0)"),
            q.expression("assert_no_negative_order_amounts", "is_delivered and not (order_amount_inr > 0)"),
        ],
        "stg_restaurant_ratings": [
            q.unique("restaurant_id"), q.not_null("restaurant_id"),
            q.between("aggregate_rating", 0, 5, "aggregate_rating is not null"),
            q.accepted_values("rating_tier", RATING_TIER_NAMES), q.not_null("valid_from"),
            q.accepted_values("is_current", bools), q.row_count_between(0),
        ],
        "stg_weather": [
            q.not_null("city"), q.relationships("city", restaurants, "city"),
            q.not_null("weather_date"), q.accepted_values("weather_category", WEATHER_CATEGORIES),
            q.accepted_values("monsoon_month", bools), q.accepted_values("is_extreme_weather", bools),
            q.not_null("season"), q.accepted_values("season", SEASONS), q.row_count_between(0),
            q.unique(["city", "weather_date"]),
        ],
        "stg_ipl_schedule": [
            q.not_null("match_date"), q.not_null("venue_city"),
            q.accepted_values("match_type", MATCH_TYPES), q.accepted_values("is_knockout", bools),
            q.unique(["match_date", "venue_city", "team1", "team2"]),
        ],
        "stg_festival_calendar": [
            q.not_null("festival_date"), q.not_null("festival_name"),
            q.accepted_values("festival_type", FESTIVAL_TYPES),
            q.accepted_values("region", FESTIVAL_REGIONS),
            q.unique(["festival_date", "festival_name"]),
        ],
    }


def source_freshness(bronze: dict[str, DataFrame], as_of: str) -> DataFrame:
    """AGG10 / DQ13 for every bronze source that declares thresholds."""
    parts = []
    for name, df in bronze.items():
        th = FRESHNESS_THRESHOLDS_HOURS.get(name)
        if th is None:
            continue
        if name == "raw_orders":
            df = filters.within_recent(df, "order_date", as_of, ORDERS_FRESHNESS_LOOKBACK_DAYS)
        parts.append(freshness(df, FRESHNESS_LOADED_AT[name], as_of, th[0], th[1], source=name))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
