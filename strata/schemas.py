"""Declared table schemas and source header contracts (SRC3).

Every read of raw text uses one of these explicit schemas; nothing is
inferred. Names and types are fixed values matching the landed tables.
"""

from __future__ import annotations

from pyspark.sql.types import (ArrayType, BooleanType, DateType, DoubleType, LongType, StringType,
                               StructField, StructType, TimestampType)


def _s(*fields: tuple) -> StructType:
    return StructType([StructField(n, t, nullable) for n, t, nullable in
                       [(f[0], f[1], f[2] if len(f) > 2 else True) for f in fields]])


S, L, D, B, DT, TS = StringType(), LongType(), DoubleType(), BooleanType(), DateType(), TimestampType()

# ---------------------------------------------------------------------------
# Bronze table schemas.
RAW_RESTAURANTS = _s(
    ("restaurant_id", L), ("restaurant_name", S), ("city", S), ("address", S), ("locality", S),
    ("longitude", D), ("latitude", D), ("cuisines", S), ("average_cost_for_two", L), ("currency", S),
    ("has_table_booking", B), ("has_online_delivery", B), ("price_range", L), ("aggregate_rating", D),
    ("rating_text", S), ("votes", L), ("country_code", L), ("_ingested_at", TS), ("_source_file", S),
    ("_ingestion_date", DT),
)
RAW_ORDERS = _s(
    ("order_id", S, False), ("restaurant_id", L), ("customer_id", S), ("city", S), ("order_date", DT),
    ("order_datetime", TS), ("order_amount_inr", D), ("payment_method", S), ("platform", S),
    ("order_status", S), ("delivery_time_mins", L), ("customer_rating", L), ("cuisine_category", S),
    ("_generated_at", TS),
)
RAW_WEATHER = _s(
    ("city", S), ("weather_date", DT), ("temperature_max", D), ("temperature_min", D),
    ("precipitation_sum", D), ("windspeed_max", D), ("weather_code", L), ("weather_description", S),
    ("is_rainy", B), ("weather_category", S), ("_fetched_at", TS),
)
RAW_IPL_SCHEDULE = _s(
    ("match_date", DT), ("season", L), ("match_number", L), ("team1", S), ("team2", S),
    ("venue_city", S), ("match_type", S), ("winner", S), ("is_service_city", B),
    ("_ingested_at", TS), ("_source_file", S), ("_ingestion_date", DT),
)
RAW_FESTIVAL_CALENDAR = _s(
    ("festival_date", DT), ("festival_name", S), ("festival_type", S), ("region", S),
    ("is_major", B), ("_ingested_at", TS), ("_source_file", S), ("_ingestion_date", DT),
)
PIPELINE_AUDIT = _s(
    ("run_id", S), ("dag_id", S), ("task_id", S), ("source_name", S), ("run_date", TS),
    ("rows_processed", L), ("rows_rejected", L), ("status", S), ("error_message", S),
    ("duration_seconds", D), ("gcs_uri", S),
)

# Partition column and clustering columns per bronze table.
TABLE_LAYOUT: dict[str, tuple[str | None, tuple[str, ...]]] = {
    "raw_restaurants": ("_ingestion_date", ("city", "price_range")),
    "raw_orders": ("order_date", ("city", "platform", "order_status")),
    "raw_weather": ("weather_date", ("city",)),
    "raw_ipl_schedule": ("_ingestion_date", ("venue_city",)),
    "raw_festival_calendar": ("_ingestion_date", ("region",)),
    "pipeline_audit": (None, ()),
}
# Tables partitioned by the month of their partition column, and that column's name.
MONTH_PARTITION: dict[str, str] = {"raw_orders": "order_month"}
# Reads of raw_orders must constrain its partition column.
REQUIRE_PARTITION_FILTER = {"raw_orders"}

# Required source headers (all must be present; extra columns are allowed).
RESTAURANT_CSV_COLUMNS: tuple[str, ...] = (
    "Restaurant ID", "Restaurant Name", "Country Code", "City", "Address", "Locality",
    "Locality Verbose", "Longitude", "Latitude", "Cuisines", "Average Cost for two", "Currency",
    "Has Table booking", "Has Online delivery", "Is delivering now", "Switch to order menu",
    "Price range", "Aggregate rating", "Rating color", "Rating text", "Votes",
)
IPL_CSV_REQUIRED: tuple[str, ...] = ("match_date", "season", "team1", "team2", "venue_city", "match_type")
FESTIVAL_CSV_REQUIRED: tuple[str, ...] = ("festival_date", "festival_name", "festival_type", "region",
                                          "is_major")
# ---------------------------------------------------------------------------

# Typed read schemas for the CSV sources (header names as in the files).
RESTAURANT_CSV_SCHEMA = _s(
    ("Restaurant ID", L), ("Restaurant Name", S), ("Country Code", L), ("City", S), ("Address", S),
    ("Locality", S), ("Locality Verbose", S), ("Longitude", D), ("Latitude", D), ("Cuisines", S),
    ("Average Cost for two", L), ("Currency", S), ("Has Table booking", S), ("Has Online delivery", S),
    ("Is delivering now", S), ("Switch to order menu", S), ("Price range", L), ("Aggregate rating", D),
    ("Rating color", S), ("Rating text", S), ("Votes", L),
)
IPL_CSV_SCHEMA = _s(
    ("match_date", S), ("season", L), ("match_number", L), ("team1", S), ("team2", S),
    ("venue_city", S), ("match_type", S), ("winner", S),
)
FESTIVAL_CSV_SCHEMA = _s(
    ("festival_date", S), ("festival_name", S), ("festival_type", S), ("region", S), ("is_major", S),
)

# Weather API payload: struct of parallel daily arrays.
WEATHER_PAYLOAD = StructType([
    StructField("daily", StructType([
        StructField("time", ArrayType(S)),
        StructField("temperature_2m_max", ArrayType(D)),
        StructField("temperature_2m_min", ArrayType(D)),
        StructField("precipitation_sum", ArrayType(D)),
        StructField("windspeed_10m_max", ArrayType(D)),
        StructField("weathercode", ArrayType(L)),
    ])),
])

BRONZE_SCHEMAS: dict[str, StructType] = {
    "raw_restaurants": RAW_RESTAURANTS,
    "raw_orders": RAW_ORDERS,
    "raw_weather": RAW_WEATHER,
    "raw_ipl_schedule": RAW_IPL_SCHEDULE,
    "raw_festival_calendar": RAW_FESTIVAL_CALENDAR,
    "pipeline_audit": PIPELINE_AUDIT,
}


def conform(df, schema: StructType):
    """Project ``df`` onto ``schema`` (D7): known columns cast with ``try_cast``
    semantics, missing ones as typed NULL, unknown ones dropped."""
    from pyspark.sql import functions as F

    cols = []
    present = set(df.columns)
    for f in schema.fields:
        if f.name in present:
            cols.append(F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*cols)
