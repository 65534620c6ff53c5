"""Column functions (FN*, PRJ1/2, FLT5/8) on fixture values from FIXTURES.md."""

import datetime as dt
import math

import duckdb
import pytest
from pyspark.sql import functions as F

from strata import functions as X


def one(spark, expr, value, ddl="v string"):
    return spark.createDataFrame([(value,)], ddl).select(expr.alias("o")).first()["o"]


@pytest.mark.parametrize("raw,expected", [
    (" bengaluru ", "Bangalore"), ("Bangalore", "Bangalore"), ("NEW DELHI", "Delhi"), ("delhi", "Delhi"),
    ("bombay", "Mumbai"), ("new york", "New york"), ("pUNE", "Pune"), (None, None), ("", ""),
])
def test_standardise_city(spark, raw, expected):
    assert one(spark, X.standardise_city("v"), raw) == expected


@pytest.mark.parametrize("precip,tmax,silver,ingest", [
    (15.0, 30.0, "light_rain", "heavy_rain"),   # D1: 15 is heavy at ingest, light in silver
    (15.1, 30.0, "heavy_rain", "heavy_rain"),
    (2.5, 40.0, "hot", "clear"),                 # 2.5 is dry; 40 is not > 40
    (0.0, 42.0, "extreme_heat", "extreme_heat"),
    (5.0, 28.0, "light_rain", "light_rain"),
    (0.0, 28.0, "normal", "clear"),
    (None, None, "normal", "clear"),             # N7: NULL falls through to the default
    (0.0, 35.0, "normal", "clear"),
])
def test_classify_weather(spark, precip, tmax, silver, ingest):
    df = spark.createDataFrame([(precip, tmax)], "p double, t double")
    r = df.select(X.classify_weather(F.col("p"), F.col("t")).alias("s"),
                  X.classify_weather(F.col("p"), F.col("t"), X.INGEST_THRESHOLDS).alias("i")).first()
    assert (r["s"], r["i"]) == (silver, ingest)


def test_nan_is_cleaned_before_classification(spark):
    df = spark.createDataFrame([(float("nan"),)], "p double")
    raw = df.select(X.classify_weather(F.col("p"), F.lit(20.0)).alias("c")).first()["c"]
    assert raw == "heavy_rain"  # N1: Spark orders NaN above every number
    clean = X.nan_to_null("p")
    r = df.select(X.classify_weather(clean, F.lit(20.0)).alias("c"), X.is_rainy(clean).alias("r")).first()
    assert (r["c"], r["r"]) == ("normal", False)


@pytest.mark.parametrize("p,expected", [(0.0, False), (2.5, False), (5.0, True), (None, False)])
def test_is_rainy_boundary(spark, p, expected):
    assert one(spark, X.is_rainy("v"), p, "v double") is expected


@pytest.mark.parametrize("d,season,monsoon", [
    (dt.date(2023, 10, 5), "POST_MONSOON", True),   # D2: October is both
    (dt.date(2023, 6, 1), "MONSOON", True),
    (dt.date(2023, 12, 1), "WINTER", False),
    (dt.date(2023, 3, 1), "SPRING", False),
    (None, None, False),
])
def test_season_and_monsoon(spark, d, season, monsoon):
    df = spark.createDataFrame([(d,)], "d date")
    r = df.select(X.season("d").alias("s"), X.monsoon_month("d").alias("m")).first()
    assert (r["s"], r["m"]) == (season, monsoon)


def test_extreme_and_range(spark):
    df = spark.createDataFrame([("heavy_rain", 30.0, 20.0), ("hot", None, 20.0), (None, 1.0, 0.5)],
                               "c string, a double, b double")
    got = [tuple(r) for r in df.select(X.is_extreme_weather("c"), X.temperature_range("a", "b")).collect()]
    assert got == [(True, 10.0), (False, None), (False, 0.5)]


@pytest.mark.parametrize("rating,tier", [
    (4.5, "EXCELLENT"), (4.0, "GOOD"), (3.5, "AVERAGE"), (3.0, "BELOW_AVERAGE"), (2.9, "POOR"),
    (0.0, "POOR"), (None, None)])
def test_rating_tier(spark, rating, tier):
    assert one(spark, X.rating_tier("v"), rating, "v double") == tier


@pytest.mark.parametrize("value,expected", [(5.1, None), (-1.0, None), (None, None), (0.0, 0.0), (5.0, 5.0)])
def test_between_or_null(spark, value, expected):
    assert one(spark, X.between_or_null("v", 0, 5), value, "v double") == expected


@pytest.mark.parametrize("pr,tier", [(1, "BUDGET"), (2, "AFFORDABLE"), (3, "PREMIUM"), (4, "LUXURY"),
                                     (5, None), (None, None)])
def test_price_tier(spark, pr, tier):
    assert one(spark, X.price_tier("v"), pr, "v bigint") == tier


@pytest.mark.parametrize("cuisines,primary,indian", [
    (" Biryani , Thai", "Biryani", True), ("Italian", "Italian", False), (None, None, False),
    ("", "", False), ("North Indian, Chinese", "North Indian", True), ("south indian", "south indian", True),
])
def test_cuisine_helpers(spark, cuisines, primary, indian):
    df = spark.createDataFrame([(cuisines,)], "v string")
    r = df.select(X.first_list_item("v").alias("p"), X.is_indian_cuisine("v").alias("i")).first()
    assert (r["p"], r["i"]) == (primary, indian)


def test_safe_divide(spark):
    df = spark.createDataFrame([(10.0, 2.0), (1.0, 0.0), (1.0, None), (None, 4.0)], "n double, d double")
    assert [r[0] for r in df.select(X.safe_divide("n", "d")).collect()] == [5.0, None, None, None]


@pytest.mark.parametrize("base,factor,expected", [
    (500.0, 0.45, 220.0),    # 225 -> 22.5 -> half-even 22 -> 220
    (0.0, 1.0, 300.0),       # non-positive base falls back to 300
    (20.0, 1.0, 80.0),       # clamp low
    (9999.0, 1.0, 3500.0),   # clamp high
    (350.0, 1.0, 350.0),
])
def test_order_amount(spark, base, factor, expected):
    df = spark.createDataFrame([(base, factor)], "b double, f double")
    got = df.select(X.order_amount("b", "f")).first()[0]
    assert got == expected
    py = min(max(round(((base if base > 0 else 300.0) * factor) / 10) * 10, 80), 3500)
    assert got == py


@pytest.mark.parametrize("header,snake", [
    ("Restaurant ID", "restaurant_id"), ("Average Cost for two", "average_cost_for_two"),
    ("hasOnlineDelivery", "has_online_delivery"), ("  Rating text ", "rating_text"),
    ("Switch to order menu", "switch_to_order_menu"),
])
def test_snake_case(header, snake):
    assert X.snake_case(header) == snake


def test_clean_strings(spark):
    df = spark.createDataFrame([(" Le Petit Souffle ", 1), ("", 2), ("\t x\n", 3), (None, 4)], "s string, n int")
    assert [r[0] for r in X.clean_string_columns(df).orderBy("n").collect()] == ["Le Petit Souffle", None, "x", None]


@pytest.mark.parametrize("text,expected", [("TRUE", True), (" false ", False), ("yes", None), (None, None)])
def test_text_to_bool(spark, text, expected):
    assert one(spark, X.text_to_bool("v"), text) is expected


def test_weekday_weekend_and_hour(spark):
    df = spark.createDataFrame([(dt.datetime(2023, 1, 1, 12, 30),), (dt.datetime(2023, 1, 2, 9, 0),), (None,)],
                               "t timestamp_ntz")
    got = [tuple(r) for r in df.select(X.day_of_week_mon0("t"), X.is_weekend("t"), X.hour_of("t")).collect()]
    assert got == [(6, True, 12), (0, False, 9), (None, False, None)]


def test_status_flags(spark):
    df = spark.createDataFrame([("delivered",), ("Cancelled",), (None,)], "s string")
    flags = X.status_flags("s")
    got = [tuple(r) for r in df.select(*[c.alias(n) for n, c in flags.items()]).collect()]
    assert got == [(False, True, False), (True, False, False), (False, False, False)]


def test_surrogate_key_matches_duckdb(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b")], "k bigint, s string")
    got = [r[0] for r in df.select(X.surrogate_key(["k", "s"])).collect()]
    con = duckdb.connect()
    want = [con.execute("select md5(concat_ws('-', coalesce(cast(? as varchar), '_dbt_utils_surrogate_key_null_'),"
                        " coalesce(?, '_dbt_utils_surrogate_key_null_')))", [k, s]).fetchone()[0]
            for k, s in [(1, "a"), (None, "b")]]
    assert got == want


def test_lookups(spark):
    df = spark.createDataFrame([("Delhi", "PIZZA"), ("Goa", "thai"), (None, None)], "c string, q string")
    from strata.operators.demand import CITY_DAILY_ORDER_MULTIPLIERS, CUISINE_ORDER_MULTIPLIERS

    got = [tuple(r) for r in df.select(
        X.lookup("c", CITY_DAILY_ORDER_MULTIPLIERS, default=1.0),
        X.lookup("q", CUISINE_ORDER_MULTIPLIERS, default=1.0, case_insensitive=True),
        X.weather_description(F.lit(65)), X.weather_description(F.lit(7))).collect()]
    assert got == [(1.8, 1.4, "Heavy rain", None), (1.0, 1.0, "Heavy rain", None), (1.0, 1.0, "Heavy rain", None)]


def test_replace_values_case_sensitive(spark):
    df = spark.createDataFrame([("Bengaluru",), ("bengaluru",), ("New Delhi",), ("Ahmedabad",)], "v string")
    got = [r[0] for r in df.select(X.replace_values("v", {"Bengaluru": "Bangalore", "New Delhi": "Delhi"})).collect()]
    assert got == ["Bangalore", "bengaluru", "Delhi", "Ahmedabad"]


def test_knockout_and_label(spark):
    df = spark.createDataFrame([(" Final ", "A", "B"), ("league", "A", None), (None, None, None)],
                               "m string, a string, b string")
    got = [tuple(r) for r in df.select(X.is_knockout("m"), X.pair_label("a", "b")).collect()]
    assert got == [(True, "A vs B"), (False, None), (False, None)]
    assert not math.isnan(1.0)
