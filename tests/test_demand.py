"""Expected demand (MD13, MD14) on the generator fixture A5."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata.operators.demand import cuisine_category, expected_demand, hour_weights, hourly_profile


@pytest.fixture()
def restaurants(spark):
    df = spark.createDataFrame([(1, "Bangalore", "North Indian, Chinese"), (2, "Delhi", "Biryani"),
                                (3, "Mumbai", "Pizza, Fast Food"), (4, "Pune", "South Indian"),
                                (5, "Goa", None)], "restaurant_id bigint, city string, cuisines string")
    return df.withColumn("cuisine_category", cuisine_category("cuisines"))


def test_expected_demand_a5(spark, restaurants):
    out = expected_demand(restaurants, "2023-01-01", "2023-01-07")
    got = {(r["restaurant_id"], r["order_date"]): r["expected_orders"] for r in out.collect()}
    assert len(got) == 35
    mon, sun = dt.date(2023, 1, 2), dt.date(2023, 1, 1)
    assert got[(1, mon)] == pytest.approx(19.25)
    assert got[(1, sun)] == pytest.approx(25.9875)
    assert got[(2, mon)] == pytest.approx(13.86)
    assert got[(3, mon)] == pytest.approx(9.8)
    assert got[(4, mon)] == pytest.approx(10.5)
    assert got[(5, mon)] == pytest.approx(3.5)          # default city, 'others' cuisine


def test_expected_demand_rainy_join_no_fanout(spark, restaurants):
    rain = spark.createDataFrame([("Bangalore", dt.date(2023, 1, 2), True), ("Bangalore", dt.date(2023, 1, 2), False),
                                  ("Delhi", dt.date(2023, 1, 2), None)],
                                 "city string, weather_date date, is_rainy boolean")
    out = expected_demand(restaurants, "2023-01-01", "2023-01-07", rainy=rain)
    assert out.count() == 35
    got = {(r["restaurant_id"], r["order_date"]): r["expected_orders"] for r in out.collect()}
    assert got[(1, dt.date(2023, 1, 2))] == pytest.approx(19.25 * 1.25)
    assert got[(2, dt.date(2023, 1, 2))] == pytest.approx(13.86)


def test_hourly_profile(spark):
    weights = dict(hour_weights())
    assert sum(weights.values()) == 37 and weights[12] == 3 and weights[20] == 4 and weights[0] == 1
    daily = spark.createDataFrame([("x", 37.0)], "k string, expected_orders double")
    hourly = {r["order_hour"]: r["expected_orders_hour"] for r in hourly_profile(daily).collect()}
    assert hourly[13] == pytest.approx(3.0) and hourly[21] == pytest.approx(4.0) and hourly[5] == pytest.approx(1.0)
    plan = hourly_profile(daily)._jdf.queryExecution().executedPlan().toString()
    assert "Generate" in plan and "Join" not in plan
    assert daily.select(F.lit(1)).count() == 1
