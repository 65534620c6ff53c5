"""Silver models (MD1-MD6) on the fixtures of FIXTURES.md part B."""

import datetime as dt

from pyspark.sql import functions as F

from strata.operators import quality
from strata.plans import silver
from tests.fixtures import a2_ipl, a3_festivals, b1_orders, b2_weather, b3_restaurants


def by_key(df, key):
    return {r[key]: r.asDict() for r in df.collect()}


def test_stg_orders_b1(spark):
    out = by_key(silver.stg_orders(b1_orders(spark)), "order_id")
    # latest wins; latest outlier removes the key altogether; bounds; start; null key
    assert out["o1"]["order_amount_inr"] == 200.0
    assert (out["o1"]["order_day_of_week"], out["o1"]["is_weekend"], out["o1"]["order_hour"],
            out["o1"]["order_status"]) == (6, True, 12, "DELIVERED")
    assert "o2" not in out
    assert "o3" in out and "o4" not in out and "o5" not in out
    assert "o6" not in out and None not in out
    o7 = out["o7"]
    assert o7["order_hour"] is None and o7["order_day_of_week"] is None
    assert (o7["is_weekend"], o7["is_cancelled"], o7["is_delivered"], o7["is_refund_requested"]) == (
        False, False, False, False)
    assert "o8" in out and out["o9"]["is_cancelled"] is True


def test_dedup_independent_of_partitioning(spark):
    raw = b1_orders(spark)
    a = sorted(map(tuple, silver.stg_orders(raw.repartition(1)).collect()), key=repr)
    b = sorted(map(tuple, silver.stg_orders(raw.repartition(7)).collect()), key=repr)
    c = sorted(map(tuple, silver.stg_orders(raw.orderBy(F.rand(3))).collect()), key=repr)
    assert a == b == c
    # idempotent: cleaning the cleaned output's dedup again changes nothing
    from strata.operators.dedup import keep_latest
    once = silver.stg_orders(raw)
    twice = keep_latest(once, ["order_id"], "_generated_at")
    assert sorted(map(tuple, once.collect()), key=repr) == sorted(map(tuple, twice.collect()), key=repr)


def test_dq_singular_tests_on_orders(spark):
    orders = silver.stg_orders(b1_orders(spark))
    restaurants = silver.stg_restaurants(b3_restaurants(spark))
    report = {r["check_name"]: r["failing_rows"] for r in
              quality.run_checks(orders, silver.silver_checks(restaurants)["stg_orders"]).collect()}
    assert report["assert_delivery_time_positive_for_delivered"] == 1   # o8
    assert report["assert_no_negative_order_amounts"] == 0
    assert report["unique_order_id"] == 0
    assert report["accepted_values_order_status"] == 0


def test_stg_weather_b2(spark):
    rows = silver.stg_weather(b2_weather(spark)).collect()
    got = {(r["city"], r["weather_date"]): r for r in rows}
    b = got[("Bangalore", dt.date(2023, 10, 5))]
    assert (b["weather_category"], b["monsoon_month"], b["season"], b["temperature_range"],
            b["is_extreme_weather"]) == ("light_rain", True, "POST_MONSOON", 10.0, False)
    d = got[("Delhi", dt.date(2023, 6, 1))]
    assert (d["weather_category"], d["season"], d["is_extreme_weather"]) == ("extreme_heat", "MONSOON", True)
    m = got[("Mumbai", dt.date(2023, 12, 1))]
    assert (m["weather_category"], m["season"]) == ("hot", "WINTER")
    ny = got[("New york", dt.date(2023, 3, 1))]
    assert (ny["weather_category"], ny["season"]) == ("normal", "SPRING")
    p = got[("Pune", dt.date(2023, 7, 1))]
    assert (p["weather_category"], p["temperature_range"], p["precipitation_sum"]) == ("normal", None, None)
    assert got[("Pune", dt.date(2023, 7, 2))]["weather_category"] == "heavy_rain"  # last fetch wins
    # D4: both spellings survive the dedup, and the uniqueness check reports it.
    assert sum(1 for r in rows if r["city"] == "Bangalore" and r["weather_date"] == dt.date(2023, 1, 1)) == 2
    report = {r["check_name"]: r["failing_rows"] for r in quality.run_checks(
        silver.stg_weather(b2_weather(spark)), [quality.unique(["city", "weather_date"])]).collect()}
    assert report["unique_city_weather_date"] == 1


def test_stg_restaurants_b3(spark):
    raw = b3_restaurants(spark)
    out = by_key(silver.stg_restaurants(raw), "restaurant_id")
    assert None not in out
    assert out[1]["cuisine_primary"] == "Biryani" and out[1]["cuisine_is_indian"] is True
    assert out[2]["cuisine_primary"] is None and out[2]["cuisine_is_indian"] is False
    assert out[3]["cuisine_primary"] == ""
    assert [out[i]["price_tier"] for i in (1, 2, 3, 4, 5, 6)] == [
        "BUDGET", "AFFORDABLE", "PREMIUM", "LUXURY", None, None]
    assert out[1]["restaurant_name"] == "R1" and out[1]["cost_per_person"] == 250.0
    assert out[7]["aggregate_rating"] is None and out[8]["aggregate_rating"] is None
    assert out[10]["votes"] == 20                      # higher votes win
    assert out[11]["aggregate_rating"] == 2.0          # equal votes: later ingest wins
    assert out[12]["votes"] == 1                       # NULL votes lose
    ratings = by_key(silver.stg_restaurant_ratings(raw), "restaurant_id")
    assert [ratings[i]["rating_tier"] for i in (1, 2, 3, 4, 5, 6, 7, 9)] == [
        "EXCELLENT", "GOOD", "AVERAGE", "BELOW_AVERAGE", "POOR", "POOR", None, None]
    assert ratings[1]["valid_from"] == dt.date(2020, 1, 1) and ratings[1]["valid_to"] is None
    assert ratings[1]["is_current"] is True


def test_shared_dedup_matches_separate(spark):
    raw = b3_restaurants(spark)
    d = silver.dedup_restaurants(raw)
    a = sorted(map(tuple, silver.stg_restaurants(raw, d).collect()), key=repr)
    b = sorted(map(tuple, silver.stg_restaurants(raw).collect()), key=repr)
    assert a == b


def test_stg_ipl_and_festivals(spark):
    ipl = silver.stg_ipl_schedule(a2_ipl(spark)).collect()
    assert len(ipl) == 4
    latest = [r for r in ipl if r["match_number"] == 3][0]
    assert latest["match_type"] == "league" and latest["match_label"] == "RCB vs MI"
    final = [r for r in ipl if r["match_number"] == 70][0]
    assert final["is_knockout"] is True and final["venue_city"] == "Ahmedabad"
    assert [r for r in ipl if r["match_number"] == 69][0]["match_label"] is None
    fest = silver.stg_festival_calendar(a3_festivals(spark)).collect()
    assert len(fest) == 4
    diwali = [r for r in fest if r["festival_name"] == "Diwali"][0]
    assert (diwali["festival_type"], diwali["region"], diwali["festival_year"], diwali["festival_month"]) == (
        "RELIGIOUS", "ALL", 2023, 11)


def test_festival_and_match_day_flags(spark):
    fest = silver.stg_festival_calendar(a3_festivals(spark))
    days = spark.createDataFrame([(dt.date(2023, 11, 12), "Delhi"), (dt.date(2023, 1, 26), "Delhi"),
                                  (dt.date(2023, 4, 2), "Bangalore"), (None, "Delhi")], "d date, city string")
    flagged = silver.is_festival_day(days, "d", fest)
    flagged = silver.is_festival_day(flagged, "d", fest, major_only=True, flag="is_major_festival")
    flagged = silver.is_ipl_match_day(flagged, "d", "city", silver.stg_ipl_schedule(a2_ipl(spark)))
    got = sorted(((r["d"], r["is_festival_day"], r["is_major_festival"], r["is_ipl_match_day"])
                  for r in flagged.collect()), key=repr)
    # two festivals on 2023-11-12: one row, flag true once (no fan-out)
    assert got == sorted([(dt.date(2023, 11, 12), True, True, False), (dt.date(2023, 1, 26), True, False, False),
                          (dt.date(2023, 4, 2), False, False, True), (None, False, False, False)], key=repr)


def test_weather_coverage(spark):
    orders = silver.stg_orders(b1_orders(spark))
    weather = silver.stg_weather(b2_weather(spark))
    gaps = silver.weather_coverage(orders, weather).collect()
    # D3: orders keep the raw city; none of the fixture dates have Delhi weather
    assert [(r["city"], r["order_date"], r["orders_without_weather"]) for r in gaps][0] == (
        "Delhi", dt.date(2023, 1, 2), 4)   # o3, o7, o8, o9
    assert sum(r["orders_without_weather"] for r in gaps) == orders.count()


def test_plan_has_partial_window_limit_and_no_python(spark):
    plan = silver.stg_orders(b1_orders(spark))._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
