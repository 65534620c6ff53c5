"""Data-quality checks: NULL rules, one-pass evaluation, freshness (DQ*, AGG10, B5)."""

import datetime as dt

from strata.operators import quality as q
from strata.operators.aggregates import freshness


def report(df, checks):
    return {r["check_name"]: (r["failing_rows"], r["status"]) for r in q.run_checks(df, checks).collect()}


def test_null_rules(spark):
    df = spark.createDataFrame([(1, "A", 1.0), (1, None, None), (None, "Z", 9.0), (None, "B", 2.0)],
                               "k int, s string, x double")
    got = report(df, [q.not_null("k"), q.unique("k"), q.accepted_values("s", ["A", "B"]),
                      q.between("x", 0, 5), q.row_count_between(0, 3),
                      q.proportion_unique_between("s", 0.0, 0.5)])
    assert got["not_null_k"] == (2, "error")
    assert got["unique_k"] == (1, "error")            # NULLs ignored, 1 duplicated value
    assert got["accepted_values_s"] == (1, "error")   # NULL passes, Z fails
    assert got["between_x"] == (1, "error")           # NULL passes, 9 fails
    assert got["row_count_between"] == (1, "error")   # 4 rows > 3
    assert got["proportion_unique_s"] == (1, "error")  # 3 distinct / 3 = 1.0 > 0.5


def test_row_checks_are_one_aggregate(spark):
    df = spark.range(100).selectExpr("id", "id % 7 as m")
    checks = [q.not_null("id"), q.between("m", 0, 5), q.expression("big", "id > 90"),
              q.accepted_values("m", [0, 1, 2])]
    out = q.run_checks(df, checks)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") == 2 and "Exchange" in plan   # one partial + one final
    got = {r["check_name"]: r["failing_rows"] for r in out.collect()}
    assert got == {"not_null_id": 0, "between_m": 14, "big": 9, "accepted_values_m": 56}


def test_relationships_and_severity(spark):
    child = spark.createDataFrame([(1,), (2,), (None,), (2,)], "fk int")
    parent = spark.createDataFrame([(1,)], "pk int")
    c = q.relationships("fk", parent, "pk")
    c.severity = "warn"
    assert report(child, [c]) == {"relationships_fk": (2, "warn")}
    assert q.failing_rows(child, c).count() == 2


def test_freshness_b5(spark):
    as_of = "2024-01-10 12:00:00"
    for hours_old, status in [(12, "pass"), (36, "warn"), (60, "error")]:
        ts = dt.datetime(2024, 1, 10, 12) - dt.timedelta(hours=hours_old)
        df = spark.createDataFrame([(ts,)], "t timestamp_ntz")
        r = freshness(df, "t", as_of, 24.0, 48.0).first()
        assert (r["status"], r["age_hours"]) == (status, float(hours_old))
    empty = spark.createDataFrame([], "t timestamp_ntz")
    assert freshness(empty, "t", as_of, 24.0, 48.0).first()["status"] == "error"
    warn_only = spark.createDataFrame([(dt.datetime(2024, 1, 1),)], "t timestamp_ntz")
    assert freshness(warn_only, "t", as_of, 72.0, None).first()["status"] == "warn"


def test_source_freshness_with_lookback(spark):
    from strata.plans import silver
    from tests.fixtures import a3_festivals, b1_orders, b2_weather

    bronze = {"raw_orders": b1_orders(spark), "raw_weather": b2_weather(spark),
              "raw_festival_calendar": a3_festivals(spark)}
    got = {r["source"]: r["status"] for r in silver.source_freshness(bronze, "2023-01-06 12:00:00").collect()}
    # orders: newest _generated_at 2023-01-06 10:00 -> 2 h old; weather: 1.1 days (< 3 d warn)
    assert got == {"raw_orders": "pass", "raw_weather": "pass", "raw_festival_calendar": "pass"}
    late = {r["source"]: r["status"] for r in silver.source_freshness(bronze, "2023-05-01 00:00:00").collect()}
    # orders dated before the 90-day look-back are filtered out -> no rows -> error
    assert late == {"raw_orders": "error", "raw_weather": "warn", "raw_festival_calendar": "warn"}


def test_left_join_two_keys(spark):
    from strata.operators.joins import left_join

    left = spark.createDataFrame([("a", 1, 10), ("a", 2, 20), ("b", 1, 30), (None, 1, 40)], "c string, d int, x int")
    right = spark.createDataFrame([("a", 1, "w1"), ("b", 1, "w2")], "city string, day int, w string")
    got = sorted((tuple(r) for r in left_join(left, right, [("c", "city"), ("d", "day")]).collect()), key=repr)
    assert got == sorted([("a", 1, 10, "w1"), ("a", 2, 20, None), ("b", 1, 30, "w2"), (None, 1, 40, None)], key=repr)
