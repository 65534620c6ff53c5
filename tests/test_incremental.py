"""High-water marks, next ranges and append-only-new (INC1, INC2, JN5, SNK9, B5)."""

import datetime as dt
import os

import pytest

from strata.plans import ingest
from strata.schemas import RAW_ORDERS
from strata.sinks.landing import land_table
from strata.session import local_path, scratch_path
from strata.streaming.incremental import WatermarkError, WatermarkStore, next_range, next_ranges
from tests.fixtures import frame, order


@pytest.mark.parametrize("last,expected", [
    (None, ("2023-01-09", "2023-01-15")), ("2023-01-10", ("2023-01-11", "2023-01-15")), ("2023-01-15", None)])
def test_next_range_b5(last, expected):
    assert next_range(last, "2023-01-15") == expected


def test_next_ranges_frame(spark):
    sources = spark.createDataFrame([("weather",), ("ipl",), ("orders",)], "source_name string")
    state = spark.createDataFrame([("weather", dt.date(2023, 1, 10)), ("orders", dt.date(2023, 1, 15))],
                                  "source_name string, watermark_date date")
    got = {r["source_name"]: (r["start_date"], r["end_date"], r["is_empty"], r["n_days"])
           for r in next_ranges(sources, state, "2023-01-15").collect()}
    assert got["weather"] == (dt.date(2023, 1, 11), dt.date(2023, 1, 15), False, 5)
    assert got["ipl"] == (dt.date(2023, 1, 9), dt.date(2023, 1, 15), False, 7)
    assert got["orders"][2] is True and got["orders"][3] == 0


def test_watermark_store(spark):
    store = WatermarkStore(spark, scratch_path(spark, "t-wm"))
    assert store.get("weather") is None and store.get_all() == {}
    store.set("weather", "2023-01-10")
    store.set("ipl_schedule", "2023-01-15")
    store.set("weather", "2023-01-12")
    assert store.get("weather") == "2023-01-12"
    assert store.get_all() == {"weather": "2023-01-12", "ipl_schedule": "2023-01-15"}
    landed = spark.createDataFrame([("delhi", dt.date(2023, 1, 14)), ("pune", dt.date(2023, 1, 13)),
                                    ("delhi", dt.date(2023, 1, 13))], "city string, d date")
    marks = {r["watermark_key"]: r["watermark_date"].isoformat()
             for r in store.advance_from(landed, "weather", "city", "d").collect()}
    assert marks == {"delhi": "2023-01-14", "pune": "2023-01-13"}
    assert store.get("weather", "pune") == "2023-01-13" and store.get("weather") == "2023-01-12"


def test_corrupt_watermark_raises(spark):
    path = scratch_path(spark, "t-wm-bad")
    os.makedirs(local_path(path), exist_ok=True)
    with open(os.path.join(local_path(path), "part-0.json"), "w") as fh:
        fh.write("{not json\n")
    with pytest.raises(WatermarkError):
        WatermarkStore(spark, path).get("weather")


def test_ingest_orders_appends_only_new_b5(spark):
    d = dt.date(2023, 1, 2)
    at = dt.datetime(2023, 1, 2, 10)
    src = scratch_path(spark, "t-orders-src")
    bronze = scratch_path(spark, "t-orders-bronze")
    audit = scratch_path(spark, "t-orders-audit")
    land_table(frame(spark, RAW_ORDERS, [order("o2", d, at, 10.0)]), "raw_orders", bronze)
    batch = frame(spark, RAW_ORDERS, [order(o, d, at, 10.0) for o in ("o1", "o2", "o3")])
    batch.write.partitionBy("order_date").parquet(src)
    r = ingest.ingest_orders(spark, src, bronze, audit)
    assert (r["batch_rows"], r["rows_processed"], r["rows_rejected"], r["status"]) == (3, 2, 1, "PARTIAL")
    assert sorted(x["order_id"] for x in spark.read.parquet(bronze).collect()) == ["o1", "o2", "o3"]
    r2 = ingest.ingest_orders(spark, src, bronze, audit)          # everything exists now
    assert (r2["rows_processed"], r2["rows_rejected"]) == (0, 3)
    assert spark.read.parquet(bronze).count() == 3
    statuses = sorted(x["status"] for x in spark.read.parquet(audit).collect())
    assert statuses == ["PARTIAL", "PARTIAL"]


def test_ingest_orders_of_other_file_types(spark):
    """Ids as numbers and times as text, as a pandas writer lands them; an id that is no number is counted."""
    src, bronze, audit = (scratch_path(spark, n) for n in ("t-typed-src", "t-typed-bronze", "t-typed-audit"))
    (spark.createDataFrame([("a1", 7, 70, "2023-01-02T10:00:00", "2023-01-02", "5"), ("a2", 8, 80, "not a time", "2023-02-02", "x")],
                           "order_id string, restaurant_id bigint, customer_id bigint, order_datetime string, order_date string, "
                           "delivery_time_mins string").write.parquet(src))
    r = ingest.ingest_orders(spark, src, bronze, audit)
    assert (r["rows_processed"], r["rows_unparsed"], r["status"]) == (2, 1, "PARTIAL") and r["rows_rejected"] == 1
    audited = spark.read.parquet(audit).first()
    assert (audited["rows_processed"], audited["rows_rejected"], audited["status"]) == (2, 1, "PARTIAL")
    again = ingest.ingest_orders(spark, src, bronze, audit)  # there already, one of them unparsed as well
    assert (again["rows_processed"], again["rows_rejected"], again["rows_unparsed"]) == (0, 2, 1)
    got = {x["order_id"]: x for x in spark.read.schema(RAW_ORDERS).parquet(bronze).collect()}
    assert got["a1"]["customer_id"] == "70" and got["a1"]["order_datetime"] == dt.datetime(2023, 1, 2, 10)
    assert got["a2"]["order_datetime"] is None and got["a2"]["delivery_time_mins"] is None
    assert sorted(n for n in os.listdir(local_path(bronze)) if "=" in n) == ["order_month=2023-01-01", "order_month=2023-02-01"]


def test_marks_survive_a_crash_and_never_move_back(spark):
    path = scratch_path(spark, "t-wm-crash")
    store = WatermarkStore(spark, path)
    store.set("weather", "2023-01-10")
    os.makedirs(os.path.join(local_path(path), "version=000099"))  # a write that was never committed
    assert store.get("weather") == "2023-01-10"
    older = spark.createDataFrame([("delhi", dt.date(2023, 1, 5))], "city string, d date")
    store.set("weather", "2023-01-09", "delhi")
    assert [r["watermark_date"] for r in store.advance_from(older, "weather", "city", "d").collect()] == [dt.date(2023, 1, 9)]
    for d in ("2023-01-11", "2023-01-12"):
        store.set("weather", d)
    assert store.get("weather") == "2023-01-12" and len(store._versions()) == 2


def test_two_updates_at_once_keep_both_marks(spark):
    path = scratch_path(spark, "t-wm-two")
    WatermarkStore(spark, path).set("weather", "2023-01-01", "delhi")
    first, second = WatermarkStore(spark, path), WatermarkStore(spark, path)
    listed, plain = [], first._versions

    def late():  # the other run comes between this one's listing and its write
        found = plain()
        if not listed:
            listed.append(1)
            second.set("weather", "2023-01-05", "pune")
        return found

    first._check_corrupt = lambda: None
    first._versions = late
    first.set("weather", "2023-01-07", "agra")
    store = WatermarkStore(spark, path)
    assert {k: store.get("weather", k) for k in ("delhi", "pune", "agra")} == {"delhi": "2023-01-01", "pune": "2023-01-05", "agra": "2023-01-07"}
    # a mark that moved on meanwhile is not set back
    landed = spark.createDataFrame([("pune", dt.date(2023, 1, 3))], "city string, d date")
    assert [r["watermark_date"] for r in store.advance_from(landed, "weather", "city", "d").collect()] == [dt.date(2023, 1, 5)]
