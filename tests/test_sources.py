"""Sources and ingest flows on the reference's fixtures (A1-A4, B5)."""

import csv
import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from strata.plans import ingest
from strata.schemas import RESTAURANT_CSV_COLUMNS
from strata.session import scratch_path
from strata.sources.csv import SchemaValidationError, validate_contract
from strata.sources.json_payload import flatten_weather, read_payloads, split_valid
from tests.conftest import rows

INGESTED_AT = "2024-02-01 00:00:00"


def write_csv(path, header, data, encoding="utf-8"):
    with open(path, "w", newline="", encoding=encoding) as fh:
        w = csv.writer(fh)
        w.writerow(header)
        w.writerows(data)
    return str(path)


def restaurant_csv(tmp_path, drop=()):
    header = [c for c in RESTAURANT_CSV_COLUMNS if c not in drop]
    base = {
        40: [40, "\tCafé Zoë, Koramangala  ", 1, "Bengaluru", "12/1, 4th \"A\" Cross", "Koramangala", " ", 77.62, 12.93,
             "Café, Desserts", 0, "Rs", "No", "Yes", "Yes", "No", 2, 0.0, "White", "Not rated", 0],
        17: [17, "Öl & Brot", 30, "Curitiba", "Rua 9", "Centro", "Centro, Curitiba", -49.27, -25.43, "German", 80, "R$", "Yes",
             "No", "No", "No", 3, 3.9, "Yellow", "Good", 7],
        63: [63, "Jalsa", 1, "Pune", "", "   ", "Baner, Pune", 73.79, 18.56, "Mughlai", 1450, "Rs", "Yes", "No",
             "No", "No", 4, 4.1, "Green", "Very Good", 2041],
    }
    idx = [RESTAURANT_CSV_COLUMNS.index(c) for c in header]
    data = [[row[i] for i in idx] for row in base.values()]
    return write_csv(tmp_path / "restaurants.csv", header, data, encoding="latin-1")


def test_restaurant_contract_missing_columns_raise(spark, tmp_path):
    path = restaurant_csv(tmp_path, drop=("Votes", "Cuisines"))
    with pytest.raises(SchemaValidationError, match="Votes"):
        validate_contract(spark, path, RESTAURANT_CSV_COLUMNS, "ISO-8859-1")


def test_ingest_restaurants_a1(spark, tmp_path):
    path = restaurant_csv(tmp_path)
    root = scratch_path(spark, "test-landing")
    bronze = scratch_path(spark, "test-raw-restaurants")
    audit = scratch_path(spark, "test-audit")
    m = ingest.ingest_restaurants(spark, path, root, bronze, audit, "2024-02-01", INGESTED_AT)
    assert (m["row_count"], m["indian_rows"], m["rows_dropped"]) == (3, 2, 1)
    landed = spark.read.parquet(m["landing"])
    assert {"restaurant_id", "average_cost_for_two", "has_online_delivery", "locality_verbose"} <= set(
        landed.columns)
    got = {r["restaurant_id"]: r for r in spark.read.parquet(bronze).collect()}
    assert sorted(got) == [40, 63]
    assert got[40]["restaurant_name"] == "Café Zoë, Koramangala"      # trimmed, Latin-1 decoded
    assert got[40]["address"] == '12/1, 4th "A" Cross' and got[63]["address"] is None
    assert got[63]["locality"] is None                                # blank -> NULL
    assert got[63]["has_table_booking"] is True and got[40]["has_table_booking"] is False  # D8
    assert got[40]["_source_file"] == "restaurants.csv" and got[40]["_ingestion_date"] == dt.date(2024, 2, 1)
    assert spark.read.parquet(audit).first()["status"] == "SUCCESS"


def test_ingest_ipl_a2(spark, tmp_path):
    header = ["match_date", "season", "match_number", "team1", "team2", "venue_city", "match_type", "winner"]
    data = [["2023-04-02", 2023, 3, "Royal Challengers Bangalore", "Mumbai Indians", "Bengaluru", "league",
             "Mumbai Indians"],
            ["2023-04-09", 2023, 10, "Delhi Capitals", "Punjab Kings", "New Delhi", "league", "Punjab Kings"],
            ["2023-05-28", 2023, 70, "Chennai Super Kings", "Gujarat Titans", "Ahmedabad", "final",
             "Chennai Super Kings"]]
    path = write_csv(tmp_path / "ipl.csv", header, data)
    bronze, audit, marks = (scratch_path(spark, n) for n in ("t-ipl", "t-audit", "t-marks"))
    m = ingest.ingest_ipl(spark, path, bronze, audit, marks, "2024-02-01", INGESTED_AT)
    assert (m["row_count"], m["service_city_rows"]) == (3, 2)
    got = [(r["venue_city"], r["is_service_city"]) for r in spark.read.parquet(bronze).orderBy("match_date").collect()]
    assert got == [("Bangalore", True), ("Delhi", True), ("Ahmedabad", False)]
    bad = write_csv(tmp_path / "ipl_bad.csv", header[:4], [r[:4] for r in data])
    with pytest.raises(SchemaValidationError):
        ingest.ingest_ipl(spark, bad, bronze, audit, marks, "2024-02-01", INGESTED_AT)
    statuses = [r["status"] for r in spark.read.parquet(audit).collect()]
    assert sorted(statuses) == ["FAILURE", "SUCCESS"]   # extraction errors are audited too


def test_ingest_festivals_a3(spark, tmp_path):
    header = ["festival_date", "festival_name", "festival_type", "region", "is_major"]
    data = [["2023-11-12", "Diwali", "religious", "all", "TRUE"],
            ["2023-01-26", "Republic Day", "national", "all", "FALSE"],
            ["2023-01-15", "Pongal", "regional", "south", "FALSE"]]
    path = write_csv(tmp_path / "fest.csv", header, data)
    bronze, audit, marks = (scratch_path(spark, n) for n in ("t-fest", "t-audit2", "t-marks2"))
    m = ingest.ingest_festivals(spark, path, bronze, audit, marks, "2024-02-01", INGESTED_AT)
    assert (m["row_count"], m["major_festival_count"]) == (3, 1)
    got = spark.read.parquet(bronze).orderBy("festival_date").collect()
    assert [(r["festival_type"], r["region"], r["is_major"]) for r in got] == [
        ("REGIONAL", "SOUTH", False), ("NATIONAL", "ALL", False), ("RELIGIOUS", "ALL", True)]
    by_name = {r["festival_name"]: r for r in got}
    assert by_name["Diwali"]["festival_type"] == "RELIGIOUS" and by_name["Diwali"]["is_major"] is True
    assert by_name["Pongal"]["region"] == "SOUTH" and by_name["Republic Day"]["is_major"] is False
    bad = write_csv(tmp_path / "fest_bad.csv", header[:2], [r[:2] for r in data])
    with pytest.raises(SchemaValidationError):
        ingest.ingest_festivals(spark, bad, bronze, audit, marks, "2024-02-01", INGESTED_AT)


PAYLOAD = {"daily": {"time": ["2024-01-01", "2024-01-02", "2024-01-03", "2024-01-04"],
                     "temperature_2m_max": [28.0, 28.0, 28.0, 42.0],
                     "temperature_2m_min": [18.0, 18.0, 18.0, 30.0],
                     "precipitation_sum": [0.0, 2.5, 15.0, 0.0],
                     "windspeed_10m_max": [5.0, 5.0, 5.0, 5.0],
                     "weathercode": [0, 61, 65, 7]}}


def land_payloads(root, payloads):
    for city, body in payloads.items():
        d = os.path.join(root, f"city={city}")
        os.makedirs(d, exist_ok=True)
        with open(os.path.join(d, "payload.json"), "w") as fh:
            json.dump(body, fh)


def test_weather_payload_flatten_a4(spark, tmp_path):
    land_payloads(str(tmp_path), {"delhi": PAYLOAD, "pune": {"error": "no data"}})
    valid, bad = split_valid(read_payloads(spark, str(tmp_path)))
    assert [r["city"] for r in bad.collect()] == ["pune"]
    out = flatten_weather(valid, "2024-01-05 00:00:00").orderBy("weather_date").collect()
    assert [r["is_rainy"] for r in out] == [False, False, True, False]
    assert [r["weather_category"] for r in out] == ["clear", "clear", "heavy_rain", "extreme_heat"]
    assert [r["weather_description"] for r in out] == ["Clear sky", "Slight rain", "Heavy rain", None]
    assert out[0]["weather_date"] == dt.date(2024, 1, 1) and out[0]["city"] == "delhi"


def test_weather_payload_strict_mode_fails(spark, tmp_path):
    land_payloads(str(tmp_path), {"pune": {"error": "no data"}})
    checked, _ = split_valid(read_payloads(spark, str(tmp_path)), strict=True)
    with pytest.raises(Exception, match="daily"):
        checked.collect()


def test_ingest_weather_incremental(spark, tmp_path):
    land_payloads(str(tmp_path), {"delhi": PAYLOAD, "pune": PAYLOAD})
    bronze, audit, marks = (scratch_path(spark, n) for n in ("t-weather", "t-audit3", "t-marks3"))
    r = ingest.ingest_weather(spark, str(tmp_path), bronze, audit, marks, "2024-01-03", "2024-01-05 00:00:00")
    assert r["range"] == ("2023-12-28", "2024-01-03") and r["rows"] == 6 and r["cities"] == 2
    # next run resumes after the mark; re-sent days are upserted, not duplicated
    r2 = ingest.ingest_weather(spark, str(tmp_path), bronze, audit, marks, "2024-01-04", "2024-01-06 00:00:00")
    assert r2["range"] == ("2024-01-04", "2024-01-04") and r2["rows"] == 2
    assert spark.read.parquet(bronze).count() == 8
    r3 = ingest.ingest_weather(spark, str(tmp_path), bronze, audit, marks, "2024-01-04", "2024-01-06 00:00:00")
    assert r3["status"] == "UP_TO_DATE"


def test_a_failed_city_is_not_skipped(spark, tmp_path):
    """Pune's payload fails on the first run and comes whole on the second: no day is lost."""
    bronze, audit, marks = (scratch_path(spark, n) for n in ("t-w2", "t-audit4", "t-marks4"))
    landing, tmp_path = tmp_path / "landing", tmp_path / "payloads"
    run = lambda day: ingest.ingest_weather(spark, str(tmp_path), bronze, audit, marks, day, f"{day} 06:00:00",
                                            landing_root=str(landing))
    three = {"daily": {k: v[:3] for k, v in PAYLOAD["daily"].items()}}
    land_payloads(str(tmp_path), {"delhi": three, "pune": {"error": "no data"}})
    first = run("2024-01-03")
    assert (first["rows"], first["quarantined"], first["status"]) == (3, 1, "PARTIAL")
    land_payloads(str(tmp_path), {"delhi": three, "pune": three})
    second = run("2024-01-04")
    assert (second["rows"], second["rows_merged"]) == (3, 6)           # pune's days are new, delhi's came again
    got = spark.read.parquet(bronze).groupBy("city").count().collect()
    assert {r["city"]: r["count"] for r in got} == {"delhi": 3, "pune": 3}
    land_payloads(str(tmp_path), {"delhi": PAYLOAD})
    assert run("2024-01-03")["status"] == "UP_TO_DATE"
    third = ingest.ingest_weather(spark, str(tmp_path), bronze, audit, marks, "2024-01-05", "2024-01-05 06:00:00")
    assert third["rows"] == 1 and third["rows_ahead"] == 0


def test_csv_quotes_line_breaks_and_bad_values(spark, tmp_path):
    from pyspark.sql.types import LongType, StringType, StructField, StructType
    from strata.sources.csv import read_csv

    path = tmp_path / "q.csv"
    path.write_text('id,address,n\n1,"Shop 3, ""Plaza"", Delhi",5\n2,"two\nlines",x\n3,,\n')
    declared = StructType([StructField("id", LongType()), StructField("address", StringType()), StructField("n", LongType())])
    got = [tuple(r) for r in read_csv(spark, str(path), declared, multi_line=True, count_bad=True).orderBy("id").collect()]
    assert got == [(1, 'Shop 3, "Plaza", Delhi', 5, 0), (2, "two\nlines", None, 1), (3, None, None, 0)]


def test_bad_dates_are_counted(spark, tmp_path):
    header = ["festival_date", "festival_name", "festival_type", "region", "is_major"]
    path = write_csv(tmp_path / "f.csv", header, [["2023-11-12", "A", "x", "all", "TRUE"], ["12/11/2023", "B", "x", "all", "TRUE"]])
    bronze, audit, marks = (scratch_path(spark, n) for n in ("t-fest2", "t-audit5", "t-marks5"))
    m = ingest.ingest_festivals(spark, path, bronze, audit, marks, "2024-02-01", INGESTED_AT, landing_root=str(tmp_path / "land"))
    assert (m["row_count"], m["rows_rejected"], m["status"]) == (2, 1, "PARTIAL")
    assert os.path.isdir(tmp_path / "land/festival_calendar/ingestion_date=2024-02-01")
    assert spark.read.parquet(audit).first()["rows_rejected"] == 1


def test_unchanged_restaurant_file_is_skipped(spark, tmp_path):
    path = restaurant_csv(tmp_path)
    root, bronze, audit, led = (scratch_path(spark, n) for n in ("t-l", "t-b", "t-a", "t-led"))
    run = lambda: ingest.ingest_restaurants(spark, path, root, bronze, audit, "2024-02-01", INGESTED_AT, ledger_path=led)
    first = run()
    assert first["status"] == "SUCCESS" and len(first["fingerprint"]) == 32
    assert run()["status"] == "UNCHANGED"
    with open(path, "a") as f:
        f.write("\n")
    assert run()["status"] == "SUCCESS"


def test_partition_pruning_in_plan(spark):
    from strata.plans.workloads import PRUNE_FROM
    from strata.operators.filters import since
    from strata.sinks.landing import write_by_date

    df = spark.createDataFrame([(i, dt.date(2024, 1, 1 + i % 20)) for i in range(100)], "id int, d date")
    path = scratch_path(spark, "t-prune")
    write_by_date(df, path, "d")
    scan = since(spark.read.parquet(path), "d", PRUNE_FROM)
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(d" in plan and "2024-01-15" in plan
    assert scan.count() == 30
    with pytest.raises(ValueError):
        since(spark.read.parquet(path), "d", None)
    assert spark.read.parquet(path).where(F.col("d") == "2024-01-01").count() == 5


@pytest.mark.parametrize("encoding", ["UTF-8", "ISO-8859-1"])
def test_multi_line_files_are_read_by_many_tasks(spark, tmp_path, encoding):
    import csv as plain
    import random

    from pyspark.sql.types import LongType, StructField, StructType

    from strata.sources.csv import read_csv

    rng = random.Random(3)
    cell = lambda: "".join(rng.choice(['a', 'é', ',', '"', '\n', '\r\n', ' ', 'long text ' * 3]) for _ in range(rng.randrange(12)))
    cols = ["id", "odd `name`", "text"]
    for name, n in (("one", 400), ("two", 1), ("none", 0), ("big", 60)):
        with open(tmp_path / f"{name}.csv", "w", encoding=encoding, newline="") as f:
            out = plain.writer(f, lineterminator=rng.choice(["\n", "\r\n"]))
            out.writerow(cols)
            for i in range(n):
                out.writerow([i, cell(), ("\n" * 5000 + "x" * 3000) if name == "big" and i % 20 == 7 else cell()])
                if i % 9 == 0:
                    f.write("\n")
    declared = StructType([StructField("id", LongType())])
    read = lambda split: read_csv(spark, str(tmp_path), declared, encoding, cols, multi_line=True, count_bad=True, split=split)
    want = rows(read(False))
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {k: spark.conf.get(k) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "700b")
        got = read(True)
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 30 and rows(got) == want and len(want) == 461
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert rows(read(True)) == want


def test_payloads_that_drift_are_kept_or_counted(spark, tmp_path):
    from strata.sources.json_payload import read_drifting_payloads

    lines = ['{"daily": {"time": ["2024-01-01", "x"], "temperature_2m_max": [1.5, null], "temperature_2m_min": ["2", "3"], "precipitation_sum": [0, 1],'
             ' "windspeed_10m_max": [1, 2], "weathercode": [3, 4], "zz": 1}, "other": {}}',
             '{"daily": {"time": ["2024-01-02"], "temperature_2m_max": "warm"}}', '{"daily": []}', '{"x": 1}', '{"daily": {"time": 7, "a`b": 1}}', 'no', '', '[1]']
    (tmp_path / "city=a b").mkdir()
    (tmp_path / "city=a b" / "p.json").write_text("\n".join(lines))
    found = read_drifting_payloads(spark, str(tmp_path)).cache()
    got = {r.payload: r for r in found.collect()}
    assert len(got) == len(lines) and {r.city for r in got.values()} == {"a b"}
    assert [got[x].reason for x in lines] == [None, None, "no daily block", "no daily block", "no days", "not json", "not json", "no daily block"]
    assert got[lines[0]].drift == ["extra:zz"] and "type:temperature_2m_max" in got[lines[1]].drift and "missing:weathercode" in got[lines[1]].drift
    valid, bad = split_valid(found)
    days = flatten_weather(valid, INGESTED_AT).select("temperature_max", "temperature_min", "weather_code").collect()
    assert sorted(map(tuple, days), key=repr) == sorted([(1.5, 2.0, 3), (None, 3.0, 4), (None, None, None)], key=repr) and bad.count() == 6
    with pytest.raises(Exception, match="missing 'daily'"):
        split_valid(found, strict=True)[0].collect()


def test_extents_come_from_footers(spark):
    from pyspark.sql import Row

    from strata.operators.footers import _extent, pushed_aggregates, table_extent
    from strata.sources.catalog import BronzeCatalog

    df = spark.range(1000).selectExpr("id as k", "date_add(date'2024-01-01', cast(id % 7 as int)) as d", "cast(id as string) as s", "if(id = 3, null, id) as n")
    path = scratch_path(spark, "t-footers")
    df.repartition(4).write.parquet(path)
    with pushed_aggregates(spark):
        plan = _extent(spark.read.schema(df.schema).parquet(path), ["k", "d", "n"])._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*), MIN(k), MAX(k)" in plan
    assert "useV1SourceList" not in plan and "parquet" in spark.conf.get("spark.sql.sources.useV1SourceList")
    want = _extent(df, ["k", "d", "n"]).first()
    assert table_extent(spark, path, df.schema, ["k", "d", "n"]) == want
    assert table_extent(spark, path, df.schema, ["s", "k"]) == _extent(df, ["s", "k"]).first()
    empty = scratch_path(spark, "t-footers-empty")
    df.limit(0).write.parquet(empty)
    assert table_extent(spark, empty, df.schema, ["k"]) == Row(n_rows=0, min_k=None, max_k=None)
    catalog = BronzeCatalog(spark, {"t": path}, {"t": df.schema})
    assert catalog.row_count("t") == 1000 and catalog.row_count("absent") == 0 and catalog.extent("absent", "k") == (0, None, None)
