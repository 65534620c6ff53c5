"""Bronze catalog, silver pipeline, SQL functions, landing sinks and the ledger."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from strata import functions as X
from strata.functions.sql import register_sql_functions
from strata.plans import silver_build as pipeline
from strata.schemas import RAW_WEATHER
from strata.session import local_path, scratch_path
from strata.sinks import landing, ledger
from strata.sources.catalog import BronzeCatalog, PartitionFilterRequired, load_ndjson, run_query
from tests.fixtures import a2_ipl, a3_festivals, b1_orders, b2_weather, b3_restaurants


@pytest.fixture(scope="module")
def catalog(spark):
    root = scratch_path(spark, "t-bronze")
    frames = {"raw_restaurants": b3_restaurants(spark), "raw_orders": b1_orders(spark),
              "raw_weather": b2_weather(spark), "raw_ipl_schedule": a2_ipl(spark),
              "raw_festival_calendar": a3_festivals(spark)}
    paths = {}
    for name, df in frames.items():
        paths[name] = f"{root}/{name}"
        landing.land_table(df, name, paths[name])
    return BronzeCatalog(spark, paths)


def test_partition_filter_guard(catalog):
    with pytest.raises(PartitionFilterRequired):
        catalog.source("raw_orders")
    n = catalog.source("raw_orders", "2023-01-02").count()
    assert n == 10
    assert catalog.row_count("raw_weather") == 9
    assert catalog.row_count("pipeline_audit") == 0 and not catalog.exists("pipeline_audit")
    views = catalog.register_views({"raw_orders": "2020-01-01"})
    assert "raw_orders" in views
    got = run_query(catalog.spark, "SELECT count(*) AS n FROM raw_orders WHERE order_date >= :d",
                    d=dt.date(2023, 1, 2)).first()["n"]
    assert got == 10


def test_build_and_check_silver(spark, catalog):
    paths = pipeline.build_silver(spark, catalog, scratch_path(spark, "t-silver"))
    assert set(paths) == {"stg_restaurants", "stg_restaurant_ratings", "stg_orders", "stg_weather",
                          "stg_ipl_schedule", "stg_festival_calendar"}
    assert spark.read.parquet(paths["stg_orders"]).count() == 5
    report = {(r["table_name"], r["check_name"]): r["failing_rows"]
              for r in pipeline.check_silver(spark, paths).collect()}
    assert report[("stg_orders", "assert_delivery_time_positive_for_delivered")] == 1
    assert report[("stg_weather", "unique_city_weather_date")] == 1        # D4
    assert report[("stg_restaurants", "unique_restaurant_id")] == 0
    assert report[("stg_orders", "relationships_restaurant_id")] == 0
    assert pipeline.coverage_report(spark, paths).count() >= 1


def test_sql_functions_match_column_functions(spark):
    register_sql_functions(spark)
    df = spark.createDataFrame([(" bengaluru ", 15.0, 30.0, dt.date(2023, 10, 5)),
                                ("new york", 0.0, 41.0, dt.date(2023, 1, 5)),
                                (None, None, None, None)], "c string, p double, t double, d date")
    df.createOrReplaceTempView("sqlfn")
    via_sql = spark.sql("SELECT standardise_city(c), classify_weather(p, t), indian_season(d), "
                        "safe_divide(p, t) FROM sqlfn").collect()
    via_col = df.select(X.standardise_city("c"), X.classify_weather(F.col("p"), F.col("t")), X.season("d"),
                        X.safe_divide("p", "t")).collect()
    assert [tuple(r) for r in via_sql] == [tuple(r) for r in via_col]


def test_landing_manifest_and_city_ranges(spark):
    df = b2_weather(spark).withColumn("city", F.lower(F.trim("city")))
    path = scratch_path(spark, "t-land")
    m = landing.land(df, path, partition_cols=["city"], metrics={"rainy": F.count_if(F.col("precipitation_sum") > 2.5)})
    assert m["row_count"] == 9 and m["rainy"] == 3
    man = landing.partition_manifest(spark, path, ["city"]).collect()
    assert sum(r["rows"] for r in man) == 9 and all(r["file_path"] for r in man)
    per_city = {r["city"]: r["rows"] for r in
                landing.write_city_ranges(df, scratch_path(spark, "t-ranges"), "2023-01-01", "2023-12-31").collect()}
    assert per_city["pune"] == 3
    monthly = landing.with_month_partition(df, "weather_date", "weather_month")
    assert monthly.where(F.col("weather_month") == dt.date(2023, 10, 1)).count() == 1


def test_create_table_and_materialize(spark):
    name = "t_raw_weather_ddl"
    loc = scratch_path(spark, "t-ddl")
    assert landing.create_table_if_absent(spark, name, RAW_WEATHER, ["weather_date"], location=loc) is True
    assert landing.create_table_if_absent(spark, name, RAW_WEATHER, ["weather_date"], location=loc) is False
    assert spark.table(name).columns[-1] == "weather_date"
    landing.materialize(b2_weather(spark), "t_weather_view", "view")
    assert spark.table("t_weather_view").count() == 9
    inc = scratch_path(spark, "t-inc")
    landing.materialize(b2_weather(spark), "x", "incremental", path=inc, partition_col="weather_date")
    landing.materialize(b2_weather(spark).where("city = 'pune'"), "x", "incremental", path=inc,
                        partition_col="weather_date")
    assert spark.read.parquet(inc).count() == 9     # only pune's partitions were rewritten


def test_checksum_ledger(spark, tmp_path):
    for name, body in [("a.csv", "x,y\n1,2\n"), ("b.csv", "x,y\n3,4\n")]:
        (tmp_path / name).write_text(body)
    led = scratch_path(spark, "t-ledger")
    pattern = os.path.join(str(tmp_path), "*.csv")
    first = ledger.changed_files(spark, pattern, led)
    assert first.count() == 2
    ledger.record_files(first, led, "2024-01-01 00:00:00")
    assert ledger.changed_files(spark, pattern, led).count() == 0          # unchanged: skip
    (tmp_path / "b.csv").write_text("x,y\n3,5\n")
    changed = [os.path.basename(r["path"]) for r in ledger.changed_files(spark, pattern, led).collect()]
    assert changed == ["b.csv"]
    meta = ledger.file_fingerprints(spark, pattern, "metadata")
    assert meta.count() == 2


def test_ndjson_load(spark, tmp_path):
    (tmp_path / "w.json").write_text(
        '{"city": "pune", "weather_date": "2023-01-01", "temperature_max": 30.5}\n'
        '{"city": "delhi", "weather_date": "2023-01-01", "is_rainy": true, "extra": 1}\n')
    target = scratch_path(spark, "t-ndjson")
    assert load_ndjson(spark, str(tmp_path / "w.json"), RAW_WEATHER, target) == 2
    got = spark.read.parquet(target)
    assert got.columns == RAW_WEATHER.names and got.where("city = 'delhi'").first()["is_rainy"] is True
    assert local_path("file:/x/y") == "/x/y"


def test_write_by_date_one_file_per_date(spark):
    """Reference behaviour: one file per order_date for ordinary (non-hot) sizes."""
    df = spark.range(300).select(F.date_add(F.lit(dt.date(2023, 1, 1)), (F.col("id") % 7).cast("int"))
                                 .alias("order_date"), "id").repartition(5)
    path = scratch_path(spark, "t-by-date")
    landing.write_by_date(df, path, "order_date")
    man = landing.partition_manifest(spark, path, ["order_date"]).collect()
    assert len(man) == 7 and all(r["rows"] in (42, 43) for r in man)
