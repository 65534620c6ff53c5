"""Driver-table workloads that run whole flows: files landed, ingested, upserted, read back.

Each writes raw files of the driver's tables to a scratch folder in the form
that a feed would have, runs the library's flow over them, and returns what
the flow left behind. ``FLOW_SQL`` holds the same results in DuckDB SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, LongType, StringType, StructField, StructType

from strata import functions as X
from strata.functions.sql import register_sql_functions
from strata.operators import aggregates, filters, joins, quality, setops
from strata.operators.footers import table_extent
from strata.operators.lookup import append_unseen
from strata.plans import ingest, silver
from strata.plans.silver_refresh import refresh, refresh_from
from strata.schemas import MONTH_PARTITION, RAW_FESTIVAL_CALENDAR, RAW_IPL_SCHEDULE, RAW_ORDERS, RAW_RESTAURANTS, RAW_WEATHER, conform
from strata.session import scratch_path
from strata.sinks.landing import (create_table_if_absent, land, land_table, materialize, partition_manifest,
                                  write_by_date, write_city_ranges)
from strata.sinks.upsert import upsert_table
from strata.sinks.versions import VersionedTable
from strata.sources.catalog import BronzeCatalog, load_ndjson, run_query
from strata.sources.csv import read_csv
from strata.sources.json_payload import flatten_weather, read_drifting_payloads, split_valid
from strata.sources.tables import read_table
from strata.streaming.streams import upsert_table_stream

INGESTED_AT = "2024-02-01 00:00:00"
INGESTION_DATE = "2024-02-01"
FIRST_LOAD_BEFORE, SECOND_LOAD_FROM = "1997-01-01", "1995-01-01"
FLOW_SQL: dict[str, str] = {}


def _ntz(text: str):
    return F.lit(text).cast("timestamp_ntz")


# ---------------------------------------------------------------- upsert of files

def snk_upsert_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK7 / JN6 / WIN5 / INC3 on files: two overlapping batches and an empty one, upserted into a table
    partitioned by a text key with leading zeros and NULLs. The second batch holds two versions of each row."""
    zone = F.when(F.col("o_custkey") % 20 == 7, F.lit(None)).otherwise(F.lpad((F.col("o_custkey") % 20).cast("string"), 4, "0"))
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", zone.alias("zone"), "o_totalprice", "o_orderdate",
                                                        F.lit(0).alias("version"))
    table, keys = VersionedTable(spark, scratch_path(spark, "orders-by-zone")), ["o_orderkey", "zone"]
    table.create(orders.schema, ["zone"])
    upsert_table(table, orders.where(F.col("o_orderdate") < _ntz(FIRST_LOAD_BEFORE)), keys)
    later = orders.where(F.col("o_orderdate") >= _ntz(SECOND_LOAD_FROM))
    sent_again = later.withColumns({"o_totalprice": F.col("o_totalprice") + 1, "version": F.lit(1)})
    upsert_table(table, sent_again.unionByName(later), keys, order_by=["version"])
    upsert_table(table, orders.limit(0), keys, order_by=["version"])
    return table.read().select("o_orderkey", "zone", "o_totalprice", "version")


FLOW_SQL["snk_upsert_file"] = f"""
WITH o AS (SELECT o_orderkey, o_totalprice, o_orderdate,
             CASE WHEN o_custkey % 20 = 7 THEN NULL ELSE lpad(CAST(o_custkey % 20 AS VARCHAR), 4, '0') END AS zone FROM orders),
b AS (SELECT o_orderkey, zone, o_totalprice + 1 AS o_totalprice, 1 AS version FROM o WHERE o_orderdate >= TIMESTAMP '{SECOND_LOAD_FROM}')
SELECT o_orderkey, zone, o_totalprice, 0 AS version FROM o WHERE o_orderdate < TIMESTAMP '{FIRST_LOAD_BEFORE}'
  AND NOT EXISTS (SELECT 1 FROM b WHERE b.o_orderkey = o.o_orderkey AND b.zone = o.zone)
UNION ALL SELECT * FROM b
"""


UNSEEN_BUT = 97


def jn_append_unseen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN5 / SRC9 / INC4 without a bound on dates: a batch of ids scattered over the whole table; those that it lacks are
    appended, found by the Bloom filters of its key column."""
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderdate")
    root = scratch_path(spark, "orders-keyed")
    table = VersionedTable(spark, f"{root}/table")
    table.create(orders.schema, bloom=["o_orderkey"])
    table.append(orders.where("o_orderkey % 3 <> 0"))
    batch = orders.where(F.col("o_orderkey") % UNSEEN_BUT == 0).withColumn("o_totalprice", F.col("o_totalprice") + 1)
    _, n = append_unseen(table, batch, "o_orderkey", root)
    return table.read().select("o_orderkey", "o_totalprice", F.lit(n).cast("long").alias("n_added"))


FLOW_SQL["jn_append_unseen"] = f"""
SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
  (SELECT count(*) FROM orders WHERE o_orderkey % 3 = 0 AND o_orderkey % {UNSEEN_BUT} = 0) AS n_added
FROM orders WHERE o_orderkey % 3 <> 0 OR o_orderkey % {UNSEEN_BUT} = 0
"""

CLUSTER_FILES, CLUSTER_PARTS = 64, 10


def snk_cluster_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK10: lines in Z-order of two columns, read by a range of the second one, which opens fewer than half of the files."""
    lines = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    table = VersionedTable(spark, scratch_path(spark, "lines-clustered"))
    table.create(lines.schema, cluster_by=["l_shipdate", "l_partkey"], rows_per_file=max(1, lines.count() // CLUSTER_FILES))
    table.append(lines)
    some = table.read(ranges={"l_partkey": (1, CLUSTER_PARTS)})
    few = 2 * len(some.inputFiles()) < len(table.read().inputFiles())
    return some.withColumn("few_files", F.lit(few))


FLOW_SQL["snk_cluster_ranges"] = f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate, true AS few_files FROM lineitem WHERE l_partkey BETWEEN 1 AND {CLUSTER_PARTS}
"""

SILVER_FROM, NEW_DAY, AGAIN_FROM, AGAIN_TO = "1993-01-01", "1998-01-05", "1995-03-01", "1995-03-31"


def snk_silver_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK11 / MD3: silver orders refreshed after a batch with a new day and orders of one other month sent again: only their
    keys are computed, only their months are written, and the result is that of a full build."""
    feed = conform(_orders_feed(spark, sf_dir).withColumn("order_amount_inr", F.col("order_amount_inr") / 30), RAW_ORDERS)
    root, month = scratch_path(spark, "silver-refresh"), MONTH_PARTITION["raw_orders"]
    monthly = lambda df: df.withColumn(month, F.trunc("order_date", "month"))
    bronze, out = VersionedTable(spark, f"{root}/bronze"), VersionedTable(spark, f"{root}/silver")
    at = lambda when: F.lit(when).cast(RAW_ORDERS["_generated_at"].dataType)
    build = lambda: refresh(bronze, out, lambda raw: monthly(silver.stg_orders(raw, SILVER_FROM)), ["order_id"], [month])
    day = F.col("order_date") == F.lit(NEW_DAY).cast("date")
    first = monthly(feed.where(~day).withColumn("_generated_at", at("2024-01-01")))
    bronze.create(first.schema, [month])
    bronze.append(first)
    build()
    again = F.col("order_date").between(F.lit(AGAIN_FROM).cast("date"), F.lit(AGAIN_TO).cast("date")) & (F.substring("order_id", 2, 20).cast("long") % 3 == 0)
    bronze.append(monthly(feed.where(day | again).withColumns({"order_amount_inr": F.col("order_amount_inr") + 500, "_generated_at": at("2024-01-02")})))
    done = build()
    return out.read().select("order_id", "order_date", "order_amount_inr", "order_status", "order_hour", "is_weekend",
                             F.lit(done["built"]).alias("second_build"), F.lit(done["partitions"]).cast("long").alias("months_written"))


FLOW_SQL["snk_silver_refresh"] = f"""
WITH f AS (SELECT 'o' || o_orderkey AS order_id, CAST(o_orderdate AS DATE) AS order_date,
             o_totalprice / 30 + CASE WHEN CAST(o_orderdate AS DATE) = DATE '{NEW_DAY}' OR CAST(o_orderdate AS DATE) BETWEEN DATE '{AGAIN_FROM}' AND DATE '{AGAIN_TO}' AND o_orderkey % 3 = 0 THEN 500 ELSE 0 END AS order_amount_inr,
             upper(o_orderstatus) AS order_status, CAST(hour(o_orderdate) AS INTEGER) AS order_hour, isodow(o_orderdate) >= 6 AS is_weekend FROM orders)
SELECT *, 'changes' AS second_build, 2 AS months_written FROM f WHERE order_date >= DATE '{SILVER_FROM}' AND order_amount_inr > 0 AND order_amount_inr <= 10000
"""


COVERAGE_CUTS = ("2024-01-10", "2024-01-20")


def jn_coverage_kept_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MD12 / DQ14 / JN2: purchases without a view of the same user and day, kept up over three batches of purchases, whose views
    come a batch late; the result is that of the whole tables."""
    ev = read_table(spark, sf_dir, "events").select("user_id", F.to_date("ts").alias("event_date"), "event_type")
    root, first, second = scratch_path(spark, "coverage"), *(F.lit(c).cast("date") for c in COVERAGE_CUTS)
    batch = F.when(F.col("event_date") < first, 0).when(F.col("event_date") < second, 1).otherwise(2)
    purchases, views, out = (VersionedTable(spark, f"{root}/{n}") for n in ("purchases", "views", "coverage"))
    bought, seen = (ev.where(F.col("event_type") == t).select("user_id", "event_date", batch.alias("batch")) for t in ("purchase", "view"))
    for table, rows in ((purchases, bought), (views, seen)):
        table.create(rows.drop("batch").schema, ["event_date"])
    gaps = lambda p, v: joins.coverage_gap(p, v, ["user_id", "event_date"], "purchases_without_view")
    for n in range(4):
        purchases.append(bought.where(F.col("batch") == n).drop("batch"))
        views.append(seen.where(F.col("batch") == n - 1).drop("batch"))
        done = refresh_from([(purchases, ["event_date"]), (views, ["event_date"])], out, gaps, ["event_date"], ["event_date"])
    return out.read().withColumn("last_build", F.lit(done["built"]))


FLOW_SQL["jn_coverage_kept_up"] = """
WITH e AS (SELECT user_id, CAST(ts AS DATE) AS event_date, event_type FROM events)
SELECT p.user_id, p.event_date, count(*) AS purchases_without_view, 'changes' AS last_build FROM e p
WHERE p.event_type = 'purchase' AND NOT EXISTS (SELECT 1 FROM e v WHERE v.event_type = 'view' AND v.user_id = p.user_id AND v.event_date = p.event_date)
GROUP BY 1, 2
"""


def stream_upsert_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """INC3 as Structured Streaming into a table of versions: two loads with a restart between them, each event's largest
    version winning, and a restart that has lost its progress and sends all micro-batches again."""
    ev = read_table(spark, sf_dir, "events").select("event_id", F.to_date("ts").alias("event_date"), "value", F.lit(0).alias("version"))
    root = scratch_path(spark, "events-upsert")
    table = VersionedTable(spark, f"{root}/table")
    table.create(ev.schema, ["event_date"])
    twice = ev.where("event_id % 4 = 0").withColumns({"value": F.col("value") + 1, "version": F.lit(1)})
    for n, rows in enumerate((ev.where("event_id % 7 <> 0"), ev.where("event_id % 7 = 0 or event_id % 4 = 0").unionByName(twice))):
        rows.write.parquet(f"{root}/feed/load={n}")
        upsert_table_stream(table, f"{root}/feed", ev.schema, ["event_id", "event_date"], f"{root}/progress", order_by=["version"])
    upsert_table_stream(table, f"{root}/feed", ev.schema, ["event_id", "event_date"], f"{root}/progress-2", order_by=["version"])
    return table.read()


FLOW_SQL["stream_upsert_events"] = """
SELECT event_id, CAST(ts AS DATE) AS event_date, CASE WHEN event_id % 4 = 0 THEN value + 1 ELSE value END AS value,
  CASE WHEN event_id % 4 = 0 THEN 1 ELSE 0 END AS version FROM events
"""


# ---------------------------------------------------------------- orders

def _orders_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a pandas writer lands them: ids as numbers, times as text."""
    o = read_table(spark, sf_dir, "orders")
    return o.select(F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("order_id"), F.col("o_custkey").alias("restaurant_id"),
                    F.col("o_custkey").alias("customer_id"), F.to_date("o_orderdate").cast("string").alias("order_date"),
                    F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("order_datetime"),
                    F.col("o_totalprice").alias("order_amount_inr"), F.col("o_orderpriority").alias("platform"),
                    F.col("o_orderstatus").alias("order_status"))


def _ingest_orders_twice(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    feed, root = _orders_feed(spark, sf_dir), scratch_path(spark, "orders-feed")
    bronze, audit = f"{root}/bronze", f"{root}/audit"
    for name, rows in (("first", feed.where(F.col("order_date") < FIRST_LOAD_BEFORE)), ("second", feed.where(F.col("order_date") >= SECOND_LOAD_FROM))):
        rows.write.parquet(f"{root}/{name}")
        ingest.ingest_orders(spark, f"{root}/{name}", bronze, audit)
    return bronze, audit


def md8_orders_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MD8: SRC4, SRC9, JN5, SNK6, SNK10, SNK12, FN22: two overlapping feeds appended to the monthly bronze table."""
    bronze, _ = _ingest_orders_twice(spark, sf_dir)
    written = StructType([*RAW_ORDERS.fields, StructField(MONTH_PARTITION["raw_orders"], DateType())])
    return spark.read.schema(written).parquet(bronze).select(
        "order_id", "restaurant_id", "customer_id", "order_date", F.col("order_datetime").cast("timestamp_ntz").alias("order_datetime"),
        "order_amount_inr", "platform", "order_status", "delivery_time_mins", "order_month")


FLOW_SQL["md8_orders_ingest"] = """
SELECT 'o' || o_orderkey AS order_id, o_custkey AS restaurant_id, CAST(o_custkey AS VARCHAR) AS customer_id,
  CAST(o_orderdate AS DATE) AS order_date, date_trunc('second', o_orderdate) AS order_datetime, o_totalprice AS order_amount_inr,
  o_orderpriority AS platform, o_orderstatus AS order_status, CAST(NULL AS BIGINT) AS delivery_time_mins,
  CAST(date_trunc('month', o_orderdate) AS DATE) AS order_month
FROM orders
"""


def snk_audit_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK9 / AGG12: the audit rows of two orders runs, the second with rows that are there already."""
    _, audit = _ingest_orders_twice(spark, sf_dir)
    return spark.read.parquet(audit).select("source_name", "rows_processed", "rows_rejected", "status", "error_message",
                                            (F.col("duration_seconds") > 0).alias("timed"))


FLOW_SQL["snk_audit_rows"] = f"""
WITH n AS (SELECT count(*) FILTER (o_orderdate < TIMESTAMP '{FIRST_LOAD_BEFORE}') AS first,
                  count(*) FILTER (o_orderdate >= TIMESTAMP '{FIRST_LOAD_BEFORE}') AS new,
                  count(*) FILTER (o_orderdate >= TIMESTAMP '{SECOND_LOAD_FROM}' AND o_orderdate < TIMESTAMP '{FIRST_LOAD_BEFORE}') AS again FROM orders)
SELECT 'orders' AS source_name, first AS rows_processed, 0 AS rows_rejected, 'SUCCESS' AS status, CAST(NULL AS VARCHAR) AS error_message, true AS timed FROM n
UNION ALL SELECT 'orders', new, again, CASE WHEN again > 0 THEN 'PARTIAL' ELSE 'SUCCESS' END, NULL, true FROM n
"""


# ---------------------------------------------------------------- restaurants

def md7_restaurants_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MD7: SRC1, SRC3, FLT1, PRJ1-3, SNK1, SNK5, SNK8: customers as a Latin-1 restaurant feed with quoted fields;
    the second run finds the files unchanged."""
    c = read_table(spark, sf_dir, "customer")
    key = F.col("c_custkey").cast("string")
    cells = {"Restaurant ID": F.col("c_custkey"), "Restaurant Name": F.concat(F.lit("  "), F.col("c_name")), "Country Code": F.col("c_nationkey"),
             "City": F.col("c_mktsegment"), "Address": F.concat(F.lit('No. "'), key, F.lit('", Rue Soufflé')), "Locality": F.lit(" "),
             "Locality Verbose": F.lit("x, y"), "Longitude": F.col("c_acctbal"), "Latitude": F.lit("north"), "Cuisines": F.lit("Thai, Indian"),
             "Average Cost for two": F.col("c_custkey") * 10, "Currency": F.lit("Rs"), "Has Table booking": F.lit("Yes"),
             "Has Online delivery": F.lit("No"), "Is delivering now": F.lit("No"), "Switch to order menu": F.lit("No"),
             "Price range": F.lit(3), "Aggregate rating": F.lit(4.5), "Rating color": F.lit("Green"), "Rating text": F.lit("Good"),
             "Votes": F.col("c_custkey")}
    root = scratch_path(spark, "restaurants-feed")
    (c.select(*(v.alias(k) for k, v in cells.items())).write.option("header", True).option("encoding", "ISO-8859-1")
     .option("escape", '"').option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(f"{root}/feed"))
    run = lambda: ingest.ingest_restaurants(
        spark, f"{root}/feed", root, f"{root}/bronze", f"{root}/audit", INGESTION_DATE, INGESTED_AT, ledger_path=f"{root}/ledger")
    run()
    again = run()["status"]
    return spark.read.schema(RAW_RESTAURANTS).parquet(f"{root}/bronze").select(
        "restaurant_id", "restaurant_name", "city", "address", "locality", "longitude", "latitude", "average_cost_for_two",
        "has_table_booking", "has_online_delivery", "votes", "country_code", "_source_file", "_ingestion_date",
        F.lit(again).alias("second_run"))


FLOW_SQL["md7_restaurants_ingest"] = f"""
SELECT c_custkey AS restaurant_id, c_name AS restaurant_name, c_mktsegment AS city, 'No. "' || c_custkey || '", Rue Soufflé' AS address,
  CAST(NULL AS VARCHAR) AS locality, c_acctbal AS longitude, CAST(NULL AS DOUBLE) AS latitude, c_custkey * 10 AS average_cost_for_two,
  true AS has_table_booking, false AS has_online_delivery, c_custkey AS votes, CAST(c_nationkey AS BIGINT) AS country_code,
  'feed' AS _source_file, DATE '{INGESTION_DATE}' AS _ingestion_date, 'UNCHANGED' AS second_run
FROM customer WHERE c_nationkey = 1
"""


# ---------------------------------------------------------------- weather

WEATHER_RUNS = ("2024-01-10", "2024-12-31")


def md9_weather_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MD9: SRC5, SRC6, FN3, FN4, JN10, INC1, INC2, SNK3, SNK7, D10: a day of an event type is a day of a city's weather.
    The payload of one city fails on the first run; the second run, which has all, misses none of its days."""
    daily = (read_table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("city"), F.to_date("ts").cast("string").alias("time"))
             .agg(F.max("value").alias("high"), F.min("value").alias("low"), F.count("*").alias("n")))
    fields = {"time": "time", "temperature_2m_max": "high", "temperature_2m_min": "low", "precipitation_sum": "rain",
              "windspeed_10m_max": "low", "weathercode": "code"}
    daily = daily.withColumns({"rain": (F.col("n") % 40).cast("double"), "code": F.col("n") % 100})
    days = F.array_sort(F.collect_list(F.struct("time", "high", "low", "rain", "code")))
    payload = daily.groupBy("city").agg(days.alias("d")).select(
        "city", F.struct(*(F.col(f"d.{c}").alias(name) for name, c in fields.items())).alias("daily"))
    root = scratch_path(spark, "weather-feed")
    failed = payload.agg(F.min("city").alias("city")).first()["city"]
    (payload.withColumn("daily", F.when(F.col("city") != failed, F.col("daily"))).withColumn("error", F.lit("none"))
     .write.partitionBy("city").json(f"{root}/first"))
    payload.write.partitionBy("city").json(f"{root}/second")
    for feed, day in zip(("first", "second"), WEATHER_RUNS, strict=True):
        ingest.ingest_weather(spark, f"{root}/{feed}", f"{root}/bronze", f"{root}/audit", f"{root}/marks", day, f"{day} 06:00:00",
                              landing_root=f"{root}/landing")
    return spark.read.schema(RAW_WEATHER).parquet(f"{root}/bronze").select(
        "city", "weather_date", "temperature_max", "temperature_min", "precipitation_sum", "weather_code", "weather_description", "is_rainy",
        "weather_category")


def src_payload_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC5 / SRC6: payloads of which one type has a renamed field, one a field of another type and one a field more; one has no
    days and one is no JSON. Days of the usable ones, and the others with the reason."""
    ev = read_table(spark, sf_dir, "events")
    daily = (ev.groupBy(F.col("event_type").alias("city"), F.to_date("ts").cast("string").alias("time"))
             .agg(F.max("value").alias("high"), F.count("*").alias("n")))
    packed = daily.groupBy("city").agg(F.array_sort(F.collect_list(F.struct("time", "high", "n"))).alias("d"))
    place = packed.withColumn("place", F.row_number().over(Window.orderBy("city")) % 5)  # a row a type

    def body(*fields):
        return F.to_json(F.struct(F.struct(*fields).alias("daily")))

    time, high, code = F.col("d.time").alias("time"), F.col("d.high").alias("temperature_2m_max"), F.col("d.n").alias("weathercode")
    words = F.transform("d.n", lambda n: F.concat(F.lit("code "), n.cast("string"))).alias("weathercode")
    text = (F.when(F.col("place") == 1, body(time, F.col("d.high").alias("temp_max"), code)).when(F.col("place") == 2, body(time, high, words))
            .when(F.col("place") == 3, body(time, high, code, F.col("d.n").alias("humidity"))).when(F.col("place") == 4, body(high, code))
            .otherwise(F.lit("<html>busy</html>")))
    root = scratch_path(spark, "payload-drift")
    place.select("city", text.alias("value")).write.partitionBy("city").text(root)
    valid, bad = split_valid(read_drifting_payloads(spark, root))
    days = flatten_weather(valid.select(F.struct("city", F.array_join("drift", " ").alias("drift")).alias("city"), "daily"), f"{INGESTED_AT}")
    columns = ["city", "drift", "weather_date", "temperature_max", "weather_code", "reason"]
    return (days.select("city.city", "city.drift", "weather_date", "temperature_max", F.col("weather_code").cast("long").alias("weather_code"),
                        F.lit(None).cast("string").alias("reason"))
            .unionByName(bad.selectExpr("city", "array_join(drift, ' ') as drift", "reason"), allowMissingColumns=True).select(*columns))


_OTHERS = "missing:precipitation_sum missing:temperature_2m_min"
FLOW_SQL["src_payload_drift"] = f"""
WITH e AS (SELECT event_type AS city, CAST(ts AS DATE) AS weather_date, max(value) AS high, count(*) AS n FROM events GROUP BY 1, 2),
p AS (SELECT city, row_number() OVER (ORDER BY city) % 5 AS place FROM (SELECT DISTINCT city FROM e))
SELECT city, CASE place WHEN 1 THEN 'extra:temp_max missing:precipitation_sum missing:temperature_2m_max missing:temperature_2m_min missing:windspeed_10m_max'
    WHEN 2 THEN '{_OTHERS} missing:windspeed_10m_max type:weathercode' ELSE 'extra:humidity {_OTHERS} missing:windspeed_10m_max' END AS drift,
  weather_date, CASE WHEN place <> 1 THEN high END AS temperature_max, CASE WHEN place <> 2 THEN n END AS weather_code, CAST(NULL AS VARCHAR) AS reason
FROM e JOIN p USING (city) WHERE place IN (1, 2, 3)
UNION ALL SELECT city, CASE place WHEN 4 THEN '{_OTHERS} missing:time missing:windspeed_10m_max' END, NULL, NULL, NULL,
  CASE place WHEN 4 THEN 'no days' ELSE 'not json' END FROM p WHERE place IN (4, 0)
"""

_CODES = ", ".join(f"({k}, '{v}')" for k, v in X.weather.WMO_WEATHER_CODES.items())
FLOW_SQL["md9_weather_ingest"] = f"""
WITH d AS (SELECT event_type AS city, CAST(ts AS DATE) AS weather_date, max(value) AS temperature_max, min(value) AS temperature_min,
             CAST(count(*) % 40 AS DOUBLE) AS precipitation_sum, count(*) % 100 AS weather_code FROM events GROUP BY 1, 2),
w(code, weather_description) AS (VALUES {_CODES})
SELECT d.*, weather_description, precipitation_sum > 2.5 AS is_rainy,
  CASE WHEN precipitation_sum > 10 THEN 'heavy_rain' WHEN precipitation_sum > 2.5 THEN 'light_rain'
       WHEN temperature_max > 40 THEN 'extreme_heat' ELSE 'clear' END AS weather_category
FROM d LEFT JOIN w ON w.code = d.weather_code
"""


# ---------------------------------------------------------------- calendars

def _calendar_csv(spark: SparkSession, sf_dir: str, cells: dict) -> str:
    path = f"{scratch_path(spark, 'calendar-feed')}/feed"
    (read_table(spark, sf_dir, "customer").select(*(v.alias(k) for k, v in cells.items()))
     .write.option("header", True).option("ignoreTrailingWhiteSpace", False).option("ignoreLeadingWhiteSpace", False).csv(path))
    return path


def _day_text():
    return F.when(F.col("c_nationkey") == 3, "soon").otherwise(F.date_add(F.lit("2023-01-01").cast("date"), (F.col("c_custkey") % 365).cast("int")).cast("string"))


def md10_matches_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MD10: SRC2, SRC3, JN11, FLT7, FN23, PRJ3, SNK5: customers as a match calendar; dates that are none become NULL and are counted."""
    venue = F.when(F.col("c_nationkey") == 0, "Bengaluru").when(F.col("c_nationkey") == 1, "New Delhi").when(F.col("c_nationkey") == 2, "Pune").otherwise("Agra")
    feed = _calendar_csv(spark, sf_dir, {"match_date": _day_text(), "season": F.lit(2023), "match_number": F.col("c_custkey"), "team1": F.col("c_name"),
                                         "team2": F.col("c_mktsegment"), "venue_city": venue, "match_type": F.lit("league"), "winner": F.col("c_name")})
    root = scratch_path(spark, "matches")
    got = ingest.ingest_ipl(spark, feed, f"{root}/bronze", f"{root}/audit", f"{root}/marks", INGESTION_DATE, INGESTED_AT, landing_root=f"{root}/landing")
    return spark.read.schema(RAW_IPL_SCHEDULE).parquet(f"{root}/bronze").select(
        "match_date", "season", "match_number", "team1", "team2", "venue_city", "is_service_city", "_source_file", "_ingestion_date",
        F.lit(got["rows_rejected"]).cast("long").alias("rows_rejected"))


_DAY_SQL = "CASE WHEN c_nationkey = 3 THEN NULL ELSE DATE '2023-01-01' + CAST(c_custkey % 365 AS INTEGER) END"
FLOW_SQL["md10_matches_ingest"] = f"""
SELECT {_DAY_SQL} AS match_date, CAST(2023 AS BIGINT) AS season, c_custkey AS match_number, c_name AS team1, c_mktsegment AS team2,
  CASE c_nationkey WHEN 0 THEN 'Bangalore' WHEN 1 THEN 'Delhi' WHEN 2 THEN 'Pune' ELSE 'Agra' END AS venue_city,
  c_nationkey IN (0, 1, 2) AS is_service_city, 'feed' AS _source_file, DATE '{INGESTION_DATE}' AS _ingestion_date,
  (SELECT count(*) FROM customer WHERE c_nationkey = 3) AS rows_rejected
FROM customer
"""


def md11_festivals_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MD11: SRC2, SRC3, FN21, FN24, PRJ3, SNK5: customers as a festival calendar."""
    major = F.when(F.col("c_nationkey") % 3 == 0, " true ").when(F.col("c_nationkey") % 3 == 1, "False").otherwise("maybe")
    feed = _calendar_csv(spark, sf_dir, {"festival_date": _day_text(), "festival_name": F.col("c_name"), "festival_type": F.lower("c_mktsegment"),
                                         "region": F.lit("all"), "is_major": major})
    root = scratch_path(spark, "festivals")
    got = ingest.ingest_festivals(spark, feed, f"{root}/bronze", f"{root}/audit", f"{root}/marks", INGESTION_DATE, INGESTED_AT, landing_root=f"{root}/landing")
    return spark.read.schema(RAW_FESTIVAL_CALENDAR).parquet(f"{root}/bronze").select(
        "festival_date", "festival_name", "festival_type", "region", "is_major", F.lit(got["status"]).alias("run_status"))


FLOW_SQL["md11_festivals_ingest"] = f"""
SELECT {_DAY_SQL} AS festival_date, c_name AS festival_name, upper(c_mktsegment) AS festival_type, 'ALL' AS region,
  CASE c_nationkey % 3 WHEN 0 THEN true WHEN 1 THEN false END AS is_major,
  CASE WHEN (SELECT count(*) FROM customer WHERE c_nationkey = 3) > 0 THEN 'PARTIAL' ELSE 'SUCCESS' END AS run_status
FROM customer
"""


# ---------------------------------------------------------------- sources

def src_csv_text_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC1 / SRC2: whole texts with quotes, commas and line breaks through CSV and back."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "source", "n_chars")
    path = scratch_path(spark, "documents-csv")
    (docs.write.option("header", True).option("escape", '"').option("quoteAll", True).option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).csv(path))
    return read_csv(spark, path, docs.schema, header_cols=docs.columns, multi_line=True, count_bad=True)


FLOW_SQL["src_csv_text_round_trip"] = "SELECT doc_id, text, source, n_chars, 0 AS _bad_values FROM documents"


def src_ndjson_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC7 / FN22: events as JSON lines, reloaded under a declared schema; fields that it lacks go, missing ones are NULL."""
    root = scratch_path(spark, "events-ndjson")
    read_table(spark, sf_dir, "events").select("event_id", "event_type", "value", "props").write.json(f"{root}/feed")
    declared = StructType([StructField("event_id", LongType()), StructField("event_type", StringType()), StructField("value", StringType()),
                           StructField("note", StringType())])
    loaded = load_ndjson(spark, f"{root}/feed", declared, f"{root}/table")
    table = spark.read.schema(declared).parquet(f"{root}/table")
    typed = conform(table, StructType([StructField("event_id", StringType()), StructField("event_type", StringType()), StructField("value", DoubleType()),
                                       StructField("user_id", LongType())]))
    return typed.withColumn("loaded", F.lit(loaded).cast("long"))


FLOW_SQL["src_ndjson_load"] = """
SELECT CAST(event_id AS VARCHAR) AS event_id, event_type, value, CAST(NULL AS BIGINT) AS user_id,
  (SELECT count(*) FROM events) AS loaded FROM events
"""

CATALOG_FROM = "1996-06-15"


def src_catalog_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC8, SRC10, SRC11, FLT10: a guarded bronze table read through the catalog, by SQL with a parameter."""
    path = scratch_path(spark, "catalog-orders")
    land_table(conform(_orders_feed(spark, sf_dir), RAW_ORDERS), "raw_orders", path)
    catalog = BronzeCatalog(spark, {"raw_orders": path})
    assert not catalog.register_views() and catalog.register_views({"raw_orders": CATALOG_FROM}) == ["raw_orders"]
    found = run_query(spark, "SELECT order_status, count(*) AS n_orders, min(order_date) AS first_date, max(order_amount_inr) AS largest "
                             "FROM raw_orders WHERE order_amount_inr > :least GROUP BY order_status", least=1000.0)
    return found.withColumn("table_rows", F.lit(catalog.row_count("raw_orders")).cast("long"))


FLOW_SQL["src_catalog_sql"] = f"""
SELECT o_orderstatus AS order_status, count(*) AS n_orders, CAST(min(o_orderdate) AS DATE) AS first_date, max(o_totalprice) AS largest,
  (SELECT count(*) FROM orders) AS table_rows
FROM orders WHERE o_orderdate >= TIMESTAMP '{CATALOG_FROM}' AND o_totalprice > 1000 GROUP BY 1
"""


# ---------------------------------------------------------------- sinks

CHANGED_FROM, SENT_BEFORE = "2024-01-20", "2024-01-03"


def snk_partition_writes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK2, SNK4, SNK6: all days landed, the later ones overwritten alone, the first ones appended again."""
    ev = read_table(spark, sf_dir, "events").select("event_id", "value", F.to_date("ts").alias("event_date"))
    path = scratch_path(spark, "events-partitions")
    write_by_date(ev, path, "event_date")
    later = ev.where(F.col("event_date") >= F.lit(CHANGED_FROM).cast("date")).withColumn("value", F.col("value") + 1)
    land(later, path, partition_cols=["event_date"])
    land(ev.where(F.col("event_date") < F.lit(SENT_BEFORE).cast("date")), path, mode="append", partition_cols=["event_date"])
    return spark.read.schema(ev.schema).parquet(path)


FLOW_SQL["snk_partition_writes"] = f"""
WITH e AS (SELECT event_id, value, CAST(ts AS DATE) AS event_date FROM events)
SELECT event_id, CASE WHEN event_date >= DATE '{CHANGED_FROM}' THEN value + 1 ELSE value END AS value, event_date FROM e
UNION ALL SELECT * FROM e WHERE event_date < DATE '{SENT_BEFORE}'
"""


def snk_city_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK1, SNK3: events by type and range of dates, and the manifest of what was written."""
    ev = read_table(spark, sf_dir, "events").withColumnRenamed("event_type", "city")
    files = write_city_ranges(ev, scratch_path(spark, "events-by-type"), "2024-01-01", "2024-01-31")
    return files.groupBy("city", "date_range").agg(F.sum("rows").alias("rows"), F.bool_and(F.col("file_path").contains("date_range=")).alias("has_paths"))


FLOW_SQL["snk_city_manifest"] = """
SELECT event_type AS city, '2024-01-01_2024-01-31' AS date_range, count(*) AS rows, true AS has_paths FROM events GROUP BY 1
"""


def snk_table_and_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK10, SNK11: a declared partitioned table, loaded by partition, behind a view; counted file by file."""
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice", "p_brand")
    path = scratch_path(spark, "parts-table")
    name = f"parts_{path.rpartition('-')[2]}"
    create_table_if_absent(spark, name, part.schema, ["p_brand"], location=path)
    materialize(part, name, "incremental", path=path, partition_col="p_brand")
    spark.sql(f"MSCK REPAIR TABLE {name}")
    materialize(spark.table(name), f"{name}_view", "view")
    out = scratch_path(spark, "parts-by-brand")
    materialize(spark.sql(f"SELECT p_brand, count(*) AS n_parts, round(sum(p_retailprice), 2) AS total FROM {name}_view GROUP BY p_brand"), name, "table", path=out)
    sizes = partition_manifest(spark, path, ["p_brand"], part.schema).groupBy("p_brand").agg(F.sum("rows").alias("rows_in_files"))
    table = spark.read.schema("p_brand string, n_parts bigint, total double").parquet(out)
    spark.sql(f"DROP TABLE {name}")
    return table.join(sizes, "p_brand")


FLOW_SQL["snk_table_and_views"] = """
SELECT p_brand, count(*) AS n_parts, round(sum(p_retailprice), 2) AS total, count(*) AS rows_in_files FROM part GROUP BY 1
"""


FOOTER_COLUMNS = ("l_orderkey", "l_partkey", "l_linenumber")


def agg_footer_extent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG7, SRC11: row count and extents of all lines, landed as a table, from the footers of its files."""
    lines = read_table(spark, sf_dir, "lineitem").select(*FOOTER_COLUMNS)
    path = scratch_path(spark, "lines-table")
    land(lines, path)
    return spark.createDataFrame([table_extent(spark, path, lines.schema, FOOTER_COLUMNS)])


FLOW_SQL["agg_footer_extent"] = f"""
SELECT count(*) AS n_rows, {', '.join(f'{f}({c}) AS {f}_{c}' for c in FOOTER_COLUMNS for f in ('min', 'max'))} FROM lineitem
"""


# ---------------------------------------------------------------- operators without a workload of their own

def srt_ranked_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRT1, SRT2, LIM1: distinct priorities in ascending order with their place, and the sizes of the three largest."""
    orders = read_table(spark, sf_dir, "orders")
    values = aggregates.sorted_distinct(orders, "o_orderpriority")
    placed = values.withColumn("place", F.row_number().over(Window.orderBy("o_orderpriority")))
    top = setops.head_sample(aggregates.frequency(orders, "o_orderpriority"), 3)
    return placed.join(top, "o_orderpriority", "left")


FLOW_SQL["srt_ranked_values"] = """
WITH f AS (SELECT o_orderpriority, count(*) AS n_rows FROM orders GROUP BY 1),
t AS (SELECT * FROM f ORDER BY n_rows DESC, o_orderpriority LIMIT 3)
SELECT f.o_orderpriority, CAST(row_number() OVER (ORDER BY f.o_orderpriority) AS INTEGER) AS place, t.n_rows
FROM f LEFT JOIN t ON t.o_orderpriority = f.o_orderpriority
"""

RECENT_AS_OF = "2024-01-28"


def flt_recent_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT11: events of the seven days before a given day, and later ones."""
    ev = read_table(spark, sf_dir, "events").withColumn("event_date", F.to_date("ts"))
    return filters.within_recent(ev, "event_date", RECENT_AS_OF, 7).select("event_id", "event_date")


FLOW_SQL["flt_recent_window"] = f"""
SELECT event_id, CAST(ts AS DATE) AS event_date FROM events WHERE CAST(ts AS DATE) >= DATE '{RECENT_AS_OF}' - 7
"""


def fn_text_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FN18, FN23, FN24 on part names and types made into such texts."""
    part = read_table(spark, sf_dir, "part")
    flag = F.when(F.col("p_size") % 3 == 0, F.lit("\ttrue ")).when(F.col("p_size") % 3 == 1, F.lit("FALSE")).otherwise(F.col("p_brand"))
    day = F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("2024-02-"), F.lpad(F.col("p_size").cast("string"), 2, "0"))).otherwise(F.col("p_name"))
    cuisine = F.concat_ws(", ", "p_type", F.when(F.col("p_size") % 5 == 0, F.lit("South Indian")))
    return part.select("p_partkey", X.is_indian_cuisine(cuisine).alias("is_indian"), X.to_date_strict(day).alias("day"), X.text_to_bool(flag).alias("flag"))


FLOW_SQL["fn_text_flags"] = """
SELECT p_partkey, p_size % 5 = 0 AS is_indian,
  CASE WHEN p_size % 2 = 0 THEN TRY_CAST('2024-02-' || lpad(CAST(p_size AS VARCHAR), 2, '0') AS DATE) END AS day,
  CASE p_size % 3 WHEN 0 THEN true WHEN 1 THEN false END AS flag
FROM part
"""


def udf_sql_macros(spark: SparkSession, sf_dir: str) -> DataFrame:
    """UDF1: the SQL-language macros over events, called from SQL; customers make a festival calendar and a match schedule."""
    tag = scratch_path(spark, "v").rpartition("-")[2]
    view, customer = f"events_{tag}", read_table(spark, sf_dir, "customer")
    read_table(spark, sf_dir, "events").createOrReplaceTempView(view)
    day = lambda n: F.date_add(F.lit("2024-01-01").cast("date"), (F.col("c_custkey") % n).cast("int"))
    (customer.where("c_custkey % 2 = 0").select(day(50).alias("festival_date"), (F.col("c_nationkey") == 0).alias("is_major"))
     .createOrReplaceTempView(f"festivals_{tag}"))
    (customer.where("c_custkey % 5 = 1").select(day(25).alias("match_date"), F.when(F.col("c_nationkey") < 9, "click").otherwise("view").alias("venue_city"),
                                               (F.col("c_nationkey") % 4 == 0).alias("is_service_city")).createOrReplaceTempView(f"matches_{tag}"))
    register_sql_functions(spark, f"festivals_{tag}", f"matches_{tag}")
    return spark.sql(f"SELECT event_id, safe_divide(value, user_id % 4) AS per_user, classify_weather(user_id % 20, value) AS weather, "
                     f"standardise_city(concat(' ', event_type)) AS city, indian_season(to_date(ts)) AS season, day_of_week_mon0(ts) AS weekday, "
                     "is_festival_day(to_date(ts), false) AS festival, is_festival_day(to_date(ts), true) AS major_festival, "
                     "is_match_day(to_date(ts), event_type) AS match_day, surrogate_key(array(event_type, cast(nullif(user_id % 3, 0) AS string))) AS skey "
                     f"FROM {view}")


FLOW_SQL["udf_sql_macros"] = """
WITH fest AS (SELECT DATE '2024-01-01' + CAST(c_custkey % 50 AS INTEGER) AS d, bool_or(c_nationkey = 0) AS major FROM customer WHERE c_custkey % 2 = 0 GROUP BY 1),
mat AS (SELECT DATE '2024-01-01' + CAST(c_custkey % 25 AS INTEGER) AS d, CASE WHEN c_nationkey < 9 THEN 'click' ELSE 'view' END AS city,
          bool_or(c_nationkey % 4 = 0) AS ours FROM customer WHERE c_custkey % 5 = 1 GROUP BY 1, 2)
SELECT event_id, CASE WHEN user_id % 4 = 0 THEN NULL ELSE value / (user_id % 4) END AS per_user,
  CASE WHEN user_id % 20 > 15 THEN 'heavy_rain' WHEN user_id % 20 > 2.5 THEN 'light_rain' WHEN value > 40 THEN 'extreme_heat'
       WHEN value > 35 THEN 'hot' ELSE 'normal' END AS weather,
  upper(substr(event_type, 1, 1)) || lower(substr(event_type, 2)) AS city,
  CASE WHEN month(ts) IN (12, 1, 2) THEN 'WINTER' WHEN month(ts) IN (3, 4, 5) THEN 'SPRING' WHEN month(ts) IN (6, 7, 8, 9) THEN 'MONSOON'
       WHEN month(ts) IN (10, 11) THEN 'POST_MONSOON' END AS season, CAST(isodow(ts) - 1 AS INTEGER) AS weekday,
  fest.d IS NOT NULL AS festival, coalesce(fest.major, false) AS major_festival, coalesce(mat.ours, false) AS match_day,
  md5(event_type || '-' || coalesce(CAST(nullif(user_id % 3, 0) AS VARCHAR), '_dbt_utils_surrogate_key_null_')) AS skey
FROM events LEFT JOIN fest ON fest.d = CAST(ts AS DATE) LEFT JOIN mat ON mat.d = CAST(ts AS DATE) AND mat.city = event_type
"""


def dq_composite_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ7, DQ12: uniqueness of named column sets, and a rule on two columns, over conversations and lines."""
    q = quality
    turns = q.run_checks(read_table(spark, sf_dir, "conversations"), [
        q.unique(["conv_id", "turn"], "unique_turn"), q.unique(["conv_id", "role"], "unique_role"),
        q.expression("assert_first_turn_is_no_answer", "turn = 0 and role = 'assistant'")], table="conversations")
    lines = q.run_checks(read_table(spark, sf_dir, "lineitem"), [
        q.unique(["l_orderkey", "l_partkey", "l_suppkey"]),
        q.expression("assert_shipped_lines_have_a_price", "l_linestatus = 'F' and not (l_extendedprice > 0)"),
        q.proportion_unique_between("l_returnflag", 0.0, 0.5)], table="lineitem")
    return turns.unionByName(lines)


def _check_sql(table: str, name: str, count: str) -> str:
    return f"SELECT '{table}' AS table_name, '{name}' AS check_name, ({count}) AS failing_rows"


def _duplicates(table: str, *keys: str) -> str:
    some = " AND ".join(f"{k} IS NOT NULL" for k in keys)
    return f"SELECT count(*) FROM (SELECT 1 FROM {table} WHERE {some} GROUP BY {', '.join(keys)} HAVING count(*) > 1)"


FLOW_SQL["dq_composite_keys"] = f"""
SELECT *, CASE WHEN failing_rows > 0 THEN 'error' ELSE 'pass' END AS status FROM (
{_check_sql('conversations', 'unique_turn', _duplicates('conversations', 'conv_id', 'turn'))}
UNION ALL {_check_sql('conversations', 'unique_role', _duplicates('conversations', 'conv_id', 'role'))}
UNION ALL {_check_sql('conversations', 'assert_first_turn_is_no_answer', "SELECT count(*) FROM conversations WHERE turn = 0 AND role = 'assistant'")}
UNION ALL {_check_sql('lineitem', 'unique_l_orderkey_l_partkey_l_suppkey', _duplicates('lineitem', 'l_orderkey', 'l_partkey', 'l_suppkey'))}
UNION ALL {_check_sql('lineitem', 'assert_shipped_lines_have_a_price', "SELECT count(*) FROM lineitem WHERE l_linestatus = 'F' AND NOT (l_extendedprice > 0)")}
UNION ALL {_check_sql('lineitem', 'proportion_unique_l_returnflag', "SELECT CASE WHEN count(DISTINCT l_returnflag) / count(l_returnflag) BETWEEN 0 AND 0.5 THEN 0 ELSE 1 END FROM lineitem")}
)
"""

FLOW_QUERIES = {f.__name__: f for f in (
    snk_upsert_file, jn_append_unseen, snk_cluster_ranges, snk_silver_refresh, jn_coverage_kept_up, stream_upsert_events, md7_restaurants_ingest, md8_orders_ingest, md9_weather_ingest, src_payload_drift, agg_footer_extent, md10_matches_ingest, md11_festivals_ingest,
    snk_audit_rows, src_csv_text_round_trip, src_ndjson_load, src_catalog_sql, snk_partition_writes, snk_city_manifest,
    snk_table_and_views, srt_ranked_values, flt_recent_window, fn_text_flags, udf_sql_macros, dq_composite_keys)}
