"""Bronze ingest flows (MD7-MD11, AGG11).

Each flow is: contract check -> typed read -> row filters / standardisation ->
lineage columns -> landing write (manifest from an Observation) -> bronze
load (truncate, append, or keyed upsert) -> audit row and high-water mark.
Errors of the extraction are audited too. Values that are there but do not
parse become NULL and their rows are counted as rejected.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from strata import functions as X
from strata.operators import joins
from strata.operators.filters import filter_with_counts, within_extent
from strata.schemas import (FESTIVAL_CSV_REQUIRED, FESTIVAL_CSV_SCHEMA, IPL_CSV_REQUIRED, IPL_CSV_SCHEMA,
                            MONTH_PARTITION, RAW_FESTIVAL_CALENDAR, RAW_IPL_SCHEDULE, RAW_ORDERS,
                            RAW_RESTAURANTS, RAW_WEATHER, RESTAURANT_CSV_COLUMNS, RESTAURANT_CSV_SCHEMA, conform)
from strata.session import path_exists
from strata.sinks import ledger
from strata.sinks.audit import audited, run_status
from strata.sinks.landing import land, land_table, with_month_partition, write_city_ranges
from strata.sinks.upsert import upsert_parquet
from strata.sources.csv import BAD_VALUES, read_csv, validate_contract
from strata.sources.json_payload import flatten_weather, read_payloads
from strata.streaming.incremental import ALL_KEYS, WatermarkStore, next_ranges

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for identical results.
INDIA_COUNTRY_CODE = 1
SERVICE_CITIES: tuple[str, ...] = ("Delhi", "Mumbai", "Bangalore", "Chennai", "Hyderabad", "Pune")
# ---------------------------------------------------------------------------
#: Name of the runs in the audit table, unless a flow is given another.
PIPELINE = "bronze_ingestion"


def lineage(df: DataFrame, ingested_at, source_file: str | None, ingestion_date: str | None) -> DataFrame:
    """PRJ3: lineage columns from passed-in values (replayable, not now())."""
    cols = {"_ingested_at": F.lit(ingested_at).cast("timestamp")}
    if source_file is not None:
        cols["_source_file"] = F.lit(source_file)
    if ingestion_date is not None:
        cols["_ingestion_date"] = F.lit(ingestion_date).cast("date")
    return df.withColumns(cols)


def clean_restaurants_for_landing(df: DataFrame, ingested_at, source_file: str,
                                  ingestion_date: str) -> DataFrame:
    """PRJ1 + PRJ2 + PRJ3: snake_case names, trimmed strings (blank -> NULL), lineage."""
    return lineage(X.clean_string_columns(X.snake_case_columns(df)), ingested_at, source_file,
                   ingestion_date)


def _bad_dates(df: DataFrame, *columns: str) -> DataFrame:
    """Parse text dates; each that is there but is no date adds to the row's ``_bad_values``."""
    for c in columns:
        date = X.to_date_strict(c)
        lost = (F.col(c).isNotNull() & (F.trim(c) != "") & date.isNull()).cast("int")
        df = df.withColumns({c: date, BAD_VALUES: F.col(BAD_VALUES) + lost})
    return df


def ingest_restaurants(spark: SparkSession, csv_path: str, landing_root: str, bronze_path: str, audit_path: str,
                       ingestion_date: str, ingested_at, ledger_path: str | None = None, multi_line: bool = False,
                       pipeline: str = PIPELINE) -> dict:
    """MD7: SRC1, SRC3 -> FLT1 -> PRJ1-3 -> SNK1 -> SNK5.

    With ``ledger_path`` (SNK8) a file whose fingerprint is in the ledger is
    skipped (status UNCHANGED); else it is recorded after the load, and the
    fingerprint is part of the manifest.
    """
    fingerprint = None
    if ledger_path is not None:
        changed = ledger.changed_files(spark, csv_path, ledger_path)
        first = changed.select("fingerprint").first()
        if first is None:
            return {"status": "UNCHANGED", "row_count": 0}
        fingerprint = first["fingerprint"]
    with audited(spark, audit_path, pipeline, "restaurants") as run:
        cols = validate_contract(spark, csv_path, RESTAURANT_CSV_COLUMNS, "ISO-8859-1", "restaurant source")
        raw = read_csv(spark, csv_path, RESTAURANT_CSV_SCHEMA, encoding="ISO-8859-1", header_cols=cols,
                       multi_line=multi_line, count_bad=True)
        india, counts = filter_with_counts(raw, F.col("Country Code") == INDIA_COUNTRY_CODE, "india")
        bad = Observation()
        india = india.observe(bad, F.count_if(F.col(BAD_VALUES) > 0).alias("n")).drop(BAD_VALUES)
        cleaned = clean_restaurants_for_landing(india, ingested_at, os.path.basename(csv_path), ingestion_date)
        landing = f"{landing_root}/restaurants/raw"
        manifest = land(cleaned, landing, partition_cols=["_ingestion_date"])
        got = counts.get
        landed = spark.read.schema(cleaned.schema).parquet(landing).where(
            F.col("_ingestion_date") == F.lit(ingestion_date).cast("date"))
        conform(landed, RAW_RESTAURANTS).write.mode("overwrite").parquet(bronze_path)
        run.update(processed=manifest["row_count"], rejected=int(bad.get["n"]))
        run.uri = landing
        if ledger_path is not None:
            ledger.record_files(changed, ledger_path, ingested_at)
    return {"row_count": int(got["total_rows"]), "indian_rows": int(got["rows_kept"]),
            "rows_dropped": int(got["total_rows"] - got["rows_kept"]), "landing": landing,
            "fingerprint": fingerprint, "rows_rejected": run["rejected"], "status": run_status(run)}


def ingest_orders(spark: SparkSession, orders_dir: str, bronze_path: str, audit_path: str,
                  pipeline: str = PIPELINE) -> dict:
    """MD8: SRC4 -> SRC9 -> JN5 -> SNK6 / SNK12 -> SNK9.

    The batch is read with its files' own types (ids may be numbers and times
    text) and conformed. The bronze table is partitioned by month; existing ids
    are looked up between the batch's first and last date only (FLT10), which
    prunes the months. An unreadable bronze table fails the run (D11); only an
    absent one is empty. Rows that are there already are rejected; rows with a
    value that does not conform are loaded with NULL in its place and count as
    rejected too, each row once.
    """
    month = MONTH_PARTITION["raw_orders"]
    with audited(spark, audit_path, pipeline, "orders") as run:
        files, obs = spark.read.parquet(orders_dir), Observation()
        lost = F.lit(0)
        for f in RAW_ORDERS.fields:
            if f.name in files.columns:
                lost = lost + (F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull()).cast("int")
        typed = [F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) if f.name in files.columns else F.lit(None).cast(f.dataType).alias(f.name)
                 for f in RAW_ORDERS.fields]
        batch = files.select(*typed, (lost > 0).alias("_lost")).withColumn("order_date", F.coalesce("order_date", F.to_date("order_datetime")))
        batch = with_month_partition(batch, "order_date", month)
        written = StructType([*RAW_ORDERS.fields, StructField(month, DateType(), True)])
        existing = (spark.read.schema(written).parquet(bronze_path) if path_exists(spark, bronze_path)
                    else spark.createDataFrame([], written))
        bounds = with_month_partition(conform(files, RAW_ORDERS).select(
            F.coalesce("order_date", F.to_date("order_datetime")).alias("order_date")), "order_date", month)
        existing_ids = within_extent(existing, bounds, [month, "order_date"]).select("order_id")
        marked = joins.exists_flag(batch, existing_ids, ["order_id"], "_exists")
        observed = marked.observe(obs, F.count(F.lit(1)).alias("batch_rows"),
                                  F.count_if(F.col("_exists")).alias("rows_known"), F.count_if(F.col("_lost")).alias("rows_unparsed"),
                                  F.count_if(F.col("_exists") | F.col("_lost")).alias("rows_rejected"))
        new = observed.where(~F.col("_exists")).select(*RAW_ORDERS.names)
        land_table(new, "raw_orders", bronze_path, mode="append")
        got = obs.get
        processed = int(got["batch_rows"] - got["rows_known"])
        run.update(processed=processed, rejected=int(got["rows_rejected"]))
    return {"batch_rows": int(got["batch_rows"]), "rows_processed": processed, "rows_unparsed": int(got["rows_unparsed"]),
            "rows_rejected": int(got["rows_rejected"]), "status": run_status(run)}


def ingest_weather(spark: SparkSession, payload_path: str, bronze_path: str, audit_path: str,
                   watermark_path: str, run_date: str, fetched_at, landing_root: str | None = None,
                   pipeline: str = PIPELINE) -> dict:
    """MD9: INC1 -> SRC5/6 -> FN3, FN4, JN10 -> SNK3 -> SNK7 -> INC2 (per city, D10).

    Each city of the payloads has its own next range; the run is up to date
    only when none has one. All rows up to the run date are merged -- the new
    days, and older ones that were sent again, the latest fetch winning. Rows
    after the run date or without a date are rejected and counted, as are
    payloads without data. A city's mark moves to its last merged day; a city
    that failed keeps its mark and is due again. The source's mark is the
    earliest of its cities'.
    """
    marks = WatermarkStore(spark, watermark_path)
    payloads = read_payloads(spark, payload_path)
    cities = payloads.select(F.col("city").cast("string").alias("city")).distinct()
    state = (marks.as_frame().where((F.col("source_name") == "weather") & (F.col("watermark_key") != ALL_KEYS))
             .select(F.col("watermark_key").alias("city"), "watermark_date"))
    due = next_ranges(cities, state, run_date, source_col="city").where(~F.col("is_empty"))
    span = due.agg(F.min("start_date").alias("start"), F.max("end_date").alias("end")).first()
    if span["start"] is None:
        return {"rows": 0, "cities": 0, "status": "UP_TO_DATE"}
    last = F.lit(run_date).cast("date")
    with audited(spark, audit_path, pipeline, "weather") as run:
        valid, found = filter_with_counts(payloads, F.col("daily").isNotNull(), "payloads")
        rows = conform(flatten_weather(valid, fetched_at), RAW_WEATHER)
        kept, dated = filter_with_counts(rows, F.col("weather_date") <= last, "dated")
        if landing_root is not None:
            landing = f"{landing_root}/weather"
            write_city_ranges(kept, landing, span["start"].isoformat(), span["end"].isoformat())
            kept = conform(spark.read.schema(RAW_WEATHER).parquet(landing).where(
                F.col("_fetched_at") == F.lit(fetched_at).cast("timestamp")), RAW_WEATHER)
        result = upsert_parquet(spark, kept, bronze_path, ["city", "weather_date"],
                                partition_cols=["weather_date"], order_by=["_fetched_at"])
        counts, payload_counts = dated.get, found.get
        # this run's rows, as they are in the table now; its days prune the partitions
        landed = within_extent(spark.read.schema(RAW_WEATHER).parquet(bronze_path), kept, "weather_date").where(
            F.col("_fetched_at") == F.lit(fetched_at).cast("timestamp"))
        new = (landed.join(due.select("city", "start_date", "end_date"), "city")
               .where(F.col("weather_date").between(F.col("start_date"), F.col("end_date")))
               .agg(F.count(F.lit(1)).alias("n"), F.count_distinct("city").alias("cities")).first())
        marks.advance_from(landed, "weather", "city", "weather_date")
        earliest = (marks.as_frame().where((F.col("source_name") == "weather") & (F.col("watermark_key") != ALL_KEYS))
                    .agg(F.min("watermark_date").alias("d")).first()["d"])
        if earliest is not None:
            marks.set("weather", earliest.isoformat(), ALL_KEYS)
        quarantined = int(payload_counts["total_rows"] - payload_counts["rows_kept"])
        ahead = int(counts["total_rows"] - counts["rows_kept"])
        run.update(processed=result.rows_loaded, rejected=quarantined + ahead)
    return {"rows": int(new["n"]), "rows_merged": result.rows_loaded, "rows_affected": result.rows_affected,
            "rows_ahead": ahead, "cities": int(new["cities"]), "quarantined": quarantined,
            "range": (span["start"].isoformat(), span["end"].isoformat()), "status": run_status(run)}


def _ingest_calendar(spark, name, source, csv_path, bronze_path, audit_path, watermark_path, ingestion_date, ingested_at,
                     landing_root, pipeline, required, declared, shape, schema, metrics) -> dict:
    """Shared steps of the CSV calendars: contract, typed read, ``shape``, landing by ingestion date, load, mark."""
    with audited(spark, audit_path, pipeline, name) as run:
        cols = validate_contract(spark, csv_path, required, source=source)
        raw = read_csv(spark, csv_path, declared, header_cols=cols, count_bad=True)
        df = lineage(shape(raw), ingested_at, os.path.basename(csv_path), ingestion_date)
        bad = Observation()
        df = conform(df.observe(bad, F.count_if(F.col(BAD_VALUES) > 0).alias("n")), schema)
        if landing_root is not None:
            landing = f"{landing_root}/{name}"
            land(df.withColumn("ingestion_date", F.col("_ingestion_date")), landing, partition_cols=["ingestion_date"])
            df = spark.read.schema(schema).parquet(f"{landing}/ingestion_date={ingestion_date}")
            run.uri = landing
        manifest = land(df, bronze_path, metrics=metrics)
        WatermarkStore(spark, watermark_path).set(name, ingestion_date)
        run.update(processed=manifest["row_count"], rejected=int(bad.get["n"]))
    return {"row_count": manifest["row_count"], "rows_rejected": run["rejected"], "status": run_status(run),
            **{m: manifest[m] for m in metrics}}


def ingest_ipl(spark: SparkSession, csv_path: str, bronze_path: str, audit_path: str, watermark_path: str,
               ingestion_date: str, ingested_at, landing_root: str | None = None, pipeline: str = PIPELINE) -> dict:
    """MD10: SRC2, SRC3 -> JN11 -> FLT7 -> PRJ3 -> SNK5 -> INC2."""

    def shape(raw: DataFrame) -> DataFrame:
        venue = X.replace_values(F.col("venue_city"), X.text.INGEST_CITY_REPLACEMENTS)
        return (_bad_dates(raw, "match_date").withColumn("venue_city", venue)
                .withColumn("is_service_city", F.coalesce(F.col("venue_city").isin(list(SERVICE_CITIES)), F.lit(False))))

    return _ingest_calendar(spark, "ipl_schedule", "IPL schedule source", csv_path, bronze_path, audit_path, watermark_path,
                            ingestion_date, ingested_at, landing_root, pipeline, IPL_CSV_REQUIRED, IPL_CSV_SCHEMA, shape,
                            RAW_IPL_SCHEDULE, {"service_city_rows": F.count_if(F.col("is_service_city"))})


def ingest_festivals(spark: SparkSession, csv_path: str, bronze_path: str, audit_path: str, watermark_path: str,
                     ingestion_date: str, ingested_at, landing_root: str | None = None, pipeline: str = PIPELINE) -> dict:
    """MD11: SRC2, SRC3 -> FN21 upper, FN24 text bool -> PRJ3 -> SNK5 -> INC2."""

    def shape(raw: DataFrame) -> DataFrame:
        return _bad_dates(raw, "festival_date").withColumns({
            "festival_type": F.upper("festival_type"), "region": F.upper("region"), "is_major": X.text_to_bool("is_major")})

    return _ingest_calendar(spark, "festival_calendar", "Festival calendar source", csv_path, bronze_path, audit_path,
                            watermark_path, ingestion_date, ingested_at, landing_root, pipeline, FESTIVAL_CSV_REQUIRED,
                            FESTIVAL_CSV_SCHEMA, shape, RAW_FESTIVAL_CALENDAR,
                            {"major_festival_count": F.count_if(F.col("is_major"))})
