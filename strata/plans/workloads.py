"""Driver-table workloads: one callable per operator family.

Each function takes ``(spark, sf_dir)`` and returns a lazy DataFrame built
from the package's operators. The matching DuckDB text lives in
``strata.plans.oracle``; column names agree one to one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import functions as X
from strata.operators import dedup, filters
from strata.sources.tables import read_table

# Status letters of the driver's orders table, flagged like the order model's
# CANCELLED / DELIVERED / REFUND_REQUESTED flags.
DRIVER_STATUS_FLAGS = {"is_finished": "F", "is_open": "O", "is_partial": "P"}


def md3_orders_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MD3 shape on ``orders``: FLT3 -> FLT2 -> WIN1 -> FN9-11,13 -> FLT4."""
    orders = read_table(spark, sf_dir, "orders")
    src = filters.since(orders, "o_orderdate", "1996-01-01")
    latest = dedup.keep_latest(src, ["o_orderkey"], "o_orderdate", drop_null_keys=["o_orderkey"])
    flags = X.status_flags("o_orderstatus", DRIVER_STATUS_FLAGS)
    ts = F.col("o_orderdate")
    shaped = latest.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.to_date(ts).alias("order_date"),
        ts.alias("order_datetime"),
        X.hour_of(ts).alias("order_hour"),
        X.day_of_week_mon0(ts).alias("order_day_of_week"),
        X.is_weekend(ts).alias("is_weekend"),
        F.col("o_totalprice").alias("order_amount"),
        F.upper("o_orderstatus").alias("order_status"),
        *[c.alias(n) for n, c in flags.items()],
        F.col("o_orderpriority").alias("order_priority"),
    )
    return filters.plausible_range(shaped, "order_amount", 0, 400000)


# ---------------------------------------------------------------------------
# Window dedup (WIN1-WIN5)

LINE_KEYS = ["l_orderkey", "l_linenumber"]


def win_dedup_latest_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WIN1/WIN3 + FLT2: latest ship date per (order, line); total tie-break."""
    li = read_table(spark, sf_dir, "lineitem")
    return dedup.keep_latest(li, LINE_KEYS, "l_shipdate", drop_null_keys=LINE_KEYS)


def win_dedup_authoritative_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WIN2: one document per distinct text: most characters, then lowest doc_id.

    The text itself never enters the shuffle: only its md5 travels with the
    small columns, so the exchange is a few dozen bytes per row whatever the
    document length.
    """
    docs = read_table(spark, sf_dir, "documents").select(
        F.md5(F.col("text")).alias("text_hash"), "doc_id", "lang", "source", "n_chars")
    return dedup.keep_first(docs, ["text_hash"], ["n_chars", F.col("doc_id").asc_nulls_last()])


# ---------------------------------------------------------------------------
# Silver-model shapes on driver tables (MD1, MD2, MD4, MD5, MD6)

# Workload parameters of our own (not reference values): words in part names
# that mark a fastener, and the size band -> price bucket rule.
FASTENER_WORDS = ("BOLT", "RING", "ROD")
SIZE_BAND_WIDTH = 13


def md1_part_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MD1 shape: WIN2 -> FN1 city-style standardise, FN17, FN18/FLT8, FN16, FN14."""
    part = read_table(spark, sf_dir, "part")
    best = dedup.keep_most_authoritative(part, ["p_partkey"], "p_retailprice", "p_size",
                                         drop_null_keys=["p_partkey"])
    band = F.ceil(F.col("p_size") / F.lit(SIZE_BAND_WIDTH)).cast("int")
    return best.select(
        F.col("p_partkey").alias("part_id"),
        F.trim("p_name").alias("part_name"),
        X.standardise_city("p_type").alias("part_type"),
        X.first_list_item("p_name", " ").alias("name_primary"),
        X.contains_any("p_name", FASTENER_WORDS).alias("is_fastener"),
        X.safe_divide(F.col("p_retailprice"), F.col("p_size").cast("double")).alias("price_per_size"),
        band.alias("size_band"),
        X.price_tier(band).alias("size_tier"),
        X.between_or_null(F.col("p_retailprice") / F.lit(200.0), 0, 5).alias("price_score"),
    )


ACCTBAL_SCALE = 2000.0
SCD_VALID_FROM = "2020-01-01"


def md2_tiering_scd1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MD2 shape: WIN2 -> FLT5 range guard -> FN15 tiers -> PRJ6 validity columns."""
    sup = read_table(spark, sf_dir, "supplier")
    best = dedup.keep_most_authoritative(sup, ["s_suppkey"], "s_acctbal", "s_nationkey",
                                         drop_null_keys=["s_suppkey"])
    score = X.between_or_null(F.col("s_acctbal") / F.lit(ACCTBAL_SCALE), 0, 5)
    return (best.select(F.col("s_suppkey").alias("supplier_id"), score.alias("score"),
                        F.col("s_name").alias("supplier_name"))
            .select("supplier_id", "score", "supplier_name",
                    X.rating_tier(F.col("score")).alias("score_tier"),
                    F.lit(SCD_VALID_FROM).cast("date").alias("valid_from"),
                    F.lit(None).cast("date").alias("valid_to"),
                    F.lit(True).alias("is_current")))


def md4_weather_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MD4 shape on lineitem read as daily readings.

    A (return flag, ship day) pair stands for (city, weather_date); the
    highest order key is the latest fetch (WIN3). Quantity stands for the
    max temperature, discount x 200 for precipitation and tax x 100 for the
    min temperature, which spans every season and weather class.
    """
    li = read_table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("city"),
        F.to_date("l_shipdate").alias("weather_date"),
        F.col("l_quantity").alias("temperature_max"),
        (F.col("l_tax") * F.lit(100.0)).alias("temperature_min"),
        (F.col("l_discount") * F.lit(200.0)).alias("precipitation_sum"),
        F.col("l_orderkey").alias("fetch_seq"),
        F.col("l_linenumber").alias("reading_no"),
    )
    latest = dedup.keep_latest(li, ["city", "weather_date"], "fetch_seq",
                               drop_null_keys=["city", "weather_date"])
    category = X.classify_weather(F.col("precipitation_sum"), F.col("temperature_max"))
    return latest.select(
        X.standardise_city("city").alias("city"),
        "weather_date", "temperature_max", "temperature_min", "precipitation_sum",
        X.is_rainy("precipitation_sum").alias("is_rainy"),
        category.alias("weather_category"),
        X.temperature_range("temperature_max", "temperature_min").alias("temperature_range"),
        X.monsoon_month("weather_date").alias("monsoon_month"),
        X.is_extreme_weather(category).alias("is_extreme_weather"),
        X.season("weather_date").alias("season"),
        "fetch_seq",
    )


KNOCKOUT_PRIORITIES = ("1-urgent", "2-high", "3-medium")


def md5_label_knockout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MD5 shape: WIN4 (4-key keep-latest) -> FN1, FN19, FN20 via a customer join."""
    orders = read_table(spark, sf_dir, "orders").select(
        F.to_date("o_orderdate").alias("match_date"), "o_custkey", "o_orderstatus",
        "o_orderpriority", "o_orderkey")
    latest = dedup.keep_latest(orders, ["match_date", "o_custkey", "o_orderstatus", "o_orderpriority"],
                               "o_orderkey", drop_null_keys=["match_date"])
    cust = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    joined = latest.join(cust, latest.o_custkey == cust.c_custkey, "left")
    return joined.select(
        "match_date", "o_orderkey",
        X.standardise_city("c_mktsegment").alias("venue"),
        X.pair_label("c_name", "c_mktsegment").alias("match_label"),
        F.lower(F.trim("o_orderpriority")).alias("match_type"),
        X.in_folded("o_orderpriority", KNOCKOUT_PRIORITIES).alias("is_knockout"),
    )


def md6_calendar_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MD6 shape: WIN3 keep-latest per (date, name) -> FN12 year/month, FN21 upper-trim."""
    orders = read_table(spark, sf_dir, "orders").select(
        F.to_date("o_orderdate").alias("festival_date"),
        F.col("o_orderpriority").alias("festival_name"),
        F.col("o_orderstatus").alias("festival_type"),
        F.col("o_orderkey").alias("ingest_seq"))
    latest = dedup.keep_latest(orders, ["festival_date", "festival_name"], "ingest_seq",
                               drop_null_keys=["festival_date", "festival_name"])
    return latest.select(
        "festival_date", "festival_name",
        X.upper_trim("festival_type").alias("festival_type"),
        (X.upper_trim("festival_type") == F.lit("F")).alias("is_major"),
        F.year("festival_date").alias("festival_year"),
        F.month("festival_date").alias("festival_month"),
        "ingest_seq",
    )


# ---------------------------------------------------------------------------
# Joins (JN1-JN11), coverage (MD12)

def jn_coverage_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MD12 shape: orders with no lineitem, counted per order date."""
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", F.to_date("o_orderdate").alias("order_date"))
    li = read_table(spark, sf_dir, "lineitem")
    return joins_coverage(orders, li)


def joins_coverage(orders: DataFrame, li: DataFrame) -> DataFrame:
    from strata.operators import joins

    return joins.coverage_gap(orders, li, [("o_orderkey", "l_orderkey")], "orders_without_lines",
                              group_cols=["order_date"])


def jn_coverage_gap_two_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN1/JN2 + AGG1: (user, day) purchases with no view that day (MD12 exactly)."""
    from strata.operators import joins

    ev = read_table(spark, sf_dir, "events").select(
        "user_id", F.to_date("ts").alias("event_date"), "event_type")
    purchases = ev.where(F.col("event_type") == "purchase")
    views = ev.where(F.col("event_type") == "view")
    return joins.coverage_gap(purchases, views, ["user_id", "event_date"], "purchases_without_view")


def jn_exists_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN3: per order, EXISTS a lineitem."""
    from strata.operators import joins

    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    li = read_table(spark, sf_dir, "lineitem")
    return joins.exists_flag(orders, li, [("o_orderkey", "l_orderkey")], "has_lines")


def jn_exists_flag_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN3 (major_only) / JN4: EXISTS a returned lineitem on the order, and one
    shipped on the order's date (two keys).

    One aggregate per order carries both facts: whether any line was returned,
    and the distinct ship dates (a few lines an order), so lines are scanned,
    and orders joined, once.
    """
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", F.to_date("o_orderdate").alias("order_date"))
    lines = (read_table(spark, sf_dir, "lineitem").where(F.col("l_orderkey").isNotNull())
             .groupBy(F.col("l_orderkey").alias("o_orderkey"))
             .agg(F.bool_or(F.col("l_returnflag") == "R").alias("returned"),
                  F.collect_set(F.to_date("l_shipdate")).alias("ship_dates")))
    return orders.join(lines, "o_orderkey", "left").select(
        "o_orderkey", "order_date", F.coalesce("returned", F.lit(False)).alias("has_returned_line"),
        F.coalesce(F.array_contains("ship_dates", F.col("order_date")), F.lit(False)).alias("shipped_same_day"))


APPEND_BATCH_FROM = "1998-01-01"
APPEND_EXISTING_BEFORE = "1999-01-01"


def _lineitem_batches(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem").withColumn("ship_date", F.to_date("l_shipdate"))
    batch = li.where(F.col("l_shipdate") >= F.lit(APPEND_BATCH_FROM).cast("timestamp_ntz"))
    existing = li.where(F.col("l_shipdate") < F.lit(APPEND_EXISTING_BEFORE).cast("timestamp_ntz"))
    return batch, existing


def _existing_near(batch, existing):
    """Existing rows between the batch's first and last date: two literals that prune the scan (SRC9)."""
    return filters.within_extent(existing, batch, ["ship_date"])


def jn_append_new_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN5 / SET2 / SRC9 / INC4: batch rows whose key is not already landed.

    Existing keys are looked up only between the batch's dates, then
    anti-joined once on the key; in-batch duplicates are kept.
    """
    from strata.operators import joins

    batch, existing = _lineitem_batches(spark, sf_dir)
    return joins.anti_join(batch, _existing_near(batch, existing), LINE_KEYS)


def agg_append_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG12: rows in the batch, processed (new) and rejected (already landed).

    One pass: each batch row is flagged by an existence join against the
    existing keys between its dates, then a single aggregate counts both.
    """
    from strata.operators import joins

    batch, existing = _lineitem_batches(spark, sf_dir)
    flagged = joins.exists_flag(batch.select(*LINE_KEYS), _existing_near(batch, existing), LINE_KEYS, "_exists")
    return flagged.agg(F.count(F.lit(1)).alias("rows_in_batch"),
                       F.count_if(~F.col("_exists")).alias("rows_processed"),
                       F.count_if(F.col("_exists")).alias("rows_rejected"))


# Workload parameters of our own: segment multipliers (case-insensitive keys,
# 'others' default), nation display names, and exact renames.
SEGMENT_MULTIPLIERS = {"building": 2.2, "automobile": 2.0, "machinery": 1.8, "furniture": 1.4, "others": 1.0}
NATION_LABELS = {0: "Nation zero", 1: "Nation one", 2: "Nation two", 3: "Nation three"}
NATION_RENAMES = {"NATION_1": "NATION_ONE", "NATION_2": "NATION_TWO"}


def jn_lookup_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN9 (lookup with default), JN10 (no default -> NULL), JN11 (exact replace)."""
    cust = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    joined = cust.join(nation, cust.c_nationkey == nation.n_nationkey, "left")
    return joined.select(
        "c_custkey",
        X.lookup(F.col("c_mktsegment"), SEGMENT_MULTIPLIERS, default=SEGMENT_MULTIPLIERS["others"],
                 case_insensitive=True).alias("segment_multiplier"),
        X.lookup(F.col("c_nationkey"), NATION_LABELS).alias("nation_label"),
        X.replace_values(F.col("n_name"), NATION_RENAMES).alias("nation_name"),
    )


DEMAND_START = "2024-01-01"
DEMAND_END = "2024-01-30"
# Our workload's stand-in for city multipliers: keyed by the driver's nation names.
NATION_DEMAND_MULTIPLIERS = {"NATION_0": 1.8, "NATION_1": 2.0, "NATION_2": 2.2, "NATION_3": 1.4,
                             "NATION_4": 1.6, "NATION_5": 1.5}
RAINY_VALUE = 50.0


def _daily_rain_from_events(spark, sf_dir) -> DataFrame:
    """Per date 'weather': rainy when the values of all the day's events average above a level."""
    ev = read_table(spark, sf_dir, "events")
    return (ev.groupBy(F.to_date("ts").alias("weather_date"))
            .agg((F.avg("value") > F.lit(RAINY_VALUE)).alias("is_rainy")))


def jn_spine_expected_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MD13 / JN8 / JN9: customer x date spine x multipliers (+ rainy-day join)."""
    from strata.operators import demand

    cust = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    ents = (cust.join(nation, cust.c_nationkey == nation.n_nationkey, "left")
            .select("c_custkey", F.col("n_name").alias("city"), F.col("c_mktsegment").alias("segment")))
    rain = _daily_rain_from_events(spark, sf_dir)
    out = demand.expected_demand(
        ents, DEMAND_START, DEMAND_END, city_col="city",
        cuisine_col="segment", rainy=rain, rainy_on=(("order_date", "weather_date"),),
        city_multipliers=NATION_DEMAND_MULTIPLIERS, cuisine_multipliers=SEGMENT_MULTIPLIERS)
    return out.select("c_custkey", "city", "segment", "order_date",
                      F.round("expected_orders", 6).alias("expected_orders"))


def fn_hour_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MD14: daily expected demand per nation spread over 24 weighted hours."""
    from strata.operators import demand

    daily = (jn_spine_expected_demand(spark, sf_dir)
             .groupBy("city", "order_date").agg(F.sum("expected_orders").alias("expected_orders")))
    hourly = demand.hourly_profile(daily)
    return hourly.select("city", "order_date", "order_hour",
                         F.round("expected_orders_hour", 4).alias("expected_orders_hour"))


# ---------------------------------------------------------------------------
# Sinks (SNK7 upsert), sources (SRC4, SRC5, SRC1-3), streaming (INC4)

UPSERT_TARGET_BEFORE = "1999-01-01"
UPSERT_SOURCE_FROM = "1998-06-01"


def _upsert_sides(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    target = li.where(F.col("l_shipdate") < F.lit(UPSERT_TARGET_BEFORE).cast("timestamp_ntz"))
    source = (li.where(F.col("l_shipdate") >= F.lit(UPSERT_SOURCE_FROM).cast("timestamp_ntz"))
              .withColumn("l_quantity", F.col("l_quantity") + F.lit(1.0)))
    return target, source


def snk_upsert_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK7 / JN6 / WIN5: the table a MERGE of a changed, later batch leaves.

    The reduced batch is staged once, as a load job would; the merge reads it twice.
    """
    from strata.session import scratch_path
    from strata.sinks.upsert import merge_frames

    target, source = _upsert_sides(spark, sf_dir)
    stage = scratch_path(spark, "upsert-batch")
    dedup.keep_first(source, LINE_KEYS).write.parquet(stage)
    return merge_frames(target, spark.read.schema(source.schema).parquet(stage), LINE_KEYS, dedup_source=False)


def snk_upsert_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK7 run facts: rows loaded, updated, inserted, affected."""
    from strata.sinks.upsert import merge_counts

    target, source = _upsert_sides(spark, sf_dir)
    return merge_counts(target, source, LINE_KEYS)


PROPS_SCHEMA = "struct<k: bigint>"


def src_json_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC5 / SRC6: parse the JSON payload column; rows without the field are flagged."""
    ev = read_table(spark, sf_dir, "events").select("event_id", "event_type", "props")
    parsed = ev.withColumn("p", F.from_json(F.col("props"), PROPS_SCHEMA))
    return parsed.select("event_id", "event_type", F.col("p.k").alias("k"),
                         F.col("p.k").isNotNull().alias("is_valid"))


def src_array_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC5 on an array column: one row per (vector, position), zipped with its index."""
    emb = read_table(spark, sf_dir, "embeddings")
    return emb.select("vec_id", "label", F.posexplode("embedding").alias("pos", "value"))


PRUNE_FROM = "2024-01-15"


def src_partition_prune_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK2 + SRC4 + FLT3: land events by day, read back only days >= a bound.

    The landing goes to a fresh folder under the shared checkpoint dir; the
    read passes the schema explicitly (N9) and the date bound becomes a
    ``PartitionFilters`` entry, so earlier days are never opened.
    """
    from pyspark.sql.types import DateType, StructField, StructType

    from strata.session import scratch_path
    from strata.sinks.landing import write_by_date

    ev = read_table(spark, sf_dir, "events")
    path = scratch_path(spark, "events-by-day")
    write_by_date(ev.withColumn("event_date", F.to_date("ts")), path, "event_date")
    schema = StructType(ev.schema.fields + [StructField("event_date", DateType(), True)])
    return filters.since(spark.read.schema(schema).parquet(path), "event_date", PRUNE_FROM)


# Our CSV round trip: title-case headers as a raw feed would carry them.
CUSTOMER_CSV_HEADERS = {"c_custkey": "Customer Key", "c_name": "Customer Name",
                        "c_nationkey": "Country Code", "c_acctbal": "Account Balance",
                        "c_mktsegment": "Market Segment"}
CSV_INGESTED_AT = "2024-02-01 00:00:00"


def src_csv_contract_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC1 + SRC3 + FLT1 + PRJ1-3: a Latin-1 header CSV feed, contract-checked.

    The customer table is written as a raw CSV feed (title-case headers,
    ISO-8859-1) to a fresh scratch folder, then read back the way a raw feed
    is: header contract, explicit header-ordered schema, country filter with
    kept/dropped counts, snake_case names, trimmed strings, lineage columns.
    """
    from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

    from strata.session import scratch_path
    from strata.sources.csv import read_csv, validate_contract

    cust = read_table(spark, sf_dir, "customer")
    path = scratch_path(spark, "customer-csv")
    (cust.select(*[F.col(c).alias(h) for c, h in CUSTOMER_CSV_HEADERS.items()])
     .write.option("header", True).option("encoding", "ISO-8859-1").csv(path))
    declared = StructType([
        StructField("Customer Key", LongType()), StructField("Customer Name", StringType()),
        StructField("Country Code", IntegerType()), StructField("Account Balance", DoubleType()),
        StructField("Market Segment", StringType())])
    cols = validate_contract(spark, path, list(CUSTOMER_CSV_HEADERS.values()), "ISO-8859-1", "customer feed")
    raw = read_csv(spark, path, declared, encoding="ISO-8859-1", header_cols=cols)
    kept, _ = filters.filter_with_counts(raw, F.col("Country Code") == 1, "country")
    cleaned = X.clean_string_columns(X.snake_case_columns(kept))
    return cleaned.withColumns({
        "_ingested_at": F.lit(CSV_INGESTED_AT).cast("timestamp_ntz"),
        "_source_file": F.lit("customer.csv"),
    })


def stream_dedup_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """INC4 as Structured Streaming: events arrive in two batches, the second
    with a slice sent again and with unseen ids of any age; the sink, which is
    partitioned by day, holds each event once."""
    from strata.session import scratch_path
    from strata.streaming.streams import append_new_stream

    ev = read_table(spark, sf_dir, "events")
    src, sink = scratch_path(spark, "events-stream-src"), scratch_path(spark, "events-stream-sink")
    late = F.col("event_id") % 5 == 0
    progress = scratch_path(spark, "events-stream-progress")
    for n, rows in enumerate((ev.where(~late), ev.where(late | (F.col("ts") >= F.lit("2024-01-25").cast("timestamp_ntz"))))):
        rows.write.parquet(f"{src}/batch={n}")
        append_new_stream(spark, src, ev.schema, ["event_id"], "ts", sink, progress)
    return spark.read.schema(ev.schema).parquet(sink).select(*ev.columns)


# ---------------------------------------------------------------------------
# Aggregations (AGG2-AGG12)

def agg_duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG2: duplicated (order, line) keys with their multiplicity."""
    from strata.operators.aggregates import duplicate_keys

    return duplicate_keys(read_table(spark, sf_dir, "lineitem"), LINE_KEYS)


def agg_frequency_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG5 + AGG6: orders per priority, largest first, with share of total."""
    from strata.operators.aggregates import frequency, share_of_total

    counts = frequency(read_table(spark, sf_dir, "orders"), "o_orderpriority")
    return share_of_total(counts, "n_rows").withColumn("share", F.round("share", 9))


def agg_order_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG3 + AGG6 (idxmax) + AGG7 + AGG8 + AGG9 in one pass over orders.

    One aggregate computes extents, conditional and distinct counts and the
    unique proportion; the most frequent priority comes from a scalar
    subquery over the (small) per-priority counts.
    """
    from strata.operators.aggregates import frequency, top_value

    orders = read_table(spark, sf_dir, "orders")
    top = top_value(frequency(orders, "o_orderpriority"), "o_orderpriority", "n_rows").scalar()
    d = F.to_date("o_orderdate")
    return orders.agg(
        F.min(d).alias("min_order_date"), F.max(d).alias("max_order_date"),
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct(d).alias("n_distinct_dates"),
        F.count_if(F.col("o_orderstatus") == "F").alias("n_finished"),
        F.count_if(F.col("o_totalprice") > 300000).alias("n_large"),
        F.round(F.try_divide(F.count_distinct("o_orderstatus").cast("double"),
                             F.count("o_orderstatus").cast("double")), 9).alias("status_unique_proportion"),
    ).withColumn("top_priority", top)


def agg_ingest_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG11: rows per source, distinct 'cities' and rows // cities."""
    from strata.operators.aggregates import ingest_summary

    parts = {
        "customers": read_table(spark, sf_dir, "customer").withColumnRenamed("c_nationkey", "city"),
        "suppliers": read_table(spark, sf_dir, "supplier").withColumnRenamed("s_nationkey", "city"),
        "events": read_table(spark, sf_dir, "events").withColumnRenamed("event_type", "city"),
        "orders": read_table(spark, sf_dir, "orders"),
    }
    return ingest_summary(parts, city_col="city")


def agg_conditional_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG8 grouped: flagged-row counts per return flag."""
    from strata.operators.aggregates import conditional_counts

    li = read_table(spark, sf_dir, "lineitem")
    return conditional_counts(li, {
        "n_discounted": F.col("l_discount") > 0.05,
        "n_bulk": F.col("l_quantity") >= 40,
        "n_open": F.col("l_linestatus") == "O",
    }, group_by=["l_returnflag"])


# ---------------------------------------------------------------------------
# Data quality (DQ1-DQ14)

ORDER_PRIORITIES_ACCEPTED = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED")
SEGMENTS_ACCEPTED = ("AUTOMOBILE", "BUILDING", "FURNITURE", "MACHINERY")


def dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ1-DQ12 over orders, lineitem and customer: (table, check, failing rows, status).

    Per table, every predicate check shares one scan and one aggregate;
    uniqueness / relationship / proportion checks add one key-only shuffle each.
    """
    from strata.operators import quality as q

    orders = read_table(spark, sf_dir, "orders")
    li = read_table(spark, sf_dir, "lineitem")
    cust = read_table(spark, sf_dir, "customer")
    nation = read_table(spark, sf_dir, "nation")
    suites = [
        ("orders", orders, [
            q.not_null("o_orderkey"), q.unique("o_orderkey"),
            q.accepted_values("o_orderstatus", ("F", "O", "P")),
            q.accepted_values("o_orderpriority", ORDER_PRIORITIES_ACCEPTED),
            q.between("o_totalprice", 0, 400000, "o_totalprice is not null"),
            q.relationships("o_custkey", cust, "c_custkey"),
            q.expression("finished_orders_positive_price", "o_orderstatus = 'F' and not (o_totalprice > 0)"),
            q.row_count_between(0), q.proportion_unique_between("o_orderpriority", 0.0, 0.5),
        ]),
        ("lineitem", li, [
            q.not_null("l_orderkey"), q.unique(["l_orderkey", "l_linenumber"]),
            q.between("l_discount", 0, 0.1), q.accepted_values("l_returnflag", ("A", "N", "R")),
            q.expression("returned_lines_positive_quantity",
                         "l_returnflag = 'R' and (l_quantity is null or l_quantity <= 0)"),
            q.relationships("l_orderkey", orders, "o_orderkey"),
        ]),
        ("customer", cust, [
            q.not_null("c_custkey"), q.unique("c_custkey"),
            q.accepted_values("c_mktsegment", SEGMENTS_ACCEPTED),
            q.between("c_acctbal", -999.99, 9999.99),
            q.relationships("c_nationkey", nation, "n_nationkey"),
        ]),
    ]
    out = None
    for name, df, checks in suites:
        r = q.run_checks(df, checks, table=name)
        out = r if out is None else out.unionByName(r)
    return out


FRESHNESS_AS_OF = "2024-01-31 23:30:00"


def dq_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG10 / DQ13: per event type, age of the newest event vs 24 h / 48 h."""
    from strata.operators.aggregates import freshness_by

    ev = read_table(spark, sf_dir, "events")
    return freshness_by(ev, "event_type", "ts", FRESHNESS_AS_OF, 24.0, 48.0)


# ---------------------------------------------------------------------------
# Incremental (INC1, INC2)

INC_LANDED_THROUGH = "2024-01-20"
INC_LANDED_SOURCES = ("click", "view")
INC_RUN_DATES = ("2024-01-15", "2024-01-30")


def inc_next_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """INC1 + INC2: next load range per source and run date, and its row count.

    State: the high-water mark of what landed earlier (click and view events
    through 2024-01-20); other sources are on their first run (7-day
    look-back). A run date before a mark yields an empty range. One count per
    source and day, written once, feeds the sources, the state and the ranges.
    """
    from strata.session import scratch_path
    from strata.streaming.incremental import next_ranges, rows_in_ranges

    daily = scratch_path(spark, "events-by-source-and-day")
    (read_table(spark, sf_dir, "events")
     .groupBy(F.col("event_type").alias("source_name"), F.to_date("ts").alias("event_date"))
     .agg(F.count(F.lit(1)).alias("n")).write.parquet(daily))
    ev = spark.read.schema("source_name string, event_date date, n bigint").parquet(daily)
    landed = ev.where((F.col("event_date") <= F.lit(INC_LANDED_THROUGH).cast("date"))
                      & F.col("source_name").isin(list(INC_LANDED_SOURCES)))
    state = landed.groupBy("source_name").agg(F.max("event_date").alias("watermark_date"))
    runs = F.explode(F.array(*[F.lit(d).cast("date") for d in INC_RUN_DATES]))
    sources = ev.select("source_name").distinct().withColumn("run_date", runs)
    ranges = next_ranges(sources, state, F.col("run_date"))
    return rows_in_ranges(ev, ranges, "source_name", "event_date", group_cols=["run_date"], count_col="n").select(
        "source_name", "run_date", "last_date", "start_date", "end_date", "is_empty", "n_days", "n_rows")


# ---------------------------------------------------------------------------
# Scalar functions (FN16, FN25, FN26), set ops (SET1), projections (PRJ1, PRJ2)

def fn_surrogate_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FN26: md5 surrogate key over (order, line, flag, ship date)."""
    li = read_table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     X.surrogate_key(["l_orderkey", "l_linenumber", "l_returnflag", "l_shipdate"])
                     .alias("line_sk"))


def fn_round_clamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FN25: amount = half-even round to 10 of base x factor, clamped to [80, 3500]."""
    li = read_table(spark, sf_dir, "lineitem")
    base = F.col("l_extendedprice") / F.lit(100.0) - F.lit(50.0)
    factor = F.lit(1.0) + F.col("l_discount") * F.lit(10.0)
    return li.select("l_orderkey", "l_linenumber", X.order_amount(base, factor).alias("order_amount"))


def fn_safe_divide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FN16: division that yields NULL for a zero or NULL denominator."""
    li = read_table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     X.safe_divide(F.col("l_extendedprice"), F.col("l_quantity")).alias("unit_price"),
                     X.safe_divide(F.col("l_tax"), F.col("l_discount")).alias("tax_per_discount"))


def set_union_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SET1: UNION ALL by name of two slices (early and late) that make up all orders."""
    from strata.operators.setops import union_all

    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    is_early = F.coalesce(F.col("o_orderdate") < F.lit("1997-01-01").cast("timestamp_ntz"), F.lit(False))
    early = o.where(is_early).withColumn("slice", F.lit("early"))
    late = o.where(~is_early).select("o_totalprice", "o_orderkey", "o_orderdate").withColumn("slice", F.lit("late"))
    return union_all([early, late])


def prj_clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ1 + PRJ2 + FN21: snake_case names, whitespace-stripped text, blank -> NULL.

    Only lengths and flags leave the projection, never the documents
    themselves, so the output stays small however long the texts are.
    """
    pages = read_table(spark, sf_dir, "pages")
    named = pages.select(F.col("page_id").alias("PageID"), F.col("url").alias("Page URL"),
                         F.col("html").alias("rawHtml"))
    named = X.snake_case_columns(named)
    cleaned = X.clean_string_columns(named)
    return cleaned.select(
        "page_id",
        F.length("page_url").alias("url_length"),
        F.length("raw_html").alias("html_length"),
        F.col("raw_html").isNull().alias("html_is_blank"),
        X.upper_trim(F.regexp_extract("page_url", r"^(\w+)://", 1)).alias("scheme"),
    )


def jn_left_enrich_two_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN1: LEFT equi-join on two keys -- each line enriched with its day's class.

    The right side is the MD4 table (one row per (city, day) after its
    dedup), so the left join cannot fan out; unmatched rows keep NULLs. It is
    written once: the planner then knows its size, and sends it to the lines
    where that is under the broadcast threshold instead of shuffling these.
    """
    from strata.operators import joins
    from strata.session import scratch_path

    lines = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_returnflag").alias("city"),
        F.to_date("l_shipdate").alias("ship_date"))
    daily = md4_weather_classify(spark, sf_dir).select("city", "weather_date", "weather_category", "season")
    path = scratch_path(spark, "daily-weather")
    daily.write.parquet(path)
    daily = spark.read.schema(daily.schema).parquet(path)
    return joins.left_join(lines, daily, [("city", "city"), ("ship_date", "weather_date")])
