"""Keyed upsert (SNK7) on fixture B4 and its invariants."""

import datetime as dt

import pytest

from pyspark.sql import functions as F

from strata.session import scratch_path
from strata.sinks.upsert import merge_counts, merge_frames, upsert_parquet
from tests.conftest import rows

D1 = dt.date(2023, 1, 1)
SCHEMA = "city string, d date, v bigint"


def test_merge_frames_b4(spark):
    target = spark.createDataFrame([("A", D1, 1), ("B", D1, 2), (None, D1, 9)], SCHEMA)
    source = spark.createDataFrame([("A", D1, 5), ("A", D1, 5), ("C", D1, 7), (None, D1, 8)], SCHEMA)
    merged = merge_frames(target, source, ["city", "d"])
    assert rows(merged) == rows(spark.createDataFrame(
        [("A", D1, 5), ("B", D1, 2), ("C", D1, 7), (None, D1, 9), (None, D1, 8)], SCHEMA))
    c = merge_counts(target, source, ["city", "d"]).first()
    assert (c["rows_loaded"], c["rows_updated"], c["rows_inserted"], c["rows_affected"]) == (4, 1, 2, 3)


def test_merge_keeps_null_source_values(spark):
    target = spark.createDataFrame([("A", D1, 1)], SCHEMA)
    source = spark.createDataFrame([("A", D1, None)], SCHEMA)
    assert rows(merge_frames(target, source, ["city", "d"])) == [("A", D1, None)]


def test_upsert_parquet_partitioned_and_idempotent(spark):
    path = scratch_path(spark, "test-upsert")
    d2 = dt.date(2023, 1, 2)
    first = spark.createDataFrame([("A", D1, 1), ("B", D1, 2), ("A", d2, 3)], SCHEMA)
    r0 = upsert_parquet(spark, first, path, ["city", "d"], partition_cols=["d"])
    assert (r0.rows_loaded, r0.rows_inserted, r0.rows_updated) == (3, 3, 0)
    batch = spark.createDataFrame([("A", D1, 5), ("A", D1, 5), ("C", D1, 7)], SCHEMA)
    r1 = upsert_parquet(spark, batch, path, ["city", "d"], partition_cols=["d"])
    assert (r1.rows_loaded, r1.rows_affected, r1.rows_updated, r1.rows_inserted) == (3, 2, 1, 1)
    got = rows(spark.read.parquet(path).select("city", "d", "v"))
    assert got == sorted([("A", D1, 5), ("B", D1, 2), ("C", D1, 7), ("A", d2, 3)], key=repr)
    d2_files = spark.read.parquet(f"{path}/d=2023-01-02").inputFiles()
    # re-running the batch changes nothing, and the untouched partition keeps its file
    r2 = upsert_parquet(spark, batch, path, ["city", "d"], partition_cols=["d"])
    assert r2.rows_inserted == 0
    assert rows(spark.read.parquet(path).select("city", "d", "v")) == got
    assert spark.read.parquet(f"{path}/d=2023-01-02").inputFiles() == d2_files


def test_upsert_null_keys_not_idempotent(spark):
    path = scratch_path(spark, "test-upsert-null")
    batch = spark.createDataFrame([(None, D1, 8)], SCHEMA)
    upsert_parquet(spark, batch, path, ["city", "d"])
    upsert_parquet(spark, batch, path, ["city", "d"])
    assert spark.read.parquet(path).count() == 2   # JN6: NULL keys never match


def test_touched_partition_read_is_pruned(spark):
    """The extent of the touched values becomes static PartitionFilters; a semi-join decides."""
    from strata.operators.filters import restrict_to_values

    path = scratch_path(spark, "test-dpp")
    spark.range(3000).selectExpr("id", "date_add(date'2023-01-01', cast(id % 30 as int)) as d") \
        .write.partitionBy("d").parquet(path)
    batch = spark.createDataFrame([(1, dt.date(2023, 1, 3)), (2, dt.date(2023, 1, 5))], "id bigint, d date")
    pruned = restrict_to_values(spark.read.parquet(path), batch, ["d"])
    rows_ = pruned.collect()
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert ">= 2023-01-03" in filters and "<= 2023-01-05" in filters
    assert len(rows_) == 200 and {r["d"] for r in rows_} == {dt.date(2023, 1, 3), dt.date(2023, 1, 5)}
    keys = spark.createDataFrame([(2, dt.date(2023, 1, 3)), (1, dt.date(2023, 1, 5))], "id bigint, d date")
    two = restrict_to_values(spark.read.parquet(path), keys, ["d", "id"])
    assert sorted((r["id"], r["d"]) for r in two.collect()) == [(2, dt.date(2023, 1, 3))]


def test_restrict_to_many_values(spark):
    from strata.operators.filters import restrict_to_values

    df = spark.range(300000).selectExpr("id", "id % 977 as b")
    assert restrict_to_values(df, spark.range(0, 200000, 2), ["id"]).count() == 100000
    pairs = spark.range(0, 10000, 2).selectExpr("id", "id % 977 as b")
    assert restrict_to_values(df, pairs, ["id", "b"]).count() == 5000
    nulls = spark.createDataFrame([(None, 1), (3, None)], "id bigint, b bigint")
    assert restrict_to_values(nulls, nulls, ["id", "b"]).count() == 0
    assert restrict_to_values(nulls, nulls, ["id", "b"], nulls_match=True).count() == 2
    assert restrict_to_values(df, nulls.limit(0), ["id"]).count() == 0


KEYED = "k string, p string, v bigint"


def read(spark, path):
    return rows(spark.read.schema(KEYED).parquet(path).select("k", "p", "v"))


def test_upsert_keeps_null_partitions_types_and_empty_batches(spark):
    path = scratch_path(spark, "test-upsert-nulls")
    up = lambda data: upsert_parquet(spark, spark.createDataFrame(data, KEYED), path, ["k", "p"], ["p"])
    up([("A", None, 9)])                                   # only NULL partition values
    up([("B", "0123", 1), ("B", "01", 2)])                 # leading zeros stay
    r = up([("Z", None, 8), ("C", "0123", 4), ("B", "0123", 5)])
    assert (r.rows_loaded, r.rows_updated, r.rows_inserted) == (3, 1, 2)
    want = sorted([("A", None, 9), ("Z", None, 8), ("B", "0123", 5), ("C", "0123", 4), ("B", "01", 2)], key=repr)
    assert read(spark, path) == want
    r = up([])
    assert (r.rows_loaded, r.rows_affected) == (0, 0) and read(spark, path) == want


def test_first_batch_may_be_empty(spark):
    path = scratch_path(spark, "test-upsert-empty")
    assert upsert_parquet(spark, spark.createDataFrame([], KEYED), path, ["k", "p"], ["p"]).rows_loaded == 0
    upsert_parquet(spark, spark.createDataFrame([("A", "x", 1)], KEYED), path, ["k", "p"], ["p"])
    assert read(spark, path) == [("A", "x", 1)]


def test_latest_row_of_a_batch_wins(spark):
    path = scratch_path(spark, "test-upsert-latest")
    batch = spark.createDataFrame([("A", "2024-01-02", 3), ("A", "2024-01-01", 50)], KEYED)
    upsert_parquet(spark, batch, path, ["k"], order_by=["p"])
    assert read(spark, path) == [("A", "2024-01-02", 3)]
    upsert_parquet(spark, batch, path, ["k"], order_by=["v"])
    assert read(spark, path) == [("A", "2024-01-01", 50)]


def test_failed_upsert_leaves_target_and_no_staging(spark):
    from strata.session import checkpoint_dir, list_names, local_path

    path = scratch_path(spark, "test-upsert-fail")
    upsert_parquet(spark, spark.createDataFrame([("A", "x", 1)], KEYED), path, ["k"])
    bad = spark.createDataFrame([("A", "y", 0)], KEYED).selectExpr("k", "p", "raise_error('no') as v")
    before = list_names(spark, f"{checkpoint_dir(spark)}/strata-scratch")
    with pytest.raises(Exception, match="no"):
        upsert_parquet(spark, bad.selectExpr("k", "p", "cast(v as bigint) as v"), path, ["k"])
    upsert_parquet(spark, spark.createDataFrame([("B", "x", 1)], KEYED), path, ["k"])
    assert read(spark, path) == [("A", "x", 1), ("B", "x", 1)]
    assert sorted(list_names(spark, f"{checkpoint_dir(spark)}/strata-scratch")) == sorted(before)
    assert local_path(path)
