"""Hot keys: one key holding a third of the rows (the brief's skew model).

Checks that results stay whole and exact, that dedup pre-limits rows per map
task before the shuffle, that existence joins split a hot left partition
(AQE skew join) when no broadcast is allowed, and that landing a hot
partition value is spread over several files.
"""

import contextlib
import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata.operators import dedup, joins
from strata.session import scratch_path
from strata.sinks.landing import land


@contextlib.contextmanager
def conf(spark, **kv):
    keys = {k.replace("__", "."): v for k, v in kv.items()}
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def hot_frame(spark, n=30000):
    # a third of all rows share key 0; the rest are spread over ~n keys
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("ts"), (F.col("id") * 7 % 101).alias("v")).repartition(8)


def test_dedup_hot_key_exact_and_prelimited(spark):
    df = hot_frame(spark)
    out = dedup.keep_latest(df, ["k"], "ts")
    got = out.where("k = 0").collect()
    assert len(got) == 1 and got[0]["ts"] == 29997          # latest of the hot key
    assert out.count() == df.select("k").distinct().count()
    plan = out._jdf.queryExecution().executedPlan().toString()
    before_shuffle = plan.split("Exchange")[1]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle


def test_exists_flag_splits_hot_left_key(spark):
    left = hot_frame(spark)
    right = spark.range(0, 30000, 2).select(F.col("id").alias("k"))
    with conf(spark,
              spark__sql__autoBroadcastJoinThreshold="-1",
              spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
              spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="1k",
              spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
              spark__sql__adaptive__advisoryPartitionSizeInBytes="4k",
              spark__sql__shuffle__partitions="16"):
        out = joins.exists_flag(left, right, ["k"], "hit")
        rows = out.collect()
        final = out._jdf.queryExecution().executedPlan().toString()
    assert len(rows) == 30000                                # no fan-out, nothing dropped
    assert sum(r["hit"] for r in rows) == left.where(F.col("k") % 2 == 0).count()
    assert "SortMergeJoin(skew=true)" in final               # AQE split the hot key's partition


def test_hot_partition_landing_is_split(spark):
    d0 = dt.date(2024, 1, 1)
    df = spark.range(60000).select(
        F.when(F.col("id") % 3 == 0, F.lit(d0)).otherwise(F.date_add(F.lit(d0), (F.col("id") % 50).cast("int")))
        .alias("d"), F.col("id"), F.sha2(F.col("id").cast("string"), 256).alias("pad"))
    path = scratch_path(spark, "t-hot-land")
    with conf(spark, spark__sql__adaptive__advisoryPartitionSizeInBytes="64k",
              spark__sql__shuffle__partitions="16"):
        m = land(df, path, partition_cols=["d"])
    assert m["row_count"] == 60000
    hot_files = spark.read.parquet(f"{path}/d=2024-01-01").inputFiles()
    assert len(hot_files) > 1                                # the hot day is not one task's file
    assert spark.read.parquet(path).count() == 60000


def test_upsert_with_hot_target_key(spark):
    from strata.sinks.upsert import merge_frames

    target = hot_frame(spark, 9000)
    source = spark.createDataFrame([(0, 99999, 1), (5, 1, 1), (-1, 1, 1)], "k bigint, ts bigint, v bigint")
    with conf(spark, spark__sql__autoBroadcastJoinThreshold="-1",
              spark__sql__adaptive__autoBroadcastJoinThreshold="-1"):
        merged = merge_frames(target, source, ["k"])
        assert merged.count() == 9001                       # every target row kept/updated, one insert
        assert merged.where("k = 0 and ts = 99999").count() == 3000   # all hot rows updated
