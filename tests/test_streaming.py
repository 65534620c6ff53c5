"""Structured Streaming forms: append unseen keys (INC4) and foreachBatch upsert (INC3)."""

import datetime as dt

from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType, TimestampNTZType

from strata.session import scratch_path
from strata.streaming.streams import append_new_stream, upsert_stream

SCHEMA = StructType([StructField("id", LongType()), StructField("ts", TimestampNTZType()),
                     StructField("city", StringType()), StructField("v", DoubleType())])


def test_append_new_keeps_late_unseen_ids(spark):
    src, sink, progress = (scratch_path(spark, n) for n in ("t-stream-src", "t-stream-sink", "t-stream-ckpt"))
    t = dt.datetime(2024, 1, 21)
    first = [(i, t + dt.timedelta(minutes=i), "a", float(i)) for i in range(50)]
    spark.createDataFrame(first, SCHEMA).write.parquet(f"{src}/b=1")
    assert append_new_stream(spark, src, SCHEMA, ["id"], "ts", sink, progress)["rows_written"] == 50
    again = first[40:] + [(99, t - dt.timedelta(days=20), "a", 1.0), (99, t - dt.timedelta(days=20), "a", 1.0), (98, None, "a", 1.0)]
    spark.createDataFrame(again, SCHEMA).write.parquet(f"{src}/b=2")
    second = append_new_stream(spark, src, SCHEMA, ["id"], "ts", sink, progress)
    assert (second["rows_in"], second["rows_written"]) == (13, 2)      # only the new files were read
    out = spark.read.schema(SCHEMA).parquet(sink)
    assert out.count() == 52 and out.select("id").distinct().count() == 52
    assert append_new_stream(spark, src, SCHEMA, ["id"], "ts", sink, scratch_path(spark, "t-lost"))["rows_written"] == 0


def test_upsert_stream_last_wins(spark):
    src, target, progress = (scratch_path(spark, n) for n in ("t-upsert-src", "t-upsert-target", "t-upsert-ckpt"))
    t = dt.datetime(2024, 1, 1)
    spark.createDataFrame([(1, t, "a", 50.0), (2, t, "b", 2.0), (1, t + dt.timedelta(hours=1), "a", 3.0)], SCHEMA).write.parquet(f"{src}/b=1")
    results = upsert_stream(spark, src, SCHEMA, ["id"], target, progress, order_by=["ts"])
    assert sum(r["rows_loaded"] for r in results) == 3
    spark.createDataFrame([(2, t + dt.timedelta(hours=1), "b", 1.0), (3, t, "c", 3.0)], SCHEMA).write.parquet(f"{src}/b=2")
    upsert_stream(spark, src, SCHEMA, ["id"], target, progress, order_by=["ts"])
    assert {r["id"]: r["v"] for r in spark.read.parquet(target).collect()} == {1: 3.0, 2: 1.0, 3: 3.0}
