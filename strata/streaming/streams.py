"""Structured Streaming forms of the incremental operators (INC3, INC4).

* ``append_new_stream`` -- append only unseen keys (INC4): each micro-batch is
  reduced to one row per key and anti-joined with the keys already in the sink,
  of which only the partitions of the batch's dates are read. However late an
  unseen key comes, it is kept; nothing is dropped by a delay, and no state grows.
* ``upsert_stream`` -- last write wins on re-sent data (INC3): every
  micro-batch is merged into a parquet table with the keyed upsert (SNK7);
  ``order_by`` decides between rows of one batch.

* ``upsert_table_stream`` -- the same on a table of versions: a micro-batch shows as a
  whole, and its number goes into the record, so one that is run again after its
  commit is known by it and not merged twice (rows with a NULL key would be).

All run with ``trigger(availableNow=True)`` for batch-like catch-up and keep
their progress in the checkpoint that the caller names, on shared storage: a
restarted query resumes there. A micro-batch that is run again after a failure
finds its keys in the sink, so nothing is written twice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from strata.operators.dedup import keep_first
from strata.operators.filters import restrict_to_values
from strata.operators.joins import anti_join
from strata.session import observing, path_exists, staging
from strata.sinks.landing import land
from strata.sinks.upsert import upsert_parquet, upsert_table
from strata.sinks.versions import VersionedTable

#: Partition column of an append-only sink: the date of the event time.
DATE_COL = "event_date"


def file_stream(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet",
                max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def append_new_stream(spark: SparkSession, source_path: str, schema: StructType, keys: Sequence[str],
                      event_time: str, sink_path: str, checkpoint: str, fmt: str = "parquet",
                      max_files_per_trigger: int | None = None) -> dict:
    """INC4 as a stream: write each key once, to a sink partitioned by the event's date."""
    written = StructType([*schema.fields, StructField(DATE_COL, DateType(), True)])
    facts = {"batches": 0, "rows_in": 0, "rows_written": 0}

    def append(batch: DataFrame, batch_id: int) -> None:
        spark_ = batch.sparkSession
        seen = Observation()
        dated = batch.observe(seen, F.count(F.lit(1)).alias("n")).withColumn(DATE_COL, F.to_date(event_time))
        with staging(spark_, "append-batch") as stage, observing(spark_):
            keep_first(dated, keys).write.parquet(stage)
            facts["batches"] += 1
            facts["rows_in"] += int(seen.get["n"])
            new = spark_.read.schema(written).parquet(stage)
            if path_exists(spark_, sink_path):
                landed = restrict_to_values(spark_.read.schema(written).parquet(sink_path), new, [DATE_COL], nulls_match=True)
                new = anti_join(new, landed, list(keys))
            facts["rows_written"] += land(new, sink_path, mode="append", partition_cols=[DATE_COL])["row_count"]

    (file_stream(spark, source_path, schema, fmt, max_files_per_trigger).writeStream.foreachBatch(append)
     .option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination())
    return {**facts, "sink": sink_path}


def upsert_stream(spark: SparkSession, source_path: str, schema: StructType, keys: Sequence[str], target_path: str,
                  checkpoint: str, partition_cols: Sequence[str] = (), order_by: Sequence = (), fmt: str = "parquet",
                  max_files_per_trigger: int | None = None) -> list[dict]:
    """INC3 as a stream: each micro-batch upserted into ``target_path``, the first under ``order_by`` winning."""
    results: list[dict] = []

    def merge_batch(batch: DataFrame, batch_id: int) -> None:
        r = upsert_parquet(batch.sparkSession, batch, target_path, keys, partition_cols, order_by)
        results.append({"batch_id": batch_id, "rows_loaded": r.rows_loaded, "rows_affected": r.rows_affected})

    (file_stream(spark, source_path, schema, fmt, max_files_per_trigger).writeStream.foreachBatch(merge_batch)
     .option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination())
    return results


def upsert_table_stream(table: VersionedTable, source_path: str, schema: StructType, keys: Sequence[str], checkpoint: str,
                        order_by: Sequence = (), fmt: str = "parquet", max_files_per_trigger: int | None = None) -> list[dict]:
    """INC3 as a stream into a table of versions: each micro-batch is one version, merged once however often it is run."""
    results: list[dict] = []
    mark = f"stream:{checkpoint}"

    def merge_batch(batch: DataFrame, batch_id: int) -> None:
        if table.snapshot().properties.get(mark, -1) >= batch_id:
            return
        r = upsert_table(VersionedTable(batch.sparkSession, table.root), batch, keys, order_by, {mark: batch_id})
        results.append({"batch_id": batch_id, "rows_loaded": r.rows_loaded, "rows_affected": r.rows_affected})

    (file_stream(table.spark, source_path, schema, fmt, max_files_per_trigger).writeStream.foreachBatch(merge_batch)
     .option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination())
    return results
