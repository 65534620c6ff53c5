"""Landing writes (SNK1-SNK6, SNK10-SNK12).

Every write is a distributed DataFrame write; run facts (row counts, kept /
rejected rows) come from an ``Observation`` on the written plan, so they cost
no second pass over the data.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.functions.temporal import month_start
from strata.schemas import MONTH_PARTITION, TABLE_LAYOUT
from strata.session import configure, observing


def land(df: DataFrame, path: str, *, mode: str = "overwrite", fmt: str = "parquet",
         partition_cols: Sequence[str] = (), metrics: Mapping[str, Column] | None = None,
         sort_within: Sequence[str] = (), rebalance: bool = True) -> dict:
    """SNK1 / SNK4-SNK6: write ``df`` and return a manifest.

    ``mode``: 'overwrite' (truncate, SNK5), 'append' (SNK6). With
    ``partition_cols`` and overwrite, only partitions present in ``df`` are
    replaced (dynamic partition overwrite, SNK4). ``metrics`` are extra named
    aggregate expressions observed during the same write (e.g. ``count_if``).

    ``rebalance`` asks AQE to size output files: a partition value holding a
    third of the rows is split over several tasks / files instead of one.
    ``sort_within`` clusters rows inside each file (min/max skipping, SNK10).
    """
    configure(df.sparkSession)
    obs = Observation()
    aggs = [F.count(F.lit(1)).alias("row_count")]
    for name, expr in (metrics or {}).items():
        aggs.append(expr.alias(name))
    out = df.observe(obs, *aggs)
    if partition_cols and rebalance:
        out = out.hint("rebalance", *partition_cols)
    if sort_within:  # the partition first, as the writer asks for
        out = out.sortWithinPartitions(*partition_cols, *sort_within)
    writer = out.write.mode(mode).format(fmt)
    if partition_cols:
        writer = writer.partitionBy(*partition_cols)
        if mode == "overwrite":
            writer = writer.option("partitionOverwriteMode", "dynamic")
    with observing(df.sparkSession):
        writer.save(path)
    manifest = {k: (int(v) if isinstance(v, (int,)) else v) for k, v in obs.get.items()}
    manifest.update({"path": path, "mode": mode, "format": fmt, "partition_cols": list(partition_cols)})
    return manifest


def partition_manifest(spark: SparkSession, path: str, partition_cols: Sequence[str],
                       schema: StructType | None = None) -> DataFrame:
    """SNK2 / SNK3: written files per partition with their row counts.

    Reads only file metadata columns and partition values (no data columns).
    """
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.parquet(path)
    return (df.groupBy(*partition_cols, F.col("_metadata.file_path").alias("file_path"))
            .agg(F.count(F.lit(1)).alias("rows")).orderBy(*partition_cols, "file_path"))


def write_by_date(df: DataFrame, path: str, date_col: str = "order_date") -> dict:
    """SNK2: ``{path}/{date_col}={d}/`` -- normally one file per date (a
    hot date is split by AQE's rebalance rather than written by one task)."""
    return land(df, path, partition_cols=[date_col])


def write_city_ranges(df: DataFrame, path: str, start: str, end: str,
                      city_col: str = "city") -> DataFrame:
    """SNK3: ``{path}/city={c}/date_range={start}_{end}/``; the manifest lists the files and their rows.

    The manifest is read from what was written (file footers), not by
    computing ``df`` again.
    """
    tagged = df.withColumn("date_range", F.lit(f"{start}_{end}"))
    land(tagged, path, partition_cols=[city_col, "date_range"])
    files = partition_manifest(df.sparkSession, path, [city_col, "date_range"], tagged.schema)
    return files.where(F.col("date_range") == f"{start}_{end}")


def land_table(df: DataFrame, name: str, path: str, mode: str = "overwrite",
               metrics: Mapping[str, Column] | None = None) -> dict:
    """SNK10: write a bronze table as ``TABLE_LAYOUT`` says: partitioned (orders by month), rows clustered in files."""
    partition, cluster = TABLE_LAYOUT[name]
    if name in MONTH_PARTITION:
        df, partition = with_month_partition(df, partition, MONTH_PARTITION[name]), MONTH_PARTITION[name]
    return land(df, path, mode=mode, partition_cols=[partition] if partition else [], sort_within=cluster, metrics=metrics)


def with_month_partition(df: DataFrame, date_col: str = "order_date",
                         out_col: str = "order_month") -> DataFrame:
    """SNK12: month partition value (first day of month) for a date column."""
    return df.withColumn(out_col, month_start(F.col(date_col)))


def create_table_if_absent(spark: SparkSession, name: str, schema: StructType,
                           partition_cols: Sequence[str] = (), location: str | None = None) -> bool:
    """SNK10: ``CREATE TABLE IF NOT EXISTS ... USING parquet PARTITIONED BY``.

    Returns True when the table was created. Clustering is applied at write
    time with ``sort_within`` (parquet has no clustering metadata).
    """
    if spark.catalog.tableExists(name):
        return False
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    ddl = f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet"
    if partition_cols:
        ddl += " PARTITIONED BY (" + ", ".join(f"`{c}`" for c in partition_cols) + ")"
    if location:
        ddl += f" LOCATION '{location}'"
    spark.sql(ddl)
    return True


def materialize(df: DataFrame, name: str, kind: str, *, path: str | None = None,
                partition_col: str | None = None) -> None:
    """SNK11: bronze = view, silver = table, gold = incremental by partition.

    'incremental' rewrites only the partitions present in ``df`` (dynamic
    partition overwrite on ``partition_col``).
    """
    if kind == "view":
        df.createOrReplaceTempView(name)
    elif kind == "table":
        w = df.write.mode("overwrite")
        w.parquet(path) if path else w.saveAsTable(name)
    elif kind == "incremental":
        if not path or not partition_col:
            raise ValueError("incremental needs a path and a partition column")
        land(df, path, partition_cols=[partition_col])
    else:
        raise ValueError(f"unknown materialization {kind!r}")
