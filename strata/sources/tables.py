"""Readers for the driver's parquet tables and named table registries (SRC4, SRC8)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES: tuple[str, ...] = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table. Column pruning and filter pushdown happen at the scan."""
    return spark.read.parquet(table_path(sf_dir, name))


def register_views(spark: SparkSession, sf_dir: str, names=DRIVER_TABLES) -> None:
    """Expose the tables as temp views for ``spark.sql`` (SRC8 / SRC10)."""
    for name in names:
        read_table(spark, sf_dir, name).createOrReplaceTempView(name)
