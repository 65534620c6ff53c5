"""Intermediate tables in the shared folder, and connected components as joins.

Lineage is cut by writing Parquet under ``spark.checkpoint.dir``; a lost
executor rereads it. ``Scratch.drop`` removes what no later step reads.
"""

from __future__ import annotations

import contextlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import remove_path, scratch_path


class Scratch:
    """Named tables of one run of an operator."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.base, self.made = spark, scratch_path(spark, name), 0
        self.paths: list[tuple[DataFrame, str]] = []

    def save(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` written and read back; the shuffle files of the write go when it is done."""
        self.made += 1
        path = f"{self.base}/{self.made}-{name}"
        with shuffles_removed(self.spark):
            df.write.parquet(path)
        saved = self.spark.read.schema(df.schema).parquet(path)
        self.paths.append((saved, path))
        return saved

    def drop(self, *tables: DataFrame) -> None:
        """Remove tables that :meth:`save` returned; others stay."""
        for saved, path in self.paths:
            if any(saved is t for t in tables):
                remove_path(self.spark, path)
        self.paths = [x for x in self.paths if not any(x[0] is t for t in tables)]


@contextlib.contextmanager
def shuffles_removed(spark: SparkSession):
    """For an action that nothing but its written result is read of: its shuffle files go at its end, not with the driver's garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches to Python limited by bytes, so long texts do not add up in a task."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))


@contextlib.contextmanager
def one_row_batches(spark: SparkSession):
    """For an action over rows of several MB each: Python gets them one by one."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "1")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def connected_components(edges: DataFrame, scratch: Scratch, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label): the smallest node that links reach, for every node of an edge.

    Alternates the large-star and small-star steps: each hands a node's
    neighbours its smallest neighbour, so chains shorten by a factor every
    round and hubs never gather their lists in one place (only minima by
    partial aggregation, and joins that Spark may split).
    """
    links = (edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
             .where("u <> v").distinct())
    links = scratch.save(links, "links")
    mark = None
    while True:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.where("v > u").join(least, "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        large = scratch.save(large, "large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        kept = large.join(least, "u")
        small = (kept.select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(kept.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        small = scratch.save(small, "small")
        now = small.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        scratch.drop(links, large)
        links = small
        if now == mark:
            break
        mark = now
    nodes = links.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return nodes.unionByName(links.select(F.col("v").alias("node"), F.col("v").alias("label"))).distinct()
