"""Keyed upsert (SNK7, JN6, WIN5) without a transactional table format.

MERGE semantics: the source is first reduced to one row per key (WIN5: the
first under ``order_by``, then a total tie-break); every target row whose key
matches a source row is replaced by that row (all columns); source rows that
match nothing are inserted. Keys compare with SQL '=' -- a NULL key never
matches, so a NULL-keyed source row is always inserted (JN6).

Plan: the reduced source is staged once. One left join target -> source
(matched rows take the source's values via a marker column, so NULL source
values are kept, not coalesced away) and one left-anti join source -> target
keys for the inserts, unioned. Both joins shuffle on the key; AQE broadcasts
the staged side when its measured size is small and splits skewed keys
otherwise.

A partitioned target, whose partition columns are part of the key, is read and
rewritten only where the source touches it (NULL partition values included), by
dynamic partition overwrite, whose commit replaces partitions after all rows
are written. An unpartitioned target is written beside the old one and swapped
in by renames. Every read passes the source's types, so partition values are
never guessed from folder names. Staging folders are removed in any case.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.operators.dedup import keep_first
from strata.operators.filters import restrict_to_values
from strata.session import configure, observing, path_exists, staging, swap_in
from strata.sinks.versions import Conflict, VersionedTable

OP_COL = "__merge_op"
_MARK = "__merge_matched"


@dataclass
class UpsertResult:
    rows_loaded: int
    rows_affected: int
    rows_updated: int
    rows_inserted: int
    target: str


def _key_cond(left: DataFrame, right: DataFrame, keys: Sequence[str], prefix: str):
    cond = None
    for k in keys:
        c = left[k] == right[f"{prefix}{k}"]
        cond = c if cond is None else cond & c
    return cond


def merge_frames(target: DataFrame, source: DataFrame, keys: Sequence[str],
                 with_op: bool = False, dedup_source: bool = True) -> DataFrame:
    """The table that MERGE would leave behind, as a lazy DataFrame.

    ``with_op`` adds ``__merge_op`` in {'keep', 'update', 'insert'} for
    counting affected rows.
    """
    cols = target.columns
    missing = [c for c in cols if c not in source.columns]
    if missing:
        raise ValueError(f"source lacks target columns {missing}")
    staged = keep_first(source.select(*cols), keys) if dedup_source else source.select(*cols)
    prefix = "__s_"
    s = staged.select(*[F.col(c).alias(f"{prefix}{c}") for c in cols], F.lit(True).alias(_MARK))
    joined = target.join(s, _key_cond(target, s, keys, prefix), "left")
    matched = F.coalesce(F.col(_MARK), F.lit(False))
    updated = joined.select(
        *[F.when(matched, F.col(f"{prefix}{c}")).otherwise(target[c]).alias(c) for c in cols],
        *([F.when(matched, F.lit("update")).otherwise(F.lit("keep")).alias(OP_COL)] if with_op else []))
    # Distinct target keys: a key repeated across a third of the target is
    # pre-reduced map-side instead of landing whole in one anti-join task.
    t_keys = target.select(*[F.col(k).alias(f"{prefix}{k}") for k in keys]).distinct()
    inserts = staged.join(t_keys, _key_cond(staged, t_keys, keys, prefix), "left_anti")
    if with_op:
        inserts = inserts.withColumn(OP_COL, F.lit("insert"))
    return updated.unionByName(inserts)


def merge_counts(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """rows_loaded / rows_updated / rows_inserted / rows_affected in one row.

    Counted from the keys alone: one aggregate over the keys of both sides,
    pre-aggregated map-side, instead of the merge itself.
    """
    sides = (target.select(*keys, F.lit(1).alias("t"), F.lit(0).alias("s"))
             .unionByName(source.select(*keys, F.lit(0).alias("t"), F.lit(1).alias("s"))))
    by_key = sides.groupBy(*keys).agg(F.sum("t").alias("t"), F.sum("s").alias("s"))
    no_null = F.lit(True)
    for k in keys:
        no_null = no_null & F.col(k).isNotNull()
    matched = no_null & (F.col("t") > 0) & (F.col("s") > 0)
    counts = by_key.agg(F.coalesce(F.sum("s"), F.lit(0)).cast("long").alias("rows_loaded"),
                        F.coalesce(F.sum(F.when(matched, F.col("t"))), F.lit(0)).cast("long").alias("rows_updated"),
                        F.count_if((F.col("s") > 0) & ~matched).alias("rows_inserted"))
    return counts.withColumn("rows_affected", F.col("rows_updated") + F.col("rows_inserted"))


def _columns_of(spark: SparkSession, path: str, partition_cols: Sequence[str]) -> list[str] | None:
    """Columns of the table at ``path``, from a file's footer; None where there is no table yet."""
    if not path_exists(spark, path):
        return None
    try:
        in_files = spark.read.option("recursiveFileLookup", "true").parquet(path).columns
    except AnalysisException as exc:
        if exc.getCondition() == "UNABLE_TO_INFER_SCHEMA":  # a folder without files
            return None
        raise
    return [*(c for c in in_files if c not in partition_cols), *partition_cols]


#: Times that an upsert is done again after another writer changed the same partitions.
ATTEMPTS = 5


def upsert_table(table: VersionedTable, source: DataFrame, keys: Sequence[str], order_by: Sequence = (), properties: dict | None = None) -> UpsertResult:
    """SNK7 on a table of versions: readers see the whole change or nothing of it, in all partitions.

    As :func:`upsert_parquet`, but only the touched partitions' rows are written,
    to a new folder, and one published record puts them in place. Where another
    writer changed one of these partitions meanwhile, the merge is done again
    on what it left. ``properties`` go into the record.
    """
    spark = table.spark
    snapshot = table.snapshot()
    if any(p not in keys for p in snapshot.partition_cols):
        raise ValueError("partition columns must be part of the upsert key")
    missing = [c for c in snapshot.columns.names if c not in source.columns]
    if missing:
        raise ValueError(f"source lacks target columns {missing}")
    loaded_obs = Observation()
    with staging(spark, "upsert-source") as stage, observing(spark):
        loaded = source.observe(loaded_obs, F.count(F.lit(1)).alias("rows_loaded"))
        keep_first(loaded, keys, order_by).write.parquet(stage)
        staged = spark.read.schema(source.schema).parquet(stage).select(*snapshot.columns.names)
        rows_loaded = int(loaded_obs.get["rows_loaded"])
        if not rows_loaded:
            return UpsertResult(0, 0, 0, 0, table.root)
        for attempt in range(ATTEMPTS):
            op_obs = Observation()
            target = table.read(snapshot)
            if snapshot.partition_cols:
                target = restrict_to_values(target, staged, snapshot.partition_cols, nulls_match=True)
            merged = merge_frames(target, staged, keys, with_op=True, dedup_source=False)
            merged = merged.observe(op_obs, F.count_if(F.col(OP_COL) == "update").alias("rows_updated"),
                                    F.count_if(F.col(OP_COL) == "insert").alias("rows_inserted")).drop(OP_COL)
            try:
                table.replace(merged, snapshot, operation="upsert", whole=not snapshot.partition_cols, properties=properties)
                break
            except Conflict:
                if attempt == ATTEMPTS - 1:
                    raise
                snapshot = table.snapshot()
        ops = op_obs.get
    return UpsertResult(rows_loaded, int(ops["rows_updated"] + ops["rows_inserted"]), int(ops["rows_updated"]), int(ops["rows_inserted"]), table.root)


def upsert_parquet(spark: SparkSession, source: DataFrame, target_path: str, keys: Sequence[str],
                   partition_cols: Sequence[str] = (), order_by: Sequence = ()) -> UpsertResult:
    """SNK7 against a parquet table at ``target_path`` (created when absent).

    ``order_by`` says which of several source rows of a key wins (largest
    first, e.g. the fetch time). With ``partition_cols`` (all of which must be
    keys) only touched partitions are read and rewritten. An empty source
    changes nothing; it creates an empty table where there is none.
    """
    configure(spark)
    partition_cols = list(partition_cols)
    if any(p not in keys for p in partition_cols):
        raise ValueError("partition columns must be part of the upsert key")
    loaded_obs, op_obs = Observation(), Observation()
    with staging(spark, "upsert-source") as stage, observing(spark):
        loaded = source.observe(loaded_obs, F.count(F.lit(1)).alias("rows_loaded"))
        keep_first(loaded, keys, order_by).write.parquet(stage)
        staged = spark.read.schema(source.schema).parquet(stage)
        rows_loaded = int(loaded_obs.get["rows_loaded"])
        cols = _columns_of(spark, target_path, partition_cols)
        if rows_loaded == 0 and cols is not None:
            return UpsertResult(0, 0, 0, 0, target_path)
        if cols is None:
            cols = [*(c for c in source.columns if c not in partition_cols), *partition_cols]
            target = spark.createDataFrame([], source.select(*cols).schema)
        else:
            missing = [c for c in cols if c not in source.columns]
            if missing:
                raise ValueError(f"source lacks target columns {missing}")
            target = spark.read.schema(StructType([source.schema[c] for c in cols])).parquet(target_path)
            if partition_cols:
                target = restrict_to_values(target, staged, partition_cols, nulls_match=True)
        merged = merge_frames(target, staged.select(*cols), keys, with_op=True, dedup_source=False)
        merged = merged.observe(op_obs, F.count_if(F.col(OP_COL) == "update").alias("rows_updated"),
                                F.count_if(F.col(OP_COL) == "insert").alias("rows_inserted")).drop(OP_COL)
        if partition_cols and rows_loaded:
            (merged.hint("rebalance", *partition_cols).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy(*partition_cols).parquet(target_path))
        else:
            beside = f"{target_path.rstrip('/')}.new-{stage.rpartition('-')[2]}"
            merged.hint("rebalance").write.parquet(beside)
            swap_in(spark, beside, target_path)
        ops = op_obs.get
    return UpsertResult(rows_loaded=rows_loaded, rows_affected=int(ops["rows_updated"] + ops["rows_inserted"]),
                        rows_updated=int(ops["rows_updated"]), rows_inserted=int(ops["rows_inserted"]),
                        target=target_path)
