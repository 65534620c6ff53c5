"""Row counts and extents of Parquet tables from their files' footers (AGG7, AGG10, SRC11, DQ6, DQ13).

Spark answers ``count``, ``min`` and ``max`` from footers when the table is read
through its newer Parquet source and aggregates are pushed down; no data page is
read then, whatever the table's size. Both settings hold for the one aggregate
only. Texts, decimals, times and floating point numbers have no exact extent in
footers, so a request with one of them is an ordinary scan of its columns.
"""

from __future__ import annotations

import contextlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, ByteType, DateType, IntegerType, LongType, ShortType, StructType

_EXACT = (BooleanType, ByteType, ShortType, IntegerType, LongType, DateType)
_SETTINGS = {"spark.sql.sources.useV1SourceList": lambda old: ",".join(x for x in old.split(",") if x.strip() != "parquet"),
             "spark.sql.parquet.aggregatePushdown": lambda old: "true"}


@contextlib.contextmanager
def pushed_aggregates(spark: SparkSession):
    """For reading a Parquet table and an action on its aggregate."""
    before = {k: spark.conf.get(k) for k in _SETTINGS}
    try:
        for k, change in _SETTINGS.items():
            spark.conf.set(k, change(before[k]))
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def _extent(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    return rows.agg(F.count(F.lit(1)).alias("n_rows"), *(f(c).alias(f"{name}_{c}") for c in columns for name, f in (("min", F.min), ("max", F.max))))


def table_extent(spark: SparkSession, path: str, schema: StructType, columns: Sequence[str] = ()) -> Row:
    """``n_rows`` and ``min_<c>`` / ``max_<c>`` of a Parquet table, one row; 0 and NULLs for a table without rows."""
    exact = all(isinstance(schema[c].dataType, _EXACT) for c in columns)
    with pushed_aggregates(spark) if exact else contextlib.nullcontext():
        found = _extent(spark.read.schema(schema).parquet(path), columns).first().asDict()
    return Row(**{**found, "n_rows": found["n_rows"] or 0})  # the sum over no footers is NULL
