"""Named bronze sources (SRC8, SRC10, SRC11, FLT10, SRC7).

A ``BronzeCatalog`` maps each bronze table name to its storage path and
declared schema. Reads always pass the schema (no inference, N9) and go
through one place, which is where the partition-filter guard lives: a table
declared with a required partition filter can only be read with a lower
bound on its partition column, so a full scan of e.g. ``raw_orders`` is
refused rather than silently run.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.types import StructType

from strata.operators.filters import since
from strata.operators.footers import table_extent
from strata.schemas import BRONZE_SCHEMAS, REQUIRE_PARTITION_FILTER, TABLE_LAYOUT


class PartitionFilterRequired(ValueError):
    """A table that requires a partition predicate was read without one."""


class BronzeCatalog:
    def __init__(self, spark: SparkSession, paths: Mapping[str, str],
                 schemas: Mapping[str, StructType] = BRONZE_SCHEMAS) -> None:
        self.spark = spark
        self.paths = dict(paths)
        self.schemas = dict(schemas)

    def partition_column(self, name: str) -> str | None:
        return TABLE_LAYOUT.get(name, (None, ()))[0]

    def exists(self, name: str) -> bool:
        path = self.paths.get(name)
        if path is None:
            return False
        try:
            self.spark.read.schema(self.schemas[name]).parquet(path)
            return True
        except AnalysisException as exc:
            if "PATH_NOT_FOUND" in str(exc):
                return False
            raise

    def source(self, name: str, since_value=None) -> DataFrame:
        """SRC8: the table as a DataFrame; ``since_value`` bounds the partition column.

        FLT10: tables in ``REQUIRE_PARTITION_FILTER`` refuse reads without it.
        """
        part = self.partition_column(name)
        if name in REQUIRE_PARTITION_FILTER and since_value is None:
            raise PartitionFilterRequired(f"{name} must be read with a lower bound on {part}")
        df = self.spark.read.schema(self.schemas[name]).parquet(self.paths[name])
        if since_value is not None and part is not None:
            df = since(df, part, since_value)
        return df

    def register_views(self, since_values: Mapping[str, object] | None = None) -> list[str]:
        """Temp views for ``spark.sql`` users; guarded tables need a bound."""
        done = []
        for name in self.paths:
            bound = (since_values or {}).get(name)
            if name in REQUIRE_PARTITION_FILTER and bound is None:
                continue
            self.source(name, bound).createOrReplaceTempView(name)
            done.append(name)
        return done

    def row_count(self, name: str) -> int:
        """SRC11: row count, 0 when the table does not exist; from the files' footers alone."""
        return self.extent(name)["n_rows"]

    def extent(self, name: str, *columns: str) -> Row:
        """AGG7: row count and least and largest values of columns; from footers where these are exact."""
        if not self.exists(name):
            return Row("n_rows", *(f"{f}_{c}" for c in columns for f in ("min", "max")))(0, *(None for _ in range(2 * len(columns))))
        return table_extent(self.spark, self.paths[name], self.schemas[name], columns)


def run_query(spark: SparkSession, sql: str, **args) -> DataFrame:
    """SRC10: ad-hoc SQL with named parameters (``:name`` markers), lazily planned."""
    return spark.sql(sql, args=args or None)


def load_ndjson(spark: SparkSession, path: str, schema: StructType, target: str) -> int:
    """SRC7: newline-delimited JSON under the declared schema, full reload (truncate).

    Returns the rows loaded, observed during the write itself.
    """
    from pyspark.sql import Observation
    from pyspark.sql import functions as F

    obs = Observation("ndjson_load")
    (spark.read.schema(schema).option("mode", "PERMISSIVE").json(path)
     .observe(obs, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(target))
    return int(obs.get["n"])
