"""Which keys of a batch a table has already (JN5, SRC9, INC4), without a scan where they are few.

A batch of few keys is sent to the scan as a list of literals, which Spark
pushes down to Parquet: row groups whose Bloom filter, dictionary or extent has
none of them are not read (``bloom`` columns of ``strata.sinks.versions``). In a
batch of many keys hardly a row group would be passed over, so it meets the
table's key column in a semi join. Both give the same keys.
"""

from __future__ import annotations

import contextlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.sinks.versions import Snapshot, VersionedTable

#: Keys of a batch that are sent as literals at most.
AT_MOST = 1000
_THRESHOLD = "spark.sql.parquet.pushdown.inFilterThreshold"


@contextlib.contextmanager
def pushed_lists(spark: SparkSession, size: int):
    """For an action: lists of up to ``size`` values go down to Parquet as they are, not as their extent."""
    before = spark.conf.get(_THRESHOLD)
    spark.conf.set(_THRESHOLD, str(max(size, int(before))))
    try:
        yield
    finally:
        spark.conf.set(_THRESHOLD, before)


def known_keys(table: DataFrame, batch: DataFrame, key: str, path: str, at_most: int = AT_MOST) -> DataFrame:
    """Distinct values of ``key`` in ``batch`` that ``table`` has, written to ``path`` and read back. NULL is never known."""
    spark = table.sparkSession
    wanted = batch.select(key).where(F.col(key).isNotNull()).distinct()
    few = [r[0] for r in wanted.limit(at_most + 1).collect()]
    column = table.select(key)
    if len(few) <= at_most:
        with pushed_lists(spark, at_most):
            column.where(F.col(key).isin(few) if few else F.lit(False)).distinct().write.parquet(path)
    else:
        column.distinct().join(wanted, key, "left_semi").write.parquet(path)
    return spark.read.schema(column.schema).parquet(path)


def append_unseen(table: VersionedTable, batch: DataFrame, key: str, path: str, at_most: int = AT_MOST) -> tuple[Snapshot, int]:
    """INC4: append the rows of ``batch`` (one row a key) whose key the table lacks; the version and the number of rows added.

    Rows without a key are always added. ``path`` is a scratch folder. No bound
    on dates is needed. Where another writer adds rows meanwhile, the keys are
    looked up again in what it added.
    """
    from pyspark.sql import Observation

    from strata.session import observing

    seen, tries = table.snapshot(), 0
    known = known_keys(table.read(seen), batch, key, f"{path}/known-0", at_most)
    while True:
        added = Observation()
        with observing(table.spark):
            rows = batch.join(known, key, "left_anti").select(*batch.columns).observe(added, F.count(F.lit(1)).alias("n"))
            made = table.append_after(rows, seen)
            if made is not None:
                return made, int(added.get["n"])
        tries += 1
        now = table.snapshot()
        late = known_keys(table.difference(seen.number, now.number)[1], batch, key, f"{path}/known-{tries}", at_most)
        known, seen = known.unionByName(late).distinct(), now
