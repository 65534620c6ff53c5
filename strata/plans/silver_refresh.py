"""Incremental silver (SNK11, MD1-MD6, MD12): only what a bronze change touches is computed and written again.

Bronze and silver are tables of versions. The silver table's record says which
bronze version it shows. A refresh compares the bronze folders of that version
with those of the last one, finds the keys whose rows differ (rows taken away and
rows added cancel out by count and digest, so a feed loaded anew without change
touches nothing), runs the model on the rows of these keys alone, and replaces
their rows in the partitions that have them. Partitions that only gain rows get
one more folder. A model must be local to the key: what it makes of a key's rows
depends on no others.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.plans import silver
from strata.session import staging
from strata.sinks.versions import VersionedTable

SOURCE_VERSION = "source_version"
#: By model: its bronze table, its model, the key that its rows share with it, and the partition columns of its table.
MODELS: dict[str, tuple[str, Callable[[DataFrame], DataFrame], tuple[str, ...], tuple[str, ...]]] = {
    "stg_restaurants": ("raw_restaurants", silver.stg_restaurants, ("restaurant_id",), ()),
    "stg_restaurant_ratings": ("raw_restaurants", silver.stg_restaurant_ratings, ("restaurant_id",), ()),
    "stg_orders": ("raw_orders", silver.stg_orders, ("order_id",), ("order_date",)),
    # deduplicated by the raw city, which silver does not keep: a day at a time
    "stg_weather": ("raw_weather", silver.stg_weather, ("weather_date",), ("weather_date",)),
    "stg_ipl_schedule": ("raw_ipl_schedule", silver.stg_ipl_schedule, ("match_date",), ()),
    "stg_festival_calendar": ("raw_festival_calendar", silver.stg_festival_calendar, ("festival_date",), ()),
}


def changed_keys(source: VersionedTable, first: int, last: int, keys: Sequence[str]) -> DataFrame:
    """Distinct keys whose rows are not the same in the two versions; NULL keys are left out, as models drop them."""
    gone, new = source.difference(first, last)
    digest = lambda df: F.xxhash64(*(F.col(c) for c in df.columns)).cast("decimal(38,0)")
    signed = (new.select(*keys, F.lit(1).alias("n"), digest(new).alias("h"))
              .unionByName(gone.select(*keys, F.lit(-1).alias("n"), (-digest(gone)).alias("h"))))
    differ = signed.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("h").alias("h")).where("n <> 0 or h <> 0")
    for k in keys:
        differ = differ.where(F.col(k).isNotNull())
    return differ.select(*keys)


def refresh_from(sources: Sequence[tuple[VersionedTable, Sequence[str]]], target: VersionedTable, model: Callable[..., DataFrame], keys: Sequence[str],
                 partition_cols: Sequence[str] = ()) -> dict:
    """Bring ``target`` to the last versions of its ``sources``; the first time, and only then, all of it is built.

    Each source comes with the names that the target's ``keys`` have in it, and
    ``model`` gets a DataFrame of each. A key is touched where its rows changed
    in any source, so a join or an anti-join is kept up like a single table.
    Another refresh that was first is a conflict, and the table stays as that left it.
    """
    keys, now = list(keys), [table.snapshot() for table, _ in sources]
    rows = [table.read(at) for (table, _), at in zip(sources, now, strict=True)]
    held = target.snapshot()
    if held is None:
        target.create(model(*rows).schema, partition_cols)
        held = target.snapshot()
    before, mark = held.properties.get(SOURCE_VERSION), {SOURCE_VERSION: [at.number for at in now]}
    if before == mark[SOURCE_VERSION]:
        return {"built": "nothing", "keys": 0, "partitions": 0}
    if before is None:
        made = target.replace(model(*rows), held, operation="build", whole=True, properties=mark)
        return {"built": "all", "keys": None, "partitions": len(made.changed)}
    spark, touched = target.spark, None
    for (table, own), first, last in zip(sources, before, now, strict=True):
        if first != last.number:
            found = changed_keys(table, first, last.number, list(own)).toDF(*keys)
            touched = found if touched is None else touched.unionByName(found)
    with staging(spark, "refresh-keys") as at_keys:
        touched.distinct().write.parquet(at_keys)
        touched = spark.read.schema(touched.schema).parquet(at_keys)
        n = touched.count()
        some = [r.join(touched.toDF(*own), list(own), "left_semi") for r, (_, own) in zip(rows, sources, strict=True)]
        owners = target.parts_with(held, lambda old: old.join(touched, keys, "left_semi"))
        rest = target.read_parts(held, owners).join(touched, keys, "left_anti")
        made = target.replace(rest.unionByName(model(*some)), held, gone=owners, operation="refresh", properties=mark, keep_others=True)
    return {"built": "changes", "keys": n, "partitions": len(made.changed)}


def refresh(source: VersionedTable, target: VersionedTable, model: Callable[[DataFrame], DataFrame], keys: Sequence[str],
            partition_cols: Sequence[str] = ()) -> dict:
    """:func:`refresh_from` one source, in which the keys have the same names."""
    return refresh_from([(source, keys)], target, model, keys, partition_cols)


def refresh_coverage(orders: VersionedTable, weather: VersionedTable, target: VersionedTable) -> dict:
    """MD12 / DQ14 kept up: orders without weather by city and day, of which only days with a change in either table are counted again."""
    return refresh_from([(orders, ["order_date"]), (weather, ["weather_date"])], target, silver.weather_coverage, ["order_date"], ["order_date"])


def refresh_silver(spark: SparkSession, bronze: Mapping[str, VersionedTable], out_root: str, start_date: str = silver.START_DATE) -> dict[str, dict]:
    """Refresh every silver table whose bronze table is given, at ``out_root/<model>``."""
    dated = {"stg_orders": lambda raw: silver.stg_orders(raw, start_date),
             "stg_restaurant_ratings": lambda raw: silver.stg_restaurant_ratings(raw, start_date=start_date)}
    return {name: refresh(bronze[raw], VersionedTable(spark, f"{out_root.rstrip('/')}/{name}"), dated.get(name, model), keys, parts)
            for name, (raw, model, keys, parts) in MODELS.items() if raw in bronze}
