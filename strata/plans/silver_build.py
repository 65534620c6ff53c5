"""The silver build (lifecycle E2 + E3): bronze catalog -> six silver tables -> checks.

One call materialises every silver model from the bronze catalog, each as
its own table under ``out_root``, then runs the declared test suites and
source freshness. The restaurant dedup is shared by MD1 and MD2: it is
written once to a staging table under the shared checkpoint dir (which also
cuts its lineage, surviving executor loss) and both models read that.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.operators.quality import run_checks
from strata.plans import silver
from strata.session import staging
from strata.sources.catalog import BronzeCatalog


def build_silver(spark: SparkSession, catalog: BronzeCatalog, out_root: str,
                 start_date: str = silver.START_DATE) -> dict[str, str]:
    """Write the six silver tables; returns ``{model: path}``."""
    out = {}

    def write(name: str, df: DataFrame) -> None:
        path = f"{out_root.rstrip('/')}/{name}"
        df.write.mode("overwrite").parquet(path)
        out[name] = path

    restaurants_raw = catalog.source("raw_restaurants")
    with staging(spark, "restaurants-dedup") as staged:
        silver.dedup_restaurants(restaurants_raw).write.parquet(staged)
        deduped = spark.read.schema(restaurants_raw.schema).parquet(staged)
        write("stg_restaurants", silver.stg_restaurants(restaurants_raw, deduped))
        write("stg_restaurant_ratings", silver.stg_restaurant_ratings(restaurants_raw, deduped, start_date))
    write("stg_orders", silver.stg_orders(catalog.source("raw_orders", start_date), start_date))
    write("stg_weather", silver.stg_weather(catalog.source("raw_weather")))
    write("stg_ipl_schedule", silver.stg_ipl_schedule(catalog.source("raw_ipl_schedule")))
    write("stg_festival_calendar", silver.stg_festival_calendar(catalog.source("raw_festival_calendar")))
    return out


def check_silver(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """All declared checks over the written silver tables: (table, check, failing rows, status)."""
    tables = {name: spark.read.parquet(p) for name, p in paths.items()}
    suites = silver.silver_checks(tables["stg_restaurants"])
    report = None
    for name, checks in suites.items():
        if name not in tables:
            continue
        r = run_checks(tables[name], checks, table=name)
        report = r if report is None else report.unionByName(r)
    return report


def coverage_report(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """The weather-coverage analysis (MD12) over the written silver tables."""
    return silver.weather_coverage(spark.read.parquet(paths["stg_orders"]),
                                   spark.read.parquet(paths["stg_weather"]))
