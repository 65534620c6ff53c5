"""Nested API payloads flattened to rows (SRC5, SRC6, FN3, FN4, JN10).

A landed weather payload is a struct of parallel daily arrays. One row per
(city, day) comes from ``inline(arrays_zip(...))`` -- a per-row generator, so
each payload is expanded where it was read, with no shuffle and no grouping.
Payloads without the ``daily`` block are split off to a quarantine frame (or
fail the job in strict mode) instead of stopping the whole load.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.numeric import nan_to_null
from strata.functions.weather import INGEST_THRESHOLDS, classify_weather, is_rainy, weather_description
from strata.schemas import WEATHER_PAYLOAD

# Fixed value: api tag stamped on landed weather rows.
WEATHER_API_VERSION = "archive-api.open-meteo.com"

_DAILY_FIELDS = {
    "time": "weather_date",
    "temperature_2m_max": "temperature_max",
    "temperature_2m_min": "temperature_min",
    "precipitation_sum": "precipitation_sum",
    "windspeed_10m_max": "windspeed_max",
    "weathercode": "weather_code",
}


def read_payloads(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """Landed payload files; a ``city=<name>`` directory level becomes a column."""
    return spark.read.schema(WEATHER_PAYLOAD).option("multiLine", multiline).json(path)


def read_drifting_payloads(spark: SparkSession, path: str) -> DataFrame:
    """SRC5 / SRC6 for payloads whose form drifts: every line is a payload, parsed as VARIANT, and none is lost.

    Returns the partition columns of the folders, ``daily`` as :func:`flatten_weather`
    takes it, ``reason`` (why a payload cannot be used: ``not json``, ``no daily
    block`` or ``no days``; else NULL), ``drift`` (fields that are not as declared, in order
    of their names: ``extra:``, ``missing:`` or ``type:`` and the name) and the ``payload`` as text.
    A field that is missing or no list is NULL on all its days, an element that does not cast on its day.
    """
    raw = spark.read.text(path)
    known = {f.name: f.dataType.simpleString() for f in WEATHER_PAYLOAD["daily"].dataType.fields}
    parsed = raw.withColumn("v", F.try_parse_json("value"))
    block = F.try_variant_get("v", "$.daily", "map<string, variant>")
    told = parsed.withColumn("fields", F.map_keys(block)).withColumns(
        {f"_{name}": F.try_variant_get("v", f"$.daily.{name}", kind) for name, kind in known.items()})
    has = lambda name: F.array_contains("fields", name)
    given = {n: F.try_variant_get("v", f"$.daily.{n}", "array<variant>") for n in known}
    lost = {n: F.exists(F.arrays_zip(F.col(f"_{n}").alias("value"), given[n].alias("given")),
                        lambda x: x["value"].isNull() & ~F.is_variant_null(x["given"])) for n in known}
    drift = [F.when(has(n) & (F.col(f"_{n}").isNull() | lost[n]), F.lit(f"type:{n}")).when(~has(n), F.lit(f"missing:{n}")) for n in known]
    extra = F.transform(F.array_except("fields", F.array(*map(F.lit, known))), lambda n: F.concat(F.lit("extra:"), n))
    reason = (F.when(F.col("v").isNull(), "not json").when(F.col("fields").isNull(), "no daily block").when(F.col("_time").isNull(), "no days"))
    others = [c for c in raw.columns if c != "value"]
    # as many NULLs as there are days, so that the days stay
    nulls = {n: F.array_repeat(F.try_element_at(F.col(f"_{n}"), F.lit(1)), F.size("_time")) for n in known}
    daily = F.when(reason.isNull(), F.struct(*(F.coalesce(F.col(f"_{n}"), nulls[n]).alias(n) for n in known)))
    return told.select(*others, daily.alias("daily"), reason.alias("reason"),
                       F.array_sort(F.concat(F.array_compact(F.array(*drift)), extra)).alias("drift"), F.col("value").alias("payload"))


def split_valid(payloads: DataFrame, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """SRC6: (payloads with a daily block, payloads without one).

    ``strict`` makes a missing block fail the job (``raise_error``).
    """
    missing = F.col("reason").isNotNull() if "reason" in payloads.columns else F.col("daily").isNull()
    if strict:
        checked = payloads.withColumn(
            "daily", F.when(missing, F.raise_error(F.lit("payload is missing 'daily' key")))
            .otherwise(F.col("daily")))
        return checked, payloads.limit(0)
    return payloads.where(~missing), payloads.where(missing)


def flatten_weather(payloads: DataFrame, fetched_at, city_col: str = "city") -> DataFrame:
    """SRC5: one row per (city, day) with ingest-time derived columns.

    Adds ``is_rainy`` (FN4), the ingest classification (FN3), the WMO
    description (JN10) and lineage columns. NaN readings become NULL first
    (N1) so they cannot classify as heavy rain.
    """
    zipped = F.arrays_zip(*[F.col(f"daily.{src}").alias(src) for src in _DAILY_FIELDS])
    rows = payloads.select(F.col(city_col).alias("city"), F.inline(zipped))
    rows = rows.select("city", *[F.col(src).alias(dst) for src, dst in _DAILY_FIELDS.items()])
    rows = rows.withColumns({
        "weather_date": F.try_to_date(F.col("weather_date"), "yyyy-MM-dd"),
        "temperature_max": nan_to_null("temperature_max"),
        "temperature_min": nan_to_null("temperature_min"),
        "precipitation_sum": nan_to_null("precipitation_sum"),
        "windspeed_max": nan_to_null("windspeed_max"),
    })
    return rows.withColumns({
        "is_rainy": is_rainy("precipitation_sum"),
        "weather_category": classify_weather(F.col("precipitation_sum"), F.col("temperature_max"),
                                             INGEST_THRESHOLDS),
        "weather_description": weather_description(F.col("weather_code")),
        "_fetched_at": F.lit(fetched_at).cast("timestamp"),
        "_api_version": F.lit(WEATHER_API_VERSION),
    })
