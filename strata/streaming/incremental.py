"""Batch high-water marks and next load ranges (INC1, INC2, D10).

The reference keeps ``{source: last_date}`` in one JSON document. Here the
state is a small keyed table (``source_name``, ``watermark_key``,
``watermark_date``) stored as JSON lines under the shared checkpoint dir, so
it can advance per (source, key) -- e.g. per city -- and only for keys that
actually landed (D10), not for the whole source when one city failed.

Updates are DataFrame merges (the keyed upsert), so advancing marks per key
never gathers keys on the driver; only point lookups of one source's mark
return a single row to it. Each update writes a folder of its own and then
renames it to the next ``version=<n>``; readers take the last one, so a crash at
any point leaves the marks of before. The rename is done only where that version
is not there yet: of two updates at once the second merges again, into what the
first left.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType, TimestampType

from strata.session import list_names, path_exists, publish, remove_path

# Fixed value: days looked back on a source's first run (run date included).
FIRST_RUN_LOOKBACK_DAYS = 7
ALL_KEYS = "*"

STATE_SCHEMA = StructType([
    StructField("source_name", StringType(), False),
    StructField("watermark_key", StringType(), False),
    StructField("watermark_date", DateType(), True),
    StructField("updated_at", TimestampType(), True),
])


_READ_SCHEMA = StructType(STATE_SCHEMA.fields + [StructField("_corrupt", StringType(), True)])


class WatermarkError(Exception):
    """The watermark state exists but cannot be read."""


class WatermarkStore:
    """INC2: get / set / list high-water marks by source (and optional key)."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark = spark
        self.path = path

    def _versions(self) -> list[int]:
        """Numbers of the committed versions, ascending."""
        names = [n for n in list_names(self.spark, self.path) if n.startswith("version=")]
        return sorted(int(n[8:]) for n in names if path_exists(self.spark, f"{self.path}/{n}/_SUCCESS"))

    def _frame(self) -> DataFrame:
        versions = self._versions()
        if not versions and not path_exists(self.spark, self.path):
            return self.spark.createDataFrame([], _READ_SCHEMA)
        at = self._version_path(versions[-1]) if versions else self.path
        return (self.spark.read.schema(_READ_SCHEMA).option("mode", "PERMISSIVE")
                .option("columnNameOfCorruptRecord", "_corrupt").json(at))

    def _version_path(self, n: int) -> str:
        return f"{self.path.rstrip('/')}/version={n:06d}"

    def get(self, source: str, key: str = ALL_KEYS) -> str | None:
        """Last recorded date for ``source`` (and key), or None if unset (point lookup)."""
        self._check_corrupt()
        hit = (self._frame().where((F.col("source_name") == source) & (F.col("watermark_key") == key))
               .select("watermark_date").limit(1).collect())
        return hit[0]["watermark_date"].isoformat() if hit and hit[0]["watermark_date"] else None

    def get_all(self) -> dict[str, str]:
        """``{source: date}`` for source-level marks (one row per source)."""
        self._check_corrupt()
        rows = self._frame().where(F.col("watermark_key") == ALL_KEYS).select(
            "source_name", "watermark_date").collect()
        return {r["source_name"]: r["watermark_date"].isoformat() for r in rows
                if r["watermark_date"] is not None}

    def _check_corrupt(self) -> None:
        # (Spark refuses queries that read only the corrupt-record column.)
        bad = (self._frame().where(F.col("_corrupt").isNotNull())
               .select("source_name", "_corrupt").limit(1).collect())
        if bad:
            raise WatermarkError(f"watermark state at {self.path} is not valid JSON")

    def as_frame(self) -> DataFrame:
        return self._frame().select(*[f.name for f in STATE_SCHEMA.fields])

    def set(self, source: str, date: str, key: str = ALL_KEYS) -> None:
        self.set_many({(source, key): date})

    def set_many(self, marks: Mapping[tuple[str, str], str]) -> None:
        """Upsert explicit (source, key) -> date marks."""
        now = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
        rows = [(s, k, _dt.date.fromisoformat(d) if isinstance(d, str) else d, now)
                for (s, k), d in marks.items()]
        self.merge(self.spark.createDataFrame(rows, STATE_SCHEMA))

    def merge(self, marks: DataFrame, forward_only: bool = False) -> None:
        """Upsert a DataFrame of marks into the state, entirely in Spark.

        The merged state is the next version; the one before is kept until the next update.
        With ``forward_only`` a mark keeps a date later than the given one.
        """
        from strata.sinks.upsert import merge_frames

        keys = ["source_name", "watermark_key"]
        while True:
            self._check_corrupt()
            versions, state, new = self._versions(), self.as_frame(), marks.select(*STATE_SCHEMA.names)
            if forward_only:
                held = state.select(*keys, F.col("watermark_date").alias("held"))
                new = (new.join(held, keys, "left").withColumn("watermark_date", F.greatest("watermark_date", "held"))
                       .select(*STATE_SCHEMA.names))
            made = f"{self.path.rstrip('/')}/new-{uuid.uuid4().hex}"
            merge_frames(state, new, keys).write.json(made)
            if publish(self.spark, made, self._version_path((versions or [0])[-1] + 1)):
                break
            remove_path(self.spark, made)
        for n in versions[:-1]:
            remove_path(self.spark, self._version_path(n))

    def advance_from(self, landed: DataFrame, source: str, key_col: str | None, date_col: str) -> DataFrame:
        """D10: per key, move the mark to the max date that actually landed.

        A distributed max per key, merged into the state without passing
        through the driver. Returns the new marks (``watermark_key``,
        ``watermark_date``) as a DataFrame.
        """
        key = F.lit(ALL_KEYS) if key_col is None else F.col(key_col).cast("string")
        now = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
        marks = (landed.where(key.isNotNull() & F.col(date_col).isNotNull())
                 .groupBy(key.alias("watermark_key")).agg(F.max(F.col(date_col)).alias("watermark_date"))
                 .select(F.lit(source).alias("source_name"), "watermark_key", "watermark_date",
                         F.lit(now).alias("updated_at")))
        self.merge(marks, forward_only=True)  # also when older days are sent again
        return self.as_frame().where(F.col("source_name") == source).join(
            marks.select("watermark_key"), "watermark_key", "left_semi").select("watermark_key", "watermark_date")


def next_range(last: str | None, run_date: str,
               lookback_days: int = FIRST_RUN_LOOKBACK_DAYS) -> tuple[str, str] | None:
    """INC1 for one source: ``[last+1, run]`` or ``[run-(lookback-1), run]``; None when empty."""
    end = _dt.date.fromisoformat(run_date)
    if last:
        start = _dt.date.fromisoformat(last) + _dt.timedelta(days=1)
    else:
        start = end - _dt.timedelta(days=lookback_days - 1)
    if start > end:
        return None
    return start.isoformat(), end.isoformat()


def next_ranges(sources: DataFrame, state: DataFrame, run_date: Column | str,
                lookback_days: int = FIRST_RUN_LOOKBACK_DAYS, source_col: str = "source_name",
                last_col: str = "watermark_date") -> DataFrame:
    """INC1 as a DataFrame op: one range per source (and run date).

    ``sources`` lists the sources to load; ``state`` holds their last dates
    (absent -> first run). Output adds last_date, start_date, end_date,
    is_empty and n_days.
    """
    run = F.lit(run_date).cast("date") if isinstance(run_date, str) else run_date.cast("date")
    joined = sources.join(state.select(F.col(source_col), F.col(last_col).alias("last_date")),
                          [source_col], "left")
    start = F.coalesce(F.date_add(F.col("last_date"), 1), F.date_sub(run, lookback_days - 1))
    out = joined.withColumns({"start_date": start, "end_date": run})
    n = F.datediff(F.col("end_date"), F.col("start_date")) + 1
    return out.withColumns({"is_empty": F.col("start_date") > F.col("end_date"),
                            "n_days": F.greatest(n, F.lit(0))})


def rows_in_ranges(data: DataFrame, ranges: DataFrame, source_col: str, date_col: str,
                   group_cols: Sequence[str] = (), count_col: str | None = None) -> DataFrame:
    """How many rows each next range would load.

    ``data`` is first reduced to counts per (source, date) -- a partial
    aggregate, so a source holding a third of all rows is pre-counted in
    every map task -- and only that small table meets the ranges. Where the rows
    of ``data`` are such counts already, ``count_col`` names them.
    """
    n = F.count(F.lit(1)) if count_col is None else F.sum(count_col)
    daily = data.groupBy(F.col(source_col), F.col(date_col).alias("_d")).agg(n.alias("_n"))
    keys = [source_col, *group_cols]
    cond = ((daily[source_col] == ranges[source_col]) & (daily["_d"] >= ranges["start_date"])
            & (daily["_d"] <= ranges["end_date"]))
    hits = (ranges.join(daily, cond, "inner")
            .groupBy(*[ranges[k] for k in keys]).agg(F.sum("_n").alias("n_rows")))
    return (ranges.join(hits, keys, "left")
            .withColumn("n_rows", F.coalesce(F.col("n_rows"), F.lit(0)).cast("long")))
