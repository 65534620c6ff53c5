"""Parquet tables whose writes show all at once or not at all (SNK4, SNK6, SNK7, SNK10).

A table's folder holds ``data/commit_id=<id>/<partitions>/``, a folder for each
write, which Spark's own writer fills, and ``_commits/<n>.json``, a record for each
version: which writes' folders make up each partition. A write puts its rows into a
folder of its own and then publishes the next record by one rename; until then
readers, who go by the last record, see nothing of it, wherever it fails. So a
change over many partitions, a MERGE for instance, shows in all of them at once,
and folders of partitions that it did not touch stay as they are.

Two writers: the record of a version is published once. Who comes second takes
the newer version as the base of the own change where that concerns other
partitions (or only adds rows), and else gets a :class:`Conflict`.

Records name partitions and folders, never rows, so they are as small as Spark's
own listing of the table. For tables with ``cluster_by``, the least and largest
values of each file are kept in ``stats/``, and :meth:`VersionedTable.read` opens
only files that a range may touch.
"""

from __future__ import annotations

import datetime as dt
import json
import time
import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from strata.operators.clustering import clustered
from strata.session import _file_system, configure, folders_below, list_names, path_exists, publish, read_text, remove_path, staging, write_text

COMMIT = "commit_id"


#: As what is touched: any newer version is in conflict.
EVERYTHING = frozenset({"*"})


class Conflict(Exception):
    """Another writer changed the same partitions since this write read them."""


@dataclass
class Snapshot:
    """One version: the writes that make up each partition, and what this version changed."""

    number: int
    schema: str
    partition_cols: list[str]
    cluster_by: list[str]
    bloom: list[str]
    rows_per_file: int
    operation: str
    parts: dict[str, list[str]] = field(default_factory=dict)
    changed: list[str] = field(default_factory=list)
    added: str | None = None
    properties: dict = field(default_factory=dict)
    at: str = ""

    @property
    def columns(self) -> StructType:
        return StructType.fromJson(json.loads(self.schema))


class VersionedTable:
    """A Parquet table of versions at ``root``, on storage that driver and executors share."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = configure(spark), root.rstrip("/")

    # ------------------------------------------------------------ versions

    def _record(self, number: int) -> str:
        return f"{self.root}/_commits/{number:08d}.json"

    def versions(self) -> list[int]:
        return sorted(int(n[:-5]) for n in list_names(self.spark, f"{self.root}/_commits") if n.endswith(".json") and n[:-5].isdigit())

    def snapshot(self, number: int | None = None) -> Snapshot | None:
        """A version's record, the last one's without a number; None where there is no table."""
        if number is None:
            found = self.versions()
            if not found:
                return None
            number = found[-1]
        return Snapshot(**json.loads(read_text(self.spark, self._record(number))))

    def _publish(self, snapshot: Snapshot) -> bool:
        snapshot.at = dt.datetime.now(dt.timezone.utc).isoformat()
        made = f"{self.root}/_commits/new-{uuid.uuid4().hex}"
        write_text(self.spark, made, json.dumps(asdict(snapshot)))
        done = publish(self.spark, made, self._record(snapshot.number))
        if not done:
            remove_path(self.spark, made)
        return done

    def create(self, schema: StructType, partition_cols: Sequence[str] = (), cluster_by: Sequence[str] = (), bloom: Sequence[str] = (),
               rows_per_file: int = 0) -> bool:
        """Version 0, without rows, unless there is a table; whether it was made.

        ``cluster_by`` columns order the rows over files; ``bloom`` columns get
        Parquet Bloom filters, by which row groups without a sought value are passed over.
        ``rows_per_file`` bounds files by rows; else AQE sizes them.
        """
        if self.versions():
            return False
        ordered = StructType([*(f for f in schema.fields if f.name not in partition_cols), *(schema[c] for c in partition_cols)])
        return self._publish(Snapshot(0, ordered.json(), list(partition_cols), list(cluster_by), list(bloom), rows_per_file, "create"))

    def _commit(self, base: Snapshot, operation: str, change: Callable[[dict], dict], touched: set[str] | frozenset | None, changed: Iterable[str],
                added: str | None, properties: Mapping | None) -> Snapshot:
        """Publish the version after ``base`` or after a newer one that did not change what is ``touched`` (None: nothing is)."""
        while True:
            parts = {p: c for p, c in change(base.parts).items() if c}
            new = Snapshot(base.number + 1, base.schema, base.partition_cols, base.cluster_by, base.bloom, base.rows_per_file, operation, parts, sorted(changed), added,
                           {**base.properties, **(properties or {})})
            if self._publish(new):
                return new
            newest = self.snapshot()
            for number in range(base.number + 1, newest.number + 1):
                if touched is EVERYTHING or touched is not None and touched & set(self.snapshot(number).changed):
                    raise Conflict(f"version {number} of {self.root} changed partitions that {operation} read")
            base = newest

    # ------------------------------------------------------------ reading

    def _paths(self, parts: Mapping[str, Sequence[str]]) -> list[str]:
        return [f"{self.root}/data/{COMMIT}={c}/{p}".rstrip("/") for p, commits in parts.items() for c in commits]

    def _open(self, snapshot: Snapshot, paths: list[str]) -> DataFrame:
        schema = snapshot.columns
        if not paths:
            return self.spark.createDataFrame([], schema)
        told = StructType([*schema.fields, StructField(COMMIT, StringType())])
        return self.spark.read.schema(told).option("basePath", f"{self.root}/data").parquet(*paths).select(*schema.names)

    def read(self, snapshot: Snapshot | int | None = None, ranges: Mapping[str, tuple] | None = None) -> DataFrame:
        """The rows of a version (the last one), as Spark reads Parquet folders: filters on partition columns prune.

        ``ranges`` maps columns to (least, largest), inclusive; of a clustered
        table only files whose values reach into all of them are opened.
        """
        if not isinstance(snapshot, Snapshot):
            snapshot = self.snapshot(snapshot)
        paths = self._paths(snapshot.parts)
        inside = [F.col(c).between(F.lit(lo).cast(snapshot.columns[c].dataType), F.lit(hi).cast(snapshot.columns[c].dataType))
                  for c, (lo, hi) in (ranges or {}).items()]
        known = {c: r for c, r in (ranges or {}).items() if c in snapshot.cluster_by}
        if known and paths:
            paths = self._files(snapshot, known)
        out = self._open(snapshot, paths)
        for c in inside:
            out = out.where(c)
        return out

    def _files(self, snapshot: Snapshot, ranges: Mapping[str, tuple]) -> list[str]:
        commits = sorted({c for own in snapshot.parts.values() for c in own})
        stats = self.spark.read.parquet(*(f"{self.root}/stats/{c}" for c in commits))
        for c, (lo, hi) in ranges.items():
            kind = snapshot.columns[c].dataType
            stats = stats.where((F.col(f"max_{c}") >= F.lit(lo).cast(kind)) & (F.col(f"min_{c}") <= F.lit(hi).cast(kind)))
        out = []
        for row in stats.select("part", COMMIT, "file").toLocalIterator():
            if row[COMMIT] in snapshot.parts.get(row["part"], ()):
                out.append(f"{self.root}/data/{COMMIT}={row[COMMIT]}/{row['part'] + '/' if row['part'] else ''}{row['file']}")
        return out

    def difference(self, first: int, last: int) -> tuple[DataFrame, DataFrame]:
        """(rows of folders that only version ``first`` has, those that only ``last`` has): all rows that may differ."""
        old, new = self.snapshot(first), self.snapshot(last)

        def only(one: Snapshot, other: Snapshot) -> DataFrame:
            return self._open(one, self._paths({p: sorted(set(c) - set(other.parts.get(p, ()))) for p, c in one.parts.items()}))

        return only(old, new), only(new, old)

    def read_parts(self, snapshot: Snapshot, parts: Iterable[str]) -> DataFrame:
        """The rows of some partitions, by their names in the record; the others' folders are not listed."""
        return self._open(snapshot, self._paths({p: snapshot.parts[p] for p in parts}))

    def parts_with(self, snapshot: Snapshot, wanted: Callable[[DataFrame], DataFrame]) -> list[str]:
        """Names of the partitions that have rows which ``wanted`` keeps."""
        rows = self.read(snapshot)
        if not snapshot.parts:
            return []
        place = F.url_decode(F.replace(F.split(F.col("_metadata.file_path"), f"/{COMMIT}=")[1], F.lit("+"), F.lit("%2B")))
        named = rows.withColumn("_part", F.regexp_replace(F.regexp_replace(place, "^[^/]*/", ""), "/?[^/]*$", ""))
        return sorted(r[0] for r in wanted(named).select("_part").distinct().collect())

    # ------------------------------------------------------------ writing

    def write_folder(self, df: DataFrame, base: Snapshot) -> tuple[str, list[str]]:
        """Write rows to a folder of their own, which no version names yet; its id and its partitions."""
        commit = uuid.uuid4().hex[:16]
        folder = f"{self.root}/data/{COMMIT}={commit}"
        rows = df.select(*base.columns.names)
        if base.cluster_by:
            with staging(self.spark, "clustering") as stage:  # read for the bounds, for the ranges' sample and to be written
                rows.write.parquet(stage)
                rows = self.spark.read.schema(base.columns).parquet(stage)
                self._write(clustered(rows, base.cluster_by, base.partition_cols), folder, base)
        else:
            self._write(rows.hint("rebalance", *base.partition_cols), folder, base)
        parts = folders_below(self.spark, folder, len(base.partition_cols)) if base.partition_cols else [""]
        if base.cluster_by:
            self._write_stats(folder, commit, base)
        return commit, parts

    def _write(self, rows: DataFrame, folder: str, base: Snapshot) -> None:
        writer = rows.write.option("maxRecordsPerFile", base.rows_per_file)
        for c in base.bloom:
            writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true").option("parquet.bloom.filter.adaptive.enabled", "true")
        if base.partition_cols:
            writer = writer.partitionBy(*base.partition_cols)
        writer.parquet(folder)

    def _write_stats(self, folder: str, commit: str, base: Snapshot) -> None:
        place = F.split(F.col("_metadata.file_path"), f"{COMMIT}={commit}/")[1]
        rows = self.spark.read.schema(base.columns).parquet(folder).groupBy(place.alias("at")).agg(
            *(f(c).alias(f"{name}_{c}") for c in base.cluster_by for name, f in (("min", F.min), ("max", F.max))))
        # the path is given as part of a URI
        rows = rows.withColumn("at", F.url_decode(F.replace(F.col("at"), F.lit("+"), F.lit("%2B"))))
        (rows.withColumns({"file": F.element_at(F.split("at", "/"), -1), "part": F.regexp_replace("at", "/?[^/]*$", ""), COMMIT: F.lit(commit)})
         .drop("at").write.parquet(f"{self.root}/stats/{commit}"))

    def _discard(self, commit: str) -> None:
        for path in (f"{self.root}/data/{COMMIT}={commit}", f"{self.root}/stats/{commit}"):
            if path_exists(self.spark, path):
                remove_path(self.spark, path)

    def append(self, df: DataFrame, properties: Mapping | None = None) -> Snapshot:
        """SNK6: add rows; never in conflict with another writer."""
        base = self.snapshot()
        commit, parts = self.write_folder(df, base)
        return self._commit(base, "append", lambda old: {**old, **{p: [*old.get(p, ()), commit] for p in parts}}, None, parts, commit, properties)

    def append_after(self, df: DataFrame, base: Snapshot) -> Snapshot | None:
        """Add rows as the version after ``base``, on whose rows they rest; None, and nothing is added, if another write came first."""
        commit, parts = self.write_folder(df, base)
        try:
            return self._commit(base, "append", lambda old: {**old, **{p: [*old.get(p, ()), commit] for p in parts}}, EVERYTHING, parts, commit, None)
        except Conflict:
            self._discard(commit)
            return None

    def replace(self, df: DataFrame, base: Snapshot, gone: Iterable[str] = (), operation: str = "replace", whole: bool = False,
                properties: Mapping | None = None, keep_others: bool = False) -> Snapshot:
        """SNK4, SNK5: the partitions that ``df`` has, and those of ``gone``, hold the rows of ``df`` alone; all of them if ``whole``.

        ``base`` is the version that the rows were derived from. With
        ``keep_others`` only partitions of ``gone`` lose their rows, and others of ``df`` gain some.
        """
        commit, parts = self.write_folder(df, base)
        gone = set(gone) | (set() if keep_others else set(parts)) | (set(base.parts) if whole else set())

        def change(old: dict) -> dict:
            kept = {p: c for p, c in old.items() if p not in gone}
            return {**kept, **{p: [*kept.get(p, ()), commit] for p in parts}}

        try:
            return self._commit(base, operation, change, EVERYTHING if keep_others or whole else gone, gone | set(parts), commit, properties)
        except Conflict:
            self._discard(commit)
            raise

    def vacuum(self, keep: int = 1, older_than_s: float = 7 * 86400) -> list[str]:
        """Remove folders that none of the last ``keep`` versions names and that are older than a write can take; their ids.

        Older versions then cannot be read any more.
        """
        used = {c for n in self.versions()[-keep:] for own in self.snapshot(n).parts.values() for c in own}
        fs, at = _file_system(self.spark, f"{self.root}/data")
        gone = []
        for f in fs.listStatus(at) if fs.exists(at) else ():
            commit = f.getPath().getName().partition("=")[2]
            if commit not in used and f.getModificationTime() < (time.time() - older_than_s) * 1000:
                self._discard(commit)
                gone.append(commit)
        return sorted(gone)
