"""Session helpers: build or tune a SparkSession, and find shared scratch space.

Everything here only *fills in* settings that are unset, so a cluster's own
configuration (shuffle partitions, checkpoint dir, broadcast threshold) always
wins over our local defaults.
"""

from __future__ import annotations

import contextlib
import os
import shutil
import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

# Runtime SQL settings that every plan in this package relies on. They are
# session-scoped and safe to set on an existing session.
RUNTIME_SQL_CONF: dict[str, str] = {
    # Timestamps are UTC instants; NTZ columns are unaffected.
    "spark.sql.session.timeZone": "UTC",
    # Adaptive execution: runtime broadcast conversion (size-checked against
    # spark.sql.adaptive.autoBroadcastJoinThreshold), partition coalescing and
    # skew-join splitting for hot keys.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Dynamic partition overwrite: a write only replaces the partitions it
    # actually contains (used by landing and upsert).
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


_SHIPPED: set[str] = set()


# AQE may replace a stage that produced no rows by an empty relation; the
# ``Observation`` metrics collected inside that stage are then lost and
# ``Observation.get`` fails. So writes that observe run without that rule.
OBSERVED_EXCLUDED_RULE = "org.apache.spark.sql.execution.adaptive.AQEPropagateEmptyRelation"
_EXCLUDED = "spark.sql.adaptive.optimizer.excludedRules"


def configure(spark: SparkSession) -> SparkSession:
    """Apply RUNTIME_SQL_CONF. The time zone is always set, as results depend on
    it; the rest only where the session has no value."""
    for key, value in RUNTIME_SQL_CONF.items():
        if key == "spark.sql.session.timeZone" or spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    return spark


@contextlib.contextmanager
def observing(spark: SparkSession):
    """For an action whose ``Observation`` is read afterwards; the session's rules come back after it."""
    before = spark.conf.get(_EXCLUDED, None)
    rules = [r for r in (before or "").split(",") if r]
    spark.conf.set(_EXCLUDED, ",".join(dict.fromkeys([*rules, OBSERVED_EXCLUDED_RULE])))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_EXCLUDED)
        else:
            spark.conf.set(_EXCLUDED, before)


def build_session(master: str | None = None, app_name: str = "strata",
                  shuffle_partitions: int | None = None) -> SparkSession:
    """Create (or reuse) a session with local-friendly defaults.

    On a cluster ``master`` stays ``None`` and the cluster's submit-time
    configuration is used as is.
    """
    builder = (SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false"))
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.sql.execution.arrow.pyspark.enabled", "true")
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    Only when the setting is absent in a local session is a fresh private folder
    created and registered, so ``DataFrame.checkpoint()`` works. On a cluster,
    where driver and executors would see different folders, that is an error.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    local = tempfile.mkdtemp(prefix="strata-ckpt-")
    sc.setCheckpointDir(local)
    return local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder under the shared checkpoint dir for written tables."""
    base = checkpoint_dir(spark)
    # checkpoint dirs may be URIs (hdfs://, s3a://, file:/); keep the scheme.
    return f"{base}/strata-scratch/{name}-{uuid.uuid4().hex[:12]}"


def _file_system(spark: SparkSession, path: str):
    """Hadoop's file system and path object of a uri."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, at = _file_system(spark, path)
    return fs.exists(at)


def remove_path(spark: SparkSession, path: str) -> None:
    fs, at = _file_system(spark, path)
    fs.delete(at, True)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder (metadata only); none if it does not exist."""
    fs, at = _file_system(spark, path)
    return [f.getPath().getName() for f in fs.listStatus(at)] if fs.exists(at) else []


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A new small file (metadata only)."""
    fs, at = _file_system(spark, path)
    out = fs.create(at, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    """A small file (metadata only)."""
    fs, at = _file_system(spark, path)
    stream = fs.open(at)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def folders_below(spark: SparkSession, path: str, depth: int) -> list[str]:
    """Paths, relative to ``path``, of the folders ``depth`` levels below it (metadata only)."""
    fs, at = _file_system(spark, path + "/*" * depth)
    base = fs.makeQualified(_file_system(spark, path)[1]).toString()
    return sorted(f.getPath().toString()[len(base) + 1:] for f in fs.globStatus(at) or () if f.isDirectory())


def publish(spark: SparkSession, made: str, name: str) -> bool:
    """Rename the finished file or folder ``made`` to ``name`` unless that is there; whether it was done.

    The rename is one step of the file system (HDFS, and local ones but for a
    moment between check and rename); an object store without such a step needs
    a committer that has one.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    source, target = (jvm.org.apache.hadoop.fs.Path(x) for x in (made, name))
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), conf) if target.toUri().getScheme() else jvm.org.apache.hadoop.fs.FileContext.getFileContext(conf)
    no_options = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        files.rename(source, target, no_options)
    except Py4JJavaError as exc:
        if "FileAlreadyExistsException" in exc.java_exception.getClass().getName():
            return False
        raise
    return True


def swap_in(spark: SparkSession, new: str, target: str) -> None:
    """Put the finished folder ``new`` in the place of ``target`` by renames."""
    fs, at = _file_system(spark, target)
    old = spark._jvm.org.apache.hadoop.fs.Path(f"{target.rstrip('/')}.replaced-{uuid.uuid4().hex[:12]}")
    if fs.exists(at) and not fs.rename(at, old):
        raise OSError(f"{target} cannot be moved aside")
    if not fs.rename(_file_system(spark, new)[1], at):
        fs.rename(old, at)
        raise OSError(f"{new} cannot be moved to {target}")
    if fs.exists(old):
        fs.delete(old, True)


@contextlib.contextmanager
def staging(spark: SparkSession, name: str):
    """A scratch folder that is removed afterwards, whether or not the work succeeds."""
    path = scratch_path(spark, name)
    try:
        yield path
    finally:
        remove_path(spark, path)


def ship_package(spark: SparkSession) -> None:
    """Give the executors' Python workers this package, once an application.

    Needed where workers neither share the driver's folders nor have the package installed.
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    here = os.path.dirname(os.path.abspath(__file__))
    archive = shutil.make_archive(os.path.join(tempfile.mkdtemp(prefix="strata-package-"), "strata"), "zip",
                                  os.path.dirname(here), os.path.basename(here))
    sc.addPyFile(archive)  # Spark's file server hands it out
    _SHIPPED.add(sc.applicationId)


def local_path(uri: str) -> str:
    """Strip a ``file:`` scheme for code that needs an OS path (tests only)."""
    if uri.startswith("file://"):
        return uri[len("file://"):]
    if uri.startswith("file:"):
        return uri[len("file:"):]
    return os.fspath(uri)
