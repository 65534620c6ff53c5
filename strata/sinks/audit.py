"""Run audit (SNK9, AGG12): one appended row for each run of a flow.

A flow runs inside :func:`audited` and adds its counts, which normally come
from an ``Observation`` of the job itself, so auditing costs no extra pass.
"""

from __future__ import annotations

import datetime as _dt
import time
import uuid
from collections import Counter
from contextlib import contextmanager

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from strata.schemas import PIPELINE_AUDIT


class RunCounts(Counter):
    """What a flow reports: ``processed``, ``rejected``, and where it wrote (``uri``)."""

    uri: str | None = None


def status_of(error, rejected):
    """FAILURE with an error, else PARTIAL with rejected rows, else SUCCESS (columns)."""
    return F.when(error.isNotNull(), "FAILURE").when(rejected > 0, "PARTIAL").otherwise("SUCCESS")


@contextmanager
def audited(spark: SparkSession, audit_path: str, pipeline: str, source: str):
    """Yield :class:`RunCounts`; append the audit row when the block ends, an error included (and raised)."""
    counts, error = RunCounts(), None
    began, at = time.monotonic(), _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    try:
        yield counts
    except BaseException as exc:
        error = str(exc)
        raise
    finally:
        facts = {"run_id": str(uuid.uuid4()), "dag_id": pipeline, "task_id": source, "source_name": source, "run_date": at,
                 "rows_processed": counts["processed"], "rows_rejected": counts["rejected"], "error_message": error,
                 "duration_seconds": time.monotonic() - began, "gcs_uri": counts.uri}
        row = spark.createDataFrame([tuple(facts.get(f) for f in PIPELINE_AUDIT.names)], PIPELINE_AUDIT)
        row = row.withColumn("status", status_of(F.col("error_message"), F.col("rows_rejected")))
        row.write.mode("append").parquet(audit_path)


def run_status(counts: RunCounts) -> str:
    """Status of a run that ended well."""
    return "PARTIAL" if counts["rejected"] else "SUCCESS"
