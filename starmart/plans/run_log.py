"""The stored run record: counts, run time and audit statuses of every job run.

Each run is filed under its id (a rerun with the same id replaces its own record), one row
a check, so the log is a plain table to query. A failed run leaves a record as well.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.sources import files

SCHEMA = ("job string, run_date date, started_at timestamp_ntz, runtime_seconds double, outcome string, "
          "check_name string, value long, status string")


class AuditError(RuntimeError):
    """The audit of a finished run has status ERROR."""


def path(root: str) -> str:
    return f"{root}/run_log"


def record(spark: SparkSession, root: str, run_id: str, job: str, run_date: date | None, started: datetime, seconds: float,
           outcome: str, checks: list[tuple[str, int | None, str | None]]) -> None:
    """File one run; a handful of rows."""
    rows = [(job, run_date, started, float(seconds), outcome, *c) for c in checks] or [(job, run_date, started, float(seconds), outcome, None, None, None)]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{path(root)}/run_id={run_id}")


def runs(spark: SparkSession, root: str) -> DataFrame:
    """The run log; empty before the first run."""
    if not files.table_exists(spark, path(root)):
        return spark.createDataFrame([], f"{SCHEMA}, run_id string")
    return spark.read.schema(f"{SCHEMA}, run_id string").parquet(path(root))


def logged(spark: SparkSession, root: str, run_id: str, job: str, run_date: date | None, work: Callable[[], dict],
           checks: Callable[[dict], list[tuple]], fail_on_error: bool = False) -> dict:
    """Run ``work`` and file its record. ``checks`` turns its result into (check, value,
    status) rows. A failure is recorded and raised again; with ``fail_on_error`` so is an
    audit status of ERROR, after it is stored."""
    started, clock = datetime.now(), time.perf_counter()
    try:
        out = work()
    except Exception as e:
        text = f"{type(e).__name__}: {e}".splitlines()[0][:500]
        record(spark, root, run_id, job, run_date, started, time.perf_counter() - clock, "FAILED", [("error", None, text)])
        raise
    rows = checks(out)
    record(spark, root, run_id, job, run_date, started, time.perf_counter() - clock, "SUCCESS", rows)
    if fail_on_error and (bad := [name for name, _, status in rows if status == "ERROR"]):
        raise AuditError(f"{job} {run_id}: audit ERROR in {', '.join(bad)}")
    return out


def last_status(spark: SparkSession, root: str, job: str) -> DataFrame:
    """(run_id, started_at, runtime_seconds, outcome, status): each run with its overall
    audit status, the newest first."""
    r = runs(spark, root).where(F.col("job") == job)
    overall = F.max(F.when(F.col("check_name").isin("overall", "error"), F.col("status")))
    return (r.groupBy("run_id", "started_at", "runtime_seconds", "outcome").agg(overall.alias("status"))
            .orderBy(F.col("started_at").desc()))
