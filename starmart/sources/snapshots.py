"""Daily Bronze snapshots.

The archive is a versioned table whose parts are the days (``snapshot_date``). A run
replaces its day as a whole by one commit: one copy, never two, other days untouched, and
a batch without rows replaces a full one by an empty day. A failed write leaves the day as
it was. One day is read by its own folder, so the other days are not even listed.
"""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.sources import versions


def replace_day(df: DataFrame, path: str, column: str, day: date | str, batch_id: str = "", guard=None) -> int:
    """Make ``df`` (without the day column) the day's rows, also if it holds none. Writers
    of different days do not disturb each other; of two writers of one day the later commit
    stays, whole. The replaced rows are removed. ``guard``: see ``versions.write_version``."""
    rows = df.withColumn(column, F.lit(str(day)).cast("date"))
    v = versions.write_version(rows, path, batch_id, partition_by=column, replace=[f"{column}={day}"], guard=guard)
    versions.vacuum(df.sparkSession, path, keep=1, dead_after_hours=24)
    return v


def snapshot(bronze: DataFrame, archive_path: str, snapshot_date: date | str | None = None,
             snapshot_id: str | None = None, guard=None) -> None:
    """Copy the current Bronze rows into the archive under ``snapshot_date``."""
    sid = snapshot_id or str(uuid.uuid4())
    replace_day(bronze.withColumn("snapshot_id", F.lit(sid)), archive_path, "snapshot_date", snapshot_date or date.today(), sid, guard)


def has_day(spark: SparkSession, archive_path: str, snapshot_date: date | str) -> bool:
    """Whether the day was written, with rows or without."""
    c = versions.latest(spark, archive_path)
    return c is not None and f"snapshot_date={snapshot_date}" in c.parts


def read_snapshot(spark: SparkSession, archive_path: str, snapshot_date: date | str) -> DataFrame:
    """The archive rows of one day; a day never written is an error."""
    if not has_day(spark, archive_path, snapshot_date):
        raise FileNotFoundError(f"[PATH_NOT_FOUND] no snapshot of {snapshot_date} in {archive_path}")
    return versions.read_commit(spark, archive_path, versions.latest(spark, archive_path), [f"snapshot_date={snapshot_date}"])


def read_archive(spark: SparkSession, archive_path: str) -> DataFrame:
    """All days."""
    return versions.read_current(spark, archive_path)


def day_counts(spark: SparkSession, path: str, column: str = "snapshot_date") -> DataFrame:
    """(day, row_count) of every day written, also those without rows (one listed part a
    day comes from the commit; the rows are counted from file footers)."""
    c = versions.latest(spark, path)
    days = spark.createDataFrame([(p.split("=", 1)[1],) for p in c.parts] if c else [], "day string").select(F.col("day").cast("date").alias(column))
    if c is None:
        return days.withColumn("row_count", F.lit(0).cast("long"))
    counts = versions.read_commit(spark, path, c).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return days.join(counts, column, "left").select(column, F.coalesce("n", F.lit(0)).alias("row_count"))
