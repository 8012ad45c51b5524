"""Dimension building and surrogate keys.

Surrogate keys (K1) without a single-partition window: the new members are range
partitioned on the natural key and sorted inside each partition; each row gets its
in-partition position from ``monotonically_increasing_id``; the result is checkpointed
to the shared checkpoint folder (so every later read sees the same positions, also after
an executor loss); the per-partition row counts (one row per partition, bounded by the
partition count, not by the data) give each partition its starting offset. The keys
equal a global ``row_number() over (order by natural_key)`` shifted past the largest
existing key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starmart.functions.dates import date_attributes, date_from_id
from starmart.session import shared_root

DATE_COLUMNS = ["date_id", "full_date", "year", "quarter", "month", "month_name", "week",
                "day_of_week", "day_name", "is_weekend"]


def dim_date_from_facts(facts: DataFrame, date_id_column: str = "date_id") -> DataFrame:
    """G1: a sparse date dimension holding the dates present in the facts.

    ``distinct`` runs with a map-side partial aggregate; its output is bounded by the
    number of calendar days, whatever the fact size.
    """
    ids = facts.select(F.col(date_id_column).alias("_id")).distinct()
    d = ids.select("_id", date_from_id("_id").alias("_d"))
    attrs = date_attributes("_d")
    # the fact's key is the dimension key as is (no round trip through the date)
    attrs["date_id"] = F.col("_id")
    return d.select(*[c.alias(n) for n, c in attrs.items()])


def calendar(bounds: DataFrame, start: str = "start_date", end: str = "end_date") -> DataFrame:
    """Every day from ``start`` to ``end`` (inclusive) of a one-row bounds frame."""
    days = bounds.select(F.explode(F.sequence(F.col(start).cast("date"), F.col(end).cast("date"),
                                              F.expr("interval 1 day"))).alias("_d"))
    return days.select(*[c.alias(n) for n, c in date_attributes("_d").items()])


def dim_time(spark: SparkSession, start_date: str = "2024-01-01",
             end_date: str = "2025-12-31") -> DataFrame:
    """G2 with literal bounds (the reference's default range holds 731 days)."""
    bounds = spark.range(1).select(F.lit(start_date).cast("date").alias("start_date"),
                                   F.lit(end_date).cast("date").alias("end_date"))
    return calendar(bounds)


def assign_keys(members: DataFrame, natural: str | list[str], key: str,
                existing: DataFrame | None = None, num_partitions: int | None = None,
                start: int | None = None, include_existing: bool = True) -> DataFrame:
    """K1: give every member a surrogate key.

    Existing members keep theirs; members not yet in ``existing`` get ``max(key)+1, ...``
    in natural-key order (gaps are allowed, duplicates never). The result has ``key``
    followed by the columns of ``members`` (and of ``existing`` for kept rows).
    ``members`` must be unique on the natural key (a dimension, e.g. the output of
    ``first_per_key``); ``num_partitions`` fixes the range partition count, otherwise
    AQE sizes it from the data.
    """
    spark = members.sparkSession
    nat = [natural] if isinstance(natural, str) else list(natural)
    if existing is not None:
        new = members.join(existing.select(*nat), nat, "left_anti")
        base = start if start is not None else (existing.agg(F.max(key)).first()[0] or 0)
    else:
        new = members
        base = start or 0

    shared_root(spark)  # make sure a (shared) checkpoint folder is set
    # Without an explicit count AQE sizes the range partitions from the data; partition
    # ids and positions are taken after that (coalesced) read and checkpointed together,
    # so the offsets below always match the rows they were counted from.
    ranged = (new.repartitionByRange(num_partitions, *nat) if num_partitions
              else new.repartitionByRange(*nat))
    ranged = (ranged.sortWithinPartitions(*nat)
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_rid", F.monotonically_increasing_id())
              .checkpoint(eager=True))
    # one row per partition: a running sum over them is tiny, and it is broadcast
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    local = F.col("_rid") - F.shiftleft(F.col("_pid").cast("long"), 33)
    keyed = (ranged.join(F.broadcast(offsets), "_pid")
             .select((F.lit(base).cast("long") + F.col("_offset") + local + 1).alias(key),
                     *[F.col(c) for c in members.columns]))
    if existing is None or not include_existing:
        return keyed
    return existing.unionByName(keyed, allowMissingColumns=True)


def with_serial(df: DataFrame, column: str, start: int = 1) -> DataFrame:
    """A SERIAL-like id for rows appended to a log: unique and increasing from ``start``,
    gaps allowed. Assigned inside the writing job (no ordering, no shuffle). A recomputed
    task may deal its ids to its rows in another order; they stay unique, and only the
    attempt that commits is ever read."""
    return df.select((F.lit(start).cast("long") + F.monotonically_increasing_id()).alias(column),
                     *df.columns)
