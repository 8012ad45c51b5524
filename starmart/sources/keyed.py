"""Q2/K2 on facts that grow by days: unique keys, checked at the cost of the day's rows.

A table filed by days (:func:`starmart.sources.snapshots.replace_day`) keeps, beside each
day, the range of its keys and a small bit filter of them (at most ``WORDS`` words of 64
bits, whatever the day's size). The keys of a new day are checked among themselves, then
against the days whose ranges they meet: by the filters first, and by an exact join with
the stored keys only for what passes them. Ascending keys meet no range and cost nothing;
a filter can let too much through but never misses a key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.operators.quality import ConstraintError
from starmart.sources import snapshots, versions

WORDS = 1 << 20                # 64-bit words of a day's filter at most: 12 MB of rows
PROBES = 4


def _probe(key: Column, k: int) -> Column:
    """Bit number of the k-th probe of a key."""
    return F.pmod(F.xxhash64(key, F.lit(k)), F.lit(64 * WORDS))


def probes(keys: DataFrame, key: str) -> DataFrame:
    """(key, word, bit mask) of each probe."""
    at = F.explode(F.array(*[_probe(F.col(key), k) for k in range(PROBES)]))
    return keys.select(key, at.alias("_at")).select(key, F.expr("_at div 64").cast("int").alias("word"),
                                                    F.expr("shiftleft(1L, cast(_at % 64 as int))").alias("mask"))


def key_filter(keys: DataFrame, key: str) -> DataFrame:
    """(word, bits): the filter of a frame's keys; filters are merged by ``bit_or``."""
    return probes(keys, key).groupBy("word").agg(F.bit_or("mask").alias("bits"))


def filter_path(path: str, version: int) -> str:
    return f"{path}/_keys/v={version}"


def stored_days(spark: SparkSession, path: str, column: str, skip: str | None = None) -> list[tuple]:
    """(part, version, least key, largest key) of the days with rows."""
    c = versions.latest(spark, path)
    if c is None:
        return []
    info = {r.version: r.info for r in versions.commit_log(spark, path).select("version", "info").collect()}     # a small map a day
    return [(p, v, int(info[v]["key_min"]), int(info[v]["key_max"])) for p, v in c.parts.items()
            if v and p != skip and info.get(v, {}).get("key_min", "None") != "None"]


def repeated_keys(new: DataFrame, path: str, key: str, column: str, day: str, low: int, high: int) -> DataFrame:
    """The distinct keys of ``new`` that another stored day holds: exact."""
    spark = new.sparkSession
    days = [d for d in stored_days(spark, path, column, f"{column}={day}") if d[2] <= high and d[3] >= low]
    keys = new.select(key).where(F.col(key).isNotNull()).distinct()
    if not days:
        return keys.limit(0)
    filters = spark.read.schema("word int, bits long").parquet(*[filter_path(path, v) for _, v, _, _ in days])
    merged = filters.groupBy("word").agg(F.bit_or("bits").alias("bits"))          # at most WORDS rows
    hits = probes(keys, key).join(merged, "word").where((F.col("bits").bitwiseAND(F.col("mask"))) == F.col("mask"))
    passed = hits.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") == PROBES).select(key)
    held = versions.read_commit(spark, path, versions.latest(spark, path), [p for p, *_ in days]).select(key)
    return passed.join(held, key, "left_semi")


def append_day(df: DataFrame, path: str, key: str, column: str, day, batch_id: str = "") -> int:
    """Append (or replace) a day of rows with unique keys; raises and publishes nothing when
    a key repeats inside the day or in another day."""
    spark = df.sparkSession

    def guard(version: int) -> dict:
        rows = spark.read.schema(df.select(key).schema).parquet(f"{path}/v={version}").select(key)
        if rows.isEmpty():
            return {"key_min": None, "key_max": None}
        seen = rows.agg(F.min(key), F.max(key), F.count(F.lit(1)), F.count(key)).first()
        if seen[2] != seen[3]:
            raise ConstraintError(f"{path}: {seen[2] - seen[3]} rows of {day} have no {key}")
        twice = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").count()
        again = 0 if twice else repeated_keys(rows, path, key, column, str(day), seen[0], seen[1]).count()
        if twice or again:
            raise ConstraintError(f"{path}: {twice} keys of {day} repeat in it, {again} in other days")
        key_filter(rows, key).write.mode("overwrite").parquet(filter_path(path, version))
        return {"key_min": seen[0], "key_max": seen[1]}

    return snapshots.replace_day(df, path, column, day, batch_id, guard)
