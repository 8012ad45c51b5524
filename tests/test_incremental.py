"""Reject tables, unique keys by days and mergeable profiles."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from starmart.operators import quality as Q
from starmart.plans import retail_job as RP
from starmart.plans import run_log
from starmart.sources import files, keyed, rejects, snapshots, versions

HEAD = "InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\n"
GOOD = [f'{i},A{i},"mug, ""big""",2,2010-12-01,1.50,17850,France\n' for i in range(8)]
BAD = ["90,B\n", '91,C,d,1,2010-12-01,1,1,UK,"x, y"\n', "92,D,d,6.5,2010-12-01,1,1,UK\n", "93,E,d,1,2010-12-01,cheap,1,UK\n"]


def landing(path, lines, encoding="latin-1"):
    with open(path, "w", encoding=encoding) as fh:
        fh.write(HEAD + "".join(lines))
    return path


def test_bad_records_are_set_aside_and_counted(spark, tmp_root):
    csv, wh = landing(f"{tmp_root}/in.csv", GOOD[:4] + BAD + GOOD[4:]), f"{tmp_root}/wh"
    out = RP.run_retail(spark, csv, wh, date(2026, 2, 22), "b1", tolerate_rejects=0.4)
    assert out["ingest"] == {"records": 12, "rejected": 4} and out["cleaning"]["bronze_rows"] == 8
    got = {(r.file, r.line, r.reason) for r in RP.rejects(spark, wh).collect()}
    assert got == {("in.csv", "90,B", "too few fields: 2 of 8"), ("in.csv", '91,C,d,1,2010-12-01,1,1,UK,"x, y"', "too many fields: 9 for 8"),
                   ("in.csv", "92,D,d,6.5,2010-12-01,1,1,UK", "quantity is no whole number: 6.5"),
                   ("in.csv", "93,E,d,1,2010-12-01,cheap,1,UK", "price is no number: cheap")}
    seen = {r.check_name: r.value for r in run_log.runs(spark, wh).collect()}
    assert seen["ingest.rejected"] == 4 and seen["ingest.records"] == 12


def test_too_many_rejects_publish_nothing(spark, tmp_root):
    wh = f"{tmp_root}/wh"
    RP.run_retail(spark, landing(f"{tmp_root}/a.csv", GOOD), wh, date(2026, 2, 22), "b1", tolerate_rejects=0.0)
    with pytest.raises(rejects.TooManyRejects, match="4 of 12"):
        RP.run_retail(spark, landing(f"{tmp_root}/b.csv", GOOD + BAD), wh, date(2026, 2, 22), "b2", tolerate_rejects=0.1)
    assert snapshots.read_snapshot(spark, RP.paths(wh)["archive"], "2026-02-22").count() == 8
    assert RP.rejects(spark, wh).where("batch_id = 'b2'").count() == 4          # to be looked at
    with pytest.raises(Exception):                                               # without a tolerance one bad line stops the load
        RP.run_retail(spark, f"{tmp_root}/b.csv", wh, date(2026, 2, 23), "b3")


def test_clean_files_leave_no_reject_table(spark, tmp_root):
    wh = f"{tmp_root}/wh"
    RP.ingest(spark, landing(f"{tmp_root}/a.csv", GOOD), wh, "b1", tolerate_rejects=0.0)
    assert RP.rejects(spark, wh).count() == 0 and not files.table_exists(spark, RP.paths(wh)["rejects"])
    a, b = files.read_raw_csv(spark, f"{tmp_root}/a.csv"), rejects.accepted(rejects.read_with_reasons(spark, f"{tmp_root}/a.csv"))
    assert a.columns == b.columns and sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


# --- unique keys --------------------------------------------------------------------------------

def days(spark, path):
    return {str(r.run_date): r.row_count for r in snapshots.day_counts(spark, path, "run_date").collect()}


def test_keys_are_unique_over_days(spark, tmp_root):
    path = f"{tmp_root}/f"
    add = lambda df, day: keyed.append_day(df, path, "id", "run_date", day)
    scattered = spark.range(4000).select(F.xxhash64("id").alias("id"), F.lit("x").alias("v"))
    add(scattered, "2026-02-20")
    add(spark.range(4000, 8000).select(F.xxhash64("id").alias("id"), F.lit("x").alias("v")), "2026-02-21")
    with pytest.raises(Q.ConstraintError, match="0 keys of 2026-02-22 repeat in it, 3 in other days"):
        add(spark.range(7997, 9000).select(F.xxhash64("id").alias("id"), F.lit("y").alias("v")), "2026-02-22")
    with pytest.raises(Q.ConstraintError, match="5 keys of 2026-02-22 repeat"):
        add(spark.range(10).select((F.col("id") % 5).alias("id"), F.lit("y").alias("v")), "2026-02-22")
    with pytest.raises(Q.ConstraintError, match="have no id"):
        add(spark.range(3).select(F.lit(None).cast("long").alias("id"), F.lit("y").alias("v")), "2026-02-22")
    assert days(spark, path) == {"2026-02-20": 4000, "2026-02-21": 4000}
    add(scattered, "2026-02-20")                                    # the rerun of a day meets its own keys freely
    add(scattered.limit(0), "2026-02-21")
    add(spark.range(4000, 4100).select(F.xxhash64("id").alias("id"), F.lit("z").alias("v")), "2026-02-22")
    assert days(spark, path) == {"2026-02-20": 4000, "2026-02-21": 0, "2026-02-22": 100}


def test_ascending_keys_read_no_stored_rows(spark, tmp_root, monkeypatch):
    path = f"{tmp_root}/f"
    keyed.append_day(spark.range(0, 500), path, "id", "run_date", "2026-02-20")
    read = []
    monkeypatch.setattr(versions, "read_commit", lambda *a, **k: read.append(a))
    keyed.append_day(spark.range(500, 900), path, "id", "run_date", "2026-02-21")
    assert read == []


def test_a_filter_never_misses_and_rarely_errs(spark):
    keys = spark.range(20_000).select(F.xxhash64("id").alias("id"))
    f = keyed.key_filter(keys, "id")
    other = spark.range(20_000, 60_000).select(F.xxhash64("id").alias("id"))
    both = keys.withColumn("own", F.lit(True)).unionByName(other.withColumn("own", F.lit(False)))
    hit = (keyed.probes(both, "id").join(f, "word").where(F.col("bits").bitwiseAND(F.col("mask")) == F.col("mask"))
           .groupBy("id").count().where(f"count = {keyed.PROBES}").join(both, "id").groupBy("own").count())
    got = {r.own: r["count"] for r in hit.collect()}
    assert got[True] == 20_000 and got.get(False, 0) < 40


# --- profiles -----------------------------------------------------------------------------------

def test_merged_sketches_profile_all_days(spark, tmp_root):
    df = spark.range(60_000).select((F.col("id") % 30_000).alias("n"), F.when(F.col("id") % 4 == 0, None).otherwise(F.col("id") % 7).alias("some"),
                                    F.lit(None).cast("double").alias("none"), F.concat(F.lit("k"), F.col("id").cast("string")).alias("s"))
    for d in range(3):
        Q.profile_sketch(df.where(F.pmod("n", F.lit(3)) == d)).write.parquet(f"{tmp_root}/p/day={d}")
    Q.profile_sketch(df.limit(0)).write.parquet(f"{tmp_root}/p/day=3")
    got = {r.column_name: r for r in Q.merged_profile(spark.read.parquet(f"{tmp_root}/p")).collect()}
    assert {c: (r.row_count, r.null_count) for c, r in got.items()} == {"n": (60_000, 0), "some": (60_000, 15_000), "none": (60_000, 60_000), "s": (60_000, 0)}
    assert abs(got["n"].distinct_count - 30_000) < 1000 and got["some"].distinct_count == 7 and got["none"].distinct_count == 0
    assert abs(got["s"].distinct_count - 60_000) < 2000
    assert abs(got["n"].p50 - 15_000) < 600 and got["s"].p50 is None and got["none"].p25 is None
