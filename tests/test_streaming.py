"""availableNow landing ingest: each run picks up only new files; reruns add nothing."""

import os

import pytest

from starmart.streaming import ingest_landing

HEADER = "InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\n"


def write(path, rows):
    with open(path, "wb") as fh:
        fh.write((HEADER + "".join(rows)).encode("latin-1"))


def test_landing_runs_are_incremental(spark, tmp_root):
    land, bronze, ck = f"{tmp_root}/landing", f"{tmp_root}/bronze", f"{tmp_root}/ck"
    os.makedirs(land)
    write(f"{land}/day1.csv", ["1,A,Mug,2,2010-12-01,1.50,17850.0,France\n", "2,B,NA,1,2010-12-01,2.00,,UK\n"])
    assert ingest_landing(spark, land, bronze, ck) == 1
    assert spark.read.parquet(bronze).count() == 2
    assert ingest_landing(spark, land, bronze, ck) == 0  # nothing new
    write(f"{land}/day2.csv", ["3,C,Cup,1,2010-12-02,3.00,12,Spain\n"])
    assert ingest_landing(spark, land, bronze, ck) == 1
    b = spark.read.parquet(bronze)
    assert b.count() == 3 and b.select("batch_id").distinct().count() == 2
    row = b.filter("invoice_no = '1'").first()
    assert row["customer_id"] == "17850" and str(row["unit_price"]) == "1.50"


def test_short_rows_fail_and_a_fresh_checkpoint_is_refused(spark, tmp_root):
    land, bronze, ck = f"{tmp_root}/landing", f"{tmp_root}/bronze", f"{tmp_root}/ck"
    os.makedirs(land)
    write(f"{land}/day1.csv", ['1,A,"Mug ""L"", red",2,2010-12-01,1.50,17850.0,France\n'])
    assert ingest_landing(spark, land, bronze, ck) == 1
    assert spark.read.parquet(bronze).first()["description"] == 'Mug "L", red'
    with pytest.raises(ValueError, match="another checkpoint"):
        ingest_landing(spark, land, bronze, f"{tmp_root}/ck2")
    write(f"{land}/day2.csv", ["2,B\n"])
    with pytest.raises(Exception):
        ingest_landing(spark, land, bronze, ck)
    assert spark.read.parquet(bronze).count() == 1


def test_bad_records_of_a_stream_are_set_aside(spark, tmp_root):
    land, bronze, ck, bad = f"{tmp_root}/landing", f"{tmp_root}/bronze", f"{tmp_root}/ck", f"{tmp_root}/rejects"
    os.makedirs(land)
    good = [f"{i},A,Mug,2,2010-12-01,1.50,17850.0,France\n" for i in range(8)]
    write(f"{land}/day1.csv", good + ["90,B\n", "91,C,d,many,2010-12-01,1,1,UK\n"])
    assert ingest_landing(spark, land, bronze, ck, tolerate_rejects=0.2, reject_dir=bad) == 1
    assert spark.read.parquet(bronze).count() == 8
    got = {(r.file, r.line, r.reason) for r in spark.read.parquet(bad).collect()}
    assert got == {("day1.csv", "90,B", "too few fields: 2 of 8"), ("day1.csv", "91,C,d,many,2010-12-01,1,1,UK", "quantity is no whole number: many")}
    write(f"{land}/day2.csv", ["3,C,Cup,1,2010-12-02,3.00,12,Spain\n", "4\n"])
    with pytest.raises(Exception, match="1 of 2 records rejected"):
        ingest_landing(spark, land, bronze, ck, tolerate_rejects=0.2, reject_dir=bad)
    assert spark.read.parquet(bronze).count() == 8
    assert ingest_landing(spark, land, bronze, ck, tolerate_rejects=0.5, reject_dir=bad) == 1      # the same files, a wider tolerance
    assert spark.read.parquet(bronze).count() == 9 and spark.read.parquet(bad).count() == 3
