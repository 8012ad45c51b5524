"""End to end: the retail job from a CSV (run twice) and the supply job."""

from datetime import date

import pytest

from pyspark.sql import functions as F

from starmart.plans import retail_job as RP
from starmart.plans import supply_job as SP
from starmart.sources import files, versions
from starmart.sources import testbed as TB

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("in_place", [True, False])
def test_retail_job_rerun_is_idempotent(spark, tmp_root, in_place):
    csv = f"{tmp_root}/landing"
    files.write_csv(TB.raw_source(spark, SF), csv)
    first = RP.run_retail(spark, csv, f"{tmp_root}/wh", date(2026, 2, 22), snapshot_in_place=in_place)
    second = RP.run_retail(spark, csv, f"{tmp_root}/wh", date(2026, 2, 22), snapshot_in_place=in_place)
    m = first["cleaning"]
    assert m["bronze_rows"] - m["duplicates_dropped"] - m["null_mandatory_dropped"] \
        - m["bad_price_dropped"] == m["silver_rows"]
    checks = {r["check_name"]: r for r in second["audit"]}
    assert checks["silver_to_gold_loss"]["value"] == 0
    assert checks["gold_rows"]["value"] == m["silver_rows"]
    p = RP.paths(f"{tmp_root}/wh")
    assert spark.read.parquet(p["archive"]).count() == m["bronze_rows"]  # one snapshot copy
    fact = versions.read_current(spark, p["fact_sales"])
    assert fact.select("sales_id").distinct().count() == fact.count()
    assert fact.select("batch_id").distinct().count() == 1
    # keys stay stable across runs
    dp1 = spark.read.parquet(f"{p['dim_products']}/v=1")
    dp2 = versions.read_current(spark, p["dim_products"])
    assert dp1.join(dp2, ["product_id", "stock_code"]).count() == dp1.count() == dp2.count()
    # the next day adds a second snapshot and leaves the first untouched
    third = RP.run_retail(spark, csv, f"{tmp_root}/wh", date(2026, 2, 23), snapshot_in_place=in_place)
    days = spark.read.parquet(p["archive"]).groupBy("snapshot_date").count().collect()
    assert sorted(r["count"] for r in days) == [m["bronze_rows"]] * 2
    assert third["cleaning"]["silver_rows"] == m["silver_rows"]


def test_supply_job(spark, tmp_root):
    SP.run_supply(spark, SF, tmp_root)
    files.assert_tables(spark, tmp_root, ["dim_products", "dim_suppliers", "dim_warehouses", "dim_orders",
                                          "dim_time", "fact_shipments"])
    assert versions.read_current(spark, f"{tmp_root}/fact_shipments").count() > 0
    before = spark.read.parquet(f"{tmp_root}/fact_shipments/v=1")
    after = versions.read_current(spark, f"{tmp_root}/fact_shipments")
    log = spark.read.parquet(f"{tmp_root}/shipment_audit_log")
    deleted = before.count() - after.count()
    assert deleted == log.filter("operation = 'DELETE'").count() > 0
    assert log.filter("changed_by is null or changed_at is null").count() == 0
    # a second batch appends with ids after the first batch's
    n1 = log.count()
    SP.run_supply(spark, SF, tmp_root)
    log = spark.read.parquet(f"{tmp_root}/shipment_audit_log")
    assert log.count() > n1 and log.select("audit_id").distinct().count() == log.count()


def test_supply_batch_is_applied_and_logged_once(spark, tmp_root, monkeypatch):
    kinds = {"batch_id": "b1", "natural_ids": True}
    real, calls = versions.commit_version, []

    def dies(spark, root, v, batch_id=""):
        calls.append(batch_id)
        if batch_id == "b1" and calls.count("b1") == 1:
            raise OSError("lost before the commit")
        real(spark, root, v, batch_id)
    monkeypatch.setattr(versions, "commit_version", dies)
    with pytest.raises(OSError):
        SP.run_supply(spark, SF, tmp_root, **kinds)
    assert SP.audit_log(spark, tmp_root).count() == 0          # written, not committed
    assert SP.run_supply(spark, SF, tmp_root, **kinds)["applied"]
    n, facts = SP.audit_log(spark, tmp_root).count(), versions.read_current(spark, f"{tmp_root}/fact_shipments").count()
    assert n == spark.read.parquet(f"{tmp_root}/shipment_audit_log").count() > 0
    assert not SP.run_supply(spark, SF, tmp_root, **kinds)["applied"]
    assert (SP.audit_log(spark, tmp_root).count(), versions.read_current(spark, f"{tmp_root}/fact_shipments").count()) == (n, facts)


def feed_with(spark, **changed):
    row = {"InvoiceNo": "1", "StockCode": "A", "Description": "d", "Quantity": "1", "InvoiceDate": "2010-12-01",
           "UnitPrice": "2.00", "CustomerID": "5", "Country": "UK"}
    return spark.createDataFrame([tuple(row.values()), tuple({**row, "InvoiceNo": "2", **changed}.values())],
                                 ", ".join(f"{c} string" for c in row))


@pytest.mark.parametrize("changed,match", [({"InvoiceDate": "garbage", "UnitPrice": "0"}, "1 rows have an unparsable"),
                                           ({"Description": "x" * 300}, "longer than declared")])
def test_a_bad_batch_leaves_silver_and_gold(spark, tmp_root, changed, match):
    wh = f"{tmp_root}/wh"
    files.write_csv(feed_with(spark), f"{tmp_root}/good")
    RP.run_retail(spark, f"{tmp_root}/good", wh, date(2026, 2, 22))
    files.write_csv(feed_with(spark, **changed), f"{tmp_root}/bad")
    with pytest.raises(ValueError, match=match):
        RP.run_retail(spark, f"{tmp_root}/bad", wh, date(2026, 2, 23))
    p = RP.paths(wh)
    assert spark.read.parquet(p["silver_tx"]).count() == 2 and versions.current_version(spark, p["fact_sales"]) == 1
    files.write_csv(feed_with(spark).limit(0), f"{tmp_root}/none")
    with pytest.raises(Exception):
        RP.run_retail(spark, f"{tmp_root}/none", wh, date(2026, 2, 24))
    assert spark.read.parquet(p["silver_tx"]).count() == 2
    with pytest.raises(ValueError, match="run_date"):
        RP.transform(spark, wh, in_place=True)
    with pytest.raises(FileNotFoundError):
        RP.transform(spark, wh, date(2026, 3, 1), in_place=True)


def test_append_mode_rerun_replaces_the_day(spark, tmp_root):
    df = spark.range(5).withColumn("v", F.lit(1))
    path = f"{tmp_root}/fact"
    files.write_fact(df, path, "append", run_date="2026-02-22")
    files.write_fact(df, path, "append", run_date="2026-02-22")
    files.write_fact(df.limit(2), path, "append", run_date="2026-02-23")
    counts = {str(r["run_date"]): r["count"] for r in spark.read.parquet(path).groupBy("run_date").count().collect()}
    assert counts == {"2026-02-22": 5, "2026-02-23": 2}


def test_run_concurrently_runs_all_and_reraises(spark, tmp_root):
    from starmart.session import run_concurrently
    run_concurrently([lambda i=i: spark.range(i + 1).write.parquet(f"{tmp_root}/t{i}") for i in range(3)])
    assert [spark.read.parquet(f"{tmp_root}/t{i}").count() for i in range(3)] == [1, 2, 3]

    def boom():
        raise ValueError("boom")
    with pytest.raises(ValueError, match="boom"):
        run_concurrently([lambda: spark.range(1).count(), boom])
