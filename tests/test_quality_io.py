"""Quality checks, I/O (CSV, snapshots, year layout, versions) and the supply reports."""

import os
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starmart.operators import joins as J
from starmart.operators import quality as Q
from starmart.plans import supply as SR
from starmart.sources import files, layout, snapshots, versions


def test_check_rows_and_unique(spark):
    df = spark.createDataFrame([(1, 5), (2, -1), (2, None)], "k int, q int")
    rules = {"q > 0": F.coalesce(F.col("q") > 0, F.lit(True)), "q not null": F.col("q").isNotNull()}
    out = {r["rule"]: r["violations"] for r in Q.check_rows(df, rules, "t").collect()}
    assert out == {"q > 0": 1, "q not null": 1}
    assert [tuple(r) for r in Q.check_unique(df, "k").collect()] == [(2, 2)]


def test_audit_layer_statuses(spark):
    def audit(b, s, g):
        counts = spark.createDataFrame([("bronze", b), ("silver", s), ("gold", g)], "layer string, row_count long")
        return {r["check_name"]: r["status"] for r in Q.audit_layers(counts).collect()}
    ok = audit(600_000, 590_000, 590_000)
    assert set(ok.values()) == {"OK"}
    low = audit(100, 90, 90)
    assert low["bronze_rows"] == "ERROR" and low["overall"] == "ERROR"
    lossy = audit(600_000, 590_000, 580_000)
    assert lossy["silver_to_gold_loss"] == "WARNING" and lossy["overall"] == "WARNING"
    dup = audit(600_000, 590_000, 600_000)
    assert dup["silver_to_gold_loss"] == "ERROR"


def test_profile(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), (None, 2)], "s string, i int")
    out = {r["column_name"]: (r["row_count"], r["null_count"], r["distinct_count"])
           for r in Q.profile(df).collect()}
    assert out == {"s": (3, 1, 1), "i": (3, 1, 2)}


def test_csv_latin1_and_na_tokens(spark, tmp_root):
    path = f"{tmp_root}/in.csv"
    text = ("InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\n"
            "536365,85123A,\xa0WHITE MUG\xa0,6,12/1/2010 8:26,2.55,17850.0,United Kingdom\n"
            "536366,22633,NA,6,12/1/2010 8:28,1.85,,Fran\xe7e\n")
    with open(path, "wb") as fh:
        fh.write(text.encode("latin-1"))
    raw = files.read_raw_csv(spark, path)
    b = files.to_bronze_types(files.standardise_columns(raw)).orderBy("invoice_no").collect()
    assert b[0]["description"] == "\xa0WHITE MUG\xa0" and b[0]["customer_id"] == "17850"
    assert b[1]["description"] is None and b[1]["customer_id"] is None and b[1]["country"] == "Fran\xe7e"
    assert b[0]["unit_price"] == Decimal("2.55")


def test_standardise_columns(spark):
    df = spark.createDataFrame([(1, 2)], "`Invoice No` int, UnitPrice int")
    assert files.standardise_columns(df, {"unitprice": "unit_price"}).columns == ["invoice_no", "unit_price"]


def test_snapshot_rerun_keeps_one_copy(spark, tmp_root):
    df = spark.range(10).withColumn("x", F.lit("a"))
    arc = f"{tmp_root}/archive"
    snapshots.snapshot(df, arc, "2026-02-22")
    snapshots.snapshot(df, arc, "2026-02-22")
    snapshots.snapshot(df.limit(3), arc, "2026-02-23")
    assert snapshots.read_snapshot(spark, arc, "2026-02-22").count() == 10
    assert snapshots.read_snapshot(spark, arc, date(2026, 2, 23)).count() == 3


def test_date_range_scan_prunes_year_folders(spark, tmp_root):
    df = spark.createDataFrame([(20101201, 1), (20110105, 2), (20120101, 3), (None, 4)], "date_id int, v int")
    path = f"{tmp_root}/fact"
    layout.write_fact_by_year(df, path)
    scan = layout.scan_date_range(spark, path, 20110101, 20111231)
    assert [r["v"] for r in scan.collect()] == [2]
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "sale_year" in plan and "PartitionFilters: [isnotnull(sale_year" in plan


def test_versions_pointer(spark, tmp_root):
    root = f"{tmp_root}/t"
    assert versions.current_version(spark, root) is None
    versions.write_version(spark.range(3), root)
    v = versions.read_current(spark, root)
    versions.write_version(v.filter("id > 0"), root)  # rewrite from the current version
    assert versions.current_version(spark, root) == 2 and versions.read_current(spark, root).count() == 2
    versions.write_version(versions.read_current(spark, root).filter("id > 1"), root)
    assert versions.vacuum(spark, root, keep=2) == [1]
    assert versions.read_current(spark, root).count() == 1


def test_tables_exist_and_reset(spark, tmp_root):
    files.reset_tables(spark, tmp_root, ["supply.fact_shipments", "supply.dim_time"])
    files.assert_tables(spark, tmp_root, ["supply.fact_shipments", "supply.dim_time"])
    assert spark.read.parquet(f"{tmp_root}/supply.fact_shipments").count() == 0
    with pytest.raises(AssertionError):
        files.assert_tables(spark, tmp_root, ["supply.dim_orders"])


def test_yoy_gap_year_and_zero_previous(spark):
    fact = spark.createDataFrame(
        [(1, 20200101, Decimal("0")), (1, 20210101, Decimal("50")), (1, 20230101, Decimal("75"))],
        "supplier_id long, date_id int, shipment_value decimal(12,2)")
    sup = spark.createDataFrame([(1, "S")], "supplier_id long, supplier_name string")
    t = spark.createDataFrame([(20200101, 2020), (20210101, 2021), (20230101, 2023)], "date_id int, year int")
    rows = SR.supplier_yoy(fact, sup, t).collect()
    assert [r["year"] for r in rows] == [2020, 2021, 2023]
    assert rows[0]["previous_year_value"] is None and rows[1]["percentage_change"] is None
    assert rows[2]["previous_year_value"] == Decimal("50.00") and rows[2]["percentage_change"] == 50.0


def test_value_consistency(spark):
    prod = spark.createDataFrame([(1, Decimal("2.50"))], "product_id long, unit_price decimal(10,2)")
    good = spark.createDataFrame([(1, 3, Decimal("7.50"))], "product_id long, quantity int, shipment_value decimal(12,2)")
    bad = spark.createDataFrame([(1, 3, Decimal("7.60"))], "product_id long, quantity int, shipment_value decimal(12,2)")
    assert J.value_mismatch(good, prod).count() == 0
    assert J.value_mismatch(bad, prod).count() == 1


def test_salted_lookup_matches_plain_join(spark):
    facts = spark.range(0, 2000).select(
        F.when(F.col("id") % 3 == 0, F.lit("UNKNOWN")).otherwise(F.concat(F.lit("c"), (F.col("id") % 50).cast("string"))).alias("nk"),
        F.col("id"))
    dim = spark.range(0, 40).select(F.concat(F.lit("c"), F.col("id").cast("string")).alias("nk"),
                                    (F.col("id") + 100).alias("sk")) \
        .unionByName(spark.createDataFrame([("UNKNOWN", 1)], "nk string, sk long"))
    salted = J.resolve_keys(facts, dim, "nk", "sk", hot_values=["UNKNOWN"], buckets=16)
    plain = J.resolve_keys(facts, dim, "nk", "sk")
    assert sorted(map(tuple, salted.collect())) == sorted(map(tuple, plain.collect()))
    assert salted.filter("sk is null").count() == 2000 // 3 * 0 + plain.filter("sk is null").count()


def test_missing_dimension_key_is_kept_and_reported(spark):
    facts = spark.createDataFrame([("A", 1), ("Z", 2)], "stock_code string, q int")
    dim = spark.createDataFrame([("A", 10)], "stock_code string, product_id long")
    resolved = J.resolve_keys(facts, dim, "stock_code", "product_id")
    assert resolved.count() == 2 and resolved.filter("product_id is null").count() == 1
    rep = J.unresolved_keys(resolved, {"dim_products": ("product_id", "stock_code")}).first()
    assert (rep["unresolved_rows"], rep["unresolved_keys"]) == (1, 1)


def test_dead_and_refused_attempts_never_become_current(spark, tmp_root):
    root = f"{tmp_root}/t"
    assert versions.write_version(spark.range(3), root) == 1
    v, path = versions.claim_version(spark, root)     # a writer that dies after its write
    spark.range(100).write.parquet(path)
    assert v == 2 and versions.current_version(spark, root) == 1

    def refuse(df):
        raise ValueError("no")
    with pytest.raises(ValueError, match="no"):
        versions.write_version(spark.range(7), root, check=refuse)
    assert versions.read_current(spark, root).count() == 3
    assert versions.write_version(spark.range(5), root, batch_id="b9") == 4
    assert versions.read_current(spark, root).count() == 5
    assert versions.committed_batches(spark, root) == {"b9": 4}
    assert versions.vacuum(spark, root, keep=1) == [1, 2, 3]
    assert versions.committed_batches(spark, root) == {"b9": 4}


def test_two_writers_never_share_a_version(spark, tmp_root):
    from starmart.session import run_concurrently
    root, got = f"{tmp_root}/t", []
    run_concurrently([lambda n=n: got.append(versions.write_version(spark.range(n + 1), root)) for n in range(4)])
    assert sorted(got) == [1, 2, 3, 4]
    with pytest.raises(RuntimeError):
        versions.commit_version(spark, root, 2)


def test_absent_version_reads_as_the_declared_table(spark, tmp_root):
    t = versions.read_current(spark, f"{tmp_root}/none", "gold.dim_products")
    assert t.count() == 0 and "stock_code" in t.columns
    with pytest.raises(FileNotFoundError):
        versions.read_current(spark, f"{tmp_root}/none")


def test_csv_header_decides_the_columns(spark, tmp_root):
    path = f"{tmp_root}/in.csv"
    head = "Stock Code,Till,InvoiceNo,Description,UnitPrice,Quantity,CustomerID,InvoiceDate,Country\n"
    with open(path, "w", encoding="latin-1") as fh:
        fh.write(head.replace("Stock Code", "StockCode") + 'A1,9,536365,"HOOK ""BIG"" 5, blue",2.55,6.0,17850,2010-12-01,France\n')
    row = files.to_bronze_types(files.standardise_columns(files.read_raw_csv(spark, path))).first()
    assert (row.invoice_no, row.stock_code, row.description, row.quantity) == ("536365", "A1", 'HOOK "BIG" 5, blue', 6)
    for bad in ("A1,9,1,d,1,6.5,1,2010-12-01,F\n", "A1,9,1,d,1,many,1,2010-12-01,F\n"):
        with open(path, "w") as fh:
            fh.write(head.replace("Stock Code", "StockCode") + bad)
        with pytest.raises(Exception, match="whole number"):
            files.to_bronze_types(files.standardise_columns(files.read_raw_csv(spark, path))).collect()
    with open(path, "w") as fh:
        fh.write("InvoiceNo,StockCode\n1,A\n")
    with pytest.raises(ValueError, match="lacks"):
        files.read_raw_csv(spark, path)
    with open(path, "w") as fh:
        fh.write(head.replace("Stock Code", "StockCode") + "A1,9,1\n")
    with pytest.raises(Exception):
        files.read_raw_csv(spark, path).collect()


def test_csv_line_break_in_a_field(spark, tmp_root):
    path = f"{tmp_root}/in.csv"
    with open(path, "w") as fh:
        fh.write('InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\n'
                 '1,A,"two\nlines ""q""",6,2010-12-01,2.55,1,France\n2,B,x,1,2010-12-01,1,2,UK\n')
    rows = files.read_raw_csv(spark, path, multi_line=True).orderBy("InvoiceNo").collect()
    assert [r.Description for r in rows] == ['two\nlines "q"', "x"]


def test_replace_is_whole_under_dynamic_overwrite(spark, tmp_root):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "v int, p string")
    files.write_replace(df, f"{tmp_root}/t", ["p"])
    files.write_replace(df.where("v = 1"), f"{tmp_root}/t", ["p"])
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "dynamic"
    assert spark.read.parquet(f"{tmp_root}/t").count() == 1


def test_absent_snapshot_day_is_an_error(spark, tmp_root):
    snapshots.snapshot(spark.range(3), f"{tmp_root}/arc", "2026-02-22")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        snapshots.read_snapshot(spark, f"{tmp_root}/arc", "2026-02-23")


def test_year_layout_writes_few_files(spark, tmp_root):
    df = spark.range(0, 4000, 1, 40).select((F.lit(19970000) + (F.col("id") % 3) * 10000 + 101).cast("int").alias("date_id"), "id")
    layout.write_fact_by_year(df, f"{tmp_root}/f")
    n = sum(f.endswith(".parquet") for _, _, fs in os.walk(f"{tmp_root}/f") for f in fs)
    assert n <= 6 and spark.read.parquet(f"{tmp_root}/f").count() == 4000


def test_constraints_name_every_broken_rule(spark):
    good = spark.createDataFrame([(1, "A", "x"), (2, "B", None)], "product_id long, stock_code string, description string")
    Q.require_constraints(good, "gold.dim_products")
    bad = good.unionByName(spark.createDataFrame([(None, "A", "y" * 300)], good.schema))
    with pytest.raises(Q.ConstraintError, match="product_id not null .1 rows.*description length.*unique .stock_code"):
        Q.require_constraints(bad, "gold.dim_products")


def test_orphans_of_several_keys_in_one_pass(spark):
    child = spark.createDataFrame([(1, 10), (2, None), (9, 99), (None, 10)], "a long, b long")
    pa, pb = spark.createDataFrame([(1,), (2,)], "a long"), spark.createDataFrame([(10,)], "b long")
    rep = J.fk_report([("c.a", child, "a", pa, "a"), ("c.b", child, "b", pb, "b")])
    assert {r.foreign_key: r.orphan_rows for r in rep.collect()} == {"c.a": 1, "c.b": 1}
    assert J.orphans(child, "a", pa, "a").count() == 1


def test_profile_approximate_close_to_exact(spark):
    df = spark.range(0, 5000).select((F.col("id") % 700).alias("k"), F.lit(None).cast("string").alias("n"))
    approx = {r["column_name"]: r for r in Q.profile(df, exact=False).collect()}
    assert abs(approx["k"]["distinct_count"] - 700) <= 35 and approx["n"]["null_count"] == 5000


def test_year_layout_dynamic_overwrite_replaces_only_given_years(spark, tmp_root):
    path = f"{tmp_root}/fact"
    first = spark.createDataFrame([(20100105, 1), (20110105, 2)], "date_id int, v int")
    layout.write_fact_by_year(first, path)
    layout.write_fact_by_year(spark.createDataFrame([(20110106, 3)], "date_id int, v int"), path)
    assert sorted(r["v"] for r in spark.read.parquet(path).collect()) == [1, 3]


def test_audit_stamp_defaults(spark):
    from starmart.operators import changes as U
    a = spark.createDataFrame([(1, "UPDATE")], "shipment_id long, operation string")
    row = U.stamp_audit(a).first()
    assert row["changed_by"] and row["changed_at"] is not None


def test_create_tables_is_idempotent(spark, tmp_root):
    from starmart import schemas
    created = files.create_tables(spark, tmp_root)
    assert sorted(created) == sorted(schemas.SCHEMAS)
    assert files.create_tables(spark, tmp_root) == []
    t = spark.read.parquet(f"{tmp_root}/supply.fact_shipments")
    assert t.count() == 0 and t.columns == schemas.FACT_SHIPMENTS.fieldNames()


def test_observed_counts_come_with_the_action(spark, tmp_root):
    df, obs = Q.observed(spark.range(10), "ten", evens=F.sum((F.col("id") % 2 == 0).cast("int")))
    df.write.parquet(f"{tmp_root}/x")
    assert obs.get == {"rows": 10, "evens": 5}
