"""Shapes that larger tables need: no single writer, no source computed twice."""

import os
import time

import pytest
from pyspark.sql import functions as F

from starmart import session
from starmart.operators import slices
from starmart.plans import retail_job as RP
from starmart.sources import files, versions
from starmart.sources import testbed as TB

RAW = "InvoiceNo string, StockCode string, Description string, Quantity string, InvoiceDate string, UnitPrice string, CustomerID string, Country string"


def feed(spark, lines):
    """A feed of own rows; ``lines`` gives (order, part, quantity)."""
    return spark.createDataFrame([(str(o), f"P{p}", f" thing {p} ", str(q), "1996-01-0%d" % (1 + o % 9), "2.50", str(o % 5), "NATION_1") for o, p, q in lines], RAW)


def test_every_file_of_a_feed_with_bad_records_has_the_header(spark, tmp_root):
    raw = feed(spark, [(o, o % 7, 40 + o % 11) for o in range(110)]).repartition(4)
    TB.write_lines(TB.feed_with_bad_records(raw), f"{tmp_root}/landing")
    parts = [f for f in os.listdir(f"{tmp_root}/landing") if f.startswith("part-")]
    assert len(parts) == 4                       # each task writes its own rows
    for f in parts:
        with open(f"{tmp_root}/landing/{f}") as fh:
            assert fh.readline() == "InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\n"
    got = RP.ingest(spark, f"{tmp_root}/landing", tmp_root, "b", run_date="2026-02-22", in_place=True, tolerate_rejects=0.6)
    assert got == {"records": 110, "rejected": 50}
    reasons = RP.rejects(spark, tmp_root).groupBy(F.split("reason", ":")[0].alias("r")).count().collect()
    assert {r["r"]: r["count"] for r in reasons} == {"too few fields": 10, "too many fields": 10, "price is no number": 10, "quantity is no whole number": 20}


def tables(spark, path, orders=40, lines=3):
    """Driver tables of own rows: every order has ``lines`` lines."""
    put = lambda name, rows, schema: spark.createDataFrame(rows, schema).write.parquet(f"{path}/{name}.parquet")
    put("nation", [(0, "A", 0), (1, "B", 0)], "n_nationkey int, n_name string, n_regionkey int")
    put("customer", [(c, c % 2) for c in range(10)], "c_custkey long, c_nationkey int")
    put("orders", [(o, o % 10) for o in range(orders)], "o_orderkey long, o_custkey long")
    put("part", [(p, f"thing {p}", 1.5 + p) for p in range(20)], "p_partkey long, p_name string, p_retailprice double")
    put("lineitem", [(o, (o * 7 + n) % 20, 1.0 + n, "R" if o % 9 == 0 else "N", f"199{o % 9}-03-01") for o in range(orders) for n in range(lines)],
        "l_orderkey long, l_partkey long, l_quantity double, l_returnflag string, l_shipdate string")
    return path


def test_a_star_cleans_its_source_once(spark, tmp_root):
    from starmart.plans.queries import retail_silver, retail_star
    from starmart.plans import retail as R
    sf = tables(spark, f"{tmp_root}/sf")
    fact = retail_star(spark, sf).fact_sales
    assert "lineitem" not in fact._jdf.queryExecution().toString()        # a scan of the stored cleaned rows
    lazy = R.build_star(*retail_silver(spark, sf)).fact_sales
    assert sorted(map(str, fact.collect())) == sorted(map(str, lazy.collect())) and fact.count() > 0


def test_a_report_carries_only_its_own_columns_through_the_key_joins(spark, tmp_root):
    from starmart.plans.queries import retail_star
    s = retail_star(spark, tables(spark, f"{tmp_root}/sf"))
    df = s.fact_sales.groupBy("product_id").agg(F.sum("total_value"))
    text = df._jdf.queryExecution().optimizedPlan().toString()
    top = text[:text.index("xxhash64")]                                   # above the salt
    assert "invoice_no" not in top and "unit_price" not in top


def test_partitions_of_the_wide_rows_are_not_merged(spark, tmp_root):
    """Memory of a task follows its rows, not the size of the narrow rows they are built of."""
    df = TB.raw_source(spark, tables(spark, f"{tmp_root}/sf"))
    text = df._jdf.queryExecution().executedPlan().toString()
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert text.count("REPARTITION_BY_NUM") == 2 and f", {n}), REPARTITION_BY_NUM" in text


def test_audit_finds_the_touched_rows_once(spark, tmp_root):
    from starmart.operators import changes as U
    fact = spark.createDataFrame([(i, i * 1.0, 10) for i in range(30)], "shipment_id long, shipment_value double, shipping_time_hours int") \
        .selectExpr("shipment_id", "cast(shipment_value as decimal(12,2)) shipment_value", "shipping_time_hours")
    fact.write.parquet(f"{tmp_root}/fact")
    fact = spark.read.parquet(f"{tmp_root}/fact")
    adj = spark.createDataFrame([(1, 2, 1), (2, 3, 1)], "shipment_id long, added_hours int, seq int")
    upd = spark.createDataFrame([(2, 7, 1), (2, 9, 2), (99, 1, 1)], "shipment_id long, new_value int, seq int")
    dele = spark.createDataFrame([(2, 1), (5, 1)], "shipment_id long, seq int")
    table = U.staged(U.change_table(adj, upd, dele, "decimal(12,2)"), f"{tmp_root}/changes")
    needs = U.OrderNeeds.of(table)
    lazy = U.audit_batch(fact, table, needs, adj, upd, dele)
    once = U.audit_batch(fact, table, needs, adj, upd, dele, stage=f"{tmp_root}/touched")
    assert sorted(map(str, once.collect())) == sorted(map(str, lazy.collect())) and once.count() == 6
    assert spark.read.parquet(f"{tmp_root}/touched").count() == 3
    assert f"{tmp_root}/fact" not in str(once.inputFiles()) and f"{tmp_root}/fact" in str(lazy.inputFiles())


def test_a_compressed_feed_loads_the_same(spark, tmp_root):
    from starmart.sources import files
    raw = feed(spark, [(o, o % 7, 1 + o % 11) for o in range(50)]).repartition(3)
    files.write_csv(raw, f"{tmp_root}/plain")
    files.write_csv(raw, f"{tmp_root}/gz", compression="gzip")
    assert sum(f.endswith(".csv.gz") for f in os.listdir(f"{tmp_root}/gz")) == 3
    rows = lambda p: sorted(map(str, files.read_raw_csv(spark, p).collect()))
    assert rows(f"{tmp_root}/gz") == rows(f"{tmp_root}/plain") and len(rows(f"{tmp_root}/gz")) == 50


def full_tables(spark, path, orders=60, lines=3):
    """Driver tables of own rows with the columns of both stars."""
    put = lambda name, rows, schema: spark.createDataFrame(rows, schema).write.parquet(f"{path}/{name}.parquet")
    put("region", [(0, "R")], "r_regionkey int, r_name string")
    put("nation", [(n, f"N{n}", 0) for n in range(25)], "n_nationkey int, n_name string, n_regionkey int")
    put("customer", [(c, c % 25) for c in range(10)], "c_custkey long, c_nationkey int")
    put("supplier", [(s, f"S{s}", s % 25) for s in range(8)], "s_suppkey long, s_name string, s_nationkey int")
    put("orders", [(o, o % 10, "F", "1996-01-02", "1-HIGH") for o in range(orders)],
        "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate string, o_orderpriority string")
    put("part", [(p, f"thing {p}", "T", 1.5 + p) for p in range(20)], "p_partkey long, p_name string, p_type string, p_retailprice double")
    put("lineitem", [(o, (o * 7 + n) % 20, o % 8, n, 1.0 + n * 11, 9.5 + o, 0.0, 0.0, "R" if o % 9 == 0 else "N", "O", f"199{o % 9}-03-0{1 + n}")
                     for o in range(orders) for n in range(lines)],
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, "
        "l_tax double, l_returnflag string, l_linestatus string, l_shipdate string")
    return path


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted(map(str, df.collect()))


def test_members_of_a_star_are_aggregated_once(spark, tmp_root):
    """ranges, keys and checks of the members read stored rows, not the cleaned ones."""
    from starmart.operators import clean as C
    from starmart.plans.queries import retail_silver, staged_silver
    sf = tables(spark, f"{tmp_root}/sf")
    staged, lazy = staged_silver(spark, sf), retail_silver(spark, sf)
    assert [rows(df) for df in staged] == [rows(df) for df in lazy] and staged[1].count() > 0
    assert all("Aggregate" not in plan(df) for df in staged)
    first = plan(C.first_per_key(staged[0], "stock_code", ["quantity"]))
    partial = first[first.index("partial_min("):].split("\n")[0]
    assert "stock_code" not in partial[:partial.index("))")]              # the key is no part of the sorted struct


def test_stripping_without_the_expression_gives_its_result(spark):
    """the short way gives what the expression gives, on every kind of edge."""
    from starmart.functions import text
    edges = ["", " ", "  ", "\t", " ", "　 ", "\x1c", "\n", "\u0000", "\x7f", "é", "~", "!", "\U0001f600", "​", "   "]
    df = spark.createDataFrame([(a + m + b,) for a in edges for m in ("", "x", "a  b", "é \t z") for b in edges] + [(None,)], "s string")
    got = df.select("s", text.strip_unicode("s").alias("a"), F.regexp_replace("s", text._EDGE_BLANKS, "").alias("b"))
    assert got.where("not a <=> b").count() == 0
    assert "regexp_replace" in plan(got.select("a")) and "substring" in plan(got.select("a"))


def test_fields_with_a_point_are_typed_as_before(spark):
    import pytest
    from starmart.sources import files
    row = lambda q, c: ("1", "P1", "d", q, "1996-01-02", "2.505", c, "N")
    schema = "invoice_no string, stock_code string, description string, quantity string, invoice_date string, unit_price string, customer_id string, country string"
    df = spark.createDataFrame([row(q, c) for q, c in (("6", "17850.0"), ("6.0", "17850.00"), ("-6.", "178"), (" 7 ", "A.0"), ("+8.000", "1.05"), (None, None))], schema)
    got = files.to_bronze_types(df).collect()
    assert [r.quantity for r in got] == [6, 6, -6, 7, 8, None]
    assert [r.customer_id for r in got] == ["17850", "17850", "178", "A.0", "1.05", None]
    for bad in ("6.5", "many", "", "99999999999"):
        with pytest.raises(Exception, match="quantity is no whole number"):
            files.to_bronze_types(spark.createDataFrame([row(bad, "1")], schema)).collect()


def test_planted_copies_are_read_in_one_pass(spark, tmp_root):
    """the ids of the shipments are computed once, and the copies are those of a union."""
    from starmart.plans import queries as Q
    df = spark.createDataFrame([(i,) for i in [*range(10), None]], "k int")
    assert rows(TB.with_copies(df, F.col("k") % 3 == 0)) == rows(df.unionByName(df.where("k % 3 = 0")))
    found = Q.q_declared_keys(spark, full_tables(spark, f"{tmp_root}/sf"))
    assert plan(found).count("md5(") == 1
    got = {(r.table_name, r.key_columns): (r.duplicated_keys, r.rows_involved) for r in found.collect()}
    assert got["gold.dim_products", "product_id"] == (0, 0) and got["supply.dim_products", "sku"] == (1, 2)    # product 0


def test_foreign_keys_move_counts_not_rows(spark):
    """no child row meets a join, and a hot value is a count a task."""
    from starmart.operators import joins as J
    child = spark.range(0, 4000, 1, 4).select(F.when(F.col("id") % 4 > 0, 7).otherwise(F.col("id") % 10).cast("int").alias("a"),
                                              F.when(F.col("id") % 5 > 0, F.col("id")).alias("b"))
    pa, pb = spark.range(0, 7, 1, 2).toDF("a"), spark.range(0, 3000, 1, 2).toDF("b")
    checks = [("a", child, "a", pa, "a"), ("b", child, "b", pb, "b")]
    rep = J.fk_report(checks)
    assert "Join" not in plan(rep) and "Expand" not in plan(rep)
    assert rows(rep) == rows(J._fk_by_join(checks)) == ["Row(foreign_key='a', orphan_rows=3200)", "Row(foreign_key='b', orphan_rows=800)"]


def test_repeated_parent_keys_count_as_in_a_join(spark):
    from starmart.operators import joins as J
    child = spark.createDataFrame([(1, 10), (1, 99), (2, None), (9, 10), (9, 99), (None, 10)], "a int, b long")
    pa = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "a long")
    pb = spark.createDataFrame([(10,), (10,), (10,)], "b long")
    checks = [("a", child, "a", pa, "a"), ("b", child, "b", pb, "b")]
    assert rows(J.fk_report(checks)) == rows(J._fk_by_join(checks)) == ["Row(foreign_key='a', orphan_rows=4)", "Row(foreign_key='b', orphan_rows=3)"]
    text = [("s", spark.createDataFrame([("x",), ("y",), (None,)], "s string"), "s", spark.createDataFrame([("x",)], "s string"), "s")]
    assert rows(J.fk_report(text)) == ["Row(foreign_key='s', orphan_rows=1)"]


def test_bronze_rules_are_counted_where_its_rows_are_read(spark, tmp_root):
    """F8: the source of Bronze is joined once; the counts are those of a pass of its own."""
    from starmart.operators import quality as QC
    from starmart.plans import queries as Q
    sf = full_tables(spark, f"{tmp_root}/sf")
    found = Q.q_row_rule_violations(spark, sf)
    assert "REPARTITION_BY_NUM" not in plan(found)                          # no join of the source
    planted = TB.bronze_with_long_text(TB.bronze(spark, sf))
    own = QC.check_rows(planted, QC.table_rules("bronze.raw_transactions", planted.columns), "bronze.raw_transactions")
    assert rows(found.where("table_name = 'bronze.raw_transactions'")) == rows(own) and own.where("violations > 0").count() > 0


def shuffle_files(spark):
    dirs = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {f for d in dirs for _, _, names in os.walk(d.getPath()) for f in names if f.startswith("shuffle_") and f.endswith(".data")}


def test_a_job_leaves_no_shuffle_files(spark, tmp_root):
    """Those of its steps would add up on the disk until the driver collects its garbage."""
    files.write_csv(feed(spark, [(o, o % 7, 1 + o % 5) for o in range(200)]).repartition(3), f"{tmp_root}/csv")
    held, before = spark.conf.get(session._DROP_SHUFFLES), shuffle_files(spark)
    RP.run_retail(spark, f"{tmp_root}/csv", f"{tmp_root}/wh", "2026-02-22", "b")
    end = time.time() + 20                                                # removed by a message to the executors
    while shuffle_files(spark) - before and time.time() < end:
        time.sleep(0.2)
    assert not shuffle_files(spark) - before
    assert spark.conf.get(session._DROP_SHUFFLES) == held


def test_a_job_in_slices_gives_the_rows_and_counts_of_one_run(spark, tmp_root, monkeypatch):
    """Copies meet in their slice, slices without rows are left out, keys do not repeat."""
    lines = [(o, p, 1 + o % 5) for o in range(60) for p in range(2)]
    raw = feed(spark, lines + lines[:50] + [(7, 3, 2)] * 40)
    few = feed(spark, [(1, 1, 2)] * 9 + [(2, 1, 3)])
    for name, df in (("many", raw), ("few", few)):
        files.write_csv(df.repartition(4), f"{tmp_root}/{name}")
        seen = {}
        for size in (1 << 40, 1):
            monkeypatch.setattr(slices, "SLICE_BYTES", size)
            wh = f"{tmp_root}/wh-{name}-{size}"
            out = RP.run_retail(spark, f"{tmp_root}/{name}", wh, "2026-02-22", "b")
            p = RP.paths(wh)
            fact = versions.read_current(spark, p["fact_sales"])
            assert fact.select("sales_id").distinct().count() == fact.count() > 0
            assert fact.select("load_timestamp").distinct().count() == 1
            assert versions.latest(spark, p["fact_sales"]).info["rows"] == str(fact.count())
            silver = [sorted(map(str, spark.read.parquet(p[t]).collect())) for t in ("silver_tx", "silver_products", "silver_customers")]
            seen[size] = out, silver, sorted(map(str, fact.drop("sales_id", "load_timestamp").collect()))
            if size == 1 and name == "many":
                assert fact.agg(F.max("sales_id")).first()[0] >= RP.SLICE_IDS
        assert seen[1] == seen[1 << 40]


def test_a_feed_in_slices_has_the_rows_of_the_whole(spark, tmp_root, monkeypatch):
    sf = tables(spark, f"{tmp_root}/sf", orders=97 + 3)
    monkeypatch.setattr(slices, "SLICE_BYTES", 1)
    parts = TB.raw_slices(spark, sf)
    assert len(parts) == TB.FEED_SLICES
    for i, part in enumerate(parts):
        files.write_csv(part, f"{tmp_root}/csv", append=i > 0)
    got = sorted(map(str, files.read_raw_csv(spark, f"{tmp_root}/csv").collect()))
    files.write_csv(TB.raw_source(spark, sf), f"{tmp_root}/whole")
    assert got == sorted(map(str, files.read_raw_csv(spark, f"{tmp_root}/whole").collect())) and len(got) > 300


def test_broken_rules_are_counted_over_all_slices(spark):
    from starmart.operators import quality as Q
    from starmart.schemas import SCHEMAS
    rows = spark.createDataFrame([(1, None, 10), (2, 5, 10), (3, None, 10)], "sales_id long, quantity int, date_id int")
    df = rows.select(*[(F.col(f.name) if f.name in rows.columns else F.lit("1999-01-01" if f.name == "load_timestamp" else "1")).cast(f.dataType).alias(f.name) for f in SCHEMAS["gold.fact_sales"].fields])
    rules = Q.ObservedRules(df.where("sales_id < 3"), "gold.fact_sales")
    rules.rows.collect()
    rules.over(df.where("sales_id = 3")).collect()
    with pytest.raises(Q.ConstraintError, match="2 rows"):
        rules.check()
