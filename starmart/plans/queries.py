"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator/report.

Every query reads the driver tables under ``sf_dir`` in full. Money aggregates are
returned as DOUBLE (the cross-engine comparison type); the library functions themselves
keep exact decimals. Queries of written tables (CSV, snapshots, layouts, the jobs) run
their writes in the shared folder when they are called; the others are lazy.
"""

from __future__ import annotations

import functools
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart import schemas
from starmart.functions.money import shipment_value
from starmart.operators import changes as U
from starmart.operators import clean as C
from starmart.operators import dims as D
from starmart.operators import joins as J
from starmart.operators import quality as QC
from starmart.plans import retail as R
from starmart.plans import retail_job as RP
from starmart.plans import run_log
from starmart.plans import supply as SR
from starmart.plans import supply_job as SP
from starmart.session import scratch_path, shuffles_dropped
from starmart.sources import files, keyed, layout, snapshots, versions
from starmart.sources import testbed as TB

# Fixed values of the registered scenarios.
STALE_BEFORE = 19980101          # dims "as of" an earlier load: rows before this date key
SNAPSHOT_DAY = "2026-02-22"
SNAPSHOT_NEXT_DAY = "2026-02-23"
RANGE_LO, RANGE_HI = 19970101, 19981231
SIGNIFICANT_PCT = 10.0
FIRST_LOAD_BEFORE = 19950301     # dims "as of" the first weeks: most keys are still unknown
CHANGED_YEAR = 1995
JOB_EARLY_BEFORE = "1995-06-01"
STAMP_TIME, STAMP_ID = datetime(2026, 2, 22, 3, 4, 5), "7b0c6c1e-9f0e-4b63-9d1c-2f8d51a3c001"
# members retired from each dimension: keys divisible by
RETIRED_MOD = {"customer_id": 23, "product_id": 19, "date_id": 29, "supplier_id": 7, "warehouse_id": 11, "order_id": 31}


def as_double(df: DataFrame) -> DataFrame:
    """Cast decimal columns to double for comparison with the SQL oracle."""
    return df.select(*[F.col(f.name).cast("double").alias(f.name)
                       if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
                       for f in df.schema.fields])


def retail_silver(spark: SparkSession, sf_dir: str):
    cleaned = C.clean(TB.bronze(spark, sf_dir))
    return C.silver_transactions(cleaned), C.silver_products(cleaned), C.silver_customers(cleaned)


def staged_cleaned(spark: SparkSession, sf_dir: str, bronze: DataFrame | None = None) -> DataFrame:
    """The cleaned rows, cleaned and written once, for what reads them several times."""
    rows = TB.bronze(spark, sf_dir) if bronze is None else bronze
    return C.stage_cleaned(C.clean(rows), scratch_path(spark, "cleaned"))


def staged_silver(spark: SparkSession, sf_dir: str, bronze: DataFrame | None = None):
    """The Silver tables over stored cleaned rows; products and customers are stored too."""
    cleaned = staged_cleaned(spark, sf_dir, bronze)
    members = [C.stage_members(df, scratch_path(spark, name)) for name, df in
               (("products", C.silver_products(cleaned)), ("customers", C.silver_customers(cleaned)))]
    return C.silver_transactions(cleaned), *members


def retail_star(spark: SparkSession, sf_dir: str) -> R.RetailStar:
    return R.build_star(*staged_silver(spark, sf_dir))


def q_top_products(spark, sf_dir):
    s = retail_star(spark, sf_dir)
    return as_double(R.top_products(s.fact_sales, s.dim_products))


def q_monthly_revenue(spark, sf_dir):
    s = retail_star(spark, sf_dir)
    return as_double(R.monthly_revenue(s.fact_sales, s.dim_date))


def q_revenue_by_country(spark, sf_dir):
    s = retail_star(spark, sf_dir)
    return as_double(R.revenue_by_country(s.fact_sales, s.dim_customers))


def q_top_customers(spark, sf_dir):
    s = retail_star(spark, sf_dir)
    return as_double(R.top_customers(s.fact_sales, s.dim_customers))


def q_sales_vs_returns(spark, sf_dir):
    s = retail_star(spark, sf_dir)
    return as_double(R.sales_vs_returns(s.fact_sales))



# --- retail: cleaning steps ---------------------------------------------------------------

def _stage(name):
    def q(spark, sf_dir):
        return as_double(C.clean_stages(TB.bronze(spark, sf_dir))[name])
    q.__name__ = f"q_{name}"
    return q


def q_raw_standardised(spark, sf_dir):
    """S1+S2: the feed written as a latin-1 CSV, read back with the pandas NA tokens,
    names standardised, Bronze types applied."""
    path = scratch_path(spark, "landing-csv")
    files.write_csv(TB.raw_source(spark, sf_dir), path)
    raw = files.read_raw_csv(spark, path)
    return as_double(files.to_bronze_types(files.standardise_columns(raw)))


def q_csv_quoted_reordered(spark, sf_dir):
    """S1+S2: a file whose columns stand in another order, with one more column, and whose
    descriptions hold quotes and commas."""
    raw = TB.raw_source(spark, sf_dir).withColumn(
        "Description", F.concat(F.col("Description"), F.lit('"BIG", size '), F.col("Quantity"), F.lit(',"x"')))
    path = scratch_path(spark, "landing-csv")
    files.write_csv(raw.select("Country", "Description", F.lit("till 7").alias("Register"), "StockCode", "InvoiceNo",
                               "CustomerID", "UnitPrice", "InvoiceDate", "Quantity"), path)
    return as_double(files.to_bronze_types(files.standardise_columns(files.read_raw_csv(spark, path))))


def q_rejected_records(spark, sf_dir):
    """Short and long records and unreadable values planted in the feed; each is set
    aside with its line and reason, the others are loaded."""
    root = scratch_path(spark, "rejects")
    TB.write_lines(TB.feed_with_bad_records(TB.raw_source(spark, sf_dir)), f"{root}/landing")
    RP.ingest(spark, f"{root}/landing", root, "batch-1", STAMP_TIME, SNAPSHOT_DAY, in_place=True, tolerate_rejects=0.2)
    loaded = RP.bronze(spark, root, SNAPSHOT_DAY, in_place=True)
    return (RP.rejects(spark, root).select("line", "reason", F.lit(1).alias("records"))
            .unionByName(loaded.select(F.lit(None).cast("string").alias("line"), F.lit("loaded").alias("reason"), F.lit(1).alias("records")))
            .groupBy("line", "reason").agg(F.sum("records").alias("records")))


def q_profile_by_day(spark, sf_dir):
    """Q7 from the stored sketches of three days, held against the exact profile: counts
    are equal, distinct counts within 4 %, quantiles within 3 % of their rank."""
    root, rows = scratch_path(spark, "profile"), TB.bronze(spark, sf_dir)
    rows.write.parquet(f"{root}/rows")
    rows = spark.read.parquet(f"{root}/rows")
    for day in range(3):
        QC.profile_sketch(rows.where(F.pmod(F.xxhash64("invoice_no"), F.lit(3)) == day)).write.parquet(f"{root}/sketch/day={day}")
    found = QC.merged_profile(spark.read.parquet(f"{root}/sketch"))
    exact = QC.profile(rows).select("column_name", F.col("distinct_count").alias("exact"))
    numbers = rows.select(F.count_if(F.col("quantity") <= F.lit(0)).alias("_"), F.percentile_approx("quantity", [0.22, 0.28, 0.47, 0.53, 0.72, 0.78], 100000).alias("quantity"),
                          F.percentile_approx("unit_price", [0.22, 0.28, 0.47, 0.53, 0.72, 0.78], 100000).alias("unit_price")) \
        .selectExpr("stack(2, 'quantity', cast(quantity as array<double>), 'unit_price', cast(unit_price as array<double>)) as (column_name, _b)")
    near = F.abs(F.col("distinct_count") - F.col("exact")) <= 0.04 * F.col("exact")
    ranks = F.when(F.col("_b").isNotNull(), F.col("p25").between(F.col("_b")[0], F.col("_b")[1]) & F.col("p50").between(F.col("_b")[2], F.col("_b")[3])
                   & F.col("p75").between(F.col("_b")[4], F.col("_b")[5]))
    return (found.join(exact, "column_name").join(F.broadcast(numbers), "column_name", "left")
            .select("column_name", "row_count", "null_count", near.alias("distinct_within_bound"), ranks.alias("quantiles_within_bound")))


def q_unique_keys_by_day(spark, sf_dir):
    """Q2/K2: shipments appended by days with unique keys; the keys of the last day that
    earlier days hold."""
    path = scratch_path(spark, "keyed")
    fact = SP.fact_with_ids(spark, sf_dir)
    day = F.pmod(F.col("order_id"), F.lit(4))
    keyed.append_day(fact.where(day == 0), path, "shipment_id", "run_date", "2026-02-20")
    keyed.append_day(fact.where(day == 1), path, "shipment_id", "run_date", "2026-02-21")
    keyed.append_day(fact.where(day == 1).where("quantity > 10"), path, "shipment_id", "run_date", "2026-02-21")
    late = fact.where((day == 2) | (day == 0) & (F.col("order_id") % 10 == 0) | (day == 1) & (F.col("order_id") % 7 == 0))
    low, high = late.agg(F.min("shipment_id"), F.max("shipment_id")).first()
    return keyed.repeated_keys(late, path, "shipment_id", "run_date", "2026-02-22", low, high)


def q_batch_stamp(spark, sf_dir):
    """S3: one load timestamp and one batch id for every row of a run."""
    return as_double(files.stamp_batch(TB.bronze(spark, sf_dir), STAMP_TIME, STAMP_ID))


def q_fact_append(spark, sf_dir):
    """The fact appended on two days, the first of them run again."""
    path = scratch_path(spark, "fact-append")
    tx, _, _ = retail_silver(spark, sf_dir)
    tx = tx.where("quantity > 0")
    files.write_fact(tx, path, "append", SNAPSHOT_DAY)
    files.write_fact(tx.where("quantity > 10"), path, "append", SNAPSHOT_NEXT_DAY)
    files.write_fact(tx.where("quantity > 5"), path, "append", SNAPSHOT_DAY)
    return as_double(versions.read_current(spark, path))


def q_fact_append_rerun_empty(spark, sf_dir):
    """A day whose rerun brings no row is empty afterwards; the other day stays."""
    path = scratch_path(spark, "fact-append")
    tx, _, _ = retail_silver(spark, sf_dir)
    files.write_fact(tx, path, "append", SNAPSHOT_DAY)
    files.write_fact(tx.where("quantity > 10"), path, "append", SNAPSHOT_NEXT_DAY)
    files.write_fact(tx.where("quantity > 1000000"), path, "append", SNAPSHOT_DAY)
    return as_double(versions.read_current(spark, path))


# --- retail: the whole job ------------------------------------------------------------------

def _job(spark, feed, root, day):
    """One day's run of the job; ``feed`` is given in slices, which are written in turn."""
    csv = f"{root}/csv-{day}"
    with shuffles_dropped(spark):
        for i, part in enumerate(feed):
            files.write_csv(part, csv, compression="gzip", append=i > 0)
    return RP.run_retail(spark, csv, f"{root}/wh", day, f"batch-{day}")


def q_retail_job_fact(spark, sf_dir):
    """R1 from the CSV to the published fact."""
    root = scratch_path(spark, "retail-job")
    _job(spark, TB.raw_slices(spark, sf_dir), root, SNAPSHOT_DAY)
    fact = versions.read_current(spark, RP.paths(f"{root}/wh")["fact_sales"])
    return as_double(fact.drop("sales_id", "sale_year", "load_timestamp"))


def q_retail_job_counts(spark, sf_dir):
    """The step counts observed by the job itself."""
    root = scratch_path(spark, "retail-job")
    counts = _job(spark, TB.raw_slices(spark, sf_dir), root, SNAPSHOT_DAY)["cleaning"]
    return spark.createDataFrame([tuple(counts.values())], ", ".join(f"{k} long" for k in counts)) \
        .drop("after_dedup")


def q_retail_job_dims(spark, sf_dir):
    """R1 on two days: first the invoices before a date with other descriptions, then the
    whole feed. Members keep their keys and take the new descriptions; new ones follow."""
    root = scratch_path(spark, "retail-job")
    feed = TB.raw_slices(spark, sf_dir)
    early = [part.where(F.col("InvoiceDate") < JOB_EARLY_BEFORE).withColumn("Description", F.concat(F.lit("old "), "Description")) for part in feed]
    _job(spark, early, root, SNAPSHOT_DAY)
    _job(spark, feed, root, SNAPSHOT_NEXT_DAY)
    p = RP.paths(f"{root}/wh")
    products = versions.read_current(spark, p["dim_products"])
    customers = versions.read_current(spark, p["dim_customers"])
    return (products.select(F.lit("product").alias("dimension"), F.col("product_id").alias("key"),
                            F.col("stock_code").alias("natural_key"), F.col("description").alias("attribute"))
            .unionByName(customers.select(F.lit("customer").alias("dimension"), F.col("customer_id").alias("key"),
                                          F.col("raw_customer_id").alias("natural_key"), F.col("country").alias("attribute"))))


def q_run_log(spark, sf_dir):
    """What the log keeps of a run and of one that failed (an empty rerun of the day)."""
    root = scratch_path(spark, "retail-job")
    feed = TB.raw_slices(spark, sf_dir)
    _job(spark, feed, root, SNAPSHOT_DAY)
    empty = f"{root}/csv-empty"
    files.write_csv(feed[0].limit(0), empty)
    try:
        RP.run_retail(spark, empty, f"{root}/wh", SNAPSHOT_DAY, "rerun")
    except ValueError:
        pass                                        # recorded as FAILED
    return (run_log.runs(spark, f"{root}/wh").where("check_name <> 'cleaning.after_dedup'")
            .select("run_id", "job", "run_date", "outcome", "check_name", "value", "status", (F.col("runtime_seconds") > 0).alias("timed")))


def q_cleaning_report(spark, sf_dir):
    return C.cleaning_report(TB.bronze(spark, sf_dir))


def q_silver_products(spark, sf_dir):
    return C.silver_products(C.clean(TB.bronze(spark, sf_dir)))


def q_silver_customers(spark, sf_dir):
    return C.silver_customers(C.clean(TB.bronze(spark, sf_dir)))


def q_dim_date(spark, sf_dir):
    tx, _, _ = retail_silver(spark, sf_dir)
    return D.dim_date_from_facts(tx)


def q_surrogate_keys(spark, sf_dir):
    _, products, _ = retail_silver(spark, sf_dir)
    return R.dim_products(products)


def q_resolve_keys(spark, sf_dir):
    return as_double(retail_star(spark, sf_dir).fact_sales)


def q_resolve_keys_measured(spark, sf_dir):
    """J3 with the heavy keys of both columns measured, not declared."""
    tx, products, customers = staged_silver(spark, sf_dir)
    heavy = J.heavy_keys(tx, ["stock_code", "raw_customer_id"])
    return as_double(R.fact_sales(tx, R.dim_products(products), R.dim_customers(customers), heavy=heavy))


def q_heavy_keys(spark, sf_dir):
    """The keys that hold a fiftieth of the sales."""
    tx, _, _ = retail_silver(spark, sf_dir)
    return J.heavy_report(tx, ["stock_code", "raw_customer_id", "date_id"], 0.02)


def _stale_silver(spark, sf_dir):
    cleaned = C.clean(TB.bronze(spark, sf_dir))
    early = cleaned.filter(F.col("date_id") < STALE_BEFORE)
    return cleaned, C.silver_products(early), C.silver_customers(early)


def q_unresolved_keys(spark, sf_dir):
    """today's facts resolved against dimensions from a first, short load."""
    cleaned = C.clean(TB.bronze(spark, sf_dir))
    early = cleaned.filter(F.col("date_id") < FIRST_LOAD_BEFORE)
    sp, sc = C.silver_products(early), C.silver_customers(early)
    resolved = (C.silver_transactions(cleaned)
                .transform(lambda t: J.resolve_keys(t, R.dim_products(sp), "stock_code", "product_id"))
                .transform(lambda t: J.resolve_keys(t, R.dim_customers(sc), "raw_customer_id",
                                                    "customer_id", hot_values=[C.CUSTOMER_SENTINEL])))
    return J.unresolved_keys(resolved, {"dim_products": ("product_id", "stock_code"),
                                        "dim_customers": ("customer_id", "raw_customer_id")})


def q_upsert_ignore(spark, sf_dir):
    """Dates of an earlier load, then insert-if-absent of all dates."""
    tx, _, _ = retail_silver(spark, sf_dir)
    existing = D.dim_date_from_facts(tx.filter(F.col("date_id") < STALE_BEFORE))
    return U.upsert_ignore(existing, D.dim_date_from_facts(tx), "date_id")


def q_upsert_update(spark, sf_dir):
    """The product dimension of an earlier load merged with the product master
    (descriptions updated, keys kept, new products keyed after the current maximum)."""
    _, sp, _ = _stale_silver(spark, sf_dir)
    existing = R.dim_products(sp)
    master = TB.table(spark, sf_dir, "part", ["p_partkey", "p_name"]).select(
        F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("stock_code"),
        F.col("p_name").alias("description"))
    return U.upsert_update(existing, master, "stock_code", "product_id", ["description"])


def q_fk_orphans(spark, sf_dir):
    """J6/Q4 after some members of every dimension were retired."""
    r = retail_star(spark, sf_dir)
    s = SP.build_star(spark, sf_dir, with_ids=False)
    f = s.fact_shipments
    kept = lambda dim, key: dim.where(F.col(key) % RETIRED_MOD[key] != 0)
    return J.fk_report([
        ("fact_sales.customer_id", r.fact_sales, "customer_id", kept(r.dim_customers, "customer_id"), "customer_id"),
        ("fact_sales.product_id", r.fact_sales, "product_id", kept(r.dim_products, "product_id"), "product_id"),
        ("fact_sales.date_id", r.fact_sales, "date_id", kept(r.dim_date, "date_id"), "date_id"),
        ("fact_shipments.product_id", f, "product_id", kept(s.dim_products, "product_id"), "product_id"),
        ("fact_shipments.supplier_id", f, "supplier_id", kept(s.dim_suppliers, "supplier_id"), "supplier_id"),
        ("fact_shipments.warehouse_id", f, "warehouse_id", kept(s.dim_warehouses, "warehouse_id"), "warehouse_id"),
        ("fact_shipments.order_id", f, "order_id", kept(s.dim_orders, "order_id"), "order_id"),
        ("fact_shipments.date_id", f, "date_id", kept(s.dim_time, "date_id"), "date_id"),
    ])


def q_duplicate_keys(spark, sf_dir):
    """Q2 on the catalog's stated grain (invoice, product), which is not a key."""
    tx, _, _ = retail_silver(spark, sf_dir)
    return QC.check_unique(tx, ["invoice_no", "stock_code"])


def _ruled_tables(spark, sf_dir, bronze):
    """Every table with declared rules after ``bronze``, as the jobs build it; the shipment
    fact with planted breaks."""
    tx, products, customers = staged_silver(spark, sf_dir, bronze)
    r = R.build_star(tx, products, customers)
    s = SP.build_star(spark, sf_dir)
    return {
        "silver.products": products, "silver.customers": customers, "silver.transactions": tx,
        "gold.dim_customers": r.dim_customers, "gold.dim_products": r.dim_products, "gold.dim_date": r.dim_date,
        "gold.fact_sales": r.fact_sales,
        "supply.dim_time": s.dim_time, "supply.dim_products": s.dim_products, "supply.dim_suppliers": s.dim_suppliers,
        "supply.dim_warehouses": s.dim_warehouses, "supply.dim_orders": s.dim_orders,
        "supply.fact_shipments": TB.shipments_with_rule_breaks(s.fact_shipments),
    }


def _counted_bronze(spark, sf_dir):
    """Bronze rows for the tables built of them, and the rules of Bronze with planted breaks,
    counted by the job that reads the rows, so that their source is joined once."""
    bronze = TB.bronze(spark, sf_dir)
    columns = bronze.columns
    planted = TB.bronze_with_long_text(bronze.withColumns({f"_{c}": F.col(c) for c in columns}))
    counted = QC.ObservedRules(planted, "bronze.raw_transactions", columns)
    return counted.rows.select(*[F.col(f"_{c}").alias(c) for c in columns]), counted


def q_row_rule_violations(spark, sf_dir):
    """Q1: every NOT NULL, VARCHAR and CHECK rule of every table."""
    bronze, counted = _counted_bronze(spark, sf_dir)
    tables = _ruled_tables(spark, sf_dir, bronze)
    parts = [counted.report(spark)] + [QC.check_rows(df, rules, name) for name, df in tables.items()
                                       if (rules := QC.table_rules(name, df.columns))]
    return functools.reduce(DataFrame.unionByName, parts)


def q_declared_keys(spark, sf_dir):
    """Q2/K2: every PRIMARY KEY and UNIQUE column; some products, dates and shipments were
    loaded twice."""
    tables = _ruled_tables(spark, sf_dir, TB.bronze(spark, sf_dir))
    for name, key, n in (("supply.dim_products", "product_id", 31), ("gold.dim_date", "date_id", 17),
                         ("supply.fact_shipments", "shipment_id", 40), ("gold.dim_products", "product_id", 53)):
        tables[name] = TB.with_copies(tables[name], F.col(key) % n == 0)
    parts = [QC.declared_keys(tables[name], name) for name in schemas.KEYS if name in tables and name != "gold.fact_sales"]
    return functools.reduce(DataFrame.unionByName, parts)


def _layers(spark, sf_dir):
    tx, products, customers = staged_silver(spark, sf_dir)
    fact = R.fact_sales(tx, R.dim_products(products), R.dim_customers(customers))
    return QC.layer_counts(TB.bronze(spark, sf_dir), tx, fact)


def q_layer_counts(spark, sf_dir):
    return _layers(spark, sf_dir)


def q_layer_audit(spark, sf_dir):
    return QC.audit_layers(_layers(spark, sf_dir))


def q_table_profile(spark, sf_dir):
    path = scratch_path(spark, "profiled")
    TB.bronze(spark, sf_dir).write.parquet(path)   # every column is then a scan of its own
    return QC.profile(spark.read.parquet(path))


def q_snapshot_roundtrip(spark, sf_dir):
    """Two runs on one day and one on the next leave one copy per day."""
    path = scratch_path(spark, "archive")
    bronze = TB.bronze(spark, sf_dir)
    snapshots.snapshot(bronze, path, SNAPSHOT_DAY)
    snapshots.snapshot(bronze, path, SNAPSHOT_DAY)
    snapshots.snapshot(bronze, path, SNAPSHOT_NEXT_DAY)
    return (snapshots.read_archive(spark, path).groupBy("snapshot_date")
            .agg(F.count(F.lit(1)).alias("row_count")))


def q_snapshot_rerun_empty(spark, sf_dir):
    """The rerun of a day with an empty batch replaces the day's rows by none."""
    path = scratch_path(spark, "archive")
    bronze = TB.bronze(spark, sf_dir)
    snapshots.snapshot(bronze, path, SNAPSHOT_DAY)
    snapshots.snapshot(bronze, path, SNAPSHOT_NEXT_DAY)
    snapshots.snapshot(bronze.where("quantity > 1000000"), path, SNAPSHOT_DAY)
    return snapshots.day_counts(spark, path)


def q_snapshot_as_of(spark, sf_dir):
    path = scratch_path(spark, "archive")
    bronze = TB.bronze(spark, sf_dir)
    snapshots.snapshot(bronze, path, SNAPSHOT_DAY)
    snapshots.snapshot(bronze.filter(F.col("quantity") > 0), path, SNAPSHOT_NEXT_DAY)
    out = snapshots.read_snapshot(spark, path, SNAPSHOT_DAY).drop("snapshot_id")
    return as_double(out)


def q_fact_date_range(spark, sf_dir):
    path = scratch_path(spark, "fact-by-year")
    layout.write_fact_by_year(retail_star(spark, sf_dir).fact_sales, path)
    return as_double(layout.scan_date_range(spark, path, RANGE_LO, RANGE_HI).drop("sale_year"))


# --- supply -------------------------------------------------------------------------------

def _supply(spark, sf_dir):
    return SP.build_star(spark, sf_dir, with_ids=False)


def q_quantity_by_category(spark, sf_dir):
    s = _supply(spark, sf_dir)
    return SR.quantity_by_category(s.fact_shipments, s.dim_products)


def q_warehouse_efficiency(spark, sf_dir):
    s = _supply(spark, sf_dir)
    return as_double(SR.warehouse_efficiency(s.fact_shipments, s.dim_warehouses))


def q_value_by_supplier(spark, sf_dir):
    s = _supply(spark, sf_dir)
    return as_double(SR.value_by_supplier(s.fact_shipments, s.dim_suppliers))


def q_top_shipped_products(spark, sf_dir):
    s = _supply(spark, sf_dir)
    return SR.top_shipped_products(s.fact_shipments, s.dim_products)


def q_value_distribution(spark, sf_dir):
    s = _supply(spark, sf_dir)
    return as_double(SR.value_distribution(s.fact_shipments, s.dim_products))


def q_shipment_summary(spark, sf_dir):
    s = _supply(spark, sf_dir)
    return as_double(SR.shipment_summary(s.fact_shipments, s.dim_products))


def _yoy(spark, sf_dir, **options):
    s = _supply(spark, sf_dir)
    fact = TB.shipments_with_idle_years(s.fact_shipments)   # a zero base has no percentage
    return as_double(SR.supplier_yoy(fact, s.dim_suppliers, s.dim_time, **options))


def q_supplier_yoy(spark, sf_dir):
    return _yoy(spark, sf_dir)


def q_supplier_yoy_significant(spark, sf_dir):
    return _yoy(spark, sf_dir, min_abs_pct=SIGNIFICANT_PCT)


def q_dim_time(spark, sf_dir):
    return _supply(spark, sf_dir).dim_time


def q_shipment_value(spark, sf_dir):
    """P10: the consistent measure, round(quantity * unit price, 2), for every shipment."""
    s = _supply(spark, sf_dir)
    p = s.dim_products.select("product_id", "unit_price")
    out = s.fact_shipments.join(p, "product_id").select(
        "order_id", "product_id", "supplier_id", "quantity", "unit_price",
        shipment_value("quantity", "unit_price").alias("shipment_value"))
    return as_double(out)


def q_value_mismatch(spark, sf_dir):
    s = _supply(spark, sf_dir)
    fact = TB.shipments_with_consistent_values(s.fact_shipments, s.dim_products)
    out = J.value_mismatch(fact, s.dim_products).select(
        "order_id", "product_id", "supplier_id", "quantity", "unit_price", "shipment_value",
        "expected_value")
    return as_double(out)


def _batch(spark, sf_dir):
    return SP.apply_change_batch(SP.fact_with_ids(spark, sf_dir))


def _facts(df):
    return as_double(df.drop("created_at"))


def q_apply_delays(spark, sf_dir):
    return _facts(_batch(spark, sf_dir).after_delays)


def q_apply_values(spark, sf_dir):
    return _facts(_batch(spark, sf_dir).after_values)


def q_delete_keys(spark, sf_dir):
    return _facts(_batch(spark, sf_dir).after_deletes)


def q_apply_batch(spark, sf_dir):
    """U3-U5 in one pass over the fact."""
    return _facts(SP.apply_change_batch_one_pass(SP.fact_with_ids(spark, sf_dir))[0])


def _supply_job(spark, sf_dir):
    """R2, the batch sent twice: it is applied and logged once."""
    root = scratch_path(spark, "supply-job")
    for _ in range(2):
        SP.run_supply(spark, sf_dir, root, "batch-1", STAMP_TIME, "tester", natural_ids=True)
    return root


def q_supply_job_fact(spark, sf_dir):
    return _facts(SP.shipments(spark, _supply_job(spark, sf_dir)))


def q_supply_job_audit(spark, sf_dir):
    return as_double(SP.audit_log(spark, _supply_job(spark, sf_dir)).drop("audit_id"))


def _two_batches(spark, sf_dir):
    """Two batches published and applied in turn, apart from the load."""
    root = scratch_path(spark, "supply-live")
    SP.load_star(spark, sf_dir, root, natural_ids=True)
    for name, sc in (("batch-1", SP.FIRST), ("batch-2", SP.SECOND)):
        SP.publish_batch(spark, root, name, SP.scenario_rows(SP.shipments(spark, root), sc))
        SP.apply_pending(spark, root, STAMP_TIME, "tester")
    return root


def q_change_batches_fact(spark, sf_dir):
    """The effects of both batches stay."""
    return _facts(SP.shipments(spark, _two_batches(spark, sf_dir)))


def q_change_batches_audit(spark, sf_dir):
    """Every change of both batches, chained over them."""
    return as_double(SP.audit_log(spark, _two_batches(spark, sf_dir)).drop("audit_id"))


def q_change_one_year(spark, sf_dir):
    """U3-U5 on one year's shipments: rows, hours and value of every year, and whether its
    files are those of the load."""
    root = scratch_path(spark, "supply-live")
    loaded = SP.load_star(spark, sf_dir, root, natural_ids=True)
    year = SP.shipments(spark, root).where(F.floor(F.col("date_id") / 10000) == CHANGED_YEAR)
    SP.publish_batch(spark, root, "batch-1", SP.scenario_rows(year))
    SP.apply_pending(spark, root, STAMP_TIME, "tester")
    now = versions.latest(spark, SP.facts_path(root))
    parts = spark.createDataFrame([(int(p.split("=")[1]), v == loaded) for p, v in now.parts.items()], "ship_year int, as_loaded boolean")
    sums = versions.read_commit(spark, SP.facts_path(root), now).groupBy("ship_year").agg(
        F.count(F.lit(1)).alias("shipments"), F.sum("shipping_time_hours").alias("hours"), F.sum("shipment_value").alias("value"))
    return as_double(sums.join(F.broadcast(parts), "ship_year"))


def q_shipment_summary_view(spark, sf_dir):
    """The reporting view, selected from by name."""
    root = scratch_path(spark, "supply-live")
    SP.load_star(spark, sf_dir, root, natural_ids=True)
    SP.register_views(spark, root)
    return as_double(spark.table("shipment_summary"))


def q_tables_exist(spark, sf_dir):
    """Which tables of the star exist after a load, and the rows of those that do."""
    root = scratch_path(spark, "supply-live")
    SP.load_star(spark, sf_dir, root, natural_ids=True)
    parts = []
    for name in (*SP.DIMS, "fact_shipments", "dim_carriers"):
        there = files.table_exists(spark, f"{root}/{name}")
        df = None if not there else SP.shipments(spark, root) if name == "fact_shipments" else spark.read.parquet(f"{root}/{name}")
        rows = df.agg(F.count(F.lit(1)).alias("row_count")) if there else spark.range(1).select(F.lit(None).cast("long").alias("row_count"))
        parts.append(rows.select(F.lit(name).alias("table_name"), F.lit(there).alias("table_exists"), "row_count"))
    return functools.reduce(DataFrame.unionByName, parts)


def q_reset_tables(spark, sf_dir):
    """Tables emptied by a reset keep their schema; the others keep their rows."""
    root = scratch_path(spark, "supply-live")
    star = SP.build_star(spark, sf_dir)
    names = {f"supply.{n}": getattr(star, n) for n in ("dim_orders", "dim_products", "fact_shipments")}
    for name, df in names.items():
        files.write_replace(df, f"{root}/{name}")
    files.reset_tables(spark, root, ["supply.fact_shipments", "supply.dim_orders"])
    files.assert_tables(spark, root, list(names))
    parts = []
    for name in names:
        df = spark.read.parquet(f"{root}/{name}")
        same = sorted(df.columns) == sorted(f.name for f in schemas.SCHEMAS[name].fields)
        parts.append(df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count", F.lit(same).alias("schema_kept")))
    return functools.reduce(DataFrame.unionByName, parts)


def q_default_stamps(spark, sf_dir):
    """S3/U6 defaults: one generated batch id and load time for all rows of a run, one
    change time and the session's user for all rows of a change batch."""
    at = F.current_timestamp().cast("timestamp_ntz")
    near = lambda c: F.abs(F.unix_timestamp(at) - F.unix_timestamp(c)) < 24 * 3600
    rows = files.stamp_batch(TB.bronze(spark, sf_dir))
    a = rows.agg(F.count(F.lit(1)).alias("row_count"), F.count_distinct("batch_id", "load_timestamp").alias("stamps"),
                 F.bool_and(F.col("batch_id").rlike("^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$")).alias("well_formed"),
                 F.bool_and(near("load_timestamp")).alias("recent")).select(F.lit("bronze").alias("table_name"), "*")
    log = U.stamp_audit(SP.apply_change_batch_one_pass(SP.fact_with_ids(spark, sf_dir))[1])
    b = log.agg(F.count(F.lit(1)).alias("row_count"), F.count_distinct("changed_at", "changed_by").alias("stamps"),
                F.bool_and(F.length("changed_by") > 0).alias("well_formed"),
                F.bool_and(near("changed_at")).alias("recent")).select(F.lit("audit").alias("table_name"), "*")
    return a.unionByName(b)


def q_audit_update(spark, sf_dir):
    return as_double(_batch(spark, sf_dir).audit.filter(F.col("operation") == "UPDATE"))


def q_audit_delete(spark, sf_dir):
    return as_double(_batch(spark, sf_dir).audit.filter(F.col("operation") == "DELETE"))


def q_latest_audit(spark, sf_dir):
    return as_double(U.latest_change(_batch(spark, sf_dir).audit))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    # retail reports
    "top_products": q_top_products,
    "monthly_revenue": q_monthly_revenue,
    "revenue_by_country": q_revenue_by_country,
    "top_customers": q_top_customers,
    "sales_vs_returns": q_sales_vs_returns,
    # retail ingest and cleaning
    "raw_standardised": q_raw_standardised,
    "csv_quoted_reordered": q_csv_quoted_reordered,
    "batch_stamp": q_batch_stamp,
    "rejected_records": q_rejected_records,
    **{n: _stage(n) for n in ["exact_dedup", "mandatory_fields", "customer_sentinel",
                              "description_sentinel", "stripped_strings", "parsed_dates",
                              "date_id", "valid_price", "line_value"]},
    "cleaning_report": q_cleaning_report,
    "silver_products": q_silver_products,
    "silver_customers": q_silver_customers,
    # dims, keys, joins, upserts
    "dim_date": q_dim_date,
    "surrogate_keys": q_surrogate_keys,
    "resolve_keys": q_resolve_keys,
    "resolve_keys_measured": q_resolve_keys_measured,
    "heavy_keys": q_heavy_keys,
    "unresolved_keys": q_unresolved_keys,
    "upsert_ignore": q_upsert_ignore,
    "upsert_update": q_upsert_update,
    # quality
    "fk_orphans": q_fk_orphans,
    "duplicate_keys": q_duplicate_keys,
    "declared_keys": q_declared_keys,
    "row_rule_violations": q_row_rule_violations,
    "layer_counts": q_layer_counts,
    "layer_audit": q_layer_audit,
    "table_profile": q_table_profile,
    "profile_by_day": q_profile_by_day,
    "unique_keys_by_day": q_unique_keys_by_day,
    # storage layouts
    "snapshot_roundtrip": q_snapshot_roundtrip,
    "snapshot_as_of": q_snapshot_as_of,
    "fact_date_range": q_fact_date_range,
    "fact_append": q_fact_append,
    "fact_append_rerun_empty": q_fact_append_rerun_empty,
    "snapshot_rerun_empty": q_snapshot_rerun_empty,
    # the jobs end to end
    "retail_job_fact": q_retail_job_fact,
    "retail_job_dims": q_retail_job_dims,
    "retail_job_counts": q_retail_job_counts,
    "run_log": q_run_log,
    "supply_job_fact": q_supply_job_fact,
    "supply_job_audit": q_supply_job_audit,
    "change_batches_fact": q_change_batches_fact,
    "change_batches_audit": q_change_batches_audit,
    "change_one_year": q_change_one_year,
    "shipment_summary_view": q_shipment_summary_view,
    "tables_exist": q_tables_exist,
    "reset_tables": q_reset_tables,
    "default_stamps": q_default_stamps,
    # supply star
    "dim_time": q_dim_time,
    "quantity_by_category": q_quantity_by_category,
    "warehouse_efficiency": q_warehouse_efficiency,
    "value_by_supplier": q_value_by_supplier,
    "top_shipped_products": q_top_shipped_products,
    "value_distribution": q_value_distribution,
    "shipment_summary": q_shipment_summary,
    "supplier_yoy": q_supplier_yoy,
    "supplier_yoy_significant": q_supplier_yoy_significant,
    "shipment_value": q_shipment_value,
    "value_mismatch": q_value_mismatch,
    # changes and audit
    "apply_batch": q_apply_batch,
    "apply_delays": q_apply_delays,
    "apply_values": q_apply_values,
    "delete_keys": q_delete_keys,
    "audit_update": q_audit_update,
    "audit_delete": q_audit_delete,
    "latest_audit": q_latest_audit,
}
