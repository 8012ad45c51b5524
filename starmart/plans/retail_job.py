"""The retail batch job, ingest -> snapshot -> transform -> load -> monitor.

Each stage reads the previous stage's persisted tables, so a failed run resumes from
the last finished stage; reruns are idempotent (Bronze and Silver are replaced, the
snapshot of a day is replaced, Gold dims are merged and the fact replaced as a new
version). A batch that breaks a rule (no rows, a bad date, over-long text, a declared
constraint of a Gold table) stops before the layer that would take it is published.
"""

from __future__ import annotations

import uuid
from datetime import date, datetime

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from starmart.operators import changes as U
from starmart.operators import clean as C
from starmart.operators import joins as J
from starmart.operators import quality as Q
from starmart.operators import slices
from starmart.operators.dims import dim_date_from_facts
from starmart.plans import retail as R
from starmart.plans import run_log
from starmart.session import run_concurrently, scratch, shuffles_dropped
from starmart.sources import files, layout, snapshots, versions
from starmart.sources.rejects import CountedLoad, read_with_reasons


FACT_SLICES = 8         # exchanges of the fact, at most
SLICE_IDS = 1 << 58     # first sales_id of the second slice; a task has 2 ** 33 ids


def paths(root: str) -> dict[str, str]:
    return {
        "bronze": f"{root}/bronze/raw_transactions",
        "archive": f"{root}/bronze/raw_transactions_archive",
        "rejects": f"{root}/bronze/rejects",
        "silver_tx": f"{root}/silver/transactions",
        "silver_products": f"{root}/silver/products",
        "silver_customers": f"{root}/silver/customers",
        "dim_products": f"{root}/gold/dim_products",
        "dim_customers": f"{root}/gold/dim_customers",
        "dim_date": f"{root}/gold/dim_date",
        "fact_sales": f"{root}/gold/fact_sales",
    }


def create_tables(spark: SparkSession, root: str) -> list[str]:
    """S15 at job start: the Silver tables, empty, where they do not exist yet. Versioned
    Gold tables read as empty until their first version; the archive is made of its days."""
    p = paths(root)
    return files.create_tables(spark, root, {"silver.transactions": p["silver_tx"], "silver.products": p["silver_products"],
                                             "silver.customers": p["silver_customers"]})


def _day(run_date: date | None, in_place: bool) -> date | None:
    if in_place and run_date is None:
        raise ValueError("a batch written in place is read by its run_date")
    return run_date


def ingest(spark: SparkSession, csv_path: str, root: str, batch_id: str | None = None,
           load_timestamp: datetime | None = None, run_date: date | None = None,
           in_place: bool = False, tolerate_rejects: float | None = None) -> dict:
    """CSV -> Bronze (truncate and reload).

    ``tolerate_rejects``: records that cannot be loaded go to the reject table of the batch
    (:func:`rejects`) as long as they are at most this share; without it the first one
    fails the load.

    ``in_place``: the batch is written once, straight into its day of the snapshot
    archive, and that partition is the current Bronze (see :func:`bronze`). A rerun of
    the day replaces the partition, so reruns stay idempotent. Otherwise Bronze is its
    own table and :func:`take_snapshot` copies it into the archive."""
    p, counted = paths(root), None
    if tolerate_rejects is None:
        raw = files.read_raw_csv(spark, csv_path)
    else:
        counted = CountedLoad(read_with_reasons(spark, csv_path), tolerate_rejects)
        raw = counted.rows
    rows = files.stamp_batch(files.to_bronze_types(files.standardise_columns(raw)),
                             load_timestamp, batch_id)
    where = f"{p['rejects']}/batch_id={batch_id}"
    if in_place:
        snapshots.snapshot(rows, p["archive"], _day(run_date, in_place), batch_id, (lambda v: counted.finish(where)) if counted else None)
    else:
        files.write_replace(rows, p["bronze"])
        if counted:
            counted.finish(where)
    return counted.seen.get if counted else {}


def rejects(spark: SparkSession, root: str):
    """(file, line, reason, batch_id) of every record set aside; empty before the first."""
    path, schema = paths(root)["rejects"], "file string, line string, reason string, batch_id string"
    if not files.table_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def bronze(spark: SparkSession, root: str, run_date: date | None = None,
           in_place: bool = False):
    """The current Bronze rows (the run day's archive partition when written in place)."""
    p = paths(root)
    if in_place:
        if not snapshots.has_day(spark, p["archive"], _day(run_date, in_place)):
            raise FileNotFoundError(f"no batch of {run_date} in {p['archive']}")
        day = snapshots.read_snapshot(spark, p["archive"], run_date)
        return day.drop("snapshot_id", "snapshot_date")
    return files.read_table(spark, p["bronze"], "bronze.raw_transactions")


def take_snapshot(spark: SparkSession, root: str, run_date: date) -> None:
    """Copy the current Bronze table into the archive under ``run_date``."""
    p = paths(root)
    snapshots.snapshot(files.read_table(spark, p["bronze"], "bronze.raw_transactions"),
                       p["archive"], run_date)


def transform(spark: SparkSession, root: str, run_date: date | None = None,
              in_place: bool = False) -> dict:
    """Bronze -> three Silver tables; returns the cleaning counts (observed metrics)."""
    p = paths(root)
    rows = bronze(spark, root, run_date, in_place)
    if rows.isEmpty():      # also a day that holds no file, whose counts no job would observe
        raise ValueError("the batch has no Bronze rows")
    # One materialisation of the cleaned rows feeds all three Silver tables: a staged
    # Parquet table in the shared folder (compressed and columnar, so each Silver scan
    # reads only its columns), removed at the end, also on failure.
    with scratch(spark, "cleaned") as staged:
        rows, obs = C.stage_observed(rows, staged)
        metrics = obs.check()       # before anything of Silver is replaced
        # one after the other: the members' exchanges are gone before the next write starts,
        # the transactions, a large table without an exchange, come last
        files.write_replace(C.silver_products(rows), p["silver_products"])
        files.write_replace(C.silver_customers(rows), p["silver_customers"])
        files.write_replace(C.silver_transactions(rows), p["silver_tx"])
    return metrics


def load(spark: SparkSession, root: str, batch_id: str | None = None) -> None:
    """Silver -> Gold: merge dims (type 1, stable keys), insert new dates, rebuild fact."""
    p = paths(root)
    tx = files.read_table(spark, p["silver_tx"], "silver.transactions")
    sp = files.read_table(spark, p["silver_products"], "silver.products")
    sc = files.read_table(spark, p["silver_customers"], "silver.customers")

    def merged(path, src, natural, key, cols):
        if versions.current_version(spark, path) is None:
            return R.assign_keys(src, natural, key)
        return U.upsert_update(versions.read_current(spark, path), src, natural, key, cols)

    def dates():
        new_dates = dim_date_from_facts(tx)
        if versions.current_version(spark, p["dim_date"]) is None:
            return new_dates
        return U.upsert_ignore(versions.read_current(spark, p["dim_date"]), new_dates, "date_id")

    # the three dimensions are independent of each other: build and write them as
    # concurrent jobs; the fact needs all three and follows
    def publish(df, name):
        # the written version is checked against its declared rules and keys, then committed
        versions.write_version(df, p[name], check=lambda t: Q.require_constraints(t, f"gold.{name}"))

    run_concurrently([
        lambda: publish(merged(p["dim_products"], sp, "stock_code", "product_id", ["description"]), "dim_products"),
        lambda: publish(merged(p["dim_customers"], sc, "raw_customer_id", "customer_id", ["country"]), "dim_customers"),
        lambda: publish(dates(), "dim_date"),
    ])
    dp = versions.read_current(spark, p["dim_products"])
    dc = versions.read_current(spark, p["dim_customers"])
    # sales_id: unique and increasing (gaps allowed, like SERIAL), assigned inside the
    # write job without a global ordering; load columns are one literal per batch.
    # the keys that salting splits are measured on the batch itself
    heavy = J.heavy_keys(tx, ["stock_code", "raw_customer_id"])
    stamp, said = datetime.now(), batch_id or ""
    batch_id = batch_id or str(uuid.uuid4())

    # rows of the fact do not depend on each other: the two key joins and the exchange by
    # year, each as wide as the fact, run once a slice of a large one
    def rows_of(part, i):
        fact = files.stamp_batch(R.fact_sales(part, dp, dc, heavy=heavy), stamp, batch_id)
        key = F.monotonically_increasing_id()
        return fact.select((key + F.lit(i * SLICE_IDS) if i else key).alias("sales_id"), *fact.columns)

    first, *others = [rows_of(part, i) for i, part in enumerate(slices.split(tx, slices.number(tx, FACT_SLICES)))]
    rules = Q.ObservedRules(first, "gold.fact_sales")

    def write(d, path):
        layout.write_fact_by_year(d, path, dynamic=False)
        for f in others:
            layout.write_fact_by_year(rules.over(f), path, append=True)

    versions.write_version(rules.rows, p["fact_sales"], said, guard=lambda v: rules.check(),
                           check=lambda t: Q.require_unique(t, "gold.fact_sales"), write=write)
    for name in ("dim_products", "dim_customers", "dim_date", "fact_sales"):
        versions.vacuum(spark, p[name], keep=2)


def monitor(spark: SparkSession, root: str, run_date: date | None = None,
            in_place: bool = False) -> list[dict]:
    p = paths(root)
    counts = Q.layer_counts(bronze(spark, root, run_date, in_place), spark.read.parquet(p["silver_tx"]),
                            versions.read_current(spark, p["fact_sales"]))
    return [r.asDict() for r in Q.audit_layers(counts).collect()]  # five summary rows


def run_retail(spark: SparkSession, csv_path: str, root: str, run_date: date | None = None,
               batch_id: str | None = None, snapshot_in_place: bool = True, fail_on_error: bool = False,
               tolerate_rejects: float | None = None) -> dict:
    """The daily job. With ``snapshot_in_place`` (default) the raw batch is written once,
    into its day of the archive, instead of a Bronze write plus a full copy.

    Every run is filed in the run log (:mod:`starmart.plans.run_log`) with its step counts
    and audit statuses, a failed one with its error. ``fail_on_error``: an audit status of
    ERROR raises after it is stored."""
    run_date = run_date or date.today()
    batch_id = batch_id or str(uuid.uuid4())

    def work() -> dict:
        with shuffles_dropped(spark):       # every step writes its tables
            create_tables(spark, root)
            loaded = ingest(spark, csv_path, root, batch_id, run_date=run_date, in_place=snapshot_in_place, tolerate_rejects=tolerate_rejects)
            if not snapshot_in_place:
                take_snapshot(spark, root, run_date)
            metrics = transform(spark, root, run_date, snapshot_in_place)
            load(spark, root, batch_id)
            return {"ingest": loaded, "cleaning": metrics, "audit": monitor(spark, root, run_date, snapshot_in_place)}

    def checks(out: dict) -> list[tuple]:
        return ([(f"ingest.{k}", v, None) for k, v in out["ingest"].items()]
                + [(f"cleaning.{k}", v, None) for k, v in out["cleaning"].items()]
                + [(r["check_name"], r["value"], r["status"]) for r in out["audit"]])

    return run_log.logged(spark, root, batch_id, "retail", date.fromisoformat(str(run_date)), work, checks, fail_on_error)
