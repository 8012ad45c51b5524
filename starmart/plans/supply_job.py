"""R2: supply-chain star load, and keyed changes with their audit log on the live table.

Loading the star (:func:`load_star`) and changing it are jobs of their own. Change batches
are published to a feed (one commit a batch); :func:`apply_pending` applies the feed's next
batches to the current fact, in order, each once. The fact's parts are the years of
shipment: a batch rewrites the years it touches and nothing else.

The change scenario used by the registered queries is derived from the fact itself by
divisibility of shipment ids (:class:`Scenario`); nothing is sampled.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.operators import changes as U
from starmart.operators import joins as J
from starmart.operators import quality as Q
from starmart.operators.dims import calendar, with_serial
from starmart.sources import testbed as TB
from starmart.plans import supply as SR
from starmart.session import run_concurrently, scratch
from starmart.sources import files, versions

@dataclass(frozen=True)
class Scenario:
    """Which shipments a derived change batch touches (ids divisible by, some of them twice)
    and by how much; fixed values."""

    delay_every: int = 50
    delay_twice_every: int = 500
    delay_hours: int = 24
    value_every: int = 70
    value_twice_every: int = 700
    value_step: int = 100
    delete_every: int = 90


FIRST = Scenario()
#: The batch after it: other shipments, and hours taken away again.
SECOND = Scenario(60, 300, -2, 80, 400, 50, 110)


@dataclass
class SupplyStar:
    dim_time: DataFrame
    dim_products: DataFrame
    dim_suppliers: DataFrame
    dim_warehouses: DataFrame
    dim_orders: DataFrame
    fact_shipments: DataFrame


def fact_with_ids(spark: SparkSession, sf_dir: str, natural: bool = True) -> DataFrame:
    """The shipment fact with surrogate ids, assigned in the scan without any exchange.

    ``natural``: an id from the order line itself, which any engine can reproduce; the
    registered queries use it. Otherwise SERIAL semantics (unique, increasing, gaps
    allowed), the choice for loading."""
    lines = TB.shipment_lines(spark, sf_dir)
    if not natural:
        return with_serial(TB.shipments_from_lines(lines), "shipment_id")
    return TB.shipments_from_lines(lines.withColumn("shipment_id", TB.natural_shipment_id()), keep=["shipment_id"])


def build_star(spark: SparkSession, sf_dir: str, with_ids: bool = True,
               natural_ids: bool = True) -> SupplyStar:
    fact = fact_with_ids(spark, sf_dir, natural_ids) if with_ids else TB.supply_fact_shipments(spark, sf_dir)
    return SupplyStar(
        dim_time=calendar(TB.shipment_date_bounds(spark, sf_dir)),
        dim_products=TB.supply_dim_products(spark, sf_dir),
        dim_suppliers=TB.supply_dim_suppliers(spark, sf_dir),
        dim_warehouses=TB.supply_dim_warehouses(spark, sf_dir),
        dim_orders=TB.supply_dim_orders(spark, sf_dir),
        fact_shipments=fact,
    )


def delay_adjustments(fact: DataFrame, sc: Scenario = FIRST) -> DataFrame:
    sid = F.col("shipment_id")
    return fact.filter(sid % sc.delay_every == 0).select(
        "shipment_id", F.lit(sc.delay_hours).alias("added_hours"),
        F.explode(F.sequence(F.lit(1), F.when(sid % sc.delay_twice_every == 0, 2).otherwise(1))).alias("seq"))


def value_updates(fact: DataFrame, sc: Scenario = FIRST) -> DataFrame:
    sid = F.col("shipment_id")
    steps = F.sequence(F.lit(1), F.when(sid % sc.value_twice_every == 0, 2).otherwise(1))
    return (fact.filter(sid % sc.value_every == 0)
            .select("shipment_id", "shipment_value", F.explode(steps).alias("seq"))
            .select("shipment_id", (F.col("shipment_value") + F.col("seq") * sc.value_step)
                    .cast("decimal(12,2)").alias("new_value"), "seq"))


def deletions(fact: DataFrame, sc: Scenario = FIRST) -> DataFrame:
    return fact.filter(F.col("shipment_id") % sc.delete_every == 0).select(
        "shipment_id", F.lit(1).alias("seq"))


def scenario_rows(fact: DataFrame, sc: Scenario = FIRST) -> DataFrame:
    """The scenario's change sets on a fact, as rows of the feed."""
    return feed_rows(fact.sparkSession, delay_adjustments(fact, sc), value_updates(fact, sc), deletions(fact, sc))


def apply_change_batch_one_pass(fact: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The same batch as :func:`apply_change_batch`, rewriting the fact once."""
    return U.apply_batch(fact, delay_adjustments(fact), value_updates(fact), deletions(fact))


@dataclass
class ChangeBatch:
    after_delays: DataFrame
    after_values: DataFrame
    after_deletes: DataFrame
    build_audit: Callable[[], DataFrame]

    @property
    def audit(self) -> DataFrame:
        """shipment_id, operation, old_value, new_value, seq, step; its chained lag is only
        built when asked for."""
        return self.build_audit()


def apply_change_batch(fact: DataFrame) -> ChangeBatch:
    adj = delay_adjustments(fact)
    f1 = U.apply_delays(fact, adj)
    upd = value_updates(f1)
    f2 = U.apply_values(f1, upd)
    dele = deletions(f2)
    f3 = U.delete_keys(f2, dele)

    def audit() -> DataFrame:
        a1 = U.audit_updates(fact, adj.select("shipment_id", "seq")).withColumn("step", F.lit(1))
        a2 = U.audit_updates(f1, upd, new="new_value").withColumn("step", F.lit(2))
        a3 = U.audit_deletes(f2, dele).withColumn("step", F.lit(3))
        return a1.unionByName(a2).unionByName(a3)
    return ChangeBatch(f1, f2, f3, audit)


DIMS = ("dim_time", "dim_products", "dim_suppliers", "dim_warehouses", "dim_orders")
FOREIGN_KEYS = {"product_id": "dim_products", "supplier_id": "dim_suppliers", "warehouse_id": "dim_warehouses",
                "order_id": "dim_orders", "date_id": "dim_time"}
YEAR = "ship_year"


def facts_path(root: str) -> str:
    return f"{root}/fact_shipments"


def feed_path(root: str) -> str:
    return f"{root}/change_feed"


def log_path(root: str) -> str:
    return f"{root}/shipment_audit_log"


def shipments(spark: SparkSession, root: str) -> DataFrame:
    """The current shipment fact."""
    return versions.read_current(spark, facts_path(root)).drop(YEAR)


# --- load ------------------------------------------------------------------------------------

def load_star(spark: SparkSession, sf_dir: str, root: str, natural_ids: bool = False) -> int:
    """Write the dimensions and the shipment fact, whose parts are the years of shipment.

    The fact's row rules are counted by the job that writes it; its keys and references are
    checked on their columns before the version is committed."""
    files.create_tables(spark, root, {f"supply.{n}": f"{root}/{n}" for n in DIMS})
    star = build_star(spark, sf_dir, natural_ids=natural_ids)

    def dim(name):
        files.write_replace(getattr(star, name), f"{root}/{name}")
        Q.require_constraints(spark.read.parquet(f"{root}/{name}"), f"supply.{name}")
    run_concurrently([lambda n=name: dim(n) for name in DIMS])

    def check_fact(t):
        keys = [(fk, t, fk, spark.read.parquet(f"{root}/{d}"), fk) for fk, d in FOREIGN_KEYS.items()]
        if bad := [r["foreign_key"] for r in J.fk_report(keys).collect() if r["orphan_rows"]]:
            raise Q.ConstraintError(f"fact_shipments: no parent row for some {bad}")
        Q.require_unique(t, "supply.fact_shipments")

    fact = star.fact_shipments.withColumn(YEAR, (F.col("date_id") / 10000).cast("int"))
    rules = Q.ObservedRules(fact, "supply.fact_shipments")
    before = versions.latest(spark, facts_path(root))
    return versions.write_version(rules.rows, facts_path(root), check=check_fact, partition_by=YEAR,
                                  guard=lambda v: rules.check(), info={"audit_to": audit_end(before)})


# --- change batches ---------------------------------------------------------------------------

def feed_rows(spark: SparkSession, adjustments: DataFrame | None = None, updates: DataFrame | None = None,
              deletes: DataFrame | None = None) -> DataFrame:
    """Change sets as rows of the feed (kind DELAY, VALUE or DELETE)."""
    given = [("DELAY", adjustments), ("VALUE", updates), ("DELETE", deletes)]
    own = {"DELAY": "added_hours", "VALUE": "new_value"}
    parts = [df.select("shipment_id", F.lit(kind).alias("kind"),
                       *[(F.col(c) if own.get(kind) == c else F.lit(None)).cast(t).alias(c) for c, t in (("added_hours", "int"), ("new_value", "decimal(12,2)"))],
                       F.col("seq").cast("int").alias("seq")) for kind, df in given if df is not None]
    if not parts:
        return spark.createDataFrame([], "shipment_id long, kind string, added_hours int, new_value decimal(12,2), seq int")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def publish_batch(spark: SparkSession, root: str, batch_id: str, changes: DataFrame) -> int:
    """File a batch in the change feed: one commit a batch. A batch published again before
    it is applied replaces the earlier one, at the earlier one's place in the order."""
    if versions.has_batch(spark, facts_path(root), batch_id):
        raise ValueError(f"batch {batch_id} is applied already")
    return versions.write_version(changes, feed_path(root), batch_id)


def pending_batches(spark: SparkSession, root: str) -> DataFrame:
    """(place, batch, seq): the batches of the feed that the current fact does not hold
    (after a reload, those that were applied before it are pending again)."""
    feed = versions.commit_log(spark, feed_path(root)).groupBy("batch").agg(F.min("seq").alias("place"), F.max("seq").alias("seq"))
    done = versions.applied_commits(spark, facts_path(root)).select("batch")
    return feed.join(done, "batch", "left_anti").select("place", "batch", "seq")


def audit_end(commit: versions.Commit | None) -> int:
    """The last audit id given out up to a commit of the fact."""
    return int(commit.info.get("audit_to", 0)) if commit else 0


def touched_parts(fact: DataFrame, ids: DataFrame) -> list[str]:
    """The years that hold one of the ids: a scan of the id column and a semi-join; the
    years reach the driver."""
    years = fact.select("shipment_id", YEAR).join(ids, "shipment_id", "left_semi").select(YEAR).distinct().collect()
    return [f"{YEAR}={'__HIVE_DEFAULT_PARTITION__' if r[0] is None else r[0]}" for r in years]


def apply_to_live(spark: SparkSession, root: str, batch_id: str, feed_seq: int,
                  changed_at: datetime | None = None, changed_by: str | None = None, since: int | None = None) -> int | None:
    """Apply one batch of the feed to the current fact, rewriting only the years it touches.
    ``since``: place in the fact's chain up to which the batch is known not to be applied.

    The new years and the audit rows are written for one attempt; the commit, which names
    the batch and the version it was read from, makes both count. If another writer came
    first the batch is applied again to that writer's version. Returns the version, None if
    the batch is applied already."""
    facts, log = facts_path(root), f"{log_path(root)}/batch_id={batch_id}"
    rows = versions.read_commit(spark, feed_path(root), versions.commit_at(spark, feed_path(root), feed_seq))
    of = lambda kind: rows.where(F.col("kind") == kind)
    adjustments, updates, deletes = of("DELAY").drop("new_value"), of("VALUE").drop("added_hours"), of("DELETE")

    def change(now: versions.Commit) -> int:
        if now is None:
            raise FileNotFoundError(f"no shipments loaded under {root}")
        with scratch(spark, "changes") as stage, scratch(spark, "touched") as touched:
            fact = versions.read_commit(spark, facts, now)
            table = U.staged(U.change_table(adjustments, updates, deletes, dict(fact.dtypes)["shipment_value"]), stage)
            parts = touched_parts(fact, table.select("shipment_id"))
            fact = versions.read_commit(spark, facts, now, parts)
            needs = U.OrderNeeds.of(table)
            after = U.apply_changes(fact, U.with_lowest(table, adjustments, needs))
            rules = Q.ObservedRules(after, "supply.fact_shipments")

            def guard(v):
                seen = rules.check()
                audit = U.stamp_audit(U.audit_batch(fact, table, needs, adjustments, updates, deletes, stage=touched), changed_at, changed_by)
                written = U.staged(with_serial(audit, "audit_id", audit_end(now) + 1), f"{log}/attempt={v}")
                return {**seen, "audit_to": written.agg(F.max("audit_id")).first()[0] or audit_end(now), "years": len(parts)}

            return versions.write_version(rules.rows, facts, batch_id, base=now, reads=True, partition_by=YEAR, replace=parts, guard=guard)

    v = versions.update(spark, facts, change, batch_id, since)
    if v is not None:      # what other attempts at this batch left can never be committed
        kept = {f"attempt={r.version}" for r in versions.commit_log(spark, facts).where(F.col("batch") == batch_id).select("version").collect()}
        for name in set(versions.names(spark, log)) - kept:
            versions.drop_path(spark, f"{log}/{name}")
    return v


def apply_pending(spark: SparkSession, root: str, changed_at: datetime | None = None, changed_by: str | None = None) -> list[dict]:
    """Apply the feed's next batches, in their order, to the live fact; apart from any load.
    Several such jobs may run: each batch is applied once."""
    out, now = [], versions.latest(spark, facts_path(root))
    for r in pending_batches(spark, root).orderBy("place").collect():
        v = apply_to_live(spark, root, r["batch"], r["seq"], changed_at, changed_by, now.seq if now else 0)
        out.append({"batch": r["batch"], "fact_version": v, "applied": v is not None})
    versions.vacuum(spark, facts_path(root), keep=2, dead_after_hours=24)
    return out


def run_supply(spark: SparkSession, sf_dir: str, root: str, batch_id: str | None = None,
               changed_at: datetime | None = None, changed_by: str | None = None,
               natural_ids: bool = False) -> dict:
    """Load the star where it is not loaded yet, publish one change batch of the scenario,
    and apply what the feed holds to the live fact.

    A batch committed already is not applied again; a run that died is run again with the
    same batch id and goes on where it stopped."""
    batch_id = batch_id or str(uuid.uuid4())
    facts = facts_path(root)
    if versions.has_batch(spark, facts, batch_id):
        return {"fact_version": versions.current_version(spark, facts), "applied": False}
    if versions.latest(spark, facts) is None:
        load_star(spark, sf_dir, root, natural_ids)
    publish_batch(spark, root, batch_id, scenario_rows(shipments(spark, root)))
    apply_pending(spark, root, changed_at, changed_by)
    return {"fact_version": versions.current_version(spark, facts), "applied": True}


def audit_log(spark: SparkSession, root: str) -> DataFrame:
    """The audit rows of committed batches: the log joined with the fact's commits, so rows
    of an attempt that died or lost are left out."""
    if not files.table_exists(spark, log_path(root)):
        return spark.createDataFrame([], LOG_SCHEMA).drop("attempt")
    done = versions.commit_log(spark, facts_path(root)).where("batch <> ''").select(
        F.col("batch").alias("batch_id"), F.col("version").alias("attempt"))
    log = spark.read.schema(LOG_SCHEMA).parquet(log_path(root)).withColumn("attempt", F.col("attempt").cast("long"))
    return log.join(done, ["batch_id", "attempt"], "left_semi").drop("attempt")


LOG_SCHEMA = ("audit_id long, shipment_id long, operation string, old_value decimal(12,2), new_value decimal(12,2), seq int, "
              "step int, changed_at timestamp_ntz, changed_by string, batch_id string, attempt long")


def register_views(spark: SparkSession, root: str) -> list[str]:
    """The reporting view a SQL user selects from, over the current star."""
    dim = spark.read.parquet(f"{root}/dim_products")
    SR.shipment_summary(shipments(spark, root), dim).createOrReplaceTempView("shipment_summary")
    return ["shipment_summary"]
