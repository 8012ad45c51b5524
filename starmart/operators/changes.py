"""Keyed change application and change audit.

Parquet tables have no UPDATE/DELETE/MERGE, so every change is a DataFrame function
``before -> after``; persisting writes a new table version (see ``sources.versions``).

Audit semantics follow the reference trigger: one row per touched row per statement
(an update that leaves the value unchanged is still logged; two updates of one id give
two chained rows), deletes log the old value with a null new value, inserts are not
logged, and an update of an unknown id changes nothing and logs nothing.
"""

from __future__ import annotations

from datetime import datetime
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmart.operators.dims import assign_keys
from starmart.session import scratch_path, shared_root


def enforce(df: DataFrame, rules: dict[str, str | Column], label: str = "row",
            keep: Column | None = None) -> DataFrame:
    """Fail the job when a row breaks a rule (like a table CHECK), from inside the plan:
    each rule becomes a ``raise_error`` branch; no extra pass over the data. ``keep``
    filters the rows after they were checked: all of it is one expression, as the
    optimizer may reorder separate conditions and drop a row before its check."""
    test = keep if keep is not None else F.lit(True)
    for name, rule in reversed(rules.items()):
        cond = F.expr(rule) if isinstance(rule, str) else rule
        test = F.when(F.coalesce(cond, F.lit(False)), test).otherwise(
            F.raise_error(F.lit(f"{label} violates {name}")).cast("boolean"))
    return df.filter(test)


# --- U1 / U2 ---------------------------------------------------------------------------

def upsert_ignore(target: DataFrame, src: DataFrame, key: str | list[str]) -> DataFrame:
    """U1 (insert ... on conflict do nothing): source rows whose key is absent are added;
    existing rows stay as they are. A key repeated in the source is inserted once."""
    keys = [key] if isinstance(key, str) else key
    new = src.dropDuplicates(keys).join(target.select(*keys), keys, "left_anti")
    return target.unionByName(new.select(*target.columns))


def unique_source(src: DataFrame, key: str) -> DataFrame:
    """The source rows, one a key; a repeated key fails the job from inside the plan (one
    grouped pass, which the join on the key needs anyway)."""
    cols = [c for c in src.columns if c != key]
    once = src.groupBy(key).agg(F.count(F.lit(1)).alias("_times"), *[F.first(c).alias(c) for c in cols])
    rule = F.when(F.col("_times") == 1, F.lit(True)).otherwise(
        F.raise_error(F.concat(F.lit(f"source repeats {key} "), F.col(key).cast("string"))).cast("boolean"))
    return once.filter(rule).select(*src.columns)


def upsert_update(target: DataFrame, src: DataFrame, natural: str, key: str,
                  columns: list[str]) -> DataFrame:
    """U2 (insert ... on conflict do update): a type-1 dimension merge.

    Matched members take the source attributes (even a null), keep their surrogate key;
    target-only members are unchanged; new members get keys after the current maximum
    (K1). A natural key repeated in the source fails the job, as the statement would."""
    src = unique_source(src, natural)
    s = src.select(natural, *[F.col(c).alias(f"_src_{c}") for c in columns]).withColumn("_hit", F.lit(True))
    merged = target.join(s, natural, "left").select(
        key, natural,
        *[F.when(F.col("_hit"), F.col(f"_src_{c}")).otherwise(F.col(c)).alias(c) for c in columns])
    new = assign_keys(src.select(natural, *columns), natural, key, existing=target,
                      include_existing=False)
    return merged.unionByName(new.select(key, natural, *columns))


# --- U3 / U4 / U5 --------------------------------------------------------------------------

def lowest_running_sum(changes: DataFrame, key: str, order: str, value: str,
                       num_partitions: int | None = None) -> DataFrame:
    """(key, ``_add``, ``_low``): the sum of a key's changes and the lowest value their
    running sum takes in ``order``. Rows are range partitioned on (key, order), so a hot
    key is cut into slices; a slice is one row (its sum, its lowest point), and the slices
    of a key, at most one a partition, are combined after that."""
    r = (changes.repartitionByRange(num_partitions, key, order) if num_partitions
         else changes.repartitionByRange(key, order))
    r = r.select(key, order, F.col(value).cast("long").alias("_v")).withColumn("_pid", F.spark_partition_id())
    run = F.sum("_v").over(Window.partitionBy("_pid", key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
    slices = (r.withColumn("_run", run).groupBy("_pid", key)
              .agg(F.min(order).alias("_at"), F.sum("_v").alias("_sum"), F.min("_run").alias("_min")))
    before = F.sum("_sum").over(Window.partitionBy(key).orderBy("_at").rowsBetween(Window.unboundedPreceding, -1))
    return (slices.withColumn("_low", F.coalesce(before, F.lit(0)) + F.col("_min"))
            .groupBy(key).agg(F.sum("_sum").alias("_add"), F.min("_low").alias("_low")))


def apply_delays(fact: DataFrame, adjustments: DataFrame, key: str = "shipment_id",
                 hours: str = "shipping_time_hours", added: str = "added_hours",
                 seq: str = "seq") -> DataFrame:
    """Add hours to the given shipments. Repeated ids add up in the order of ``seq``
    (the procedure called again), reduced to one row per id before the join. Hours that
    turn negative after any of the calls fail the job (CHECK hours >= 0), even if a later
    call would lift them again."""
    adj = lowest_running_sum(adjustments, key, seq, added)
    out = fact.join(adj, key, "left")
    out = enforce(out, {f"{hours} >= 0": F.col(hours) + F.least(F.coalesce("_low", F.lit(0)), F.lit(0)) >= 0}, "shipment")
    return (out.withColumn(hours, (F.col(hours) + F.coalesce(F.col("_add"), F.lit(0))).cast("int"))
            .drop("_add", "_low"))


def _bad_value(value: Column, dtype: str) -> Column:
    v = value.cast(dtype)
    return F.coalesce((v < 0).cast("int"), F.lit(1))


def apply_values(fact: DataFrame, updates: DataFrame, key: str = "shipment_id",
                 value: str = "shipment_value", new: str = "new_value",
                 seq: str = "seq") -> DataFrame:
    """U4: set a new value for the given shipments; the last ``seq`` per id wins. Each
    update is a statement of its own: a null or negative value fails the job (NOT NULL,
    CHECK value >= 0), even if a later update replaces it."""
    dtype = dict(fact.dtypes)[value]
    last = (updates.groupBy(key).agg(F.max_by(F.col(new), F.col(seq)).alias("_new"),
                                     F.max(_bad_value(F.col(new), dtype)).alias("_bad"))
            .withColumn("_hit", F.lit(True)))
    out = enforce(fact.join(last, key, "left"), {f"{value} not null and >= 0": F.coalesce("_bad", F.lit(0)) == 0}, "shipment")
    return (out.withColumn(value, F.when(F.col("_hit"), F.col("_new").cast(dtype)).otherwise(F.col(value)))
            .drop("_new", "_hit", "_bad"))


def delete_keys(fact: DataFrame, keys: DataFrame, key: str = "shipment_id") -> DataFrame:
    """Remove the rows whose key is listed."""
    return fact.join(keys.select(key), key, "left_anti")


# --- U6: audit -----------------------------------------------------------------------------

def lag_within_key(df: DataFrame, key: str, order: str, value: str, out: str,
                   num_partitions: int | None = None) -> DataFrame:
    """``lag(value) over (partition by key order by order)`` that stays bounded when one
    key holds a large share of the rows.

    Rows are range partitioned on ``(key, order)`` (a hot key is cut into consecutive
    slices), the lag is taken inside each (partition, key) slice, and the first row of a
    slice takes the last value of the previous partition when that partition ends with
    the same key. The per-partition last rows are one row per partition (a bounded,
    broadcast lookup). Adds ``out`` and ``{out}_is_first`` (first row of its key)."""
    spark = df.sparkSession
    shared_root(spark)
    r = df.repartitionByRange(num_partitions, key, order) if num_partitions \
        else df.repartitionByRange(key, order)  # AQE sizes the ranges from the data
    r = (r.sortWithinPartitions(key, order)
         .withColumn("_pid", F.spark_partition_id()).checkpoint(eager=True))
    ends = (r.groupBy("_pid")
            .agg(F.max_by(F.struct(F.col(key).alias("_k"), F.col(value).alias("_v")),
                          F.struct(F.col(key), F.col(order))).alias("_last"))
            .select((F.col("_pid") + 1).alias("_pid"), "_last._k", "_last._v"))
    w = Window.partitionBy("_pid", key).orderBy(order)
    local = (r.withColumn("_rn", F.row_number().over(w))
             .withColumn(out, F.lag(value).over(w)))
    j = local.join(F.broadcast(ends), "_pid", "left")
    continued = (F.col("_rn") == 1) & F.coalesce(F.col("_k") == F.col(key), F.lit(False))
    return (j.withColumn(out, F.when(continued, F.col("_v")).otherwise(F.col(out)))
            .withColumn(f"{out}_is_first", (F.col("_rn") == 1) & ~continued)
            .drop("_pid", "_rn", "_k", "_v"))


def audit_updates(before: DataFrame, touched: DataFrame, key: str = "shipment_id",
                  value: str = "shipment_value", seq: str = "seq",
                  new: str | None = None) -> DataFrame:
    """Audit rows of one UPDATE statement kind.

    ``touched`` lists (key, seq[, new]) with multiplicity. Without ``new`` the value is
    unchanged (delay updates): old = new = current value. With ``new`` (value updates)
    each row logs the value it replaced: the current value for the first update of an
    id, the previous update's value after that."""
    b = before.select(key, F.col(value).alias("_before"))
    t = touched.join(b, key)  # unknown ids log nothing
    if new is None:
        return t.select(key, F.lit("UPDATE").alias("operation"),
                        F.col("_before").alias("old_value"), F.col("_before").alias("new_value"), seq)
    dtype = dict(before.dtypes)[value]
    t = t.withColumn("_new", F.col(new).cast(dtype))
    chained = lag_within_key(t, key, seq, "_new", "_prev")
    old = F.when(F.col("_prev_is_first"), F.col("_before")).otherwise(F.col("_prev"))
    return chained.select(key, F.lit("UPDATE").alias("operation"), old.alias("old_value"),
                        F.col("_new").alias("new_value"), seq)


def audit_deletes(before: DataFrame, keys: DataFrame, key: str = "shipment_id",
                  value: str = "shipment_value", seq: str = "seq") -> DataFrame:
    """Audit rows of a DELETE: old value, null new value; a key deleted twice is logged
    once (the second delete finds no row)."""
    k = keys.groupBy(key).agg(F.min(seq).alias(seq))
    return (k.join(before.select(key, value), key)
            .select(key, F.lit("DELETE").alias("operation"), F.col(value).alias("old_value"),
                    F.lit(None).cast(dict(before.dtypes)[value]).alias("new_value"), seq))


def audit_changes(before: DataFrame, after: DataFrame, touched: DataFrame,
                  key: str = "shipment_id", value: str = "shipment_value", seq: str = "seq",
                  changed_at: datetime | None = None, changed_by: str | None = None) -> DataFrame:
    """U6 from two table versions and the keys a statement touched (with multiplicity).

    A touched key still present in ``after`` logs an UPDATE (old = before, new = after
    value, even when equal); one gone from ``after`` logs a DELETE (new null); a key not
    in ``before`` (an insert or an unknown id) logs nothing. For value updates that must
    chain within one batch, use :func:`audit_updates` with the new values instead."""
    b = before.select(key, F.col(value).alias("old_value"))
    a = after.select(key, F.col(value).alias("_after"), F.lit(True).alias("_present"))
    rows = touched.select(key, seq).join(b, key).join(a, key, "left")
    out = rows.select(
        key,
        F.when(F.col("_present"), F.lit("UPDATE")).otherwise(F.lit("DELETE")).alias("operation"),
        "old_value",
        F.when(F.col("_present"), F.col("_after")).alias("new_value"),
        seq)
    return stamp_audit(out, changed_at, changed_by)


def stamp_audit(audit: DataFrame, changed_at: datetime | None = None,
                changed_by: str | None = None) -> DataFrame:
    """Add the change time and user (one value per batch, like the column defaults)."""
    return audit.withColumns({
        "changed_at": F.lit(changed_at or datetime.now()).cast("timestamp_ntz"),
        "changed_by": F.lit(changed_by) if changed_by else F.expr("current_user()"),
    })


def latest_change(audit: DataFrame, key: str = "shipment_id",
                  order: list[str] | None = None) -> DataFrame:
    """T5: the newest audit row per key (``order by changed_at desc limit 1`` per key).
    ``max_by`` is an aggregate with a partial step (a sort aggregate, as its struct buffer
    has no fixed width), so a hot key stays bounded."""
    cols = [c for c in audit.columns if c != key]
    ordering = order or ["step", "seq"]
    picked = audit.groupBy(key).agg(
        F.max_by(F.struct(*cols), F.struct(*ordering)).alias("_l"))
    return picked.select(key, *[F.col(f"_l.{c}").alias(c) for c in cols])


# --- one-pass batch -------------------------------------------------------------------------

def change_table(adjustments: DataFrame, updates: DataFrame, deletes: DataFrame, dtype: str,
                 key: str = "shipment_id") -> DataFrame:
    """One row per id from the three change sets: their union has one exchange, with the
    map-side partial aggregate in front of it (no full outer joins). Holds the sum, number
    and least of the added hours, the last new value, the number of updates, and flags."""
    nul = F.lit(None)

    def tag(df, add=nul, val=nul, seq=nul, upd=False, gone=False):
        return df.select(key, add.cast("long").alias("_add"), val.cast(dtype).alias("_val"), seq.cast("long").alias("_seq"),
                         F.lit(upd).alias("_upd"), F.lit(gone).alias("_gone"))

    tagged = (tag(adjustments, add=F.col("added_hours"))
              .unionByName(tag(updates, val=F.col("new_value"), seq=F.col("seq"), upd=True))
              .unionByName(tag(deletes, gone=True)))
    return tagged.groupBy(key).agg(
        F.sum("_add").alias("_add"), F.count("_add").alias("_adds"), F.min("_add").alias("_least"),
        F.max(F.when(F.col("_upd"), _bad_value(F.col("_val"), dtype))).alias("_bad"),
        F.max_by(F.col("_val"), F.when(F.col("_upd"), F.col("_seq"))).alias("_new"),
        F.count_if("_upd").alias("_updates"),
        F.when(F.max(F.col("_gone").cast("int")) == 1, F.lit(True)).alias("_del"))


def staged(df: DataFrame, path: str) -> DataFrame:
    """The frame written under ``path`` and read back."""
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Ids with several changes, one of which takes hours away: their order matters.
UNORDERED = "_adds > 1 and _least < 0"
FEW = 10_000                   # changes of one id that a plain window may hold


class OrderNeeds(NamedTuple):
    """The most changes an id has whose order matters (0: none has)."""

    adds: int
    updates: int

    @classmethod
    def of(cls, changes: DataFrame) -> OrderNeeds:
        """From a stored change table, in one small job."""
        r = changes.agg(F.max(F.when(F.expr(UNORDERED), F.col("_adds"))), F.max(F.when(F.col("_updates") > 1, F.col("_updates")))).first()
        return cls(r[0] or 0, r[1] or 0)


def with_lowest(changes: DataFrame, adjustments: DataFrame, needs: OrderNeeds, key: str = "shipment_id") -> DataFrame:
    """The stored change table with ``_low``, the lowest point of each id's running hours.

    One change is its own lowest point, and changes that add never go below the start;
    only ids with several changes of which one takes hours away are put in order: by a
    window where each has few, cut into slices where one has many."""
    plain = changes.withColumn("_low", F.when(~F.expr(UNORDERED), F.col("_least")))
    if not needs.adds:
        return plain
    rows = adjustments.join(changes.where(UNORDERED).select(key), key, "left_semi")
    if needs.adds <= FEW:
        run = F.sum(F.col("added_hours").cast("long")).over(Window.partitionBy(key).orderBy("seq").rowsBetween(Window.unboundedPreceding, 0))
        low = rows.withColumn("_run", run).groupBy(key).agg(F.min("_run").alias("_run"))
    else:
        low = lowest_running_sum(rows, key, "seq", "added_hours").select(key, F.col("_low").alias("_run"))
    return plain.join(low, key, "left").withColumn("_low", F.coalesce("_low", "_run")).drop("_run")


def apply_changes(fact: DataFrame, changes: DataFrame, key: str = "shipment_id",
                  value: str = "shipment_value", hours: str = "shipping_time_hours") -> DataFrame:
    """The fact after a batch (its change table with ``_low``), by one left join. It fails
    where a statement of the batch would: hours and values are checked after every one,
    also of rows that are deleted in the end."""
    dtype = dict(fact.dtypes)[value]
    checked = enforce(fact.join(changes, key, "left"), {
        f"{hours} >= 0": F.col(hours) + F.least(F.coalesce("_low", F.lit(0)), F.lit(0)) >= 0,
        f"{value} not null and >= 0": F.coalesce("_bad", F.lit(0)) == 0}, "shipment", keep=F.col("_del").isNull())
    return (checked
            .withColumn(hours, (F.col(hours) + F.coalesce(F.col("_add"), F.lit(0))).cast("int"))
            .withColumn(value, F.when(F.col("_updates") > 0, F.col("_new").cast(dtype)).otherwise(F.col(value)))
            .select(*fact.columns))


def audit_batch(fact: DataFrame, changes: DataFrame, needs: OrderNeeds, adjustments: DataFrame, updates: DataFrame, deletes: DataFrame,
                key: str = "shipment_id", value: str = "shipment_value", stage: str | None = None) -> DataFrame:
    """The audit rows (U6) of a batch with ``step`` 1/2/3. The current values of the touched
    ids are all it needs of the fact: written once under ``stage`` if given, else found in
    the fact by each of the steps. Where an id has very many updates, their chain is cut
    into slices (:func:`lag_within_key`); otherwise a window by id follows it."""
    dtype = dict(fact.dtypes)[value]
    current = fact.select(key, value).join(changes.select(key), key, "left_semi")
    if stage:
        current = staged(current, stage)
    a1 = audit_updates(current, adjustments.select(key, "seq")).withColumn("step", F.lit(1))
    if needs.updates <= FEW:
        t = updates.join(current, key).withColumn("_new", F.col("new_value").cast(dtype))
        before = F.lag("_new").over(Window.partitionBy(key).orderBy("seq"))
        first = F.row_number().over(Window.partitionBy(key).orderBy("seq")) == 1
        a2 = t.select(key, F.lit("UPDATE").alias("operation"), F.when(first, F.col(value)).otherwise(before).alias("old_value"),
                      F.col("_new").alias("new_value"), "seq")
    else:
        a2 = audit_updates(current, updates, new="new_value")
    a2 = a2.withColumn("step", F.lit(2))
    last = changes.where("_updates > 0").select(key, F.col("_new"), F.lit(True).alias("_hit"))
    valued = (current.join(last, key, "left")
              .select(key, F.when(F.col("_hit"), F.col("_new").cast(dtype)).otherwise(F.col(value)).alias(value)))
    a3 = audit_deletes(valued, deletes).withColumn("step", F.lit(3))
    return a1.unionByName(a2).unionByName(a3)


def apply_batch(fact: DataFrame, adjustments: DataFrame, updates: DataFrame, deletes: DataFrame,
                key: str = "shipment_id", value: str = "shipment_value",
                hours: str = "shipping_time_hours", stage: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Delays (U3), then value updates (U4), then deletes (U5), with their audit (U6),
    rewriting the fact with a single join.

    The three change kinds commute on this table: delays touch only the hours, value
    updates are keyed by id and set a value, deletes are keyed by id. So the change sets
    are first reduced to one row per id and written once, under ``stage`` (by default a
    folder of the shared scratch space); what follows joins that table (a broadcast when
    small). The result equals applying :func:`apply_delays`, :func:`apply_values` and
    :func:`delete_keys` in turn, and it fails where one of those would.
    Returns ``(after, audit)``; audit rows carry ``step`` 1/2/3 like the sequential run.
    """
    dtype = dict(fact.dtypes)[value]
    table = staged(change_table(adjustments, updates, deletes, dtype, key), stage or scratch_path(fact.sparkSession, "changes"))
    needs = OrderNeeds.of(table)
    after = apply_changes(fact, with_lowest(table, adjustments, needs, key), key, value, hours)
    return after, audit_batch(fact, table, needs, adjustments, updates, deletes, key, value)
