"""Compare-and-commit, days replaced as a whole, and change batches on the live fact."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from starmart.operators import changes as U
from starmart.operators import quality as Q
from starmart.plans import retail_job as RP
from starmart.plans import run_log
from starmart.plans import supply_job as SP
from starmart.sources import files, snapshots, versions

SF = "/root/testdata/sf0.001"
NOW = datetime(2026, 2, 22, 3, 4, 5)


def ids(spark, root):
    return sorted(r.id for r in versions.read_current(spark, root).collect())


def test_interleaved_writers_keep_both_changes(spark, tmp_root):
    """B commits while A is between its write and its commit; A reads again and re-applies."""
    root, tries = f"{tmp_root}/t", []
    versions.write_version(spark.range(3), root)

    def add(n, batch, meanwhile=None):
        def change(now):
            tries.append(batch)
            if meanwhile and tries.count(batch) == 1:
                guard = lambda v: (meanwhile(), {})[1]
            else:
                guard = None
            df = versions.read_commit(spark, root, now).union(spark.range(n, n + 1))
            return versions.write_version(df, root, batch, base=now, reads=True, guard=guard)
        return versions.update(spark, root, change, batch)

    add(100, "A", lambda: add(200, "B"))
    assert ids(spark, root) == [0, 1, 2, 100, 200] and tries == ["A", "B", "A"]
    log = versions.commit_log(spark, root).orderBy("seq").collect()
    assert [r.batch for r in log] == ["", "B", "A"]
    for r in log:                                   # a listed batch's rows are in every later version
        c = versions.commit_at(spark, root, r.seq)
        got = {x.id for x in versions.read_commit(spark, root, c).collect()}
        assert {"B": {200}, "A": {100, 200}}.get(r.batch, set()) <= got
    assert add(100, "A") is None and ids(spark, root) == [0, 1, 2, 100, 200]


def test_a_commit_on_an_old_base_is_refused(spark, tmp_root):
    root = f"{tmp_root}/t"
    versions.write_version(spark.range(3), root)
    old = versions.latest(spark, root)
    versions.write_version(spark.range(5), root)
    with pytest.raises(versions.VersionConflict):
        versions.write_version(spark.range(9), root, "late", base=old, reads=True)
    assert ids(spark, root) == list(range(5)) and "late" not in versions.committed_batches(spark, root)
    versions.write_version(spark.range(7), root, base=None, reads=False)     # a full reload reads nothing
    assert len(ids(spark, root)) == 7
    with pytest.raises(versions.VersionConflict):                            # read before the first version existed
        versions.write_version(spark.range(1), root, base=None, reads=True)


def test_many_writers_at_once(spark, tmp_root):
    from starmart.session import run_concurrently
    root = f"{tmp_root}/t"
    versions.write_version(spark.range(1), root)

    def add(n):
        def change(now):
            df = versions.read_commit(spark, root, now).union(spark.range(n, n + 1))
            return versions.write_version(df.coalesce(1), root, f"b{n}", base=now, reads=True)
        versions.update(spark, root, change, f"b{n}")

    run_concurrently([lambda n=n: add(n) for n in range(10, 15)])
    assert ids(spark, root) == [0, 10, 11, 12, 13, 14]
    assert versions.commit_log(spark, root).select("seq").distinct().count() == 6


def test_writers_of_different_parts_do_not_conflict(spark, tmp_root):
    root = f"{tmp_root}/t"
    rows = lambda lo, p: spark.range(lo, lo + 2).withColumn("p", F.lit(p))
    versions.write_version(rows(0, "a").union(rows(10, "b")), root, partition_by="p")
    base = versions.latest(spark, root)
    versions.write_version(rows(20, "a"), root, base=base, reads=True, partition_by="p", replace=["p=a"])
    versions.write_version(rows(30, "b"), root, base=base, reads=True, partition_by="p", replace=["p=b"])
    assert ids(spark, root) == [20, 21, 30, 31]
    with pytest.raises(versions.VersionConflict):
        versions.write_version(rows(40, "a"), root, base=base, reads=True, partition_by="p", replace=["p=a"])
    with pytest.raises(ValueError, match="outside"):
        versions.write_version(rows(40, "c"), root, partition_by="p", replace=["p=a"])
    assert ids(spark, root) == [20, 21, 30, 31]


def test_vacuum_keeps_parts_of_earlier_versions(spark, tmp_root):
    root = f"{tmp_root}/t"
    rows = lambda lo, p: spark.range(lo, lo + 2).withColumn("p", F.lit(p))
    versions.write_version(rows(0, "a").union(rows(10, "b")), root, partition_by="p")
    for lo in (20, 30, 40):
        versions.write_version(rows(lo, "a"), root, partition_by="p", replace=["p=a"])
    assert versions.vacuum(spark, root, keep=1) == [2, 3]
    assert ids(spark, root) == [10, 11, 40, 41]                     # version 1 still holds p=b
    assert versions.names(spark, f"{root}/v=1") and "p=a" not in versions.names(spark, f"{root}/v=1")


def test_vacuum_spares_a_slow_writer(spark, tmp_root):
    root = f"{tmp_root}/t"
    slow, path = versions.claim_version(spark, root)
    for n in (1, 2, 3):
        versions.write_version(spark.range(n), root)
    spark.range(50).write.parquet(path)
    assert slow not in versions.vacuum(spark, root, keep=1, dead_after_hours=24)
    versions.commit_version(spark, root, slow)
    assert len(ids(spark, root)) == 50
    dead, _ = versions.claim_version(spark, root)
    versions.write_version(spark.range(4), root)
    versions.vacuum(spark, root, keep=1)
    with pytest.raises(RuntimeError, match="not open"):            # its claim is gone: it cannot publish
        versions.commit_version(spark, root, dead)


def test_an_empty_rerun_replaces_the_day(spark, tmp_root):
    arc, df = f"{tmp_root}/arc", spark.range(5).withColumn("x", F.lit("a"))
    for day in ("2026-02-22", "2026-02-23"):
        snapshots.snapshot(df, arc, day)
    snapshots.snapshot(df.limit(0), arc, "2026-02-22")
    assert snapshots.read_snapshot(spark, arc, "2026-02-22").count() == 0 and snapshots.has_day(spark, arc, "2026-02-22")
    assert snapshots.read_snapshot(spark, arc, "2026-02-23").count() == 5
    assert {str(r.snapshot_date): r.row_count for r in snapshots.day_counts(spark, arc).collect()} == {"2026-02-22": 0, "2026-02-23": 5}
    fact = f"{tmp_root}/fact"
    files.write_fact(df, fact, "append", "2026-02-22")
    files.write_fact(df.limit(0), fact, "append", "2026-02-22")
    assert versions.read_current(spark, fact).count() == 0


def test_a_failed_rerun_leaves_the_day(spark, tmp_root):
    arc = f"{tmp_root}/arc"
    snapshots.snapshot(spark.range(5), arc, "2026-02-22")
    with pytest.raises(Exception):
        snapshots.snapshot(spark.range(5).withColumn("x", F.raise_error(F.lit("lost"))), arc, "2026-02-22")
    assert snapshots.read_snapshot(spark, arc, "2026-02-22").count() == 5


def test_a_header_only_rerun_stops_before_silver(spark, tmp_root):
    from tests.test_jobs import feed_with
    wh = f"{tmp_root}/wh"
    files.write_csv(feed_with(spark), f"{tmp_root}/good")
    RP.run_retail(spark, f"{tmp_root}/good", wh, date(2026, 2, 22))
    files.write_csv(feed_with(spark).limit(0), f"{tmp_root}/none")
    header = f"{tmp_root}/header.csv"
    with open(header, "w") as fh:
        fh.write(",".join(feed_with(spark).columns) + "\n")
    with pytest.raises(ValueError, match="no Bronze rows"):
        RP.run_retail(spark, header, wh, date(2026, 2, 22))
    log = {r.outcome: r.status for r in run_log.last_status(spark, wh, "retail").collect()}
    assert log == {"SUCCESS": "ERROR", "FAILED": "ValueError: the batch has no Bronze rows"}      # too few rows for the monitor's floor
    with pytest.raises(run_log.AuditError, match="bronze_rows"):
        RP.run_retail(spark, f"{tmp_root}/good", wh, date(2026, 2, 23), "strict", fail_on_error=True)
    assert run_log.runs(spark, wh).where("run_id = 'strict' and outcome = 'SUCCESS'").count() > 5
    p = RP.paths(wh)
    assert snapshots.read_snapshot(spark, p["archive"], "2026-02-22").count() == 0
    assert spark.read.parquet(p["silver_tx"]).count() == 2


# --- change batches ------------------------------------------------------------------------------

@pytest.fixture()
def live(spark, tmp_root):
    SP.load_star(spark, SF, tmp_root, natural_ids=True)
    return tmp_root


def hours(spark, root):
    return {r.shipment_id: r.shipping_time_hours for r in SP.shipments(spark, root).collect()}


def delays(spark, rows):
    return SP.feed_rows(spark, spark.createDataFrame(rows, "shipment_id long, added_hours int, seq int"))


def test_two_batches_in_turn_leave_both_effects(spark, live):
    before = hours(spark, live)
    a, b = sorted(before)[:2]
    SP.publish_batch(spark, live, "one", delays(spark, [(a, 10, 1), (b, 1, 1)]))
    SP.apply_pending(spark, live, NOW, "t")
    SP.publish_batch(spark, live, "two", delays(spark, [(b, 5, 1)]))
    SP.publish_batch(spark, live, "three", delays(spark, [(b, 7, 1), (12345, 1, 1)]))
    assert [r["batch"] for r in SP.apply_pending(spark, live, NOW, "t")] == ["two", "three"]
    after = hours(spark, live)
    assert after[a] == before[a] + 10 and after[b] == before[b] + 13 and SP.pending_batches(spark, live).count() == 0
    log = SP.audit_log(spark, live)
    assert sorted((r.batch_id, r.shipment_id) for r in log.collect()) == sorted([("one", a), ("one", b), ("two", b), ("three", b)])
    assert log.select("audit_id").distinct().count() == 4
    assert SP.apply_pending(spark, live) == []
    with pytest.raises(ValueError, match="applied already"):
        SP.publish_batch(spark, live, "one", delays(spark, [(a, 1, 1)]))


def test_two_appliers_apply_each_batch_once(spark, live, monkeypatch):
    """The second applier takes batch and commit while the first stands before its commit."""
    before = hours(spark, live)
    a = min(before)
    SP.publish_batch(spark, live, "one", delays(spark, [(a, 10, 1)]))
    SP.publish_batch(spark, live, "two", delays(spark, [(a, 3, 1)]))
    real, state = versions.commit_version, {"first": True}

    def commit(spark, root, v, batch_id=""):
        if root.endswith("fact_shipments") and state["first"]:
            state["first"] = False
            SP.apply_pending(spark, live, NOW, "other")
        real(spark, root, v, batch_id)
    monkeypatch.setattr(versions, "commit_version", commit)
    out = SP.apply_pending(spark, live, NOW, "t")
    assert [r["applied"] for r in out] == [False, False] and hours(spark, live)[a] == before[a] + 13
    assert {r.changed_by for r in SP.audit_log(spark, live).collect()} == {"other"} and SP.audit_log(spark, live).count() == 2


def test_a_run_that_dies_before_the_commit_is_applied_later_once(spark, live, monkeypatch):
    a = min(before := hours(spark, live))
    SP.publish_batch(spark, live, "one", delays(spark, [(a, 10, 1)]))
    real = versions.commit_version

    def dies(spark, root, v, batch_id=""):
        raise OSError("lost before the commit")
    monkeypatch.setattr(versions, "commit_version", dies)
    with pytest.raises(OSError):
        SP.apply_pending(spark, live)
    monkeypatch.setattr(versions, "commit_version", real)
    assert hours(spark, live) == before and SP.audit_log(spark, live).count() == 0
    SP.apply_pending(spark, live)
    assert hours(spark, live)[a] == before[a] + 10 and SP.audit_log(spark, live).count() == 1
    assert spark.read.parquet(SP.log_path(live)).count() == 1      # the dead attempt's rows are gone


def test_a_batch_that_breaks_a_rule_changes_nothing(spark, live):
    a = min(before := hours(spark, live))
    SP.publish_batch(spark, live, "bad", delays(spark, [(a, -10_000, 1)]))
    with pytest.raises(Exception, match="shipping_time_hours"):
        SP.apply_pending(spark, live)
    assert hours(spark, live) == before and SP.pending_batches(spark, live).count() == 1
    SP.publish_batch(spark, live, "bad", delays(spark, [(a, 1, 1)]))          # published again, corrected
    assert SP.apply_pending(spark, live)[0]["applied"] and hours(spark, live)[a] == before[a] + 1


@pytest.mark.parametrize("few", [0, U.FEW])
def test_hours_are_checked_in_the_order_of_the_statements(spark, live, monkeypatch, few):
    """By windows, and cut into slices as for ids with very many changes."""
    monkeypatch.setattr(U, "FEW", few)
    a, b = sorted(before := hours(spark, live))[:2]
    fall = before[b] + 1
    SP.publish_batch(spark, live, "dips", delays(spark, [(a, 5, 1), (a, -3, 2), (b, fall, 1), (b, -fall, 2)]))
    SP.apply_pending(spark, live)
    assert hours(spark, live)[a] == before[a] + 2 and hours(spark, live)[b] == before[b]
    SP.publish_batch(spark, live, "deep", delays(spark, [(b, -fall, 1), (b, fall, 2)]))
    with pytest.raises(Exception, match="shipping_time_hours"):
        SP.apply_pending(spark, live)


@pytest.mark.parametrize("few", [0, U.FEW])
def test_updates_of_one_id_are_chained(spark, live, monkeypatch, few):
    monkeypatch.setattr(U, "FEW", few)
    a, b = sorted(hours(spark, live))[:2]
    old = {r.shipment_id: r.shipment_value for r in SP.shipments(spark, live).collect()}
    new = spark.createDataFrame([(a, "5.00", 1), (a, "7.00", 3), (a, "6.00", 2), (b, "1.00", 1)], "shipment_id long, new_value string, seq int")
    SP.publish_batch(spark, live, "one", SP.feed_rows(spark, updates=new))
    SP.apply_pending(spark, live)
    log = [(r.shipment_id, r.seq, float(r.old_value), float(r.new_value)) for r in SP.audit_log(spark, live).collect()]
    assert sorted(log) == sorted([(a, 1, float(old[a]), 5.0), (a, 2, 5.0, 6.0), (a, 3, 6.0, 7.0), (b, 1, float(old[b]), 1.0)])
    assert float(SP.shipments(spark, live).where(F.col("shipment_id") == a).first().shipment_value) == 7.0


def test_untouched_years_are_neither_read_nor_written(spark, live):
    root = SP.facts_path(live)
    now = versions.latest(spark, root)
    one = SP.shipments(spark, live).where(F.floor(F.col("date_id") / 10000) == 1995)
    SP.publish_batch(spark, live, "one", delays(spark, [(r.shipment_id, 1, 1) for r in one.limit(5).collect()]))
    SP.apply_pending(spark, live)
    after = versions.latest(spark, root)
    assert {p for p in now.parts if now.parts[p] != after.parts[p]} == {"ship_year=1995"}
    assert versions.names(spark, f"{root}/v={after.version}") and len([n for n in versions.names(spark, f"{root}/v={after.version}") if "=" in n]) == 1
    plan = versions.read_commit(spark, root, now, ["ship_year=1995"])._jdf.queryExecution().executedPlan().toString()
    assert "1 paths" in plan or plan.count("ship_year=1996") == 0
    pruned = versions.read_current(spark, root).where("ship_year = 1995")
    assert "PartitionFilters: [isnotnull(ship_year" in pruned._jdf.queryExecution().executedPlan().toString()
    assert pruned.select(F.input_file_name().alias("f")).distinct().where("f not like '%ship_year=1995%'").count() == 0


def test_years_that_lose_all_rows_leave_the_table(spark, live):
    gone = SP.shipments(spark, live).where(F.floor(F.col("date_id") / 10000) == 1998).select("shipment_id", F.lit(1).alias("seq"))
    left = SP.shipments(spark, live).count() - gone.count()
    SP.publish_batch(spark, live, "drop", SP.feed_rows(spark, deletes=gone))
    SP.apply_pending(spark, live)
    assert SP.shipments(spark, live).count() == left


def test_rules_are_counted_by_the_write(spark, tmp_root):
    good = SP.build_star(spark, SF).fact_shipments
    rules = Q.ObservedRules(good, "supply.fact_shipments")
    rules.rows.write.parquet(f"{tmp_root}/a")
    assert rules.check() == {"rows": good.count()}
    bad = Q.ObservedRules(good.withColumn("quantity", F.when(F.col("order_id") % 7 == 0, 0).otherwise(F.col("quantity"))), "supply.fact_shipments")
    bad.rows.write.parquet(f"{tmp_root}/b")
    with pytest.raises(Q.ConstraintError, match="quantity_positive"):
        bad.check()
    none = Q.ObservedRules(good.limit(0), "supply.fact_shipments")
    none.rows.write.parquet(f"{tmp_root}/c")
    assert none.check() == {"rows": 0}


def test_view_and_reload(spark, live):
    assert SP.register_views(spark, live) == ["shipment_summary"]
    n = spark.sql("SELECT sum(shipment_count) FROM shipment_summary").first()[0]
    assert n == SP.shipments(spark, live).count()
    SP.publish_batch(spark, live, "one", delays(spark, [(min(hours(spark, live)), 1, 1)]))
    SP.apply_pending(spark, live)
    end = SP.audit_end(versions.latest(spark, SP.facts_path(live)))
    changed = hours(spark, live)
    SP.load_star(spark, SF, live, natural_ids=True)        # a reload goes on with the audit ids; the batch is pending again
    assert end >= 1 and SP.audit_end(versions.latest(spark, SP.facts_path(live))) == end
    assert versions.committed_batches(spark, SP.facts_path(live)) == {} and hours(spark, live) != changed
    assert [r["batch"] for r in SP.apply_pending(spark, live)] == ["one"] and hours(spark, live) == changed
    assert SP.audit_log(spark, live).select("audit_id").distinct().count() == 2
