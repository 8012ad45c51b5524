"""Dimensions, surrogate keys, upserts, keyed changes and their audit."""

from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from starmart.operators import changes as U
from starmart.operators import dims as D


def test_dim_time_reference_range(spark):
    d = D.dim_time(spark, "2024-01-01", "2025-12-31")
    assert d.count() == 731
    jan1 = d.filter("date_id = 20240101").first()
    assert (jan1["day_of_week"], jan1["day_name"], jan1["month_name"], jan1["is_weekend"]) == \
        (1, "Monday", "January", False)


def test_iso_week_with_calendar_year(spark):
    d = D.dim_time(spark, "2011-01-01", "2011-01-02").orderBy("date_id").collect()
    assert (d[0]["year"], d[0]["week"], d[0]["is_weekend"]) == (2011, 52, True)


def test_assign_keys_matches_row_number(spark):
    m = spark.range(0, 5000).select(F.concat(F.lit("K"), F.col("id").cast("string")).alias("nk"))
    keyed = D.assign_keys(m, "nk", "sk", num_partitions=7)
    ref = m.withColumn("rn", F.row_number().over(Window.orderBy("nk")))
    j = keyed.join(ref, "nk")
    assert j.filter("sk != rn").count() == 0 and keyed.count() == 5000


def test_assign_keys_keeps_existing(spark):
    existing = spark.createDataFrame([(10, "b"), (3, "d")], "sk long, nk string")
    members = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "nk string")
    out = {r["nk"]: r["sk"] for r in D.assign_keys(members, "nk", "sk", existing).collect()}
    assert out == {"b": 10, "d": 3, "a": 11, "c": 12}


def test_upsert_ignore_twice_is_once(spark):
    t = spark.createDataFrame([(1, "x")], "k int, v string")
    s = spark.createDataFrame([(1, "changed"), (2, "y")], "k int, v string")
    once = U.upsert_ignore(t, s, "k")
    twice = U.upsert_ignore(once, s, "k")
    assert sorted(map(tuple, twice.collect())) == [(1, "x"), (2, "y")]


def test_upsert_update_type1(spark):
    t = spark.createDataFrame([(1, "A", "old"), (2, "B", "keep")], "id long, code string, d string")
    s = spark.createDataFrame([("A", None), ("C", "new")], "code string, d string")
    out = sorted(map(tuple, U.upsert_update(t, s, "code", "id", ["d"]).collect()))
    assert out == [(1, "A", None), (2, "B", "keep"), (3, "C", "new")]


FACT = "shipment_id long, shipment_value decimal(12,2), shipping_time_hours int"


def fact(spark):
    return spark.createDataFrame([(1, Decimal("10.00"), 20), (2, Decimal("5.00"), 30),
                                  (3, Decimal("7.00"), 40)], FACT)


def test_apply_delays_adds_repeats(spark):
    adj = spark.createDataFrame([(1, 24, 1), (1, 24, 2), (9, 5, 1)], "shipment_id long, added_hours int, seq int")
    out = {r["shipment_id"]: r["shipping_time_hours"] for r in U.apply_delays(fact(spark), adj).collect()}
    assert out == {1: 68, 2: 30, 3: 40}


def test_negative_delay_fails(spark):
    import pytest
    adj = spark.createDataFrame([(2, -31, 1)], "shipment_id long, added_hours int, seq int")
    with pytest.raises(Exception, match="violates"):
        U.apply_delays(fact(spark), adj).collect()


def changes(spark, delays=(), values=(), gone=()):
    return (spark.createDataFrame(list(delays), "shipment_id long, added_hours int, seq int"),
            spark.createDataFrame(list(values), "shipment_id long, new_value decimal(12,2), seq int"),
            spark.createDataFrame(list(gone), "shipment_id long, seq int"))


@pytest.mark.parametrize("batch", [
    {"delays": [(1, -100, 1), (1, 200, 2)]},                                  # 20 hours: negative after the first
    {"values": [(2, Decimal("-5.00"), 1), (2, Decimal("7.00"), 2)]},
    {"values": [(2, None, 1), (2, Decimal("7.00"), 2)]},
    {"values": [(3, Decimal("-1.00"), 1)], "gone": [(3, 1)]},                  # deleted afterwards
    {"delays": [(3, -41, 1)], "gone": [(3, 1)]}])
def test_every_statement_is_checked(spark, batch):
    f, (adj, upd, dele) = fact(spark), changes(spark, **batch)
    with pytest.raises(Exception, match="violates"):
        U.apply_batch(f, adj, upd, dele)[0].collect()
    with pytest.raises(Exception, match="violates"):
        U.delete_keys(U.apply_values(U.apply_delays(f, adj), upd), dele).collect()
        U.apply_values(U.apply_delays(f, adj), upd).collect()


def test_changes_of_unknown_ids_are_not_checked(spark):
    f, (adj, upd, dele) = fact(spark), changes(spark, [(77, -500, 1)], [(77, Decimal("-5.00"), 1)])
    assert U.apply_batch(f, adj, upd, dele)[0].count() == 3


def test_lowest_running_sum_of_a_hot_key(spark):
    rng = __import__("random").Random(3)
    rows = [(7, s, rng.randint(-9, 9)) for s in range(2000)] + [(k, s, rng.randint(-9, 9)) for k in range(5) for s in range(10)]
    got = {r.k: (r._add, r._low) for r in U.lowest_running_sum(
        spark.createDataFrame(rng.sample(rows, len(rows)), "k long, s int, v int"), "k", "s", "v", num_partitions=6).collect()}
    for k in {r[0] for r in rows}:
        run, low = 0, 10**9
        for _, _, v in sorted(r for r in rows if r[0] == k):
            run += v
            low = min(low, run)
        assert got[k] == (run, low)


def test_repeated_source_key_fails_the_merge(spark):
    t = spark.createDataFrame([(1, "A", "old")], "id long, code string, d string")
    s = spark.createDataFrame([("A", "x"), ("A", "y")], "code string, d string")
    with pytest.raises(Exception, match="repeats"):
        U.upsert_update(t, s, "code", "id", ["d"]).collect()


def test_apply_values_last_seq_wins_and_chained_audit(spark):
    f = fact(spark)
    upd = spark.createDataFrame([(1, Decimal("110.00"), 1), (1, Decimal("210.00"), 2), (99, Decimal("1"), 1)],
                                "shipment_id long, new_value decimal(12,2), seq int")
    out = {r["shipment_id"]: r["shipment_value"] for r in U.apply_values(f, upd).collect()}
    assert out[1] == Decimal("210.00") and out[2] == Decimal("5.00")
    audit = sorted(map(tuple, U.audit_updates(f, upd, new="new_value")
                       .select("shipment_id", "old_value", "new_value", "seq").collect()))
    assert audit == [(1, Decimal("10.00"), Decimal("110.00"), 1), (1, Decimal("110.00"), Decimal("210.00"), 2)]


def test_delay_only_update_is_audited_with_same_value(spark):
    touched = spark.createDataFrame([(2, 1)], "shipment_id long, seq int")
    a = U.audit_updates(fact(spark), touched).first()
    assert (a["operation"], a["old_value"], a["new_value"]) == ("UPDATE", Decimal("5.00"), Decimal("5.00"))


def test_delete_and_audit(spark):
    f = fact(spark)
    keys = spark.createDataFrame([(3, 1), (3, 2), (42, 1)], "shipment_id long, seq int")
    assert sorted(r["shipment_id"] for r in U.delete_keys(f, keys).collect()) == [1, 2]
    a = U.audit_deletes(f, keys).collect()
    assert len(a) == 1 and a[0]["operation"] == "DELETE" and a[0]["new_value"] is None


def test_lag_within_key_hot_key_spans_partitions(spark):
    # one key holds most rows, so it is cut across several range partitions
    hot = spark.range(0, 3000).select(F.lit(7).cast("long").alias("k"), F.col("id").alias("s"),
                                      (F.col("id") * 2).alias("v"))
    cold = spark.range(0, 300).select((F.col("id") % 13).alias("k"), (F.col("id") + 5000).alias("s"),
                                      F.col("id").alias("v"))
    df = hot.unionByName(cold)
    got = U.lag_within_key(df, "k", "s", "v", "p", num_partitions=6)
    ref = df.withColumn("p_ref", F.lag("v").over(Window.partitionBy("k").orderBy("s"))) \
            .withColumn("first_ref", F.row_number().over(Window.partitionBy("k").orderBy("s")) == 1)
    j = got.join(ref, ["k", "s"])
    bad = j.filter(~F.col("p").eqNullSafe(F.col("p_ref")) | (F.col("p_is_first") != F.col("first_ref")))
    assert bad.count() == 0 and got.count() == 3300


def test_latest_change(spark):
    a = spark.createDataFrame([(1, "UPDATE", 1, 1), (1, "UPDATE", 2, 2), (1, "DELETE", 1, 3)],
                              "shipment_id long, operation string, seq int, step int")
    assert U.latest_change(a).first()["operation"] == "DELETE"


def test_one_pass_batch_equals_sequential(spark):
    from starmart.plans import supply_job as SP
    fact = SP.fact_with_ids(spark, "/root/testdata/sf0.001")
    seq = SP.apply_change_batch(fact)
    after, audit = SP.apply_change_batch_one_pass(fact)
    own = [c for c in after.columns if c != "created_at"]
    assert sorted(map(tuple, after.select(*own).collect())) == sorted(map(tuple, seq.after_deletes.select(*own).collect()))
    cols = ["shipment_id", "operation", "old_value", "new_value", "seq", "step"]
    assert sorted(map(tuple, audit.select(*cols).collect())) == sorted(map(tuple, seq.audit.select(*cols).collect()))
    assert audit.filter("step = 2").count() > 0 and audit.filter("step = 3").count() > 0


def test_assign_keys_edge_cases(spark):
    empty = spark.createDataFrame([], "nk string")
    assert D.assign_keys(empty, "nk", "sk").count() == 0
    existing = spark.createDataFrame([(5, "a")], "sk long, nk string")
    same = spark.createDataFrame([("a",)], "nk string")
    out = D.assign_keys(same, "nk", "sk", existing).collect()
    assert [(r["sk"], r["nk"]) for r in out] == [(5, "a")]
    none_yet = spark.createDataFrame([], "sk long, nk string")
    out = sorted((r["sk"], r["nk"]) for r in D.assign_keys(same, "nk", "sk", none_yet).collect())
    assert out == [(1, "a")]


@pytest.mark.parametrize("natural", [False, True])
def test_shipment_ids_are_unique_without_shuffle(spark, natural):
    from starmart.plans import supply_job as SP
    f = SP.fact_with_ids(spark, "/root/testdata/sf0.001", natural)
    f.write.format("noop").mode("overwrite").save()
    plan = f._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert f.select("shipment_id").distinct().count() == f.count() == 6000


def test_empty_change_sets(spark):
    f = fact(spark)
    adj = spark.createDataFrame([], "shipment_id long, added_hours int, seq int")
    upd = spark.createDataFrame([], "shipment_id long, new_value decimal(12,2), seq int")
    dele = spark.createDataFrame([], "shipment_id long, seq int")
    after, audit = U.apply_batch(f, adj, upd, dele)
    assert sorted(map(tuple, after.collect())) == sorted(map(tuple, f.collect()))
    assert audit.count() == 0
    assert U.audit_updates(f, upd, new="new_value").count() == 0


def test_audit_changes_from_two_versions(spark):
    before = fact(spark)
    after = before.filter("shipment_id != 3").withColumn(
        "shipment_value", F.when(F.col("shipment_id") == 1, F.lit(Decimal("99.00"))).otherwise(F.col("shipment_value")))
    touched = spark.createDataFrame([(1, 1), (2, 1), (3, 1), (42, 1)], "shipment_id long, seq int")
    rows = sorted((r["shipment_id"], r["operation"], r["old_value"], r["new_value"])
                  for r in U.audit_changes(before, after, touched).collect())
    assert rows == [(1, "UPDATE", Decimal("10.00"), Decimal("99.00")),
                    (2, "UPDATE", Decimal("5.00"), Decimal("5.00")),
                    (3, "DELETE", Decimal("7.00"), None)]
