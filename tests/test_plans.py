"""Physical-plan properties that matter at scale (checked on the executed plans)."""

from pyspark.sql import functions as F

from starmart.operators import clean as C
from starmart.operators import dims as D
from starmart.plans import retail as R
from starmart.plans import supply as SR
from starmart.plans.queries import retail_star
from starmart.sources import testbed as TB

SF = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_cleaning_pushes_filters_and_prunes_batch_columns(spark, tmp_root):
    from starmart.sources import files
    b = files.stamp_batch(TB.bronze(spark, SF))
    b.write.parquet(f"{tmp_root}/bronze")
    bronze = spark.read.parquet(f"{tmp_root}/bronze")
    df = C.silver_transactions(C.clean(bronze))
    df.write.format("noop").mode("overwrite").save()
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(unit_price,0.00)" in text and "IsNotNull(stock_code)" in text
    assert "batch_id" not in text.split("ReadSchema:")[1].split("\n")[0]
    # exactly one exchange (the dedup) between Bronze and Silver
    assert text.count("Exchange hashpartitioning") == 1


def test_job_cleaning_dedups_by_hash_without_batch_columns(spark, tmp_root):
    from starmart.sources import files
    files.stamp_batch(TB.bronze(spark, SF)).write.parquet(f"{tmp_root}/bronze")
    df, obs = C.clean_observed(spark.read.parquet(f"{tmp_root}/bronze"))
    df.write.format("noop").mode("overwrite").save()
    text = df._jdf.queryExecution().executedPlan().toString()
    assert obs.check()["bad_dates"] == 0
    assert "SortAggregate" not in text and "batch_id" not in text and "load_timestamp" not in text
    assert text.count("Exchange hashpartitioning") == 1


def test_foreign_keys_scan_the_fact_once(spark, tmp_root):
    from starmart.operators import joins as J
    from starmart.plans import supply_job as SP
    SP.build_star(spark, SF).fact_shipments.write.parquet(f"{tmp_root}/fact_shipments")
    f = spark.read.parquet(f"{tmp_root}/fact_shipments")
    s = SP.build_star(spark, SF)
    df = J.fk_report([("p", f, "product_id", s.dim_products, "product_id"), ("o", f, "order_id", s.dim_orders, "order_id")])
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert text.count("FileScan parquet") == 3 and "Expand" not in text     # the fact and two key columns


def test_profile_and_unresolved_keys_expand_nothing(spark, tmp_root):
    from starmart.operators import joins as J
    from starmart.operators import quality as QC
    TB.bronze(spark, SF).write.parquet(f"{tmp_root}/b")
    b = spark.read.parquet(f"{tmp_root}/b")
    for df in (QC.profile(b), J.unresolved_keys(b.withColumn("k", F.lit(None).cast("long")), {"d": ("k", "stock_code")})):
        df.collect()
        assert "Expand" not in df._jdf.queryExecution().executedPlan().toString()


def test_change_queries_keep_the_fact_in_place(spark):
    """Neither an id assignment nor a checkpoint of the fact; no audit lag unless asked."""
    from starmart.plans import supply_job as SP
    b = SP.apply_change_batch(SP.fact_with_ids(spark, SF))
    text = plan_of(b.after_deletes)
    assert "rangepartitioning(l_orderkey" not in text and "Scan ExistingRDD" not in text


def test_assign_keys_has_no_single_partition_exchange(spark):
    m = spark.range(0, 2000).select(F.col("id").cast("string").alias("nk"))
    keyed = D.assign_keys(m, "nk", "sk", num_partitions=4)
    text = plan_of(keyed)
    # only the per-partition counts (one row each) pass a single task
    assert text.count("SinglePartition") <= 1 and "rangepartitioning(nk" not in text.split("SinglePartition")[0]


def test_reports_aggregate_before_the_dimension_join(spark):
    s = retail_star(spark, SF)
    df = R.revenue_by_country(s.fact_sales, s.dim_customers)
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    # join input on the fact side is the per-customer aggregate, not the raw fact
    join_at = text.find("HashJoin")
    assert join_at > 0 and "HashAggregate(keys=[customer_id" in text[join_at:]


def test_calendar_is_broadcast_in_year_over_year(spark):
    from starmart.plans import supply_job as SP
    s = SP.build_star(spark, SF, with_ids=False)
    df = SR.supplier_yoy(s.fact_shipments, s.dim_suppliers, s.dim_time)
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text and "Window [lag(" in text
