"""Hot keys: a key holding a third of the rows must not end up in one task."""

import pytest
from pyspark.sql import functions as F

from starmart.operators import clean as C
from starmart.operators import joins as J

N, HOT_SHARE = 30_000, 3


@pytest.fixture()
def no_broadcast(spark):
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold",
            "spark.sql.adaptive.enabled"]
    old = {k: spark.conf.get(k, None) for k in keys}
    for k in keys[:2]:
        spark.conf.set(k, "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # fixed partitions for the check
    yield
    for k, v in old.items():
        if v is not None:
            spark.conf.set(k, v)


def facts(spark):
    return spark.range(0, N).select(
        F.when(F.col("id") % HOT_SHARE == 0, F.lit("UNKNOWN"))
         .otherwise(F.concat(F.lit("c"), (F.col("id") % 997).cast("string"))).alias("raw_customer_id"),
        F.col("id").alias("line"))


def dim(spark):
    return spark.range(0, 997).select(F.concat(F.lit("c"), F.col("id").cast("string")).alias("raw_customer_id"),
                                      (F.col("id") + 2).alias("customer_id")) \
        .unionByName(spark.createDataFrame([("UNKNOWN", 1)], "raw_customer_id string, customer_id long"))


def hot_rows_per_task(df):
    """Rows of the sentinel in each task of the join stage."""
    per = (df.withColumn("p", F.spark_partition_id()).filter("raw_customer_id = 'UNKNOWN'")
           .groupBy("p").count().collect())
    return sorted(r["count"] for r in per)


def test_salted_lookup_spreads_the_sentinel(spark, no_broadcast):
    hot_rows = N // HOT_SHARE
    plain = J.resolve_keys(facts(spark), dim(spark), "raw_customer_id", "customer_id")
    salted = J.resolve_keys(facts(spark), dim(spark), "raw_customer_id", "customer_id",
                            hot_values=["UNKNOWN"], buckets=16)
    assert "SortMergeJoin" in salted._jdf.queryExecution().executedPlan().toString()
    assert hot_rows_per_task(plain) == [hot_rows]   # unsalted: the sentinel sits in one task
    spread = hot_rows_per_task(salted)
    assert len(spread) >= 4 and max(spread) < hot_rows / 2 and sum(spread) == hot_rows
    assert salted.filter("customer_id is null").count() == 0
    assert salted.count() == N


def test_first_row_per_key_reduces_hot_key_map_side(spark, no_broadcast):
    rows = facts(spark).select(F.col("raw_customer_id").alias("customer_id"),
                               F.lit("X").alias("country"), F.col("line").cast("timestamp").alias("invoice_ts"),
                               F.col("line").cast("string").alias("invoice_no"), F.lit("S").alias("stock_code"))
    out = C.silver_customers(rows)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan  # map-side partial aggregate before the exchange
    assert out.filter("raw_customer_id = 'UNKNOWN'").count() == 1


def rows_per_task(df):
    """Rows of each task of the join stage (a column of the dimension keeps the join)."""
    per = df.where("product_id is not null").withColumn("p", F.spark_partition_id()).groupBy("p").count().collect()
    return sorted(r["count"] for r in per)


def test_measured_heavy_keys_spread_a_hot_product(spark, no_broadcast):
    """A product nobody declared holds 40 % of the sales, another 15 %: after salting by the
    sketch the largest task stays within three times the median."""
    f = spark.range(0, 60_000).select(
        F.when(F.col("id") % 20 < 8, F.lit("P-hot")).when(F.col("id") % 20 < 11, F.lit("P-warm"))
         .otherwise(F.concat(F.lit("p"), (F.col("id") % 1999).cast("string"))).alias("stock_code"), F.col("id").alias("line"))
    d = f.select("stock_code").distinct().withColumn("product_id", F.xxhash64("stock_code"))
    heavy = J.heavy_keys(f, ["stock_code"])["stock_code"]
    assert set(heavy) == {"P-hot", "P-warm"} and heavy["P-hot"] > 2 * heavy["P-warm"]
    plain = J.resolve_keys(f, d, "stock_code", "product_id")
    salted = J.resolve_keys(f, d, "stock_code", "product_id", salts=heavy)
    assert rows_per_task(plain)[-1] > 20_000
    per = rows_per_task(salted)
    assert sum(per) == 60_000 and per[-1] <= 3 * per[len(per) // 2]
    assert salted.where(F.col("product_id") != F.xxhash64("stock_code")).count() == 0 == salted.where("product_id is null").count()


def test_heavy_report_is_exact(spark):
    f = facts(spark).withColumn("none", F.lit(None).cast("string"))
    got = {(r.key_column, r.value): r.row_count for r in J.heavy_report(f, ["raw_customer_id", "none"], 0.1).collect()}
    assert got == {("raw_customer_id", "UNKNOWN"): N // HOT_SHARE}
    assert J.heavy_keys(f.limit(0), ["raw_customer_id"]) == {"raw_customer_id": {}}
