"""Supply-chain star reports (five queries, the summary view, the year-over-year change).

Every report aggregates the shipment fact on its foreign key first and joins the
dimension to one row per member, then regroups by the dimension attribute (reports
group by *name*, so members sharing a name merge, as in the reference). Averages keep an
exact sum and a count through the partial/final aggregation and divide once at the end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _by_key(fact: DataFrame, key: str, **aggs) -> DataFrame:
    return fact.groupBy(key).agg(*[v.alias(k) for k, v in aggs.items()])


def _avg(sum_col: str, count_col: str) -> F.Column:
    """Average of exact numerics as an exact numeric, rounded half up once."""
    return F.round(F.sum(sum_col).cast("decimal(24,2)") / F.sum(count_col).cast("decimal(18,0)"), 2)


def quantity_by_category(fact: DataFrame, products: DataFrame) -> DataFrame:
    per = _by_key(fact, "product_id", _q=F.sum("quantity"))
    j = per.join(products.select("product_id", "product_category"), "product_id")
    g = j.groupBy("product_category").agg(F.sum("_q").alias("total_quantity"))
    return g.orderBy(F.desc("total_quantity"), "product_category")


def warehouse_efficiency(fact: DataFrame, warehouses: DataFrame) -> DataFrame:
    per = _by_key(fact, "warehouse_id", _h=F.sum("shipping_time_hours"),
                  _n=F.count("shipping_time_hours"))
    j = per.join(warehouses.select("warehouse_id", "warehouse_name"), "warehouse_id")
    g = j.groupBy("warehouse_name").agg(_avg("_h", "_n").alias("avg_shipping_time_hours"))
    return g.orderBy("avg_shipping_time_hours", "warehouse_name")


def value_by_supplier(fact: DataFrame, suppliers: DataFrame) -> DataFrame:
    per = _by_key(fact, "supplier_id", _v=F.sum("shipment_value"))
    j = per.join(suppliers.select("supplier_id", "supplier_name"), "supplier_id")
    g = j.groupBy("supplier_name").agg(F.round(F.sum("_v"), 2).alias("total_shipment_value"))
    return g.orderBy(F.desc("total_shipment_value"), "supplier_name")


def top_shipped_products(fact: DataFrame, products: DataFrame, n: int = 5) -> DataFrame:
    per = _by_key(fact, "product_id", _q=F.sum("quantity"))
    j = per.join(products.select("product_id", "product_name"), "product_id")
    g = j.groupBy("product_name").agg(F.sum("_q").alias("total_quantity"))
    return g.orderBy(F.desc("total_quantity"), "product_name").limit(n)


def value_distribution(fact: DataFrame, products: DataFrame) -> DataFrame:
    per = _by_key(fact, "product_id", _min=F.min("shipment_value"), _max=F.max("shipment_value"),
                  _v=F.sum("shipment_value"), _n=F.count("shipment_value"),
                  _c=F.count("shipment_id") if "shipment_id" in fact.columns else F.count(F.lit(1)))
    j = per.join(products.select("product_id", "product_category"), "product_id")
    g = j.groupBy("product_category").agg(
        F.min("_min").alias("min_shipment_value"),
        F.max("_max").alias("max_shipment_value"),
        _avg("_v", "_n").alias("avg_shipment_value"),
        F.round(F.sum("_v"), 2).alias("total_shipment_value"),
        F.sum("_c").alias("shipment_count"))
    return g.orderBy(F.desc("total_shipment_value"), "product_category")


def shipment_summary(fact: DataFrame, products: DataFrame) -> DataFrame:
    """The summary view: per category quantity, average hours, value and count."""
    per = _by_key(fact, "product_id", _q=F.sum("quantity"), _h=F.sum("shipping_time_hours"),
                  _hn=F.count("shipping_time_hours"), _v=F.sum("shipment_value"),
                  _c=F.count("shipment_id") if "shipment_id" in fact.columns else F.count(F.lit(1)))
    j = per.join(products.select("product_id", "product_category"), "product_id")
    return j.groupBy("product_category").agg(
        F.sum("_q").alias("total_quantity"),
        _avg("_h", "_hn").alias("avg_shipping_time_hours"),
        F.round(F.sum("_v"), 2).alias("total_shipment_value"),
        F.sum("_c").alias("shipment_count"))


def supplier_annual_values(fact: DataFrame, suppliers: DataFrame, dim_time: DataFrame) -> DataFrame:
    """The CTE: shipment value per supplier name and calendar year (J2: two dims).

    The calendar is bounded by the number of days, so it is broadcast: the join is a
    narrow map-side lookup and the partial aggregate per (supplier, year) follows it in
    the same stage, so the fact crosses one exchange only, already reduced. The supplier
    join then sees one row per supplier and year."""
    t = F.broadcast(dim_time.select("date_id", "year"))
    per_year = (fact.select("supplier_id", "date_id", "shipment_value").join(t, "date_id")
                .groupBy("supplier_id", "year").agg(F.sum("shipment_value").alias("_v")))
    j = per_year.join(suppliers.select("supplier_id", "supplier_name"), "supplier_id")
    return j.groupBy("supplier_name", "year").agg(F.sum("_v").alias("annual_value"))


def supplier_yoy(fact: DataFrame, suppliers: DataFrame, dim_time: DataFrame,
                 min_abs_pct: float | None = None) -> DataFrame:
    """Annual value with the previous year *present* for the supplier (LAG, W1), the net
    change (W2) and the percent change (W3, null when there is no previous year or it is
    zero; computed on unrounded values). ``min_abs_pct`` keeps only changes at least
    that large (W4); the default keeps every row, as the reference does.

    The window partitions by supplier over its years: one small group per supplier,
    never the raw fact."""
    annual = supplier_annual_values(fact, suppliers, dim_time)
    w = Window.partitionBy("supplier_name").orderBy("year")
    prev = F.lag("annual_value").over(w)
    a = annual.withColumn("_prev", prev)
    net = F.col("annual_value") - F.col("_prev")
    pct = net.cast("decimal(22,2)") * 100 / F.nullif(F.col("_prev"), F.lit(0)).cast("decimal(22,2)")
    out = a.select(
        "supplier_name", "year",
        F.round("annual_value", 2).alias("current_year_value"),
        F.round("_prev", 2).alias("previous_year_value"),
        F.round(net, 2).alias("net_change"),
        F.round(pct, 2).alias("percentage_change"))
    if min_abs_pct is not None:
        out = out.filter(F.abs(F.col("percentage_change")) >= F.lit(min_abs_pct))
    return out.orderBy("supplier_name", "year")
