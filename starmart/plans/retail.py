"""Retail Gold star (dims, keys, fact) and its five reports.

Report plans aggregate the fact on its surrogate key first (partial + final hash
aggregate) and join the dimension to that one-row-per-key result. Catalyst does not push
an aggregate below a join by itself; doing it here means the big side never crosses a
join exchange, and the sentinel customer that holds a third of the rows collapses in the
map-side partial aggregate. The second, dimension-level group-by then runs on one row
per member.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.operators.clean import CUSTOMER_SENTINEL
from starmart.operators.dims import assign_keys, dim_date_from_facts
from starmart.operators.joins import resolve_keys

FACT_COLUMNS = ["invoice_no", "customer_id", "product_id", "date_id", "quantity",
                "unit_price", "total_value"]


@dataclass
class RetailStar:
    dim_products: DataFrame
    dim_customers: DataFrame
    dim_date: DataFrame
    fact_sales: DataFrame


def dim_products(silver_products: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    return assign_keys(silver_products, "stock_code", "product_id", existing)


def dim_customers(silver_customers: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    return assign_keys(silver_customers, "raw_customer_id", "customer_id", existing)


def fact_sales(silver_tx: DataFrame, products: DataFrame, customers: DataFrame,
               hot_customers: tuple = (CUSTOMER_SENTINEL,), heavy: dict | None = None) -> DataFrame:
    """J3 twice, then P12 (fact column order). Left joins keep unresolved rows visible.
    ``heavy``: measured heavy keys of both columns instead of the declared sentinel."""
    # customers first: their salt is a hash of the row, taken in the scan; after another join
    # every column would cross that join's exchange for it, also those a report never reads
    if heavy is not None:
        f = resolve_keys(silver_tx, customers, "raw_customer_id", "customer_id", salts=heavy["raw_customer_id"])
        f = resolve_keys(f, products, "stock_code", "product_id", salts=heavy["stock_code"])
        return f.select(*FACT_COLUMNS)
    f = resolve_keys(silver_tx, customers, "raw_customer_id", "customer_id", hot_values=hot_customers)
    f = resolve_keys(f, products, "stock_code", "product_id")
    return f.select(*FACT_COLUMNS)


def build_star(silver_tx: DataFrame, silver_products: DataFrame,
               silver_customers: DataFrame) -> RetailStar:
    p = dim_products(silver_products)
    c = dim_customers(silver_customers)
    return RetailStar(p, c, dim_date_from_facts(silver_tx), fact_sales(silver_tx, p, c))


# --- reports -----------------------------------------------------------------------------

def top_products(fact: DataFrame, products: DataFrame, n: int = 10) -> DataFrame:
    """Top ``n`` products by revenue (ties broken by stock code)."""
    per_key = fact.groupBy("product_id").agg(F.sum("total_value").alias("_rev"))
    j = per_key.join(products.select("product_id", "stock_code", "description"), "product_id")
    g = j.groupBy("stock_code", "description").agg(F.sum("_rev").alias("total_revenue"))
    return g.orderBy(F.desc("total_revenue"), F.asc("stock_code")).limit(n)


def monthly_revenue(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Revenue per calendar month, chronological. The date dimension is bounded by the
    number of days, so broadcasting it is safe at any fact size."""
    per_day = fact.groupBy("date_id").agg(F.sum("total_value").alias("_rev"))
    d = F.broadcast(dim_date.select("date_id", "year", "month", "month_name"))
    g = (per_day.join(d, "date_id").groupBy("year", "month", "month_name")
         .agg(F.sum("_rev").alias("monthly_revenue")))
    return g.orderBy("year", "month")


def _per_customer(fact: DataFrame) -> DataFrame:
    return fact.groupBy("customer_id").agg(F.sum("total_value").alias("_rev"))


def revenue_by_country(fact: DataFrame, customers: DataFrame) -> DataFrame:
    """Revenue per country of the customer dimension, largest first."""
    j = _per_customer(fact).join(customers.select("customer_id", "country"), "customer_id")
    g = j.groupBy("country").agg(F.sum("_rev").alias("country_revenue"))
    return g.orderBy(F.desc("country_revenue"), F.asc("country"))


def top_customers(fact: DataFrame, customers: DataFrame, n: int = 10,
                  exclude: str = CUSTOMER_SENTINEL) -> DataFrame:
    """Top ``n`` customers by spend; the sentinel member is excluded (``!=`` also drops a
    null id, as SQL three-valued logic does)."""
    c = customers.filter(F.col("raw_customer_id") != exclude).select("customer_id", "raw_customer_id")
    j = _per_customer(fact).join(c, "customer_id")
    g = j.groupBy("raw_customer_id").agg(F.sum("_rev").alias("total_spend"))
    return g.orderBy(F.desc("total_spend"), F.asc("raw_customer_id")).limit(n)


def sales_vs_returns(fact: DataFrame) -> DataFrame:
    """Gross sales, returns (absolute) and net revenue in one global aggregate.
    ``net = gross - returns`` holds because returns are summed as absolute values."""
    q, v = F.col("quantity"), F.col("total_value")
    return fact.agg(
        F.sum(F.when(q > 0, v).otherwise(F.lit(0))).alias("gross_sales"),
        F.sum(F.when(q < 0, F.abs(v)).otherwise(F.lit(0))).alias("total_returns"),
        F.sum(v).alias("net_revenue"),
    )
