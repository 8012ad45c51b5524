"""Driver tables (TPC-H-like Parquet) re-shaped into the reference's inputs.

The retail CSV and the supply-chain star of the reference are not shipped, so they are
derived deterministically from the given tables. Defects the cleaning steps must handle
(nulls, blanks, bad prices, returns, exact copies) are planted by fixed residues of the
part / order / customer keys. Every row of the given tables flows through; nothing is
sampled or capped.

Plan shape at scale: ``orders`` is joined to ``customer``/``nation`` (order-sized),
``lineitem`` to ``part`` (a broadcast when it is small), then both on ``l_orderkey`` in
partitions that are not coalesced (see :func:`raw_source`). Only the needed columns are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.functions.dates import date_id
from starmart.operators import slices

LINEITEM_COLUMNS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                    "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
                    "l_shipdate"]

FEED_COLUMNS = ["l_orderkey", "l_partkey", "l_quantity", "l_returnflag", "l_shipdate"]
FEED_SLICES = 4         # exchanges of the feed's joins, at most

# Residues that plant defects in the derived retail feed.
DESC_NULL_MOD = 29       # description missing
DESC_BLANK_MOD = 31      # description of three blanks
PRICE_ZERO_MOD = 37      # unit price 0
PRICE_NEG_MOD = 41       # unit price -1
PRICE_NULL_MOD = 43      # unit price missing
CUSTOMER_NULL_MOD = 4    # customer id missing
DUPLICATE_MOD = 97       # whole order lines delivered twice
REVISED_MOD = 5          # description revised from a date on
REVISED_FROM = "1998-01-01"
TASKS_A_SPLIT = 8       # partitions of the wide rows for each split of the scanned lines
WAREHOUSES = 25          # shipments spread over the 25 nations as warehouses


def table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """Column-pruned scan of one driver table."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def raw_source(spark: SparkSession, sf_dir: str, part_of: tuple[int, int] | None = None) -> DataFrame:
    """The retail feed with the CSV's original headers, every field a string. ``part_of``
    (i, n): the i-th of n slices of its orders."""
    li = table(spark, sf_dir, "lineitem", FEED_COLUMNS)
    orders = table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey"])
    if part_of:
        i, n = part_of
        li, orders = (df.where(F.pmod(F.xxhash64(k), F.lit(n)) == i) for df, k in ((li, "l_orderkey"), (orders, "o_orderkey")))
    customer = table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey"])
    nation = table(spark, sf_dir, "nation", ["n_nationkey", "n_name"])
    part = table(spark, sf_dir, "part", ["p_partkey", "p_name", "p_retailprice"])
    # the price text is made once a part, not once a line
    pk = F.col("p_partkey")
    price = (F.when(pk % PRICE_ZERO_MOD == 0, F.lit(0.0))
             .when(pk % PRICE_NEG_MOD == 0, F.lit(-1.0))
             .when(pk % PRICE_NULL_MOD == 0, F.lit(None))
             .otherwise(F.col("p_retailprice"))).cast("decimal(10,2)")
    part = part.select("p_partkey", "p_name", price.cast("string").alias("_price"))

    # nation has a fixed 25 rows: a proven bound, so the hint is safe.
    order_country = (orders.join(customer, orders.o_custkey == customer.c_custkey)
                     .join(F.broadcast(nation), F.col("c_nationkey") == nation.n_nationkey)
                     .select("o_orderkey", "o_custkey", "n_name"))
    # The last join's tasks also build the wide rows and start their dedup. AQE would merge
    # its partitions by the size of the narrow, compressed rows, to millions of rows a task;
    # partitions by number are left as they are.
    n = min(int(spark.conf.get("spark.sql.shuffle.partitions")), TASKS_A_SPLIT * li.rdd.getNumPartitions())
    j = (li.join(part, li.l_partkey == part.p_partkey).repartition(n, "l_orderkey")
         .join(order_country.repartition(n, "o_orderkey"), li.l_orderkey == order_country.o_orderkey))

    pk = F.col("l_partkey")
    is_return = F.col("l_returnflag") == "R"
    qty = F.col("l_quantity").cast("int")
    rows = j.select(
        F.when(is_return, F.concat(F.lit("C"), F.col("l_orderkey").cast("string")))
         .otherwise(F.col("l_orderkey").cast("string")).alias("InvoiceNo"),
        F.concat(F.lit("P"), pk.cast("string")).alias("StockCode"),
        F.when(pk % DESC_NULL_MOD == 0, F.lit(None).cast("string"))
         .when(pk % DESC_BLANK_MOD == 0, F.lit("   "))
         .otherwise(F.concat(F.lit("  "), F.col("p_name"),
                             F.when((pk % REVISED_MOD == 0) & (F.col("l_shipdate") >= F.lit(REVISED_FROM).cast("date")), F.lit(" (revised)"))
                             .otherwise(F.lit("")), F.lit(" "))).alias("Description"),
        F.when(is_return, -qty).otherwise(qty).cast("string").alias("Quantity"),
        F.col("l_shipdate").cast("date").cast("string").alias("InvoiceDate"),
        F.col("_price").alias("UnitPrice"),
        F.when(F.col("o_custkey") % CUSTOMER_NULL_MOD == 0, F.lit(None).cast("string"))
         .otherwise(F.col("o_custkey").cast("string")).alias("CustomerID"),
        F.col("n_name").alias("Country"),
        # copies are generated in the same pass instead of re-reading the join
        F.expr(f"explode(sequence(1, if(l_orderkey % {DUPLICATE_MOD} = 0, 2, 1)))").alias("_copy"),
    )
    return rows.drop("_copy")


def raw_slices(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The retail feed in as many slices as the lines are worth, for a write that runs them
    one after the other."""
    n = slices.number(table(spark, sf_dir, "lineitem", FEED_COLUMNS), FEED_SLICES)
    return [raw_source(spark, sf_dir, (i, n) if n > 1 else None) for i in range(n)]


# --- supply-chain star -------------------------------------------------------------

def created_at():
    """The load time columns default to: one value per statement."""
    return F.current_timestamp().cast("timestamp_ntz").alias("created_at")


def natural_shipment_id():
    """An id from the whole order line (its natural key): 60 bits of its digest, the same
    in any engine and assigned in the scan, with no ordering or exchange."""
    text = F.concat_ws("|", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                       *[F.round(F.col(c) * 100).cast("long") for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")],
                       "l_returnflag", "l_linestatus", F.col("l_shipdate").cast("date").cast("string"))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def supply_dim_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part", ["p_partkey", "p_name", "p_type", "p_retailprice"])
    return p.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("product_category"),
        F.concat(F.lit("SKU-"), F.col("p_partkey").cast("string")).alias("sku"),
        F.col("p_retailprice").cast("decimal(10,2)").alias("unit_price"),
        F.lit(None).cast("string").alias("description"),
        created_at(),
    )


def supply_dim_suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier", ["s_suppkey", "s_name", "s_nationkey"])
    n = table(spark, sf_dir, "nation", ["n_nationkey", "n_name"])
    return (s.join(F.broadcast(n), s.s_nationkey == n.n_nationkey)
            .select(F.col("s_suppkey").alias("supplier_id"),
                    F.col("s_name").alias("supplier_name"),
                    F.col("n_name").alias("supplier_country"),
                    F.lit(None).cast("string").alias("contact_email"),
                    F.lit(None).cast("string").alias("phone"),
                    F.lit(None).cast("decimal(3,2)").alias("rating"), created_at()))


def supply_dim_warehouses(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    r = table(spark, sf_dir, "region", ["r_regionkey", "r_name"])
    return (n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey)
            .select(F.col("n_nationkey").cast("long").alias("warehouse_id"),
                    F.col("n_name").alias("warehouse_name"),
                    F.col("r_name").alias("warehouse_location"),
                    F.col("n_name").alias("warehouse_country"),
                    F.lit(None).cast("int").alias("capacity_sqft"),
                    F.lit(None).cast("string").alias("manager_name"), created_at()))


def supply_dim_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders",
              ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"])
    return o.select(F.col("o_orderkey").alias("order_id"),
                    F.col("o_orderdate").cast("date").alias("order_date"),
                    F.col("o_custkey").cast("string").alias("customer_id"),
                    F.col("o_orderstatus").alias("order_status"),
                    F.col("o_orderpriority").alias("order_priority"), created_at())


def shipment_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with every lineitem column (the natural key of a shipment)."""
    return table(spark, sf_dir, "lineitem", LINEITEM_COLUMNS)


def shipments_from_lines(lines: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Shipment columns of the fact (``keep`` passes e.g. ``shipment_id`` through)."""
    return lines.select(
        *(keep or []),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("supplier_id"),
        (F.col("l_orderkey") % WAREHOUSES).alias("warehouse_id"),
        F.col("l_orderkey").alias("order_id"),
        date_id("l_shipdate").alias("date_id"),
        F.col("l_shipdate").cast("date").alias("shipment_date"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("shipment_value"),
        (F.lit(12) + (F.col("l_orderkey") * 7 + F.col("l_linenumber") * 13) % 108)
        .cast("int").alias("shipping_time_hours"),
        created_at(),
    )


def supply_fact_shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shipment fact for reports (no surrogate id needed there)."""
    return shipments_from_lines(shipment_lines(spark, sf_dir))


def shipment_date_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row: first and last shipment date (bounds of the calendar dimension)."""
    li = table(spark, sf_dir, "lineitem", ["l_shipdate"])
    return li.agg(F.min("l_shipdate").cast("date").alias("start_date"),
                  F.max("l_shipdate").cast("date").alias("end_date"))


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze rows (standardised names, Bronze types) straight from the driver tables,
    without the batch columns."""
    from starmart.sources.files import standardise_columns, to_bronze_types
    return to_bronze_types(standardise_columns(raw_source(spark, sf_dir)))


# --- planted rule breaks: the same tables with defects by fixed residues ---------------------

def bronze_with_long_text(df: DataFrame) -> DataFrame:
    """Bronze rows of which some have over-long codes, descriptions and countries."""
    n = F.length("description")
    q = F.abs(F.col("quantity"))
    return df.withColumns({
        "stock_code": F.when(q % 11 == 0, F.rpad("stock_code", 24, "x")).otherwise(F.col("stock_code")),
        "description": F.when(n % 7 == 0, F.rpad("description", 300, "y")).otherwise(F.col("description")),
        "country": F.when(q % 23 == 0, F.rpad("country", 120, "z")).otherwise(F.col("country")),
    })


def shipments_with_rule_breaks(fact: DataFrame) -> DataFrame:
    """Shipments of which some have no supplier, a zero quantity, a negative value or hours."""
    o = F.col("order_id")
    return fact.withColumns({
        "supplier_id": F.when(o % 101 == 0, F.lit(None)).otherwise(F.col("supplier_id")),
        "quantity": F.when(o % 103 == 0, 0).otherwise(F.col("quantity")).cast("int"),
        "shipment_value": F.when(o % 107 == 0, -F.col("shipment_value")).otherwise(F.col("shipment_value")).cast("decimal(12,2)"),
        "shipping_time_hours": F.when(o % 109 == 0, -1).otherwise(F.col("shipping_time_hours")).cast("int"),
    })


def with_copies(df: DataFrame, twice) -> DataFrame:
    """The rows of ``df``, those of ``twice`` two times, in one pass over it."""
    times = F.sequence(F.lit(1), F.when(twice, 2).otherwise(1))
    return df.withColumn("_copy", F.explode(times)).drop("_copy")


def shipments_with_consistent_values(fact: DataFrame, products: DataFrame) -> DataFrame:
    """Shipments of which every third order's value is quantity times unit price."""
    j = fact.join(products.select("product_id", "unit_price"), "product_id")
    right = F.round(F.col("quantity") * F.col("unit_price"), 2).cast("decimal(12,2)")
    return j.withColumn("shipment_value", F.when(F.col("order_id") % 3 == 0, right).otherwise(F.col("shipment_value"))).drop("unit_price")


def shipments_with_idle_years(fact: DataFrame) -> DataFrame:
    """Shipments of which some suppliers' are worth nothing in one year."""
    idle = (F.col("supplier_id") % 7 == 3) & (F.floor(F.col("date_id") / 10000) == 1997)
    return fact.withColumn("shipment_value", F.when(idle, F.lit(0).cast("decimal(12,2)")).otherwise(F.col("shipment_value")))


def feed_with_bad_records(raw: DataFrame) -> DataFrame:
    """The retail feed as CSV lines in one column, named by their header, of which some are
    short, long, or hold a quantity or price that is no number."""
    cols = ["InvoiceNo", "StockCode", "Description", "Quantity", "InvoiceDate", "UnitPrice", "CustomerID", "Country"]
    n = F.abs(F.col("Quantity").cast("int"))
    f = {c: F.coalesce(F.trim(c), F.lit("")) for c in cols}
    f["Quantity"] = F.when(n == 49, F.lit("6.5")).when(n == 48, F.lit("many")).otherwise(f["Quantity"])
    f["UnitPrice"] = F.when(n == 47, F.lit("cheap")).otherwise(f["UnitPrice"])
    line = F.concat_ws(",", *[f[c] for c in cols])
    line = F.when(n == 50, F.concat_ws(",", f["InvoiceNo"], f["StockCode"])).when(n == 46, F.concat(line, F.lit(",till 7"))).otherwise(line)
    return raw.select(line.alias(",".join(cols)))


def write_lines(lines: DataFrame, path: str) -> None:
    """Write a column of text lines as they are, under its name as the first line of every
    file: each task writes its own file, and no line has to come before another's."""
    (lines.write.option("header", True).option("sep", "\u0001").option("quote", "")
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
