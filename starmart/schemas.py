"""Explicit schemas for every warehouse table (S15) and the declared table rules.

No schema is inferred: the CSV is read with all-string fields and cast explicitly,
every other layer is written from these ``StructType`` definitions.
"""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()
I = T.IntegerType()
L = T.LongType()
D = T.DateType()
TS = T.TimestampNTZType()
B = T.BooleanType()
PRICE = T.DecimalType(10, 2)
VALUE = T.DecimalType(12, 2)
RATING = T.DecimalType(3, 2)


def _struct(*fields, nullable: set[str] | None = None) -> T.StructType:
    nullable = nullable if nullable is not None else {f[0] for f in fields}
    return T.StructType([T.StructField(n, t, n in nullable) for n, t in fields])


# Source headers of the retail CSV, in file order.
RAW_CSV_COLUMNS = ["InvoiceNo", "StockCode", "Description", "Quantity", "InvoiceDate",
                   "UnitPrice", "CustomerID", "Country"]

# Explicit renames after lower-casing and replacing spaces.
RAW_RENAMES = {
    "invoiceno": "invoice_no",
    "stockcode": "stock_code",
    "invoicedate": "invoice_date",
    "unitprice": "unit_price",
    "customerid": "customer_id",
}

RAW_CSV = _struct(*[(c, S) for c in RAW_CSV_COLUMNS])

BUSINESS_COLUMNS = ["invoice_no", "stock_code", "description", "quantity", "invoice_date",
                    "unit_price", "customer_id", "country"]

BRONZE = _struct(
    ("invoice_no", S), ("stock_code", S), ("description", S), ("quantity", I),
    ("invoice_date", S), ("unit_price", PRICE), ("customer_id", S), ("country", S),
    ("load_timestamp", TS), ("batch_id", S),
)

BRONZE_ARCHIVE = T.StructType(BRONZE.fields + [
    T.StructField("snapshot_id", S, False), T.StructField("snapshot_date", D, False)])

SILVER_PRODUCTS = _struct(("stock_code", S), ("description", S), nullable={"description"})
SILVER_CUSTOMERS = _struct(("raw_customer_id", S), ("country", S), nullable={"country"})
SILVER_TRANSACTIONS = _struct(
    ("invoice_no", S), ("stock_code", S), ("raw_customer_id", S), ("date_id", I),
    ("quantity", I), ("unit_price", PRICE), ("total_value", VALUE))

DIM_CUSTOMERS = _struct(("customer_id", L), ("raw_customer_id", S), ("country", S),
                        nullable={"raw_customer_id", "country"})
DIM_PRODUCTS = _struct(("product_id", L), ("stock_code", S), ("description", S),
                       nullable={"stock_code", "description"})
DIM_DATE = _struct(
    ("date_id", I), ("full_date", D), ("year", I), ("quarter", I), ("month", I),
    ("month_name", S), ("week", I), ("day_of_week", I), ("day_name", S), ("is_weekend", B),
    nullable=set())
FACT_SALES = _struct(
    ("sales_id", L), ("invoice_no", S), ("customer_id", L), ("product_id", L), ("date_id", I),
    ("quantity", I), ("unit_price", PRICE), ("total_value", VALUE), ("load_timestamp", TS),
    ("batch_id", S),
    nullable={"invoice_no", "customer_id", "product_id", "date_id", "load_timestamp", "batch_id"})

# Supply-chain star.
DIM_TIME = DIM_DATE
SUPPLY_DIM_PRODUCTS = _struct(
    ("product_id", L), ("product_name", S), ("product_category", S), ("sku", S),
    ("unit_price", PRICE), ("description", S), ("created_at", TS), nullable={"description", "created_at"})
DIM_SUPPLIERS = _struct(
    ("supplier_id", L), ("supplier_name", S), ("supplier_country", S), ("contact_email", S),
    ("phone", S), ("rating", RATING), ("created_at", TS),
    nullable={"contact_email", "phone", "rating", "created_at"})
DIM_WAREHOUSES = _struct(
    ("warehouse_id", L), ("warehouse_name", S), ("warehouse_location", S),
    ("warehouse_country", S), ("capacity_sqft", I), ("manager_name", S), ("created_at", TS),
    nullable={"capacity_sqft", "manager_name", "created_at"})
DIM_ORDERS = _struct(
    ("order_id", L), ("order_date", D), ("customer_id", S), ("order_status", S),
    ("order_priority", S), ("created_at", TS), nullable={"customer_id", "order_priority", "created_at"})
FACT_SHIPMENTS = _struct(
    ("shipment_id", L), ("product_id", L), ("supplier_id", L), ("warehouse_id", L),
    ("order_id", L), ("date_id", I), ("shipment_date", D), ("quantity", I),
    ("shipment_value", VALUE), ("shipping_time_hours", I), ("created_at", TS),
    nullable={"created_at"})
SHIPMENT_AUDIT_LOG = _struct(
    ("audit_id", L), ("shipment_id", L), ("operation", S), ("old_value", VALUE),
    ("new_value", VALUE), ("changed_at", TS), ("changed_by", S),
    nullable={"shipment_id", "operation", "old_value", "new_value", "changed_at", "changed_by"})

SCHEMAS: dict[str, T.StructType] = {
    "bronze.raw_transactions": BRONZE,
    "bronze.raw_transactions_archive": BRONZE_ARCHIVE,
    "silver.products": SILVER_PRODUCTS,
    "silver.customers": SILVER_CUSTOMERS,
    "silver.transactions": SILVER_TRANSACTIONS,
    "gold.dim_customers": DIM_CUSTOMERS,
    "gold.dim_products": DIM_PRODUCTS,
    "gold.dim_date": DIM_DATE,
    "gold.fact_sales": FACT_SALES,
    "supply.dim_time": DIM_TIME,
    "supply.dim_products": SUPPLY_DIM_PRODUCTS,
    "supply.dim_suppliers": DIM_SUPPLIERS,
    "supply.dim_warehouses": DIM_WAREHOUSES,
    "supply.dim_orders": DIM_ORDERS,
    "supply.fact_shipments": FACT_SHIPMENTS,
    "supply.shipment_audit_log": SHIPMENT_AUDIT_LOG,
}

# Declared VARCHAR lengths.
VARCHAR_LIMITS = {
    "bronze.raw_transactions": {"invoice_no": 20, "stock_code": 20, "description": 255,
                                "invoice_date": 50, "customer_id": 20, "country": 100},
    "silver.products": {"stock_code": 20, "description": 255},
    "silver.customers": {"raw_customer_id": 20, "country": 100},
    "silver.transactions": {"invoice_no": 20, "stock_code": 20, "raw_customer_id": 20},
    "gold.dim_customers": {"raw_customer_id": 20, "country": 100},
    "gold.dim_products": {"stock_code": 20, "description": 255},
    "gold.dim_date": {"month_name": 20, "day_name": 20},
    "gold.fact_sales": {"invoice_no": 20},
    "supply.dim_time": {"month_name": 20, "day_name": 20},
    "supply.dim_products": {"product_name": 200, "product_category": 100, "sku": 50},
    "supply.dim_suppliers": {"supplier_name": 200, "supplier_country": 100,
                             "contact_email": 150, "phone": 50},
    "supply.dim_warehouses": {"warehouse_name": 200, "warehouse_location": 200,
                              "warehouse_country": 100, "manager_name": 150},
    "supply.dim_orders": {"customer_id": 50, "order_status": 50, "order_priority": 20},
    "supply.shipment_audit_log": {"operation": 10, "changed_by": 100},
}

# The CHECK constraints of the shipment fact.
SHIPMENT_CHECKS = {
    "quantity_positive": "quantity > 0",
    "shipment_value_non_negative": "shipment_value >= 0",
    "shipping_time_non_negative": "shipping_time_hours >= 0",
}
CHECKS = {"supply.fact_shipments": SHIPMENT_CHECKS}

# PRIMARY KEY and UNIQUE columns of each table, the primary key first.
KEYS = {
    "silver.products": [("stock_code",)],
    "silver.customers": [("raw_customer_id",)],
    "gold.dim_customers": [("customer_id",), ("raw_customer_id",)],
    "gold.dim_products": [("product_id",), ("stock_code",)],
    "gold.dim_date": [("date_id",), ("full_date",)],
    "gold.fact_sales": [("sales_id",)],
    "supply.dim_time": [("date_id",), ("full_date",)],
    "supply.dim_products": [("product_id",), ("sku",)],
    "supply.dim_suppliers": [("supplier_id",)],
    "supply.dim_warehouses": [("warehouse_id",)],
    "supply.dim_orders": [("order_id",)],
    "supply.fact_shipments": [("shipment_id",)],
    "supply.shipment_audit_log": [("audit_id",)],
}


def empty(spark, name: str):
    """An empty DataFrame with the registered schema (used by resets, S14)."""
    return spark.createDataFrame([], SCHEMAS[name])
