"""Independent SQL oracle (DuckDB dialect) for every registered query.

The chain mirrors the derived retail feed, each cleaning step, the star with
``row_number`` surrogate keys, and the reports as plain SQL over the pre-registered
driver tables. Money columns are compared as DOUBLE and counts as BIGINT on both sides.
"""

from __future__ import annotations

import re

# --- retail feed -----------------------------------------------------------------------

RAW = """
raw AS (
  SELECT l.l_orderkey AS _ok,
    CASE WHEN l.l_returnflag = 'R' THEN 'C' || CAST(l.l_orderkey AS VARCHAR)
         ELSE CAST(l.l_orderkey AS VARCHAR) END AS invoice_no,
    'P' || CAST(l.l_partkey AS VARCHAR) AS stock_code,
    CASE WHEN l.l_partkey % 29 = 0 THEN NULL
         WHEN l.l_partkey % 31 = 0 THEN '   '
         ELSE '  ' || p.p_name || CASE WHEN l.l_partkey % 5 = 0 AND l.l_shipdate >= DATE '1998-01-01' THEN ' (revised)' ELSE '' END
              || ' ' END AS description,
    CASE WHEN l.l_returnflag = 'R' THEN -CAST(l.l_quantity AS INTEGER)
         ELSE CAST(l.l_quantity AS INTEGER) END AS quantity,
    CAST(CAST(l.l_shipdate AS DATE) AS VARCHAR) AS invoice_date,
    CAST(CASE WHEN l.l_partkey % 37 = 0 THEN 0
              WHEN l.l_partkey % 41 = 0 THEN -1
              WHEN l.l_partkey % 43 = 0 THEN NULL
              ELSE p.p_retailprice END AS DECIMAL(10,2)) AS unit_price,
    CASE WHEN o.o_custkey % 4 = 0 THEN NULL ELSE CAST(o.o_custkey AS VARCHAR) END AS customer_id,
    n.n_name AS country
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN part p ON l.l_partkey = p.p_partkey
),
bronze AS (
  SELECT invoice_no, stock_code, description, quantity, invoice_date, unit_price, customer_id, country FROM raw
  UNION ALL
  SELECT invoice_no, stock_code, description, quantity, invoice_date, unit_price, customer_id, country
  FROM raw WHERE _ok % 97 = 0
)"""

CLEAN = """
s_dedup AS (
  SELECT DISTINCT invoice_no, stock_code, description, quantity, invoice_date, unit_price, customer_id, country
  FROM bronze
),
s_required AS (
  SELECT * FROM s_dedup WHERE invoice_no IS NOT NULL AND stock_code IS NOT NULL AND unit_price IS NOT NULL
),
s_customer AS (
  SELECT invoice_no, stock_code, description, quantity, invoice_date, unit_price,
         COALESCE(customer_id, 'UNKNOWN') AS customer_id, country
  FROM s_required
),
s_description AS (
  SELECT invoice_no, stock_code,
         CASE WHEN description IS NULL OR trim(description) = '' THEN 'NO DESCRIPTION' ELSE description END AS description,
         quantity, invoice_date, unit_price, customer_id, country
  FROM s_customer
),
s_stripped AS (
  SELECT trim(invoice_no) AS invoice_no, trim(stock_code) AS stock_code, trim(description) AS description,
         quantity, trim(invoice_date) AS invoice_date, unit_price, trim(customer_id) AS customer_id,
         trim(country) AS country
  FROM s_description
),
s_parsed AS (
  SELECT *, CAST(invoice_date AS TIMESTAMP) AS invoice_ts FROM s_stripped
),
s_dated AS (
  SELECT *, CAST(year(invoice_ts) * 10000 + month(invoice_ts) * 100 + day(invoice_ts) AS INTEGER) AS date_id
  FROM s_parsed
),
s_priced AS (
  SELECT * FROM s_dated WHERE unit_price > 0
),
cleaned AS (
  SELECT *, CAST(quantity * unit_price AS DECIMAL(12,2)) AS total_value FROM s_priced
),
silver_tx AS (
  SELECT invoice_no, stock_code, customer_id AS raw_customer_id, date_id, quantity, unit_price, total_value
  FROM cleaned
),
silver_products AS (
  SELECT stock_code, description FROM (
    SELECT stock_code, description, row_number() OVER (PARTITION BY stock_code
      ORDER BY invoice_ts, invoice_no, stock_code, country, description) AS rn
    FROM cleaned) WHERE rn = 1
),
silver_customers AS (
  SELECT customer_id AS raw_customer_id, country FROM (
    SELECT customer_id, country, row_number() OVER (PARTITION BY customer_id
      ORDER BY invoice_ts, invoice_no, stock_code, country) AS rn
    FROM cleaned) WHERE rn = 1
)"""

STAR = """
dim_products AS (
  SELECT CAST(row_number() OVER (ORDER BY stock_code) AS BIGINT) AS product_id, stock_code, description
  FROM silver_products
),
dim_customers AS (
  SELECT CAST(row_number() OVER (ORDER BY raw_customer_id) AS BIGINT) AS customer_id, raw_customer_id, country
  FROM silver_customers
),
dim_date AS (
  SELECT date_id, d AS full_date, CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
         CAST(month(d) AS INTEGER) AS month, monthname(d) AS month_name, CAST(weekofyear(d) AS INTEGER) AS week,
         CAST(isodow(d) AS INTEGER) AS day_of_week, dayname(d) AS day_name, isodow(d) >= 6 AS is_weekend
  FROM (SELECT DISTINCT date_id, make_date(CAST(date_id // 10000 AS INTEGER), CAST(date_id // 100 % 100 AS INTEGER),
                                          CAST(date_id % 100 AS INTEGER)) AS d FROM silver_tx)
),
fact_sales AS (
  SELECT t.invoice_no, c.customer_id, p.product_id, t.date_id, t.quantity, t.unit_price, t.total_value
  FROM silver_tx t
  LEFT JOIN dim_products p ON t.stock_code = p.stock_code
  LEFT JOIN dim_customers c ON t.raw_customer_id = c.raw_customer_id
)"""


def _with(*blocks: str, body: str) -> str:
    return "WITH " + ",".join(b.strip("\n") for b in blocks) + "\n" + body


BRONZE_COLS = "invoice_no, stock_code, description, quantity, invoice_date, unit_price, customer_id, country"


def _stage(cte: str, extra: str = "") -> str:
    cols = "invoice_no, stock_code, description, quantity, invoice_date, CAST(unit_price AS DOUBLE) AS unit_price, customer_id, country"
    return _with(RAW, CLEAN, body=f"SELECT {cols}{extra} FROM {cte}")


def retail_queries() -> dict[str, str]:
    q = {}
    full = (RAW, CLEAN, STAR)
    q["top_products"] = _with(*full, body="""
SELECT p.stock_code, p.description, CAST(SUM(f.total_value) AS DOUBLE) AS total_revenue
FROM fact_sales f JOIN dim_products p ON f.product_id = p.product_id
GROUP BY p.stock_code, p.description
ORDER BY total_revenue DESC, p.stock_code LIMIT 10""")
    q["monthly_revenue"] = _with(*full, body="""
SELECT d.year, d.month, d.month_name, CAST(SUM(f.total_value) AS DOUBLE) AS monthly_revenue
FROM fact_sales f JOIN dim_date d ON f.date_id = d.date_id
GROUP BY d.year, d.month, d.month_name ORDER BY d.year, d.month""")
    q["revenue_by_country"] = _with(*full, body="""
SELECT c.country, CAST(SUM(f.total_value) AS DOUBLE) AS country_revenue
FROM fact_sales f JOIN dim_customers c ON f.customer_id = c.customer_id
GROUP BY c.country ORDER BY country_revenue DESC""")
    q["top_customers"] = _with(*full, body="""
SELECT c.raw_customer_id, CAST(SUM(f.total_value) AS DOUBLE) AS total_spend
FROM fact_sales f JOIN dim_customers c ON f.customer_id = c.customer_id
WHERE c.raw_customer_id != 'UNKNOWN'
GROUP BY c.raw_customer_id ORDER BY total_spend DESC, c.raw_customer_id LIMIT 10""")
    q["sales_vs_returns"] = _with(*full, body="""
SELECT CAST(SUM(CASE WHEN quantity > 0 THEN total_value ELSE 0 END) AS DOUBLE) AS gross_sales,
       CAST(SUM(CASE WHEN quantity < 0 THEN ABS(total_value) ELSE 0 END) AS DOUBLE) AS total_returns,
       CAST(SUM(total_value) AS DOUBLE) AS net_revenue
FROM fact_sales""")
    return q


def _date_attrs(d: str, date_id: str | None = None) -> str:
    did = date_id or f"CAST(year({d}) * 10000 + month({d}) * 100 + day({d}) AS INTEGER)"
    return (f"{did} AS date_id, {d} AS full_date, CAST(year({d}) AS INTEGER) AS year, "
            f"CAST(quarter({d}) AS INTEGER) AS quarter, CAST(month({d}) AS INTEGER) AS month, "
            f"monthname({d}) AS month_name, CAST(weekofyear({d}) AS INTEGER) AS week, "
            f"CAST(isodow({d}) AS INTEGER) AS day_of_week, dayname({d}) AS day_name, "
            f"isodow({d}) >= 6 AS is_weekend")


STALE = """
early AS (SELECT * FROM cleaned WHERE date_id < 19980101),
early_products AS (
  SELECT stock_code, description FROM (
    SELECT stock_code, description, row_number() OVER (PARTITION BY stock_code
      ORDER BY invoice_ts, invoice_no, stock_code, country, description) AS rn FROM early) WHERE rn = 1
),
early_customers AS (
  SELECT customer_id AS raw_customer_id, country FROM (
    SELECT customer_id, country, row_number() OVER (PARTITION BY customer_id
      ORDER BY invoice_ts, invoice_no, stock_code, country) AS rn FROM early) WHERE rn = 1
),
stale_products AS (
  SELECT CAST(row_number() OVER (ORDER BY stock_code) AS BIGINT) AS product_id, stock_code, description
  FROM early_products
),
stale_customers AS (
  SELECT CAST(row_number() OVER (ORDER BY raw_customer_id) AS BIGINT) AS customer_id, raw_customer_id, country
  FROM early_customers
)"""

SUPPLY = f"""
sfact AS (
  SELECT CAST('0x' || substr(md5(concat_ws('|', l_orderkey, l_partkey, l_suppkey, l_linenumber,
           CAST(round(l_quantity * 100) AS BIGINT), CAST(round(l_extendedprice * 100) AS BIGINT),
           CAST(round(l_discount * 100) AS BIGINT), CAST(round(l_tax * 100) AS BIGINT),
           l_returnflag, l_linestatus, CAST(CAST(l_shipdate AS DATE) AS VARCHAR))), 1, 15) AS BIGINT) AS shipment_id,
    l_partkey AS product_id, l_suppkey AS supplier_id, l_orderkey % 25 AS warehouse_id, l_orderkey AS order_id,
    CAST(year(l_shipdate) * 10000 + month(l_shipdate) * 100 + day(l_shipdate) AS INTEGER) AS date_id,
    CAST(l_shipdate AS DATE) AS shipment_date, CAST(l_quantity AS INTEGER) AS quantity,
    CAST(l_extendedprice AS DECIMAL(12,2)) AS shipment_value,
    CAST(12 + (l_orderkey * 7 + l_linenumber * 13) % 108 AS INTEGER) AS shipping_time_hours
  FROM lineitem
),
sproducts AS (
  SELECT p_partkey AS product_id, p_name AS product_name, p_type AS product_category,
         'SKU-' || CAST(p_partkey AS VARCHAR) AS sku, CAST(p_retailprice AS DECIMAL(10,2)) AS unit_price,
         CAST(NULL AS VARCHAR) AS description
  FROM part
),
ssuppliers AS (
  SELECT s_suppkey AS supplier_id, s_name AS supplier_name, n_name AS supplier_country,
         CAST(NULL AS VARCHAR) AS contact_email, CAST(NULL AS VARCHAR) AS phone
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
),
swarehouses AS (SELECT CAST(n_nationkey AS BIGINT) AS warehouse_id, n_name AS warehouse_name,
  r_name AS warehouse_location, n_name AS warehouse_country, CAST(NULL AS VARCHAR) AS manager_name
  FROM nation JOIN region ON n_regionkey = r_regionkey),
sorders AS (SELECT o_orderkey AS order_id, CAST(o_orderdate AS DATE) AS order_date, CAST(o_custkey AS VARCHAR) AS customer_id,
  o_orderstatus AS order_status, o_orderpriority AS order_priority FROM orders),
stime AS (
  SELECT {_date_attrs("d")} FROM (
    SELECT CAST(unnest(generate_series(CAST(min(l_shipdate) AS TIMESTAMP), CAST(max(l_shipdate) AS TIMESTAMP),
                                       INTERVAL 1 DAY)) AS DATE) AS d FROM lineitem)
)"""

CHANGES = """
adjust AS (
  SELECT shipment_id, 24 AS added_hours, s.seq FROM sfact, (VALUES (1), (2)) s(seq)
  WHERE shipment_id % 50 = 0 AND (s.seq = 1 OR shipment_id % 500 = 0)
),
f1 AS (
  SELECT f.shipment_id, product_id, supplier_id, warehouse_id, order_id, date_id, shipment_date, quantity,
         shipment_value, CAST(shipping_time_hours + COALESCE(a.added, 0) AS INTEGER) AS shipping_time_hours
  FROM sfact f LEFT JOIN (SELECT shipment_id, SUM(added_hours) AS added FROM adjust GROUP BY shipment_id) a
    ON f.shipment_id = a.shipment_id
),
upd AS (
  SELECT shipment_id, CAST(shipment_value + s.seq * 100 AS DECIMAL(12,2)) AS new_value, s.seq
  FROM f1, (VALUES (1), (2)) s(seq)
  WHERE shipment_id % 70 = 0 AND (s.seq = 1 OR shipment_id % 700 = 0)
),
f2 AS (
  SELECT f.shipment_id, product_id, supplier_id, warehouse_id, order_id, date_id, shipment_date, quantity,
         CASE WHEN u.shipment_id IS NOT NULL THEN u.nv ELSE f.shipment_value END AS shipment_value,
         shipping_time_hours
  FROM f1 f LEFT JOIN (SELECT shipment_id, arg_max(new_value, seq) AS nv FROM upd GROUP BY shipment_id) u
    ON f.shipment_id = u.shipment_id
),
dele AS (SELECT shipment_id, 1 AS seq FROM f2 WHERE shipment_id % 90 = 0),
f3 AS (SELECT * FROM f2 WHERE shipment_id NOT IN (SELECT shipment_id FROM dele)),
audit AS (
  SELECT a.shipment_id, 'UPDATE' AS operation, f.shipment_value AS old_value, f.shipment_value AS new_value,
         a.seq, 1 AS step
  FROM adjust a JOIN sfact f ON a.shipment_id = f.shipment_id
  UNION ALL
  SELECT u.shipment_id, 'UPDATE',
         CASE WHEN u.seq = min(u.seq) OVER (PARTITION BY u.shipment_id) THEN f.shipment_value
              ELSE lag(u.new_value) OVER (PARTITION BY u.shipment_id ORDER BY u.seq) END,
         u.new_value, u.seq, 2
  FROM upd u JOIN f1 f ON u.shipment_id = f.shipment_id
  UNION ALL
  SELECT d.shipment_id, 'DELETE', f.shipment_value, CAST(NULL AS DECIMAL(12,2)), d.seq, 3
  FROM dele d JOIN f2 f ON d.shipment_id = f.shipment_id
)"""

# The batch after it: the same statements on the fact the first one left, for other ids.
_SECOND = [("% 500 ", "% 300 "), ("% 50 ", "% 60 "), ("% 700 ", "% 400 "), ("% 70 ", "% 80 "), ("% 90)", "% 110)"), ("% 90 ", "% 110 "),
           ("24 AS added_hours", "-2 AS added_hours"), ("s.seq * 100", "s.seq * 50")]


def _second(text: str) -> str:
    for name in ("adjust", "f1", "f2", "f3", "upd", "dele", "audit"):
        text = re.sub(rf"\b{name}\b", f"{name}_b", text)
    for old, new in _SECOND:
        text = text.replace(old, new)
    return text.replace("sfact", "f3")


SECOND_CHANGES = _second(CHANGES)

FACT_COLS = ("shipment_id, product_id, supplier_id, warehouse_id, order_id, date_id, shipment_date, quantity, "
             "CAST(shipment_value AS DOUBLE) AS shipment_value, shipping_time_hours")
AUDIT_COLS = ("shipment_id, operation, CAST(old_value AS DOUBLE) AS old_value, "
              "CAST(new_value AS DOUBLE) AS new_value, seq, step")


PLANTED = """
bronze_planted AS (
  SELECT invoice_no, CASE WHEN abs(quantity) % 11 = 0 THEN rpad(stock_code, 24, 'x') ELSE stock_code END AS stock_code,
    CASE WHEN length(description) % 7 = 0 THEN rpad(description, 300, 'y') ELSE description END AS description,
    quantity, invoice_date, unit_price, customer_id,
    CASE WHEN abs(quantity) % 23 = 0 THEN rpad(country, 120, 'z') ELSE country END AS country
  FROM bronze
),
sfact_planted AS (
  SELECT shipment_id, product_id, CASE WHEN order_id % 101 = 0 THEN NULL ELSE supplier_id END AS supplier_id, warehouse_id,
    order_id, date_id, shipment_date, CASE WHEN order_id % 103 = 0 THEN 0 ELSE quantity END AS quantity,
    CASE WHEN order_id % 107 = 0 THEN -shipment_value ELSE shipment_value END AS shipment_value,
    CASE WHEN order_id % 109 = 0 THEN -1 ELSE shipping_time_hours END AS shipping_time_hours
  FROM sfact
)"""

# Tables with declared rules and the oracle's name for each.
RULED = {
    "bronze.raw_transactions": "bronze_planted", "silver.products": "silver_products", "silver.customers": "silver_customers",
    "silver.transactions": "silver_tx", "gold.dim_customers": "dim_customers", "gold.dim_products": "dim_products",
    "gold.dim_date": "dim_date", "gold.fact_sales": "fact_sales", "supply.dim_time": "stime", "supply.dim_products": "sproducts",
    "supply.dim_suppliers": "ssuppliers", "supply.dim_warehouses": "swarehouses", "supply.dim_orders": "sorders",
    "supply.fact_shipments": "sfact_planted",
}


def _rules_sql() -> str:
    from starmart import schemas
    parts = []

    def rule(table, name, bad):
        parts.append(f"SELECT '{table}' AS table_name, '{name}' AS rule, "
                     f"CAST(COALESCE(SUM(CASE WHEN {bad} THEN 1 ELSE 0 END), 0) AS BIGINT) AS violations FROM {RULED[table]}")
    for table in RULED:
        for f in schemas.SCHEMAS[table].fields:
            if not f.nullable and f.name != "sales_id":
                rule(table, f"{f.name} not null", f"{f.name} IS NULL")
        for c, n in schemas.VARCHAR_LIMITS.get(table, {}).items():
            rule(table, f"{c} length <= {n}", f"{c} IS NOT NULL AND length({c}) > {n}")
        for name, expr in schemas.CHECKS.get(table, {}).items():
            rule(table, name, f"NOT COALESCE({expr}, TRUE)")
    return "\nUNION ALL\n".join(parts)


def _keys_sql() -> str:
    from starmart import schemas
    twice = {"supply.dim_products": ("product_id", 31), "gold.dim_date": ("date_id", 17),
             "supply.fact_shipments": ("shipment_id", 40), "gold.dim_products": ("product_id", 53)}
    parts = []
    for table, keys in schemas.KEYS.items():
        if table not in RULED or table == "gold.fact_sales":
            continue
        for key in keys:
            c, rows = ", ".join(key), f"SELECT * FROM {RULED[table]}"
            if table in twice:
                k, n = twice[table]
                rows += f" UNION ALL SELECT * FROM {RULED[table]} WHERE {k} % {n} = 0"
            parts.append(f"SELECT '{table}' AS table_name, '{c}' AS key_columns, COUNT(*) AS duplicated_keys, "
                         f"CAST(COALESCE(SUM(n), 0) AS BIGINT) AS rows_involved FROM (SELECT {c}, COUNT(*) AS n FROM ({rows}) "
                         f"WHERE {' AND '.join(f'{x} IS NOT NULL' for x in key)} GROUP BY {c} HAVING COUNT(*) > 1)")
    return "\nUNION ALL\n".join(parts)


def _profile_sql() -> str:
    cols = ["invoice_no", "stock_code", "description", "quantity", "invoice_date", "unit_price",
            "customer_id", "country"]
    return "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, COUNT(*) AS row_count, "
        f"CAST(SUM(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS null_count, "
        f"COUNT(DISTINCT {c}) AS distinct_count FROM bronze" for c in cols)


def more_queries() -> dict[str, str]:
    q = {}
    rc = (RAW, CLEAN)
    full = (RAW, CLEAN, STAR)
    q["raw_standardised"] = _with(RAW, body=f"SELECT {BRONZE_COLS.replace('unit_price', 'CAST(unit_price AS DOUBLE) AS unit_price')} FROM bronze")
    stages = {"exact_dedup": "s_dedup", "mandatory_fields": "s_required", "customer_sentinel": "s_customer",
              "description_sentinel": "s_description", "stripped_strings": "s_stripped"}
    for k, cte in stages.items():
        q[k] = _stage(cte)
    q["parsed_dates"] = _stage("s_parsed", ", invoice_ts")
    q["date_id"] = _stage("s_dated", ", invoice_ts, date_id")
    q["valid_price"] = _stage("s_priced", ", invoice_ts, date_id")
    q["line_value"] = _stage("cleaned", ", invoice_ts, date_id, CAST(total_value AS DOUBLE) AS total_value")
    q["cleaning_report"] = _with(RAW, body="""
, g AS (SELECT invoice_no, stock_code, description, quantity, invoice_date, unit_price, customer_id, country,
               COUNT(*) AS n FROM bronze
        GROUP BY invoice_no, stock_code, description, quantity, invoice_date, unit_price, customer_id, country),
ok AS (SELECT *, invoice_no IS NOT NULL AND stock_code IS NOT NULL AND unit_price IS NOT NULL AS good FROM g)
SELECT CAST(SUM(n) AS BIGINT) AS bronze_rows, CAST(SUM(n) - COUNT(*) AS BIGINT) AS duplicates_dropped,
  CAST(SUM(CASE WHEN NOT good THEN 1 ELSE 0 END) AS BIGINT) AS null_mandatory_dropped,
  CAST(SUM(CASE WHEN good AND customer_id IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS customers_filled,
  CAST(SUM(CASE WHEN good AND (description IS NULL OR trim(description) = '') THEN 1 ELSE 0 END) AS BIGINT) AS descriptions_filled,
  CAST(SUM(CASE WHEN good AND unit_price <= 0 THEN 1 ELSE 0 END) AS BIGINT) AS bad_price_dropped,
  CAST(SUM(CASE WHEN good AND unit_price > 0 THEN 1 ELSE 0 END) AS BIGINT) AS silver_rows
FROM ok""")
    q["silver_products"] = _with(*rc, body="SELECT * FROM silver_products")
    q["silver_customers"] = _with(*rc, body="SELECT * FROM silver_customers")
    q["dim_date"] = _with(*full, body="SELECT * FROM dim_date")
    q["surrogate_keys"] = _with(*full, body="SELECT * FROM dim_products")
    q["resolve_keys"] = _with(*full, body="""
SELECT invoice_no, customer_id, product_id, date_id, quantity, CAST(unit_price AS DOUBLE) AS unit_price,
       CAST(total_value AS DOUBLE) AS total_value FROM fact_sales""")
    q["unresolved_keys"] = _with(*rc, STALE.replace('19980101', '19950301'), body="""
, r AS (
  SELECT t.*, p.product_id, c.customer_id FROM silver_tx t
  LEFT JOIN stale_products p ON t.stock_code = p.stock_code
  LEFT JOIN stale_customers c ON t.raw_customer_id = c.raw_customer_id)
SELECT 'dim_products' AS dimension, CAST(SUM(CASE WHEN product_id IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS unresolved_rows,
       COUNT(DISTINCT CASE WHEN product_id IS NULL THEN stock_code END) AS unresolved_keys FROM r
UNION ALL
SELECT 'dim_customers', CAST(SUM(CASE WHEN customer_id IS NULL THEN 1 ELSE 0 END) AS BIGINT),
       COUNT(DISTINCT CASE WHEN customer_id IS NULL THEN raw_customer_id END) FROM r""")
    q["upsert_ignore"] = _with(*full, body="SELECT * FROM dim_date")
    q["upsert_update"] = _with(*rc, STALE, body="""
, master AS (SELECT 'P' || CAST(p_partkey AS VARCHAR) AS stock_code, p_name AS description FROM part)
SELECT s.product_id, s.stock_code, COALESCE(m.description, s.description) AS description
FROM stale_products s LEFT JOIN master m ON s.stock_code = m.stock_code
UNION ALL
SELECT CAST((SELECT max(product_id) FROM stale_products) + row_number() OVER (ORDER BY m.stock_code) AS BIGINT),
       m.stock_code, m.description
FROM master m WHERE m.stock_code NOT IN (SELECT stock_code FROM stale_products)""")
    retired = {"customer_id": 23, "product_id": 19, "date_id": 29, "supplier_id": 7, "warehouse_id": 11, "order_id": 31}
    fks = [("fact_sales", "fact_sales", "customer_id", "dim_customers"), ("fact_sales", "fact_sales", "product_id", "dim_products"),
           ("fact_sales", "fact_sales", "date_id", "dim_date"), ("fact_shipments", "sfact", "product_id", "sproducts"),
           ("fact_shipments", "sfact", "supplier_id", "ssuppliers"), ("fact_shipments", "sfact", "warehouse_id", "swarehouses"),
           ("fact_shipments", "sfact", "order_id", "sorders"), ("fact_shipments", "sfact", "date_id", "stime")]
    q["fk_orphans"] = _with(*full, SUPPLY, body="\nUNION ALL\n".join(
        f"SELECT '{t}.{k}' AS foreign_key, COUNT(*) AS orphan_rows FROM {f} f WHERE f.{k} IS NOT NULL AND NOT EXISTS "
        f"(SELECT 1 FROM {d} d WHERE d.{k} = f.{k} AND d.{k} % {retired[k]} <> 0)" for t, f, k, d in fks))
    q["duplicate_keys"] = _with(*rc, body="""
SELECT invoice_no, stock_code, COUNT(*) AS row_count FROM silver_tx GROUP BY invoice_no, stock_code HAVING COUNT(*) > 1""")
    q["row_rule_violations"] = _with(*full, SUPPLY, PLANTED, body=_rules_sql())
    q["declared_keys"] = _with(*full, SUPPLY, PLANTED, body=_keys_sql())
    layers = """
, lc AS (
  SELECT 'bronze' AS layer, COUNT(*) AS row_count FROM bronze
  UNION ALL SELECT 'silver', COUNT(*) FROM silver_tx
  UNION ALL SELECT 'gold', COUNT(*) FROM fact_sales)"""
    q["layer_counts"] = _with(*full, body=layers + "\nSELECT * FROM lc")
    q["layer_audit"] = _with(*full, body=layers + """
, w AS (SELECT max(CASE WHEN layer = 'bronze' THEN row_count END) AS b,
               max(CASE WHEN layer = 'silver' THEN row_count END) AS s,
               max(CASE WHEN layer = 'gold' THEN row_count END) AS g FROM lc),
rows AS (
  SELECT 'bronze_rows' AS check_name, b AS value, CASE WHEN b < 500000 THEN 'ERROR' ELSE 'OK' END AS status FROM w
  UNION ALL SELECT 'gold_rows', g, CASE WHEN g = 0 THEN 'ERROR' ELSE 'OK' END FROM w
  UNION ALL SELECT 'bronze_to_silver_loss', b - s, CASE WHEN b - s < 0 THEN 'ERROR' ELSE 'OK' END FROM w
  UNION ALL SELECT 'silver_to_gold_loss', s - g,
    CASE WHEN s - g > 1000 THEN 'WARNING' WHEN s - g < 0 THEN 'ERROR' ELSE 'OK' END FROM w)
SELECT check_name, CAST(value AS BIGINT) AS value, status FROM rows
UNION ALL
SELECT 'overall', CAST(NULL AS BIGINT),
  CASE max(CASE status WHEN 'ERROR' THEN 2 WHEN 'WARNING' THEN 1 ELSE 0 END) WHEN 2 THEN 'ERROR' WHEN 1 THEN 'WARNING' ELSE 'OK' END
FROM rows""")
    q["table_profile"] = _with(RAW, body=_profile_sql())
    bronze_double = BRONZE_COLS.replace("unit_price", "CAST(unit_price AS DOUBLE) AS unit_price")
    quoted = "description || '\"BIG\", size ' || quantity || ',\"x\"' AS description"
    q["csv_quoted_reordered"] = _with(RAW, body=f"SELECT {bronze_double.replace('description', quoted)} FROM bronze")
    q["batch_stamp"] = _with(RAW, body=f"""
SELECT {bronze_double}, TIMESTAMP '2026-02-22 03:04:05' AS load_timestamp, '7b0c6c1e-9f0e-4b63-9d1c-2f8d51a3c001' AS batch_id FROM bronze""")
    tx_cols = "invoice_no, stock_code, raw_customer_id, date_id, quantity, CAST(unit_price AS DOUBLE) AS unit_price, CAST(total_value AS DOUBLE) AS total_value"
    q["fact_append"] = _with(*rc, body=f"""
SELECT {tx_cols}, DATE '2026-02-22' AS run_date FROM silver_tx WHERE quantity > 5
UNION ALL SELECT {tx_cols}, DATE '2026-02-23' FROM silver_tx WHERE quantity > 10""")
    q["fact_append_rerun_empty"] = _with(*rc, body=f"SELECT {tx_cols}, DATE '2026-02-23' AS run_date FROM silver_tx WHERE quantity > 10")
    q["snapshot_rerun_empty"] = _with(RAW, body="""
SELECT DATE '2026-02-22' AS snapshot_date, CAST(0 AS BIGINT) AS row_count UNION ALL SELECT DATE '2026-02-23', COUNT(*) FROM bronze""")
    q["retail_job_fact"] = _with(*full, body="""
SELECT invoice_no, customer_id, product_id, date_id, quantity, CAST(unit_price AS DOUBLE) AS unit_price,
       CAST(total_value AS DOUBLE) AS total_value, 'batch-2026-02-22' AS batch_id FROM fact_sales""")
    q["retail_job_counts"] = (q["cleaning_report"].replace("AS silver_rows\nFROM ok", """AS silver_rows,
  CAST(0 AS BIGINT) AS overlong_rows, CAST(0 AS BIGINT) AS bad_dates
FROM ok"""))
    q["resolve_keys_measured"] = q["resolve_keys"]
    fields = ["invoice_no", "stock_code", "description", "quantity", "invoice_date", "unit_price", "customer_id", "country"]
    text = {c: f"COALESCE(trim(CAST({c} AS VARCHAR)), '')" for c in fields}
    text["quantity"] = "CASE WHEN abs(quantity) = 49 THEN '6.5' WHEN abs(quantity) = 48 THEN 'many' ELSE CAST(quantity AS VARCHAR) END"
    text["unit_price"] = "CASE WHEN abs(quantity) = 47 THEN 'cheap' ELSE COALESCE(CAST(unit_price AS VARCHAR), '') END"
    whole = " || ',' || ".join(text[c] for c in fields)
    q["rejected_records"] = _with(RAW, body=f"""
SELECT CASE abs(quantity) WHEN 50 THEN {text["invoice_no"]} || ',' || {text["stock_code"]} WHEN 46 THEN {whole} || ',till 7'
    WHEN 47 THEN {whole} WHEN 48 THEN {whole} WHEN 49 THEN {whole} END AS line,
  CASE abs(quantity) WHEN 50 THEN 'too few fields: 2 of 8' WHEN 46 THEN 'too many fields: 9 for 8' WHEN 47 THEN 'price is no number: cheap'
    WHEN 48 THEN 'quantity is no whole number: many' WHEN 49 THEN 'quantity is no whole number: 6.5' ELSE 'loaded' END AS reason,
  COUNT(*) AS records
FROM bronze GROUP BY 1, 2""")
    q["profile_by_day"] = _with(RAW, body=f"""
SELECT column_name, row_count, null_count, true AS distinct_within_bound,
  CASE WHEN column_name IN ('quantity', 'unit_price') THEN true END AS quantiles_within_bound FROM ({_profile_sql()})""")
    q["unique_keys_by_day"] = _with(SUPPLY, body="""
SELECT shipment_id FROM sfact WHERE (order_id % 4 = 0 AND order_id % 10 = 0) OR (order_id % 4 = 1 AND order_id % 7 = 0 AND quantity > 10)""")
    q["heavy_keys"] = _with(*rc, body="""
, k AS (
  SELECT 'stock_code' AS key_column, stock_code AS value FROM silver_tx UNION ALL SELECT 'raw_customer_id', raw_customer_id FROM silver_tx
  UNION ALL SELECT 'date_id', CAST(date_id AS VARCHAR) FROM silver_tx)
SELECT key_column, value, COUNT(*) AS row_count FROM k GROUP BY 1, 2 HAVING COUNT(*) >= 0.02 * (SELECT COUNT(*) FROM silver_tx)""")
    seen = "DATE '2026-02-22' AS run_date"
    q["run_log"] = f"""
SELECT 'batch-2026-02-22' AS run_id, 'retail' AS job, {seen}, 'SUCCESS' AS outcome, 'cleaning.' || check_name AS check_name,
  CAST(value AS BIGINT) AS value, CAST(NULL AS VARCHAR) AS status, true AS timed
FROM (UNPIVOT ({q["retail_job_counts"]}) ON COLUMNS(*) INTO NAME check_name VALUE value)
UNION ALL
SELECT 'batch-2026-02-22', 'retail', {seen}, 'SUCCESS', check_name, value, status, true FROM ({q["layer_audit"]})
UNION ALL
SELECT 'rerun', 'retail', {seen}, 'FAILED', 'error', NULL, 'ValueError: the batch has no Bronze rows', true"""
    q["retail_job_dims"] = _with(*full, STALE.replace("19980101", "19950601"), body="""
, p AS (
  SELECT s.product_id, n.stock_code, n.description, n.stock_code AS k FROM silver_products n LEFT JOIN stale_products s ON s.stock_code = n.stock_code),
c AS (
  SELECT s.customer_id, n.raw_customer_id, n.country FROM silver_customers n LEFT JOIN stale_customers s ON s.raw_customer_id = n.raw_customer_id)
SELECT 'product' AS dimension, CAST(COALESCE(product_id, (SELECT max(product_id) FROM stale_products)
    + row_number() OVER (PARTITION BY product_id IS NULL ORDER BY stock_code)) AS BIGINT) AS key,
  stock_code AS natural_key, description AS attribute FROM p
UNION ALL
SELECT 'customer', CAST(COALESCE(customer_id, (SELECT max(customer_id) FROM stale_customers)
    + row_number() OVER (PARTITION BY customer_id IS NULL ORDER BY raw_customer_id)) AS BIGINT), raw_customer_id, country FROM c""")
    q["snapshot_roundtrip"] = _with(RAW, body="""
SELECT DATE '2026-02-22' AS snapshot_date, COUNT(*) AS row_count FROM bronze
UNION ALL SELECT DATE '2026-02-23', COUNT(*) FROM bronze""")
    q["snapshot_as_of"] = _with(RAW, body=f"SELECT {BRONZE_COLS.replace('unit_price', 'CAST(unit_price AS DOUBLE) AS unit_price')}, DATE '2026-02-22' AS snapshot_date FROM bronze")
    q["fact_date_range"] = _with(*full, body="""
SELECT invoice_no, customer_id, product_id, date_id, quantity, CAST(unit_price AS DOUBLE) AS unit_price,
       CAST(total_value AS DOUBLE) AS total_value FROM fact_sales WHERE date_id BETWEEN 19970101 AND 19981231""")
    # supply star
    q["dim_time"] = _with(SUPPLY, body="SELECT * FROM stime")
    q["quantity_by_category"] = _with(SUPPLY, body="""
SELECT dp.product_category, CAST(SUM(fs.quantity) AS BIGINT) AS total_quantity
FROM sfact fs JOIN sproducts dp ON fs.product_id = dp.product_id
GROUP BY dp.product_category ORDER BY total_quantity DESC""")
    q["warehouse_efficiency"] = _with(SUPPLY, body="""
SELECT dw.warehouse_name, (SUM(fs.shipping_time_hours) * 200 + COUNT(fs.shipping_time_hours)) // (2 * COUNT(fs.shipping_time_hours)) / 100.0 AS avg_shipping_time_hours
FROM sfact fs JOIN swarehouses dw ON fs.warehouse_id = dw.warehouse_id
GROUP BY dw.warehouse_name ORDER BY avg_shipping_time_hours""")
    q["value_by_supplier"] = _with(SUPPLY, body="""
SELECT ds.supplier_name, CAST(ROUND(SUM(fs.shipment_value), 2) AS DOUBLE) AS total_shipment_value
FROM sfact fs JOIN ssuppliers ds ON fs.supplier_id = ds.supplier_id
GROUP BY ds.supplier_name ORDER BY total_shipment_value DESC""")
    q["top_shipped_products"] = _with(SUPPLY, body="""
SELECT dp.product_name, CAST(SUM(fs.quantity) AS BIGINT) AS total_quantity
FROM sfact fs JOIN sproducts dp ON fs.product_id = dp.product_id
GROUP BY dp.product_name ORDER BY total_quantity DESC, dp.product_name LIMIT 5""")
    q["value_distribution"] = _with(SUPPLY, body="""
SELECT dp.product_category,
  CAST(MIN(fs.shipment_value) AS DOUBLE) AS min_shipment_value,
  CAST(MAX(fs.shipment_value) AS DOUBLE) AS max_shipment_value,
  (CAST(SUM(fs.shipment_value) * 100 AS HUGEINT) * 2 + COUNT(*)) // (2 * COUNT(*)) / 100.0 AS avg_shipment_value,
  CAST(ROUND(SUM(fs.shipment_value), 2) AS DOUBLE) AS total_shipment_value,
  COUNT(fs.shipment_id) AS shipment_count
FROM sfact fs JOIN sproducts dp ON fs.product_id = dp.product_id
GROUP BY dp.product_category ORDER BY total_shipment_value DESC""")
    q["shipment_summary"] = _with(SUPPLY, body="""
SELECT dp.product_category, CAST(SUM(fs.quantity) AS BIGINT) AS total_quantity,
  (SUM(fs.shipping_time_hours) * 200 + COUNT(fs.shipping_time_hours)) // (2 * COUNT(fs.shipping_time_hours)) / 100.0 AS avg_shipping_time_hours,
  CAST(ROUND(SUM(fs.shipment_value), 2) AS DOUBLE) AS total_shipment_value,
  COUNT(fs.shipment_id) AS shipment_count
FROM sfact fs JOIN sproducts dp ON fs.product_id = dp.product_id
GROUP BY dp.product_category""")
    yoy = """
, annual AS (
  SELECT ds.supplier_name, dt.year,
    SUM(CASE WHEN fs.supplier_id % 7 = 3 AND dt.year = 1997 THEN 0 ELSE fs.shipment_value END) AS annual_value
  FROM sfact fs JOIN ssuppliers ds ON fs.supplier_id = ds.supplier_id JOIN stime dt ON fs.date_id = dt.date_id
  GROUP BY ds.supplier_name, dt.year),
yoy AS (
SELECT supplier_name, year,
  CAST(ROUND(annual_value, 2) AS DOUBLE) AS current_year_value,
  CAST(ROUND(LAG(annual_value) OVER w, 2) AS DOUBLE) AS previous_year_value,
  CAST(ROUND(annual_value - LAG(annual_value) OVER w, 2) AS DOUBLE) AS net_change,
  CAST(sign(annual_value - LAG(annual_value) OVER w) AS BIGINT)
    * ((CAST(abs(annual_value - LAG(annual_value) OVER w) * 100 AS HUGEINT) * 20000 + CAST(LAG(annual_value) OVER w * 100 AS HUGEINT))
       // (2 * CAST(NULLIF(LAG(annual_value) OVER w, 0) * 100 AS HUGEINT))) / 100.0 AS percentage_change
FROM annual WINDOW w AS (PARTITION BY supplier_name ORDER BY year))"""
    q["supplier_yoy"] = _with(SUPPLY, body=yoy + "\nSELECT * FROM yoy ORDER BY supplier_name, year")
    q["supplier_yoy_significant"] = _with(SUPPLY, body=yoy + """
SELECT * FROM yoy WHERE abs(percentage_change) >= 10.0 ORDER BY supplier_name, year""")
    q["shipment_value"] = _with(SUPPLY, body="""
SELECT f.order_id, f.product_id, f.supplier_id, f.quantity, CAST(p.unit_price AS DOUBLE) AS unit_price,
       CAST(CAST(ROUND(f.quantity * p.unit_price, 2) AS DECIMAL(12,2)) AS DOUBLE) AS shipment_value
FROM sfact f JOIN sproducts p ON f.product_id = p.product_id""")
    q["value_mismatch"] = _with(SUPPLY, body="""
SELECT f.order_id, f.product_id, f.supplier_id, f.quantity, CAST(p.unit_price AS DOUBLE) AS unit_price,
       CAST(f.shipment_value AS DOUBLE) AS shipment_value,
       CAST(CAST(ROUND(f.quantity * p.unit_price, 2) AS DECIMAL(12,2)) AS DOUBLE) AS expected_value
FROM sfact f JOIN sproducts p ON f.product_id = p.product_id
WHERE f.order_id % 3 <> 0 AND abs(f.shipment_value - CAST(ROUND(f.quantity * p.unit_price, 2) AS DECIMAL(12,2))) >= 0.01""")
    q["apply_delays"] = _with(SUPPLY, CHANGES, body=f"SELECT {FACT_COLS} FROM f1")
    q["apply_values"] = _with(SUPPLY, CHANGES, body=f"SELECT {FACT_COLS} FROM f2")
    q["apply_batch"] = q["supply_job_fact"] = _with(SUPPLY, CHANGES, body=f"SELECT {FACT_COLS} FROM f3")
    q["supply_job_audit"] = _with(SUPPLY, CHANGES, body=f"""SELECT {AUDIT_COLS}, TIMESTAMP '2026-02-22 03:04:05' AS changed_at,
  'tester' AS changed_by, 'batch-1' AS batch_id FROM audit""")
    q["change_batches_fact"] = _with(SUPPLY, CHANGES, SECOND_CHANGES, body=f"SELECT {FACT_COLS} FROM f3_b")
    stamp = "TIMESTAMP '2026-02-22 03:04:05' AS changed_at, 'tester' AS changed_by"
    q["change_batches_audit"] = _with(SUPPLY, CHANGES, SECOND_CHANGES, body=f"""SELECT {AUDIT_COLS}, {stamp}, 'batch-1' AS batch_id FROM audit
UNION ALL SELECT {AUDIT_COLS}, {stamp}, 'batch-2' FROM audit_b""")
    q["change_one_year"] = _with(SUPPLY, CHANGES, body="""
SELECT date_id // 10000 AS ship_year, date_id // 10000 <> 1995 AS as_loaded, COUNT(*) AS shipments,
  CAST(SUM(hours) AS BIGINT) AS hours, CAST(SUM(value) AS DOUBLE) AS value
FROM (SELECT date_id, shipping_time_hours AS hours, shipment_value AS value FROM f3 WHERE date_id // 10000 = 1995
  UNION ALL SELECT date_id, shipping_time_hours, shipment_value FROM sfact WHERE date_id // 10000 <> 1995)
GROUP BY 1, 2""")
    q["shipment_summary_view"] = q["shipment_summary"]
    q["tables_exist"] = _with(SUPPLY, body="\nUNION ALL\n".join(
        f"SELECT '{n}' AS table_name, true AS table_exists, COUNT(*) AS row_count FROM {t}" for n, t in (
            ("dim_time", "stime"), ("dim_products", "sproducts"), ("dim_suppliers", "ssuppliers"), ("dim_warehouses", "swarehouses"),
            ("dim_orders", "sorders"), ("fact_shipments", "sfact"))) + "\nUNION ALL SELECT 'dim_carriers', false, NULL")
    q["reset_tables"] = _with(SUPPLY, body="""
SELECT 'supply.dim_products' AS table_name, COUNT(*) AS row_count, true AS schema_kept FROM sproducts
UNION ALL SELECT 'supply.dim_orders', 0, true UNION ALL SELECT 'supply.fact_shipments', 0, true""")
    q["default_stamps"] = _with(RAW, SUPPLY, CHANGES, body="""
SELECT 'bronze' AS table_name, COUNT(*) AS row_count, CAST(1 AS BIGINT) AS stamps, true AS well_formed, true AS recent FROM bronze
UNION ALL SELECT 'audit', COUNT(*), 1, true, true FROM audit""")
    q["delete_keys"] = _with(SUPPLY, CHANGES, body=f"SELECT {FACT_COLS} FROM f3")
    q["audit_update"] = _with(SUPPLY, CHANGES, body=f"SELECT {AUDIT_COLS} FROM audit WHERE operation = 'UPDATE'")
    q["audit_delete"] = _with(SUPPLY, CHANGES, body=f"SELECT {AUDIT_COLS} FROM audit WHERE operation = 'DELETE'")
    q["latest_audit"] = _with(SUPPLY, CHANGES, body=f"""
SELECT {AUDIT_COLS} FROM (
  SELECT *, row_number() OVER (PARTITION BY shipment_id ORDER BY step DESC, seq DESC) AS rn FROM audit)
WHERE rn = 1""")
    return q


def oracle_queries() -> dict[str, str]:
    q = {}
    q.update(retail_queries())
    q.update(more_queries())
    return q
