"""Cleaning operators on the reference's literal test inputs plus edge rows."""

from decimal import Decimal

import pytest

from starmart.operators import clean as C
from starmart.sources import files

COLS = "invoice_no string, stock_code string, description string, quantity int, invoice_date string, " \
       "unit_price decimal(10,2), customer_id string, country string"


def bronze(spark, rows):
    return spark.createDataFrame(rows, COLS)


def run(spark, rows):
    cleaned = C.clean(bronze(spark, rows))
    return (C.silver_transactions(cleaned), C.silver_products(cleaned), C.silver_customers(cleaned))


def test_duplicates_dropped(spark):
    rows = [("1", "A", "D1", 1, "2010-12-01", Decimal("1.0"), "C1", "UK"),
            ("1", "A", "D1", 1, "2010-12-01", Decimal("1.0"), "C1", "UK"),
            ("2", "B", "D2", 2, "2010-12-01", Decimal("2.0"), "C2", "UK")]
    tx, _, _ = run(spark, rows)
    assert tx.count() == 2


def test_null_customer_becomes_unknown(spark):
    rows = [("1", "A", "D1", 1, "2010-12-01", Decimal("1.0"), None, "UK")]
    tx, _, cust = run(spark, rows)
    assert tx.first()["raw_customer_id"] == "UNKNOWN"
    assert cust.first()["raw_customer_id"] == "UNKNOWN"


def test_price_filter_keeps_positive_only(spark):
    rows = [("1", "A", "D", 1, "2010-12-01", Decimal("1.5"), "C", "UK"),
            ("2", "B", "D", 1, "2010-12-01", Decimal("0"), "C", "UK"),
            ("3", "C", "D", 1, "2010-12-01", Decimal("-2"), "C", "UK")]
    tx, _, _ = run(spark, rows)
    out = tx.collect()
    assert len(out) == 1 and out[0]["unit_price"] == Decimal("1.50")


def test_total_value(spark):
    rows = [("1", "A", "D", 3, "2010-12-01", Decimal("2.50"), "C", "UK")]
    tx, _, _ = run(spark, rows)
    assert tx.first()["total_value"] == Decimal("7.50")


def test_date_id(spark):
    rows = [("1", "A", "D", 1, "2010-12-01 08:26:00", Decimal("1"), "C", "UK"),
            ("2", "A", "D", 1, "12/1/2010 8:26", Decimal("1"), "C", "UK")]
    tx, _, _ = run(spark, rows)
    assert {r["date_id"] for r in tx.collect()} == {20101201}


def test_whitespace_variants_survive_dedup_then_strip(spark):
    rows = [("1", "A", "D", 1, "2010-12-01", Decimal("1"), "C", "UK"),
            ("1", "A", "D ", 1, "2010-12-01", Decimal("1"), "C", "UK")]
    tx, _, _ = run(spark, rows)
    assert tx.count() == 2


def test_non_breaking_space_stripped(spark):
    rows = [("1", "A", " Mug ", 1, "2010-12-01", Decimal("1"), "C", "\tUK ")]
    cleaned = C.clean(bronze(spark, rows)).first()
    assert cleaned["description"] == "Mug" and cleaned["country"] == "UK"


def test_blank_description_gets_sentinel(spark):
    rows = [("1", "A", "   ", 1, "2010-12-01", Decimal("1"), "C", "UK"),
            ("2", "B", None, 1, "2010-12-01", Decimal("1"), "C", "UK")]
    _, prod, _ = run(spark, rows)
    assert {r["description"] for r in prod.collect()} == {"NO DESCRIPTION"}


def test_sub_cent_price_rounds_then_filters(spark):
    raw = spark.createDataFrame([("1", "A", "D", "1", "2010-12-01", "0.004", "C", "UK"),
                                 ("2", "A", "D", "1", "2010-12-01", "0.005", "C", "UK")],
                                "invoice_no string, stock_code string, description string, quantity string, "
                                "invoice_date string, unit_price string, customer_id string, country string")
    b = files.to_bronze_types(raw)
    tx, _, _ = (C.silver_transactions(C.clean(b)), None, None)
    out = tx.collect()
    assert len(out) == 1 and out[0]["unit_price"] == Decimal("0.01")


def test_zero_and_negative_quantity_kept(spark):
    rows = [("1", "A", "D", 0, "2010-12-01", Decimal("1"), "C", "UK"),
            ("C2", "A", "D", -3, "2010-12-01", Decimal("1"), "C", "UK")]
    tx, _, _ = run(spark, rows)
    assert sorted(r["quantity"] for r in tx.collect()) == [-3, 0]


def test_float_customer_id_text(spark):
    raw = spark.createDataFrame([("1", "A", "D", "1", "2010-12-01", "1", "17850.0", "UK")],
                                "invoice_no string, stock_code string, description string, quantity string, "
                                "invoice_date string, unit_price string, customer_id string, country string")
    assert files.to_bronze_types(raw).first()["customer_id"] == "17850"


def test_unparsable_date_fails_job(spark):
    rows = [("1", "A", "D", 1, "not a date", Decimal("1"), "C", "UK")]
    with pytest.raises(Exception, match="unparsable"):
        C.clean(bronze(spark, rows)).collect()


def test_mandatory_null_dropped_blank_stock_code_passes(spark):
    rows = [(None, "A", "D", 1, "2010-12-01", Decimal("1"), "C", "UK"),
            ("2", "  ", "D", 1, "2010-12-01", Decimal("1"), "C", "UK"),
            ("3", "A", "D", 1, "2010-12-01", None, "C", "UK")]
    tx, _, _ = run(spark, rows)
    assert [r["invoice_no"] for r in tx.collect()] == ["2"]


def test_first_row_per_key_is_earliest(spark):
    rows = [("2", "A", "D", 1, "2010-12-02", Decimal("1"), None, "France"),
            ("1", "B", "D", 1, "2010-12-01", Decimal("1"), None, "Spain")]
    _, _, cust = run(spark, rows)
    assert cust.first()["country"] == "Spain"


def test_cleaning_report_conserves_rows(spark):
    from starmart.sources import testbed as TB
    rep = C.cleaning_report(TB.bronze(spark, "/root/testdata/sf0.01")).first()
    assert (rep["bronze_rows"], rep["duplicates_dropped"], rep["null_mandatory_dropped"],
            rep["bad_price_dropped"], rep["silver_rows"]) == (60586, 586, 1354, 3142, 55504)
    assert rep["bronze_rows"] - rep["duplicates_dropped"] - rep["null_mandatory_dropped"] \
        - rep["bad_price_dropped"] == rep["silver_rows"]


def test_observed_metrics_match_report(spark):
    from starmart.sources import testbed as TB
    cleaned, obs = C.clean_observed(TB.bronze(spark, "/root/testdata/sf0.001"))
    n = cleaned.count()
    m = obs.get
    assert m["silver_rows"] == n
    rep = C.cleaning_report(TB.bronze(spark, "/root/testdata/sf0.001")).first().asDict()
    for k in ("bronze_rows", "duplicates_dropped", "null_mandatory_dropped", "customers_filled",
              "descriptions_filled", "bad_price_dropped", "silver_rows"):
        assert m[k] == rep[k], k


def test_net_equals_gross_minus_returns(spark):
    from starmart.plans import retail as R
    from starmart.plans.queries import retail_star
    s = retail_star(spark, "/root/testdata/sf0.01")
    r = R.sales_vs_returns(s.fact_sales).first()
    assert r["net_revenue"] == r["gross_sales"] - r["total_returns"]
    assert (float(r["gross_sales"]), float(r["total_returns"]), float(r["net_revenue"])) == \
        (893633964.00, 447097597.30, 446536366.70)


def test_known_answers_sf001(spark):
    from starmart.plans import queries as Q
    d = "/root/testdata/sf0.01"
    top = Q.q_top_products(spark, d).first()
    assert (top["stock_code"], top["description"], top["total_revenue"]) == ("P982", "cold anvil", 806545.60)
    cust = Q.q_top_customers(spark, d).first()
    assert (cust["raw_customer_id"], cust["total_spend"]) == ("219", 1115268.50)
    shipped = Q.q_top_shipped_products(spark, d).first()
    assert (shipped["product_name"], shipped["total_quantity"]) == ("red plate", 34823)
    assert Q.q_silver_customers(spark, d).count() == 1126
    assert Q.q_supplier_yoy(spark, d).count() == 700
