"""Print the final operator trees of the headline plans as the jobs run them.

Usage: python tools/plan_trees.py [sf_dir] >> PLANS.md
Runs the retail job and loads the supply star into a scratch folder first, then shows
the AQE final plan (operator tree only) of: Bronze -> Silver cleaning, fact key
resolution, one retail report, the year-over-year report and the one-pass change batch.
"""

from __future__ import annotations

import io
import os
import sys
import tempfile
from contextlib import redirect_stdout
from datetime import date

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def tree(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    body = text.split("\n\n\n")[0]  # the tree; node details follow after blank lines
    return body.split("+- == Initial Plan ==")[0].rstrip()


def main():
    from starmart.operators import clean as C
    from starmart.operators import joins as J
    from starmart.operators import quality as Q
    from starmart.plans import retail as R
    from starmart.plans import retail_job as RP
    from starmart.plans import supply as SR
    from starmart.plans import supply_job as SP
    from starmart.session import build_session
    from starmart.sources import files, keyed, versions
    from starmart.sources import testbed as TB

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    work = tempfile.mkdtemp(prefix="starmart-trees-")
    spark = build_session("local[8]", 16, extra={"spark.driver.memory": "8g",
                                                 "spark.checkpoint.dir": f"{work}/ck"})
    csv = f"{work}/csv"
    files.write_csv(TB.raw_source(spark, sf_dir), csv)
    RP.run_retail(spark, csv, f"{work}/wh", date(2026, 2, 22))
    SP.run_supply(spark, sf_dir, f"{work}/supply")
    p = RP.paths(f"{work}/wh")
    bronze = RP.bronze(spark, f"{work}/wh", date(2026, 2, 22), in_place=True)
    tx = spark.read.parquet(p["silver_tx"])
    dp = versions.read_current(spark, p["dim_products"])
    dc = versions.read_current(spark, p["dim_customers"])
    fact = versions.read_current(spark, p["fact_sales"])
    s = f"{work}/supply"
    sf = spark.read.parquet(f"{s}/fact_shipments/v=1")
    after, audit = SP.apply_change_batch_one_pass(sf)
    facts = SP.facts_path(s)
    now = versions.read_current(spark, facts)
    shown = {
        "Bronze -> Silver transactions (cleaning with step counts, as the job runs it)": C.silver_transactions(C.clean_observed(bronze)[0]),
        "Fact key resolution (two lookups, measured heavy keys salted)": R.fact_sales(
            tx, dp, dc, heavy=J.heavy_keys(tx, ["stock_code", "raw_customer_id"])),
        "revenue_by_country over Gold": R.revenue_by_country(fact, dc),
        "supplier_yoy over the supply star": SR.supplier_yoy(
            SP.shipments(spark, s), spark.read.parquet(f"{s}/dim_suppliers"),
            spark.read.parquet(f"{s}/dim_time")),
        "change batch: fact rewrite (one join)": after,
        "change batch: audit rows": audit,
        "live batch: years touched (ids of the fact, semi-join)": now.select("shipment_id", SP.YEAR).join(
            sf.where("shipment_id % 60 = 0").select("shipment_id"), "shipment_id", "left_semi").select(SP.YEAR).distinct(),
        "live batch: the rows of one touched year (other years are not listed)": versions.read_commit(
            spark, facts, versions.latest(spark, facts), [f"{SP.YEAR}=1995"]).where("quantity > 0"),
        "load: fact with the rules counted by its write": Q.ObservedRules(SP.build_star(spark, sf_dir).fact_shipments, "supply.fact_shipments").rows,
        "keys of a new day against a stored filter": keyed.probes(sf.select("shipment_id"), "shipment_id").join(
            keyed.key_filter(sf.where("shipment_id % 2 = 0"), "shipment_id"), "word"),
    }
    print(f"\n## Operator trees ({os.path.basename(sf_dir)}, tables written by the jobs)\n")
    for title, df in shown.items():
        print(f"### {title}\n\n```\n{tree(df)}\n```\n")
    spark.stop()


if __name__ == "__main__":
    main()
