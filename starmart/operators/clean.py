"""Bronze -> Silver cleaning.

Step order is part of the semantics and follows the reference: exact dedup, drop rows
missing a mandatory field, fill the customer sentinel, fill the description sentinel,
strip every string, parse the date, derive ``date_id``, drop non-positive prices, derive
the line value, then split into the three Silver tables.

Plan shape: the dedup is the only shuffle (an aggregate on the eight business columns,
with map-side partial aggregation, so a row copied many times collapses before the
exchange); every other step is a narrow projection/filter fused into one codegen stage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.functions.dates import date_id, parse_timestamp
from starmart.functions.money import line_value
from starmart.functions.text import strip_unicode
from starmart.operators import slices
from starmart.schemas import BUSINESS_COLUMNS, VARCHAR_LIMITS

# Fixed values of the reference cleaning rules.
MANDATORY = ["invoice_no", "stock_code", "unit_price"]
CUSTOMER_SENTINEL = "UNKNOWN"
DESCRIPTION_SENTINEL = "NO DESCRIPTION"
DEDUP_SLICES = 4         # exchanges of the job's dedup, at most
# Order that defines the "first" row of a key (the reference relies on table order).
FIRST_ROW_ORDER = ["invoice_ts", "invoice_no", "stock_code", "country"]


def dedup_exact(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Drop exact copies over the business columns (null-safe); the result has just
    these. Batch columns are constant within a batch: carried along they would cross the
    exchange and, as strings to keep one of, turn the hash aggregate into a sort."""
    cols = columns or [c for c in BUSINESS_COLUMNS if c in df.columns]
    return df.select(*cols).distinct()


def _any_null(cols: list[str]) -> Column:
    cond = F.lit(False)
    for c in cols:
        cond = cond | F.col(c).isNull()
    return cond


def require(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Drop rows where a mandatory field is null."""
    return df.filter(~_any_null(columns or MANDATORY))


def fill_sentinel(df: DataFrame, column: str = "customer_id",
                  value: str = CUSTOMER_SENTINEL) -> DataFrame:
    """Null -> sentinel."""
    return df.withColumn(column, F.coalesce(F.col(column), F.lit(value)))


def _blank(column: str) -> Column:
    return F.col(column).isNull() | (strip_unicode(column) == "")


def fill_blank(df: DataFrame, column: str = "description",
               value: str = DESCRIPTION_SENTINEL) -> DataFrame:
    """Null or blank -> sentinel."""
    return df.withColumn(column, F.when(_blank(column), F.lit(value)).otherwise(F.col(column)))


def strip_strings(df: DataFrame) -> DataFrame:
    """P5: strip leading/trailing Unicode blanks from every string column."""
    return df.select(*[
        strip_unicode(f.name).alias(f.name) if isinstance(f.dataType, T.StringType)
        else F.col(f.name)
        for f in df.schema.fields])


def parse_dates(df: DataFrame, column: str = "invoice_date", out: str = "invoice_ts",
                formats: list[str] | None = None) -> DataFrame:
    """String -> timestamp; a null or unparsable value fails the job."""
    return df.withColumn(out, parse_timestamp(column, formats, strict=True, label=column))


def with_date_id(df: DataFrame, ts_column: str = "invoice_ts") -> DataFrame:
    """``YYYYMMDD`` integer key.

    The timestamp is never null after the strict parse, but Spark types a timestamp to
    date conversion as nullable; the unreachable ``0`` keeps the key non-nullable so joins
    on it infer no not-null filter that would be pushed below the dedup (which would copy
    the whole parse expression into the scan)."""
    return df.withColumn("date_id", F.coalesce(date_id(ts_column), F.lit(0)))


def valid_price(df: DataFrame) -> DataFrame:
    """Keep positive prices; negative quantities (returns) stay."""
    return df.filter(F.col("unit_price") > 0)


def with_total_value(df: DataFrame) -> DataFrame:
    """total_value = quantity * unit_price as NUMERIC(12,2)."""
    return df.withColumn("total_value", line_value("quantity", "unit_price"))


def clean_stages(bronze: DataFrame, formats: list[str] | None = None) -> dict[str, DataFrame]:
    """Every intermediate frame of the cleaning chain, by step name (lazy)."""
    s = {}
    s["exact_dedup"] = dedup_exact(bronze)
    s["mandatory_fields"] = require(s["exact_dedup"])
    s["customer_sentinel"] = fill_sentinel(s["mandatory_fields"])
    s["description_sentinel"] = fill_blank(s["customer_sentinel"])
    s["stripped_strings"] = strip_strings(s["description_sentinel"])
    s["parsed_dates"] = parse_dates(s["stripped_strings"], formats=formats)
    s["date_id"] = with_date_id(s["parsed_dates"])
    s["valid_price"] = valid_price(s["date_id"])
    s["line_value"] = with_total_value(s["valid_price"])
    return s


def clean(bronze: DataFrame, formats: list[str] | None = None) -> DataFrame:
    """Bronze -> cleaned rows (all columns needed by the three Silver tables).

    The price filter is pushed into the scan, so the strict date parse sees the rows kept
    by it; :func:`clean_observed`, which the job runs, checks the dates of all rows."""
    return clean_stages(bronze, formats)["line_value"]


def clean_observed(bronze: DataFrame, formats: list[str] | None = None
                   ) -> tuple[DataFrame, "CleaningMetrics"]:
    """Like :func:`clean`, with the step row counts attached as observed metrics.

    The counts are collected by the same job that materialises the result; no extra
    ``count()`` passes over the data. Dates that do not parse are counted over all rows
    with their mandatory fields, also those the price filter drops after it; the caller
    must not publish rows when ``bad_dates`` is not 0 (:meth:`CleaningMetrics.check`).
    """
    seen = Observation("bronze")
    obs = Observation("cleaning")
    limits = VARCHAR_LIMITS["bronze.raw_transactions"]
    long = F.lit(False)
    for c, n in limits.items():
        long = long | F.coalesce(F.length(c) > n, F.lit(False))
    d = dedup_exact(bronze.observe(seen, F.count(F.lit(1)).alias("bronze_rows"),
                                   F.coalesce(F.sum(long.cast("long")), F.lit(0)).alias("overlong_rows")))
    ok = ~_any_null(MANDATORY)
    d = d.withColumn("_ts", parse_timestamp(strip_unicode("invoice_date"), formats, strict=False))
    count = lambda cond: F.coalesce(F.sum(cond.cast("long")), F.lit(0))
    # one observation at the point where every needed count is visible
    counted = d.observe(
        obs,
        F.count(F.lit(1)).alias("after_dedup"),
        count(~ok).alias("null_mandatory_dropped"),
        count(ok & F.col("customer_id").isNull()).alias("customers_filled"),
        count(ok & _blank("description")).alias("descriptions_filled"),
        count(ok & (F.col("unit_price") <= 0)).alias("bad_price_dropped"),
        count(ok & F.col("_ts").isNull()).alias("bad_dates"),
    )
    s = fill_blank(fill_sentinel(require(counted)))
    s = with_date_id(strip_strings(s).withColumnRenamed("_ts", "invoice_ts"))
    return with_total_value(valid_price(s)), CleaningMetrics((seen, obs))


class CleaningMetrics:
    """Step counts observed while the cleaned rows are materialised (S5, Q3), added up over
    the slices of the batch (one pair of observations each)."""

    def __init__(self, *parts: tuple[Observation, Observation]):
        self.parts = parts

    @property
    def get(self) -> dict:
        m: dict = {}
        for seen, steps in self.parts:
            for k, v in {**seen.get, **steps.get}.items():
                m[k] = m.get(k, 0) + v
        m["duplicates_dropped"] = m["bronze_rows"] - m["after_dedup"]
        m["silver_rows"] = m["after_dedup"] - m["null_mandatory_dropped"] - m["bad_price_dropped"]
        return m

    def check(self) -> dict:
        """The counts; raises when the batch must not be published."""
        m = self.get
        if m["bronze_rows"] == 0:
            raise ValueError("the batch has no Bronze rows")
        if m["overlong_rows"]:
            raise ValueError(f"{m['overlong_rows']} Bronze rows hold text longer than declared")
        if m["bad_dates"]:
            raise ValueError(f"{m['bad_dates']} rows have an unparsable or missing invoice_date")
        return m


#: What the three Silver tables need of the cleaned rows.
SILVER_SOURCE = ["invoice_no", "stock_code", "description", "customer_id", "country", "invoice_ts", "date_id",
                 "quantity", "unit_price", "total_value"]


def stage_cleaned(cleaned: DataFrame, path: str) -> DataFrame:
    """The cleaned rows written once under ``path`` and read back, without the raw date: the
    three Silver tables are then scans of their columns, not three runs of the cleaning."""
    rows = cleaned.select(*SILVER_SOURCE)
    rows.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return cleaned.sparkSession.read.schema(rows.schema).parquet(path)


def stage_observed(bronze: DataFrame, path: str, n: int | None = None) -> tuple[DataFrame, CleaningMetrics]:
    """:func:`clean_observed` staged under ``path``, the exact dedup in ``n`` slices of the
    stored Bronze rows (by default as many as their size is worth): copies of a row are in
    one slice, so the rows and counts are those of one run."""
    cols = [c for c in BUSINESS_COLUMNS if c in bronze.columns]
    staged, parts = [], []
    for i, rows in enumerate(slices.split(bronze, n or slices.number(bronze, DEDUP_SLICES), cols)):
        cleaned, seen = clean_observed(rows)
        staged.append(stage_cleaned(cleaned, f"{path}/slice-{i}"))
        parts += seen.parts
    rows = bronze.sparkSession.read.schema(staged[0].schema).parquet(*[f"{path}/slice-{i}" for i in range(len(staged))])
    return rows, CleaningMetrics(*parts)


def stage_members(members: DataFrame, path: str) -> DataFrame:
    """A Silver dimension source (one row a key) written once under ``path`` and read back:
    what ranges, keys and checks its rows repeats no aggregate over the cleaned rows."""
    members.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return members.sparkSession.read.schema(members.schema).parquet(path)


def silver_transactions(cleaned: DataFrame) -> DataFrame:
    """Fact rows with natural keys."""
    return cleaned.select("invoice_no", "stock_code",
                          F.col("customer_id").alias("raw_customer_id"), "date_id",
                          "quantity", "unit_price", "total_value")


def first_per_key(df: DataFrame, key: str, value_columns: list[str],
                  order_columns: list[str] | None = None) -> DataFrame:
    """One row per key, taken from the first row in a stated order.

    Implemented as ``min(struct(order..., values...))`` per key: an aggregate with a
    map-side partial step (a sort aggregate, as a struct of strings has no fixed-width
    buffer), so a key holding a third of all rows is reduced inside each map task before
    the shuffle and never lands whole in one task. The key itself, the same in all rows of
    a group, is no part of the struct.
    """
    order = [c for c in (order_columns or FIRST_ROW_ORDER) if c in df.columns and c != key]
    fields = order + [c for c in value_columns if c not in order]
    picked = df.groupBy(key).agg(F.min(F.struct(*[F.col(c) for c in fields])).alias("_first"))
    return picked.select(key, *[F.col(f"_first.{c}").alias(c) for c in value_columns])


def silver_products(cleaned: DataFrame) -> DataFrame:
    """One product per stock code (the catalog's pair wording is not what runs)."""
    return first_per_key(cleaned, "stock_code", ["description"])


def silver_customers(cleaned: DataFrame) -> DataFrame:
    """One customer per id, including the UNKNOWN sentinel member."""
    c = first_per_key(cleaned, "customer_id", ["country"])
    return c.withColumnRenamed("customer_id", "raw_customer_id")


def cleaning_report(bronze: DataFrame) -> DataFrame:
    """Q3/A10: the step counts as one row, with conservation built in
    (``bronze_rows - duplicates - null_mandatory - bad_price = silver_rows``).

    One shuffle: the dedup aggregate keeps the copy count, then a global aggregate with
    a partial step produces the row.
    """
    groups = bronze.groupBy(*[c for c in BUSINESS_COLUMNS]).agg(F.count(F.lit(1)).alias("_n"))
    ok = ~_any_null(MANDATORY)
    return groups.agg(
        F.sum("_n").alias("bronze_rows"),
        (F.sum("_n") - F.count(F.lit(1))).alias("duplicates_dropped"),
        F.sum((~ok).cast("long")).alias("null_mandatory_dropped"),
        F.sum((ok & F.col("customer_id").isNull()).cast("long")).alias("customers_filled"),
        F.sum((ok & _blank("description")).cast("long")).alias("descriptions_filled"),
        F.sum((ok & (F.col("unit_price") <= 0)).cast("long")).alias("bad_price_dropped"),
        F.sum((ok & (F.col("unit_price") > 0)).cast("long")).alias("silver_rows"),
    )
