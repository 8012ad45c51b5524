"""CSV ingest and Parquet table I/O."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart import schemas
from starmart.functions.text import na_to_null


# --- S1: CSV scan ---------------------------------------------------------------------

def csv_header(spark: SparkSession, path: str, encoding: str = "ISO-8859-1") -> list[str]:
    """Column names of the files' own header line (one short read of the first file)."""
    return (spark.read.option("header", True).option("encoding", encoding).option("quote", '"')
            .option("escape", '"').option("inferSchema", False).csv(path).columns)


def read_raw_csv(spark: SparkSession, path: str, columns: list[str] | None = None,
                 encoding: str = "ISO-8859-1", na_values: list[str] | None = None,
                 multi_line: bool = False) -> DataFrame:
    """Read the retail CSV by its own header, every field as a string (no inference).

    The header decides which field is which: names are standardised (S2) to find the
    expected columns in any order; a missing one is an error and further columns are left
    out. Quotes inside a quoted field are doubled (``""``). ``na_values`` (default: the
    pandas token list) turns placeholder fields into nulls. A row with too few or too many
    fields fails the job.

    ``multi_line`` allows line breaks inside quoted fields. Such files cannot be split:
    one task reads one file, so keep them to a few hundred MB each. Without it a file is
    split by blocks across tasks.
    """
    cols = columns or schemas.RAW_CSV_COLUMNS
    header = csv_header(spark, path, encoding)
    schema = ", ".join(f"`{c}` STRING" for c in header)
    df = (spark.read.schema(schema)
          .option("header", True)
          .option("encoding", encoding)
          .option("quote", '"').option("escape", '"')
          .option("enforceSchema", False)       # every file's header must agree
          .option("multiLine", multi_line)
          .option("columnPruning", False)       # else a short row passes unseen
          .option("mode", "FAILFAST")
          .csv(path))
    return df.select(*[na_to_null(F.col(f"`{c}`"), na_values).alias(n) for c, n in by_header(header, cols).items()])


def by_header(header: list[str], expected: list[str]) -> dict[str, str]:
    """File column -> expected name, in the expected order; names meet when they are equal
    after standardising. A missing or repeated column is an error."""
    seen: dict[str, str] = {}
    for c in header:
        if standard_name(c) in seen:
            raise ValueError(f"CSV header repeats column {c!r}")
        seen[standard_name(c)] = c
    missing = [c for c in expected if standard_name(c) not in seen]
    if missing:
        raise ValueError(f"CSV header {header} lacks {missing}")
    return {seen[standard_name(c)]: c for c in expected}


def write_csv(df: DataFrame, path: str, encoding: str = "ISO-8859-1", compression: str = "none", append: bool = False) -> None:
    """Write a frame as a headered CSV folder, keeping blanks inside fields and doubling
    quotes inside quoted ones. A gzip file is read by one task: one file a writing task.
    ``append``: further files of a folder that is written in slices."""
    (df.write.mode("append" if append else "overwrite").option("compression", compression)
     .option("header", True)
     .option("encoding", encoding)
     .option("quote", '"').option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False)
     .csv(path))


# --- S2: column names --------------------------------------------------------------------

def standard_name(name: str, renames: dict[str, str] | None = None) -> str:
    """One column name after S2."""
    mapping = schemas.RAW_RENAMES if renames is None else renames
    # fixed rule of S2: lower case, blanks to underscores
    plain = name.strip("\ufeff").lower().replace(" ", "_")
    return mapping.get(plain, plain)


def standardise_columns(df: DataFrame, renames: dict[str, str] | None = None) -> DataFrame:
    """Lower-case names, spaces to underscores, then the explicit renames."""
    return df.toDF(*(standard_name(c, renames) for c in df.columns))


# --- Bronze typing and S3 batch stamp ----------------------------------------------------

def to_bronze_types(df: DataFrame) -> DataFrame:
    """Cast standardised string fields to the Bronze column types.

    ``unit_price`` becomes NUMERIC(10,2) here, so sub-cent prices are rounded HALF_UP
    before any later ``> 0`` test. A customer id written as ``17850.0`` (a float column in
    a spreadsheet export) keeps its integer text, and so a quantity ``6.0`` is 6; a
    quantity that is no whole number (``6.5``) or no number fails the job. Only fields that
    hold a point meet the expressions.
    """
    whole = F.regexp_replace("quantity", r"^([+-]?\d+)\.0*$", "$1").try_cast("int")
    wrong = F.when(F.col("quantity").isNotNull(), F.raise_error(F.concat(F.lit("quantity is no whole number: "), "quantity")).cast("int"))
    return df.select(
        F.col("invoice_no"), F.col("stock_code"), F.col("description"),
        F.coalesce(F.col("quantity").try_cast("int"), whole, wrong).alias("quantity"),
        F.col("invoice_date"),
        F.col("unit_price").cast("decimal(10,2)").alias("unit_price"),
        F.when(F.col("customer_id").contains(".0"), F.regexp_replace("customer_id", r"^(\d+)\.0+$", "$1"))
        .otherwise(F.col("customer_id")).alias("customer_id"),
        F.col("country"),
    )


def stamp_batch(df: DataFrame, load_timestamp: datetime | None = None,
                batch_id: str | None = None) -> DataFrame:
    """Add one load timestamp and one batch id for the whole run (literals, not per-row
    ``uuid()``, so a recomputed partition gets the same values)."""
    ts = load_timestamp or datetime.now()
    bid = batch_id or str(uuid.uuid4())
    return df.withColumns({
        "load_timestamp": F.lit(ts).cast("timestamp_ntz"),
        "batch_id": F.lit(bid),
    })


# --- Parquet sinks and scans ---------------------------------------------------------------

def write_replace(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Truncate-and-reload sink (S4, S8): the folder holds exactly this frame afterwards,
    whatever the session's partition overwrite mode is."""
    w = df.write.mode("overwrite").option("partitionOverwriteMode", "static").option("compression", "zstd")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_fact(df: DataFrame, path: str, mode: str = "replace", run_date=None,
               sort_by: list[str] | None = None, batch_id: str = "") -> None:
    """Fact sink (S9). ``replace``: the fact equals the current Silver (Bronze is a full
    reload each run). ``append``: rows are filed under ``run_date`` and a rerun of the same
    day replaces that day as a whole, also by no rows, so it never duplicates
    (:func:`starmart.sources.snapshots.replace_day`; read with ``versions.read_current``)."""
    if sort_by:
        df = df.sortWithinPartitions(*sort_by)
    if mode == "replace":
        df.write.mode("overwrite").parquet(path)
    elif mode == "append":
        if run_date is None:
            raise ValueError("append mode needs run_date")
        from starmart.sources.snapshots import replace_day
        replace_day(df, path, "run_date", run_date, batch_id)
    else:
        raise ValueError(f"unknown mode {mode!r}")


def read_table(spark: SparkSession, path: str, name: str | None = None,
               columns: list[str] | None = None) -> DataFrame:
    """Parquet scan with the registered schema (S6) and optional column pruning."""
    r = spark.read
    if name and name in schemas.SCHEMAS:
        r = r.schema(schemas.SCHEMAS[name])
    df = r.parquet(path)
    return df.select(*columns) if columns else df


# --- S13 / S14 -----------------------------------------------------------------------------

def table_exists(spark: SparkSession, path: str) -> bool:
    """True when the table folder exists (works on any Hadoop filesystem)."""
    from starmart.sources.versions import path_exists
    return path_exists(spark, path)


def assert_tables(spark: SparkSession, root: str, names: list[str]) -> None:
    """Raise if any of the named table folders under ``root`` is missing."""
    missing = [n for n in names if not table_exists(spark, f"{root}/{n}")]
    if missing:
        raise AssertionError(f"missing tables: {missing}")


def create_tables(spark: SparkSession, root: str, names: list[str] | dict[str, str] | None = None) -> list[str]:
    """Create every registered table that does not exist yet, empty, with its
    declared schema; existing tables are left as they are (safe to run on every start).
    ``names`` may map a table to its folder. Returns the tables created."""
    where = names if isinstance(names, dict) else {n: f"{root}/{n}" for n in names or schemas.SCHEMAS}
    created = []
    for n, path in where.items():
        if not table_exists(spark, path):
            schemas.empty(spark, n).write.mode("errorifexists").parquet(path)
            created.append(n)
    return created


def reset_tables(spark: SparkSession, root: str, names: list[str]) -> None:
    """Empty every named table, keeping its schema (S14). Children should be listed
    before parents; the audit log is deliberately not among the supply tables."""
    for n in names:
        schemas.empty(spark, n).write.mode("overwrite").parquet(f"{root}/{n}")
