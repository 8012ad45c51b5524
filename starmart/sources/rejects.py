"""S1 with a reject table: CSV records that cannot be loaded are set aside and counted.

One bad line need not stop a load. A record with too few or too many fields, or with a
quantity or price that is no number, becomes a row (file, line, reason) of the reject
table; the rest is loaded, as long as the rejected share stays within a stated tolerance.
Above it nothing is published. The good rows are written in one pass that also counts the
rejected ones; only if there are any are the files read again for them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from starmart import schemas
from starmart.functions.text import na_to_null
from starmart.sources import files

LINE, FILE, REASON = "_corrupt_line", "_source_file", "_reject_reason"
#: Commas outside quoted fields separate fields.
_COMMA = ',(?=(?:[^"]*"[^"]*")*[^"]*$)'


class TooManyRejects(ValueError):
    """The rejected share of a load is above its tolerance."""


def read_with_reasons(spark: SparkSession, path: str, columns: list[str] | None = None, encoding: str = "ISO-8859-1",
                      multi_line: bool = False) -> DataFrame:
    """The expected columns of every record, with the file it is from, the line where the
    record is malformed, and why it is rejected (null: it is not)."""
    cols = columns or schemas.RAW_CSV_COLUMNS
    header = files.csv_header(spark, path, encoding)
    schema = ", ".join([*(f"`{c}` STRING" for c in header), f"{LINE} STRING"])
    df = (spark.read.schema(schema).option("header", True).option("encoding", encoding)
          .option("quote", '"').option("escape", '"').option("enforceSchema", False).option("multiLine", multi_line)
          .option("columnPruning", False).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", LINE).csv(path))
    named = df.select(*[na_to_null(F.col(f"`{c}`")).alias(n) for c, n in files.by_header(header, cols).items()], F.col(LINE),
                      F.col("_metadata.file_path").alias(FILE))
    return named.withColumn(REASON, reason(F.col(LINE), len(header)))


def reason(bad: Column, fields: int) -> Column:
    """Why a record cannot be loaded."""
    n = F.size(F.split(bad, _COMMA, -1))
    quantity, price = F.col("Quantity"), F.col("UnitPrice")
    whole = F.regexp_replace(quantity, r"^([+-]?\d+)\.0*$", "$1").try_cast("int")
    return (F.when(bad.isNotNull() & (n < fields), F.format_string("too few fields: %d of %d", n, F.lit(fields)))
            .when(bad.isNotNull() & (n > fields), F.format_string("too many fields: %d for %d", n, F.lit(fields)))
            .when(bad.isNotNull(), F.lit("malformed record"))
            .when(quantity.isNotNull() & whole.isNull(), F.concat(F.lit("quantity is no whole number: "), quantity))
            .when(price.isNotNull() & price.try_cast("decimal(10,2)").isNull(), F.concat(F.lit("price is no number: "), price)))


def accepted(rows: DataFrame) -> DataFrame:
    """The records to load."""
    return rows.where(F.col(REASON).isNull()).drop(LINE, FILE, REASON)


def rejected(rows: DataFrame) -> DataFrame:
    """(file, line, reason) of the others; a record whose fields are sound but not its
    values is written again as a line."""
    fields = [c for c in rows.columns if c not in (LINE, FILE, REASON)]
    line = F.coalesce(F.col(LINE), F.to_csv(F.struct(*fields)))
    return rows.where(F.col(REASON).isNotNull()).select(F.element_at(F.split(FILE, "/"), -1).alias("file"), line.alias("line"), F.col(REASON).alias("reason"))


class CountedLoad:
    """The accepted records, with both kinds counted by the job that writes them."""

    def __init__(self, rows: DataFrame, tolerance: float):
        self.source, self.tolerance = rows, tolerance
        self.seen = Observation("records")
        bad = F.col(REASON).isNotNull()
        self.rows = accepted(rows.observe(self.seen, F.count(F.lit(1)).alias("records"), F.count_if(bad).alias("rejected")))

    def finish(self, reject_path: str) -> dict:
        """After the write: stores the rejected records, and raises when they are too many."""
        got = self.seen.get
        if got["rejected"]:
            rejected(self.source).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(reject_path)
        if got["rejected"] > self.tolerance * got["records"]:
            raise TooManyRejects(f"{got['rejected']} of {got['records']} records rejected, more than {self.tolerance:.2%} (see {reject_path})")
        return got
