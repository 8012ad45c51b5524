"""availableNow pick-up of new retail CSV files into Bronze.

Each micro-batch is standardised, typed and stamped with one batch id, then written
to Bronze under its ``batch_id`` partition (``foreachBatch``). The id is a digest of the
batch's file paths: a replayed batch overwrites its own partition, so a retry after a
failure never duplicates rows, and a stream started afresh with a new checkpoint over the
same files is refused while Bronze still holds rows of another checkpoint. A row with
too few or too many fields fails the batch, as in the batch reader; with
``tolerate_rejects`` records that cannot be loaded are filed by batch in the reject table
instead, as long as they are at most that share of a batch.
"""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart import schemas
from starmart.functions.text import na_to_null
from starmart.sources import files, rejects
from starmart.sources.versions import path_exists as table_has


def ingest_landing(spark: SparkSession, landing_dir: str, bronze_dir: str, checkpoint_dir: str,
                   encoding: str = "ISO-8859-1", max_files_per_trigger: int | None = None,
                   tolerate_rejects: float | None = None, reject_dir: str | None = None) -> int:
    """Process every CSV file that arrived since the last run; returns batches run."""
    lenient = tolerate_rejects is not None
    if lenient and not reject_dir:
        raise ValueError("tolerate_rejects needs a reject_dir")
    columns = schemas.RAW_CSV_COLUMNS + [rejects.LINE] * lenient
    schema = ", ".join(f"`{c}` STRING" for c in columns)
    if not table_has(spark, f"{checkpoint_dir}/offsets") and table_has(spark, bronze_dir):
        raise ValueError(f"{bronze_dir} holds rows of another checkpoint than {checkpoint_dir}: "
                         "landing files would be read into it again")
    reader = (spark.readStream.schema(schema).option("header", True)
              .option("encoding", encoding).option("quote", '"').option("escape", '"')
              .option("enforceSchema", False).option("mode", "PERMISSIVE" if lenient else "FAILFAST"))
    if lenient:
        reader = reader.option("columnNameOfCorruptRecord", rejects.LINE)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.csv(landing_dir)
    stream = stream.select(*[(F.col(c) if c == rejects.LINE else na_to_null(c)).alias(c) for c in stream.columns],
                           F.input_file_name().alias("_file"))

    batches = []

    def write_batch(df: DataFrame, epoch_id: int) -> None:
        # one digest of the batch's file names (a row to the driver), the same on a replay
        h = F.xxhash64("_file")
        mark = df.select("_file").distinct().agg(F.bit_xor(h), F.sum(F.pmod(h, F.lit(1 << 40))), F.count("_file")).first()
        bid = str(uuid.uuid5(uuid.NAMESPACE_URL, f"{landing_dir}#{tuple(mark)}"))
        rows = df.drop("_file")
        if lenient:
            named = df.withColumn(rejects.REASON, rejects.reason(F.col(rejects.LINE), len(schemas.RAW_CSV_COLUMNS))).withColumnRenamed("_file", rejects.FILE)
            n, bad = named.agg(F.count(F.lit(1)), F.count(rejects.REASON)).first()
            if bad:
                (rejects.rejected(named).withColumn("batch_id", F.lit(bid)).write.mode("overwrite")
                 .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(reject_dir))
            if bad > tolerate_rejects * n:
                raise rejects.TooManyRejects(f"{bad} of {n} records rejected, more than {tolerate_rejects:.2%} (see {reject_dir})")
            rows = rejects.accepted(named)
        bronze = files.stamp_batch(files.to_bronze_types(files.standardise_columns(rows)),
                                   datetime.now(), bid)
        (bronze.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").parquet(bronze_dir))
        batches.append(epoch_id)

    q = (stream.writeStream.foreachBatch(write_batch)
         .option("checkpointLocation", checkpoint_dir)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return len(batches)
