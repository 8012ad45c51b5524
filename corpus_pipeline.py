"""The training-corpus pipeline: five stages over ``documents``, each one of the operators
of ``starmart.llm``. Every stage works on all rows its predecessor kept and takes effect
on the rows or texts it hands on; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from starmart.llm import forced_bpe, nbsvm, pii, raking, tgm_join


def quality_stage(spark, docs, sf_dir):
    """Operator 5: documents that the classifier rejects (score under its threshold) go."""
    model = nbsvm.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return nbsvm.score(docs, model).where(F.col("score") >= nbsvm.THRESHOLD).select(*docs.columns)


def near_duplicate_stage(spark, docs, sf_dir):
    """Operator 8: of each group of linked documents one row stays.

    It is the row of the smallest id (a null id only where no linked document has one); of
    several rows of that id the one of the first class of equal shingle sets, by hash, then
    the text of the smallest hash, then the row whose other columns come first as JSON.
    Documents without words are linked with nothing: all stay, equal rows once.

    Decisions are made on ids and hashes. Texts meet only the exceptions (rows that go, and
    rows that stand several times), one narrow row each, in one join."""
    c = tgm_join.join_documents(docs)
    named = (F.col("doc_id") == F.col("component_id")) | F.col("component_id").isNull()
    best = F.min(F.when(named, F.struct("cls", "text_key"))).alias("best")
    chosen = c.where("cls is not null").groupBy("component").agg(best).select("component", "best.*")
    chosen = chosen.select(F.col("component").alias("of"), F.col("cls").alias("best_cls"), F.col("text_key").alias("best_key"))
    stays = named & (F.col("cls") == F.col("best_cls")) & (F.col("text_key") == F.col("best_key"))
    rows = (c.join(chosen, F.col("component") == F.col("of"), "left")
            .select("doc_id", "text_key", F.when(F.col("cls").isNull(), F.lit(True)).otherwise(F.coalesce(stays, F.lit(False))).alias("stays")))
    decided = rows.groupBy("doc_id", "text_key").agg(F.max("stays").alias("stays"), F.count(F.lit(1)).alias("times"))
    odd = decided.where("not stays or times > 1").select(F.col("doc_id").alias("odd_id"), F.col("text_key").alias("odd_key"), "stays")

    whole = docs.select(F.struct(*[docs[x] for x in docs.columns]).alias("row"), F.col("doc_id").cast("long").alias("id"),
                        F.xxhash64(F.col("text").cast("string")).alias("key"))
    met = whole.join(odd, whole["id"].eqNullSafe(odd["odd_id"]) & (whole["key"] == odd["odd_key"]), "left")
    others = F.to_json(F.struct(*[F.col(f"row.`{x}`").alias(x) for x in docs.columns if x != "text"]))
    again = met.where("stays").groupBy("id", "key").agg(F.min_by("row", others).alias("row"))
    return met.where("stays is null").select("row.*").unionByName(again.select("row.*"))


def pii_stage(spark, docs, sf_dir):
    """Operator 2: personal data in ``text`` is replaced by the name of its kind."""
    return pii.redacted(docs)


def mixing_stage(spark, docs, sf_dir):
    """Operator 1: documents are drawn by their calibrated probabilities."""
    return raking.sample(docs)


def bpe_stage(spark, docs, sf_dir):
    """Operator 4: adds token_ids and n_tokens to every document."""
    return forced_bpe.encode_documents(docs)


STAGES = [("quality", quality_stage), ("near_duplicates", near_duplicate_stage), ("pii", pii_stage),
          ("mixing", mixing_stage), ("bpe", bpe_stage)]

#: SQL cannot express the classifier, the redaction or the encoding; tests hold run()
#: against a brute-force version.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over the documents of ``sf_dir``, each result written and read again."""
    from starmart.llm.components import stored
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


PIPELINE_QUERIES = {"pipeline": run}
PIPELINE_SQL = {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
