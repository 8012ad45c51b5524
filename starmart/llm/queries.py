"""The registered queries of this package: thin views of its operators' results.

Each reads its whole table and has the operator's production parameters; columns a
contract asks for are derived from the operator's output here.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from starmart.llm import bloomlm, chunkdedup, crossparse, forced_bpe, imatch, int8_near, nbsvm, pii, raking, replytree, resample, tgm_join, variants
from starmart.llm.textkit import crc_mod, documents


def op1_raking(spark, sf_dir):
    """Raked token weight, calibrated probability and draw of every document."""
    return raking.mix(documents(spark, sf_dir, "doc_id", "text", "lang", "source")).select(
        "doc_id", "mix_source", "mix_lang", "mix_topic", "mix_tokens", "token_weight", "probability", "sample_weight", "sampled")


def op2_pii(spark, sf_dir):
    """Personal-data spans of every document."""
    return pii.detect(documents(spark, sf_dir, "doc_id", "text"))


def op3_imatch(spark, sf_dir):
    """Fingerprints of every document and of its edited text, with likenesses."""
    return imatch.fingerprint_documents(documents(spark, sf_dir, "doc_id", "text"))


def op4_bpe(spark, sf_dir):
    """Token ids of every document, digested, and the digest of their decoding."""
    return forced_bpe.digests(documents(spark, sf_dir, "doc_id", "text"))


def op5_quality(spark, sf_dir):
    """Quality score of every document, learned from labelled rows outside the held-out fold."""
    docs = documents(spark, sf_dir, "doc_id", "text")
    model = nbsvm.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return nbsvm.score(docs, model).select(
        F.col("doc_id").cast("long").alias("doc_id"), (crc_mod(F.col("doc_id"), 5) == 0).alias("held_out"), "score",
        (F.col("score") >= nbsvm.THRESHOLD).cast("int").alias("predicted"))


def op6_chunks(spark, sf_dir):
    """Repeated passages of every document, found by content-defined chunks."""
    return (chunkdedup.repeats(documents(spark, sf_dir, "doc_id", "text"))
            .withColumn("first_docs", F.concat_ws(",", F.transform("first_docs", lambda x: x.cast("string")))))


def op7_int8(spark, sf_dir):
    """Near-duplicate links, components and kept flags of every vector."""
    return int8_near.near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op8_jaccard(spark, sf_dir):
    """Shingle-set size and component of every document."""
    return tgm_join.join_documents(documents(spark, sf_dir, "doc_id", "text")).select("doc_id", "n_shingles", "component_id")


def op9_lm(spark, sf_dir):
    """Base and model log10 probability of every document."""
    return bloomlm.score(documents(spark, sf_dir, "doc_id", "text"))


def op10_language(spark, sf_dir):
    """Predicted language of every document."""
    docs = documents(spark, sf_dir, "doc_id", "lang", "text")
    return crossparse.predict(docs, crossparse.train(docs))


def op11_resample(spark, sf_dir):
    """Weight, score and rank of every document by its likeness to the benchmark texts."""
    target = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return resample.resample(documents(spark, sf_dir, "doc_id", "text"), target).select("doc_id", "n_features", "weight", "score", "rank")


def op12_replytree(spark, sf_dir):
    """Every conversation formatted, and digests of what its formatted text says."""
    said = "</s>[INST] ok [/INST]"
    own = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet").select(*own.columns)
    back = replytree.read_back(replytree.format_chains(table.unionByName(own)))
    line = F.zip_with("roles", "texts", lambda r, t: F.concat(r, F.lit("\n"), t, F.lit("\n")))
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    return back.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.size("roles").cast("long").alias("n_turns"),
        digest(F.array_join(line, "")).alias("turns_sha256"), F.length("learned").cast("long").alias("loss_chars"),
        digest(F.col("learned")).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"))


def op13_variants(spark, sf_dir):
    """Form, root and near words of every word of the documents."""
    return variants.group_variants(documents(spark, sf_dir, "doc_id", "text"))


LLM_QUERIES = {
    "op1_raking": op1_raking,
    "op2_pii": op2_pii,
    "op3_imatch": op3_imatch,
    "op4_bpe": op4_bpe,
    "op5_quality": op5_quality,
    "op6_chunks": op6_chunks,
    "op7_int8": op7_int8,
    "op8_jaccard": op8_jaccard,
    "op9_lm": op9_lm,
    "op10_language": op10_language,
    "op11_resample": op11_resample,
    "op12_replytree": op12_replytree,
    "op13_variants": op13_variants,
}
