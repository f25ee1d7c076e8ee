"""The registered queries opN_<name>: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import exact_dedup, lang_id, license_scan, line_templates, merkle, mixing, order_minhash, pii, quality_fm, simhash, sp_sampling, token_counts, whitening
from .shared import fold


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = fold(F.col("doc_id"), 4) == 2
    model = lang_id.learn(docs, ~held_out)
    return (docs.select("doc_id", held_out.alias("held_out"), lang_id.identify(model)(F.col("text")).alias("p"))
            .select("doc_id", "held_out", "p.lang_pred", "p.score", "p.margin", "p.rejected"))


def op2_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.fingerprint_with_edits(table(spark, sf_dir, "documents"))


def op3_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_templates.drop_recurring_lines(docs).select("doc_id", "n_lines", "n_dropped", "clean_text")


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_documents(table(spark, sf_dir, "documents"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_personal_data(table(spark, sf_dir, "documents"))


#: Target shares of the tokens by domain, a domain being a document's quality and toxicity as labelled.
TARGET_WEIGHTS = {"q1t0": 0.85, "q1t1": 0.09, "q0t0": 0.04, "q0t1": 0.02}


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    domain = F.concat(F.lit("q"), "quality", F.lit("t"), "toxic").alias("domain")
    labels = table(spark, sf_dir, "labels").select("doc_id", domain)
    rates, domains = mixing.mix(table(spark, sf_dir, "documents"), labels, TARGET_WEIGHTS)
    return rates.select(F.col("id").alias("doc_id"), "n_tokens", *[F.col(f"p{i}").alias(f"p_{d}") for i, d in enumerate(domains)], "rate")


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sp_sampling.encode_sampled(docs).drop("text")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = fold(F.col("doc_id"), 3) == 1
    model = quality_fm.learn(docs, table(spark, sf_dir, "labels"), ~held_out)
    scored = docs.select("doc_id", held_out.alias("held_out"), quality_fm.scorer(model)(F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicate_components(table(spark, sf_dir, "documents"))


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    tampered = F.when(fold(F.col("doc_id"), 2) == 0, F.replace("text", F.lit("\n"), F.lit("")))
    # a null text stays null: its leaf is the original one
    return merkle.manifest_rows(docs, tampered_text=tampered)


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_language_id, op2_order_minhash, op3_line_templates, op4_license_scan, op5_pii, op6_mixing,
                            op7_exact_dedup, op8_sentencepiece, op9_quality, op10_simhash, op11_token_counts,
                            op12_merkle_manifest, op13_embedding_whitening)
}
