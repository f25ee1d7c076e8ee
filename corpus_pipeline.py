"""The corpus pipeline: five stages over `documents`, each one of the text operators.

Each stage takes (spark, docs, sf_dir), works on every row its predecessor
kept and returns a frame that is written as Parquet and read again as the next
one's `docs`.  All but the last return the columns of `documents`; the last
adds the pieces.  Null texts, ids and languages, empty tables and further
columns are handled as the operators' docstrings say: texts without a letter
(null and empty ones too) are rejected by the first stage.
"""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame, SparkSession, functions as F

from lodgespark.llm import exact_dedup, lang_id, mixing, simhash, sp_sampling
from lodgespark.llm.shared import fold, stored

#: Share of the kept tokens that each domain (quality and toxicity as labelled) should have.
TARGET_WEIGHTS = {"q1t0": 0.94, "q1t1": 0.02, "q0t0": 0.02, "q0t1": 0.02}
#: Difference of a share of the expected tokens from its target (of the domains found) from which the stage warns.
SHARE_MISS = 0.005


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier rejects go."""
    model = lang_id.learn(docs, fold(F.col("doc_id"), 4) != 2)
    return lang_id.drop_undetermined(docs, model)


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts the one with the smallest id stays."""
    return exact_dedup.drop_exact_copies(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays."""
    return simhash.drop_near_copies(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are drawn at their fitted rates; no rate passes 1, so none is repeated.

    Rates of at most 1 come as close to the targets of all tokens as they can,
    and a warning gives the shares they reach where these miss the targets.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    domain = F.concat(F.lit("q"), "quality", F.lit("t"), "toxic").alias("domain")
    rates, _ = mixing.mix(docs, labels.select("doc_id", domain), TARGET_WEIGHTS, max_rate=1.0)
    got, want = ({d: n / (sum(x.values()) or 1.0) for d, n in x.items()} for x in (rates.fit.tokens, rates.fit.target))
    if any(abs(got[d] - want[d]) > SHARE_MISS for d in got):
        warnings.warn(f"rates of at most 1 miss the target shares: {', '.join(f'{d} {got[d]:.4f} for {want[d]:.4f}' for d in got)}", stacklevel=2)
    return mixing.draw(docs, rates)


def sentencepiece_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its sampled pieces, and whether they decode to its very text."""
    return sp_sampling.encode_sampled(docs)


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup_stage),
    ("simhash_near_dedup", simhash_near_dedup),
    ("mixing", mixing_stage),
    ("sentencepiece", sentencepiece_encoding),
]

#: No SQL: compression, XXH64 bits, fitted rates and sampled pieces have none; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
