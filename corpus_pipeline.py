"""Training-data pipeline: five operators in a row over ``documents``.

Each stage gets all that its predecessor kept, written as Parquet and read again.
All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martcraft.llm import op2_minhash, op3_packing, op5_suffix, op8_toxicity, op10_lines
from martcraft.llm.queries import WORD_BPE, table
from martcraft.session import scratch_path


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the toxicity threshold (held-out rule of the operator's query)."""
    model = op8_toxicity.train(docs, table(spark, sf_dir, "labels"), "crc32(cast(id as string)) % 4 != 2")
    return op8_toxicity.keep(docs, model)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are mostly content lines."""
    return op10_lines.keep(docs, op10_lines.train(docs, table(spark, sf_dir, "labels")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each near-duplicate class (five-word shingles, 0.8).

    Of rows that repeat a kept id the one with the least text stays; rows without an id belong to no class and
    stay."""
    kept = op2_minhash.near_duplicates(docs, shingle=5, percent=80).where("kept").select(
        F.col("doc_id").alias("__id"), "n_rows")
    found = docs.join(kept, docs["doc_id"] == F.col("__id"))
    once = found.where("n_rows = 1").select(docs.columns)
    least = F.min(F.struct("text", *[c for c in docs.columns if c not in ("doc_id", "text")])).alias("least")
    again = found.where("n_rows > 1").groupBy("doc_id").agg(least).select(
        *[F.col(c) if c == "doc_id" else F.col(f"least.{c}").alias(c) for c in docs.columns])
    return once.union(again).union(docs.where("doc_id is null"))


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of 200 bytes or more that occur elsewhere; every row stays."""
    cut = op5_suffix.remove(docs, min_len=200)
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return cut


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences."""
    return op3_packing.pack(docs, public_tokenizers.path(WORD_BPE))


STAGES = [
    ("toxicity", toxicity),
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("suffix_dedup", suffix_dedup),
    ("packing", packing),
]

#: Trained models and tokenizers are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is a table in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    root = scratch_path(spark, f"pipeline-{uuid.uuid4().hex}")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{root}/{name}")
        docs = spark.read.parquet(f"{root}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
