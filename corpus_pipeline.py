"""From raw documents to packed training windows: five stages, each one operator of ``cohortry.llm``.

Every stage gets (spark, docs, sf_dir) and returns a frame, which is written as Parquet to the shared
folder and read again as the next stage's ``docs``. All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from cohortry.llm import decontaminate, packing, quality, secrets_scan, similarity
from cohortry.scale import stage


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line labels retain. Rows without an id can't be named by a verdict and stay."""
    field = quality.train_lines(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    gone = quality.judged(docs, field).where("not kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group, the one with the smallest id.

    Groups are tied by close fingerprints of five-word shingles, and by a similarity of 0.8 or more of the shingles, at which
    fingerprints are too far apart for a vantage-point search.
    """
    return similarity.kept_one_each(docs, words=5, similarity=0.8)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mark."""
    return secrets_scan.redacted(docs)


def packed_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each document's token ids lie in the training windows."""
    return packing.packing_digest(docs, public_tokenizers.path("word_bpe_49k.json"), 2)


STAGES = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("secret scans", secret_scans),
    ("packing", packed_windows),
]

#: A trained line model, fingerprint components and tokenizers have no SQL form; tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
