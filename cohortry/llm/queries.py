"""The registered queries of this folder: each applies its operator to the whole table it is meant for."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import check_sql, conversations, decontaminate, language_model, merkle, packing, quality, secrets_scan, sharding, simhash, suffix_dedup, token_files, toxicity, warc


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


def op2_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packing_digest(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"), 2)


def op3_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secrets_scan.scanned(table(spark, folder, "documents"))


def op4_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op5_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.sharded(table(spark, folder, "documents"))


def op6_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.deduplicated(table(spark, folder, "documents"), with_text=False)


def op7_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return quality.judged(docs, quality.train_lines(docs, table(spark, folder, "labels")))


def op8_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.pages_of(warc.read_archives(warc.write_archives(table(spark, folder, "pages")), payloads=False))


def op9_token_files(spark: SparkSession, folder: str) -> DataFrame:
    files = token_files.write_token_files(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"), 0)
    return token_files.read_token_files(files, with_ids=False)


def op10_language_model(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return language_model.scored(docs, language_model.trained(docs))


def op11_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return toxicity.scored(docs, toxicity.trained(docs, table(spark, folder, "labels")))


def op12_conversations(spark: SparkSession, folder: str) -> DataFrame:
    return conversations.audited(table(spark, folder, "conversations"))


def op13_merkle(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.proofs(table(spark, folder, "documents"))


QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_packing": op2_packing,
    "op3_secrets": op3_secrets,
    "op4_decontaminate": op4_decontaminate,
    "op5_sharding": op5_sharding,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_quality": op7_quality,
    "op8_warc": op8_warc,
    "op9_token_files": op9_token_files,
    "op10_language_model": op10_language_model,
    "op11_toxicity": op11_toxicity,
    "op12_conversations": op12_conversations,
    "op13_merkle": op13_merkle,
}
SQL: dict[str, str] = check_sql.SQL
