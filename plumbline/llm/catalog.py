"""Registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm import chat_format, decontaminate, jaccard_join, language_id, line_dedup, merkle_manifest, pii, pq_dedup, prefix_trie, secret_scan, source_mixing, topk_search, toxicity
from plumbline.llm.common import read_table


def op1_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.dedup_lines(read_table(spark, folder, "documents"))


def op2_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    found = language_id.identify(docs, language_id.learn(docs))
    return found.select("doc_id", language_id.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    found = toxicity.score(docs, toxicity.learn(docs, read_table(spark, folder, "labels")))
    return found.select("doc_id", language_id.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op4_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.digest(secret_scan.find_secrets(read_table(spark, folder, "documents")))


def op5_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.find_leaks(read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark"))
    return found.select("doc_id", F.inline("leaks"))


def op6_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return source_mixing.mix(read_table(spark, folder, "documents"))


def op7_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.jaccard_components(read_table(spark, folder, "documents"))


def op8_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    return chat_format.format_chats(read_table(spark, folder, "conversations"))


def op9_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.replace_pii(read_table(spark, folder, "documents"))


def op10_topk_search(spark: SparkSession, folder: str) -> DataFrame:
    return topk_search.nearest(read_table(spark, folder, "embeddings"))


def op11_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return merkle_manifest.verified_manifest(read_table(spark, folder, "documents"))


def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.prefix_trie(prefix_trie.rebuilt(prefix_trie.positions(read_table(spark, folder, "conversations"))))


def op13_pq_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return pq_dedup.near_duplicates(read_table(spark, folder, "embeddings"))


QUERIES = (
    op1_line_dedup, op2_language_id, op3_toxicity, op4_secret_scan, op5_decontaminate,
    op6_source_mixing, op7_jaccard_join, op8_chat_format, op9_pii, op10_topk_search,
    op11_merkle_manifest, op12_prefix_trie, op13_pq_dedup,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {query.__name__: query for query in QUERIES}


def oracle_sql() -> dict[str, str]:
    return {
        "op1_line_dedup": line_dedup.ORACLE,
        "op6_source_mixing": source_mixing.oracle(),
        "op8_chat_format": chat_format.ORACLE,
        "op10_topk_search": topk_search.ORACLE,
        "op11_merkle_manifest": merkle_manifest.oracle(),
        "op12_prefix_trie": prefix_trie.ORACLE,
        "op13_pq_dedup": pq_dedup.ORACLE,
    }
