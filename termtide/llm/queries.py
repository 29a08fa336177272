"""The registered queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termtide.llm import alignment, bpe, decontaminate, language, neardup, negatives, pii, secrets, sharding, sql, suffixes, toolcalls, urls, vectors
from termtide.llm.common import table


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


def op2_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents"))


def op3_histogram_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.histogram_shards(table(spark, sf_dir, "documents"))


def op4_minmax_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), percent=85)


def op5_tool_call_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls, results = toolcalls.chat_trace(table(spark, sf_dir, "conversations"))
    schemas = spark.sql("SELECT * FROM VALUES ('reply', 'n_chars', 'integer', true), ('reply', 'after', 'string', false), ('reply', 'also', 'string', false) AS t(name, argument, type, required)")
    linked = toolcalls.link_calls(calls, results, schemas)
    return linked.select("conv_id", "call_id", "turn", "level", "place", "status", "problems", "result_turn", F.sha2(F.col("canonical").cast("binary"), 256).alias("canonical_sha256"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.filter_urls(table(spark, sf_dir, "pages"))


def op8_winnowing_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op10_vector_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(table(spark, sf_dir, "embeddings"))


def op11_four_russians_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(table(spark, sf_dir, "embeddings"), label, F.col("vec_id") % 50 == 0)


def op12_induced_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffixes.repeated_passages(table(spark, sf_dir, "documents"))
    removed = F.aggregate(F.zip_with("ends", "begins", lambda e, b: e - b), F.lit(0).cast("long"), lambda a, x: a + x)
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("begins").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignment_figures(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


QUERIES = {f.__name__: f for f in (
    op1_secret_scan, op2_personal_data, op3_histogram_shards, op4_minmax_near_duplicates, op5_tool_call_links, op6_language_id, op7_url_filter,
    op8_winnowing_decontamination, op9_bpe_round_trip, op10_vector_near_duplicates, op11_four_russians_negatives, op12_induced_suffix_dedup, op13_tokenizer_alignment,
)}
ORACLE_SQL = {
    "op4_minmax_near_duplicates": sql.NEAR_DUPLICATES,
    "op5_tool_call_links": sql.TOOL_CALLS,
    "op8_winnowing_decontamination": sql.DECONTAMINATION,
    "op10_vector_near_duplicates": sql.VECTORS,
    "op11_four_russians_negatives": sql.NEGATIVES,
    "op12_induced_suffix_dedup": sql.PASSAGES,
}
