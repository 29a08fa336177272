"""A training corpus from `documents` in five stages, each written as Parquet and read again by the next.

1. language ID keeps documents whose language is recognised;
2. min-max near-dedup keeps one row of each group of near copies, the one with the smallest id;
3. decontamination drops documents that share a window with a benchmark item;
4. the secret scan replaces secrets in the texts by their kind;
5. BPE encodes the texts, and decodes them again as a check.

Null texts and texts without a letter go in the first stage. Rows without id go through all stages like others: one
stays where no near copy of it has an id. Repeated rows, and rows that share an id or a text, leave one row for each
text. Texts of any length go through whole. An empty table gives an empty corpus. Other columns of `documents` are
kept, but for those named `token_ids`, `round_trip` or `n_tokens`, which the last stage replaces by its own. Each run
writes a folder of its own under the shared folder; the caller removes it with the others there.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termtide.llm import bpe, decontaminate, language, neardup, secrets
from termtide.llm.common import shared_dir, table

#: Least similarity of near copies, in percent.
NEAR_PERCENT = 80


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.keep_known(docs, language.learn(docs))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.deduplicate(docs, percent=NEAR_PERCENT)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.remove_hits(docs, table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.json"), check_col="round_trip")
    return out.withColumn("n_tokens", F.size("token_ids").cast("long"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", known_language),
    ("near_dedup", one_of_each_group),
    ("decontamination", without_benchmark),
    ("secret_scan", without_secrets),
    ("bpe", tokens),
]
#: Language ID learns a model, which SQL cannot express; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_dir(spark).rstrip('/')}/corpus-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
