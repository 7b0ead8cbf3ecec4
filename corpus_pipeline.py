"""The corpus pipeline: five stages, each written as Parquet and read again as the next one's documents.

A stage gets ``(spark, docs, sf_dir)`` and returns a table with the columns of ``docs``; the last returns token ids.
Extra columns pass through the first four stages. Nulls, repeated rows and empty tables are handled as the
operators state. Only ``run`` decides where the tables between the stages go: the shared folder.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftwright.llm import bpe, decontaminate, langid, near_dup, secret_scan
from driftwright.llm.common import crc_remainder, stash, table

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Near-duplicates of the pipeline: words of a shingle, least Jaccard similarity in percent.
SHINGLE, PERCENT = 5, 80


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is found stay; those that the identifier rejects go."""
    models = langid.train(docs, crc_remainder(F.col("doc_id")) != 2)
    return langid.accepted(docs, models)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return near_dup.keep_one(docs, shingle=SHINGLE, percent=PERCENT)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    return decontaminate.remove(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the text; ``n_chars`` follows it."""
    masked = secret_scan.redact(docs)
    if "n_chars" in docs.columns:
        masked = masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return masked


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, with digests of the ids and of what they decode to."""
    coded = bpe.encode_decode(docs.select("doc_id", "text"), public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)
    return coded.select("doc_id", "n_tokens", "ids_le", F.sha2("ids_le", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("language_id", identify_language),
    ("near_dedup", drop_near_duplicates),
    ("decontaminate", drop_contaminated),
    ("mask_secrets", mask_secrets),
    ("encode", encode),
]

#: SQL can express neither the language models nor the tokenizer; the stages are tested by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stash(stage(spark, docs, sf_dir))
    return docs
