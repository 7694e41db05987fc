"""The registered queries of this subpackage, each over its whole table with production parameters, and their SQL."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from lakeloom.llm import exact_dedup, itq, line_dedup, minhash, mixing, quality, secret_forest, spm, tokencount, url_trust
from lakeloom.llm.common import documents

TOKENIZERS = os.environ.get("LAKELOOM_TOKENIZERS", "/opt/tokenizers")
PIECES = f"{TOKENIZERS}/piece_bpe_32k.model"


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spm.sentencepiece(documents(spark, sf_dir), PIECES)


def op2_url_trust(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_trust.url_filter(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{sf_dir}/documents.parquet"
    return exact_dedup.drop_copies(documents(spark, sf_dir), path)


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.drop_lines(documents(spark, sf_dir)).select("doc_id", "text", "n_lines", "n_dropped")


def op5_itq_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return itq.near_dedup(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.token_counts(documents(spark, sf_dir), PIECES)


def op8_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.drop_near_copies(documents(spark, sf_dir))


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_forest.scan(documents(spark, sf_dir), secret_forest.words_of(PIECES))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"), reject_toxic=True)


QUERIES = {
    f.__name__: f
    for f in (
        op1_sentencepiece, op2_url_trust, op3_exact_dedup, op4_line_dedup, op5_itq_dedup,
        op6_mixing, op7_token_counts, op8_minhash_dedup, op9_secrets, op10_quality,
    )
}

ORACLE_SQL = {
    "op3_exact_dedup": "SELECT doc_id, text, lang, source, n_chars FROM (SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS k FROM documents) WHERE text IS NULL OR k = 1",
}
