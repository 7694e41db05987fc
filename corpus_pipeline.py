"""The corpus pipeline: judged, deduplicated, mixed and encoded documents.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; what it decides takes effect. Between
stages the documents are written as Parquet to the shared folder and read again; what a stage wrote there besides goes then.

Defined results: rows without doc_id and null or empty texts are judged, deduplicated, mixed and encoded like others (a null
text equals no other; without doc_id a row is told apart by its text). Texts are taken whole. Rows that repeat a document are
one. Extra columns are carried along to the last stage. No documents give none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakeloom.llm import exact_dedup, minhash, mixing, quality, queries, spm
from lakeloom.llm.common import documents, forget, made, saved, sweep


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal classifier rejects or holds toxic go."""
    return quality.select(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), reject_toxic=True)


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the first document stays."""
    return exact_dedup.drop_copies(docs, exact_dedup.folder_of(docs))


def minhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return minhash.drop_near_copies(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are drawn to their target weights and dealt to shards, in which they lie shuffled."""
    return mixing.drawn(docs)


def sentencepiece_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document and the text that they decode to."""
    return spm.sentencepiece(docs, queries.PIECES)


STAGES = [
    ("quality classifier", quality_classifier),
    ("exact dedup", exact_dedup_stage),
    ("MinHash near-dedup", minhash_dedup),
    ("mixing sources to target weights", mixing_stage),
    ("SentencePiece encoding and decoding", sentencepiece_stage),
]

#: The classifier, MinHash and the lattice aren't SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        before, old = made(), docs
        docs = saved(stage(spark, docs, sf_dir), "pipeline-" + name.split()[0].lower())
        sweep(spark, before, docs)
        forget(old)
    return STAGES[-1][1](spark, docs, sf_dir)
