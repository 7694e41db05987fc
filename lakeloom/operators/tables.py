"""Nested records to tables: core, seqs and features, and the two older tables (T-01 to T-03, T-14, T-15)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.functions.taxonomy import entry_code, review_status, tax_division

KEYS = ["review_status", "tax_division"]
TRIPLE = ["acc", *KEYS]
NOT_PASSED_ON = ["primaryAccession", "uniProtkbId", "entryType", "sequence", "features"]


def partition_keys() -> list[Column]:
    return [review_status(F.col("entryType")).alias("review_status"), tax_division(F.col("organism.lineage")).alias("tax_division")]


def core(records: DataFrame) -> DataFrame:
    """One row a record: derived columns, then all columns that are not in another table."""
    missing = [c for c in NOT_PASSED_ON if c not in records.columns]
    if missing:
        raise ValueError(f"records lack {missing}")
    status, division = partition_keys()
    return records.select(
        F.col("primaryAccession").alias("acc"),
        F.col("uniProtkbId").alias("id"),
        F.col("organism.taxonId").alias("taxid"),
        F.col("organism.scientificName").alias("organism_name"),
        F.get("genes", F.lit(0))["geneName"]["value"].alias("gene_name"),
        status,
        division,
        F.col("sequence.length").alias("seq_len"),
        F.col("sequence.molWeight").alias("seq_mass"),
        F.col("sequence.md5").alias("seq_md5"),
        *[F.col(f"`{c}`") for c in records.columns if c not in NOT_PASSED_ON],
    )


def seqs(records: DataFrame) -> DataFrame:
    return records.select(F.col("primaryAccession").alias("acc"), F.col("sequence.value").alias("sequence"), *partition_keys())


def features(records: DataFrame) -> DataFrame:
    """One row for each element of features; records without any have none."""
    flat = records.select(F.col("primaryAccession").alias("acc"), *partition_keys(), F.explode("features").alias("f"))
    return flat.select("acc", F.col("f.type").alias("type"), F.col("f.location.start.value").alias("start_pos"), F.col("f.location.end.value").alias("end_pos"), F.col("f.description").alias("description"), *KEYS)


def old_core(records: DataFrame) -> DataFrame:
    return records.select("primaryAccession", entry_code(F.col("entryType")).alias("entryType"), F.col("sequence.length").alias("seqLen"), F.col("sequence.molWeight").alias("molWeight"))


def old_sequence(records: DataFrame) -> DataFrame:
    return records.select("primaryAccession", F.col("sequence.value").alias("sequence"), F.col("sequence.length").alias("seqLen"), F.col("sequence.md5").alias("md5"))


BUILDERS = {"core": core, "seqs": seqs, "features": features}
