"""Validation of a lake: counts, equality of core and seqs, file sizes, and a report (T-05 to T-09, SNK-10)."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.operators.tables import KEYS
from lakeloom.sources.parquet import list_files, read_lake

TABLES = ("core", "seqs", "features")


@dataclass
class Report:
    rows: dict[str, int] = field(default_factory=dict)
    partitions: dict[str, list[tuple[str, str, int]]] = field(default_factory=dict)
    problems: list[str] = field(default_factory=list)
    lines: list[str] = field(default_factory=list)

    @property
    def ok(self) -> bool:
        return not self.problems

    def text(self) -> str:
        return "\n".join(self.lines) + "\n"


def partition_counts(spark: SparkSession, root: str, table: str) -> DataFrame:
    """Rows by partition (T-06): answered from footers, no column is read."""
    return read_lake(spark, root, table).groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n")).orderBy(*KEYS)


def file_sizes(spark: SparkSession, root: str) -> DataFrame:
    """Files, bytes, and the largest file of everything below (T-08, AGG-20)."""
    return list_files(spark, root).agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"), F.max("size").alias("largest"), F.max_by("path", "size").alias("largest_path"))


def validate(spark: SparkSession, root: str, max_mb: float = 512, strict: bool = False) -> Report:
    r = Report()
    for t in TABLES:
        if not list_files(spark, f"{root}/{t}").count():
            r.problems.append(f"{t}: NOT FOUND")
            r.lines.append(f"{t}: NOT FOUND")
            continue
        try:
            got = [tuple(x) for x in partition_counts(spark, root, t).collect()]
        except Exception as e:  # a table that can't be read is a finding, not the end of the report
            r.problems.append(f"{t}: {type(e).__name__}")
            r.lines.append(f"{t}: ERROR {e}")
            continue
        r.partitions[t], r.rows[t] = got, sum(n for *_, n in got)
        r.lines.append(f"{t}: {r.rows[t]:,} rows")
        r.lines += [f"  {s}/{d}: {n:,}" for s, d, n in got]
    if "core" in r.rows and "seqs" in r.rows:
        same = r.rows["core"] == r.rows["seqs"]
        r.lines.append(f"core = seqs: {'OK' if same else 'MISMATCH'} ({r.rows['core']:,} and {r.rows['seqs']:,})")
        if not same:
            r.problems.append("core and seqs differ")
    sizes = file_sizes(spark, root).first()
    if sizes["files"]:
        r.lines.append(f"{sizes['files']:,} files, {sizes['bytes'] / 1e6:.1f} MB; largest {sizes['largest'] / 1e6:.1f} MB: {sizes['largest_path']}")
        over = [x["path"] for x in list_files(spark, root).where(F.col("size") > max_mb * 1024 * 1024).collect()]
        r.problems += [f"over {max_mb} MB: {p}" for p in over]
        r.lines += [f"WARNING: over {max_mb} MB: {p}" for p in over] or [f"all files under {max_mb} MB"]
    if strict and r.problems:
        raise ValueError("; ".join(r.problems))
    return r
