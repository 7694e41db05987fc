"""Building, compacting, registering and exporting a lake of core, seqs and features."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.operators.shared import delete, scratch
from lakeloom.operators.tables import BUILDERS, KEYS
from lakeloom.sources.parquet import list_files, read_lake, read_union

ROW_GROUP_ROWS = 500_000
#: Rows of one partition that one task writes: large divisions are spread over several files.
ROWS_PER_FILE = {"core": 500_000, "seqs": 1_000_000, "features": 5_000_000}


def require(path: str) -> str:
    """The path, if there is something; for local inputs (DF-10)."""
    if "://" not in path and not os.path.exists(path):
        raise FileNotFoundError(path)
    return path


def rebalanced(df: DataFrame, *keys: str) -> DataFrame:
    """Rows of equal keys together; a division that holds most rows is cut, and small ones are put together, by the sizes that
    the shuffle itself measures. ``df`` runs once."""
    view = f"lakeloom_rebalance_{uuid.uuid4().hex}"
    df.createOrReplaceTempView(view)
    try:
        return df.sparkSession.sql(f"SELECT /*+ REBALANCE({', '.join(f'`{k}`' for k in keys)}) */ * FROM {view}")
    finally:
        df.sparkSession.catalog.dropTempView(view)


def write_table(df: DataFrame, path: str, rows_per_file: int = ROW_GROUP_ROWS, mode: str = "error") -> None:
    """zstd Parquet, partitioned by the keys (SNK-01), in files of ``rows_per_file`` rows at most; one shuffle, no counting pass."""
    rows = rebalanced(df, *KEYS).sortWithinPartitions(*KEYS, "acc")
    rows.write.mode(mode).partitionBy(*KEYS).option("compression", "zstd").option("parquet.block.row.count.limit", ROW_GROUP_ROWS).option("maxRecordsPerFile", rows_per_file).parquet(path)


@contextmanager
def staged(records: DataFrame) -> Iterator[DataFrame]:
    """The records as a Parquet table of the shared folder for the length of the block: JSON is parsed once, and each table
    then reads its own columns."""
    path = scratch(records.sparkSession, "records")
    records.write.parquet(path)
    try:
        yield records.sparkSession.read.schema(records.schema).parquet(path)
    finally:
        delete(records.sparkSession, path)


def build_lake(records: DataFrame, root: str, tables: tuple[str, ...] = ("core", "seqs", "features"), mode: str = "error") -> None:
    """All tables from records (T-01 to T-03, DF-03); the records are parsed once."""
    with staged(records) as rows:
        for name in tables:
            write_table(BUILDERS[name](rows), f"{root}/{name}", ROWS_PER_FILE[name], mode)


def collect_table(spark: SparkSession, table: str, roots: list[str], out: str) -> bool:
    """Compacts the table of several lakes to one, by name (T-04); False and nothing written if there are no files."""
    files = [(f"{r}/{table}", x["path"]) for r in roots for x in list_files(spark, f"{r}/{table}").collect()]
    if not files:
        return False
    parts = [read_union(spark, [p for b, p in files if b == base], base) for base in dict.fromkeys(b for b, _ in files)]
    df = parts[0]
    for p in parts[1:]:
        df = df.unionByName(p, allowMissingColumns=True)
    write_table(df, f"{out}/{table}", ROWS_PER_FILE.get(table, ROW_GROUP_ROWS))
    return True


def register_lake(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """Views core, seqs and features (T-10, SNK-12)."""
    out = {}
    for name in BUILDERS:
        out[name] = read_lake(spark, root, name)
        out[name].createOrReplaceTempView(name)
    return out


def export(df: DataFrame, path: str, kind: str = "csv", single: bool = False, mode: str = "error", rows_per_file: int | None = None) -> None:
    """csv and tsv with a header, json (gzip), or zstd parquet (SNK-02 to SNK-08). ``single`` makes one file."""
    w = (df.coalesce(1) if single else df).write.mode(mode)
    if rows_per_file:
        w = w.option("maxRecordsPerFile", rows_per_file)
    if kind in ("csv", "tsv"):
        w.option("header", True).option("sep", "\t" if kind == "tsv" else ",").csv(path)
    elif kind == "json":
        w.option("compression", "gzip").json(path)
    elif kind == "parquet":
        w.option("compression", "zstd").parquet(path)
    else:
        raise ValueError(kind)


def export_partitioned_json(df: DataFrame, path: str, *keys: str) -> None:
    """JSON lines in Hive folders with lower-case values (SNK-06, STR-08)."""
    rebalanced(df.withColumns({k: F.lower(F.col(k).cast("string")) for k in keys}), *keys).write.partitionBy(*keys).json(path)


def persist_table(df: DataFrame, name: str) -> DataFrame:
    """CREATE OR REPLACE TABLE ... AS (SNK-11)."""
    df.write.mode("overwrite").format("parquet").saveAsTable(name)
    return df.sparkSession.table(name)


def concat_tables(spark: SparkSession, paths: list[str], kind: str, out: str) -> None:
    """Files of one table to one file: headers once, JSON lines as they are, Parquet only of one schema (SET-02 to SET-05)."""
    if kind in ("csv", "tsv"):
        df = spark.read.option("header", True).option("sep", "\t" if kind == "tsv" else ",").csv(paths)
    elif kind == "json":
        df = spark.read.json(paths)
    else:
        frames = [spark.read.parquet(p) for p in paths]
        df = frames[0]
        for f in frames[1:]:
            if f.schema.simpleString() != df.schema.simpleString():
                raise ValueError(f"schemas differ: {df.schema.simpleString()} and {f.schema.simpleString()}")
            df = df.union(f)
    export(df, out, kind, single=True)
