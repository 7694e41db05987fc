"""From raw documents to a validated lake, in one job that can be run again.

Documents are cut to JSON-lines chunks by the streaming source, a schema is inferred by a full scan of the chunks and merged
with the one that the lake had, records are parsed with it once, the tables are written or added to, and the lake is
validated. What is written: ``core``, ``seqs``, ``features``, and ``_schema.json`` and ``_report.txt`` beside them.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from lakeloom.operators import schema as schemas
from lakeloom.operators.lake import ROWS_PER_FILE, staged, write_table
from lakeloom.operators.shared import QUICK_GZIP, delete, scratch
from lakeloom.operators.tables import BUILDERS
from lakeloom.operators.validate import Report, validate
from lakeloom.sources.records import JsonArraySource, read_lines


@dataclass(frozen=True)
class Mode:
    rows_per_chunk: int
    strict: bool
    max_mb: float = 512


MODES = {"test": Mode(100, True), "prod": Mode(500_000, True), "subset": Mode(500_000, False)}


def _file(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file of any file system; None if there is none."""
    fs, p = _file(spark, path)
    if not fs.exists(p):
        return None
    return "\n".join(r["value"] for r in spark.read.option("wholetext", True).text(path).collect())


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p = _file(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def chunks(spark: SparkSession, paths: list[str], out: str, rows: int, field: str = "results") -> None:
    """Documents too large to be one row to JSON lines, ``rows`` a file at most; a document is read by one task, once."""
    spark.dataSource.register(JsonArraySource)
    lines = spark.read.format("json_array").option("field", field).option("files", json.dumps(paths)).load()
    lines.write.option("maxRecordsPerFile", rows).options(**QUICK_GZIP).text(out)


def merged_schema(spark: SparkSession, root: str, found: T.StructType) -> T.StructType:
    """The inferred schema with the lake's own, kept beside it for the next run."""
    new = {f.name: schemas.type_string(f.dataType) for f in found.fields}
    old = read_text(spark, f"{root}/_schema.json")
    both = schemas.merge_schemas([json.loads(old), new]) if old else new
    write_text(spark, f"{root}/_schema.json", json.dumps(both, indent=2))
    return schemas.reader_schema(both)


def run_job(spark: SparkSession, paths: str | list[str], root: str, mode: str = "prod", field: str = "results", add: bool = False, variants: tuple[str, ...] = ("comments",)) -> Report:
    """Builds the lake at ``root`` from documents, or adds to it; returns what validation found."""
    how = MODES[mode]
    work = scratch(spark, "job")
    try:
        chunks(spark, [paths] if isinstance(paths, str) else list(paths), work, how.rows_per_chunk, field)
        found = schemas.infer(spark, work, variants=variants)
        records: DataFrame = read_lines(spark, work, merged_schema(spark, root, found))
        with staged(records) as rows:
            for name, build in BUILDERS.items():
                write_table(build(rows), f"{root}/{name}", ROWS_PER_FILE[name], "append" if add else "error")
    finally:
        delete(spark, work)
    report = validate(spark, root, how.max_mb, how.strict)
    write_text(spark, f"{root}/_report.txt", report.text())
    return report
