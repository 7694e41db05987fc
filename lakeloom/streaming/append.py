"""Appending new record files to a lake as a stream: each micro-batch adds to the tables, files are taken once (DF-07)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lakeloom.operators.lake import ROWS_PER_FILE, staged, write_table
from lakeloom.operators.shared import delete
from lakeloom.operators.tables import BUILDERS


def adopt(spark: SparkSession, source: str, target: str, prefix: str) -> None:
    """Moves the files of the table at ``source`` to the partitions of the one at ``target``, under names with ``prefix``; files
    of that prefix from an attempt before are deleted first. Only names move, no data is read."""
    hadoop, conf = spark.sparkContext._jvm.org.apache.hadoop.fs, spark.sparkContext._jsc.hadoopConfiguration()
    fs = hadoop.Path(target).getFileSystem(conf)
    for old in fs.globStatus(hadoop.Path(f"{target}/*/*/{prefix}*")) or []:
        fs.delete(old.getPath(), False)
    for new in fs.globStatus(hadoop.Path(f"{source}/*/*/part-*")) or []:
        at = new.getPath()
        folder = f"{target}/{at.getParent().getParent().getName()}/{at.getParent().getName()}"
        fs.mkdirs(hadoop.Path(folder))
        if not fs.rename(at, hadoop.Path(f"{folder}/{prefix}{at.getName()}")):
            raise OSError(f"{at.toString()} can't be moved to {folder}")
    delete(spark, source)


def append_stream(spark: SparkSession, folder: str, schema: T.StructType, root: str, checkpoint: str) -> StreamingQuery:
    """Starts a stream over JSON-lines files that ends when all present files are in the lake at ``root``.

    The lake's layout is that of ``build_lake``, so a lake that was built can be added to. A micro-batch is parsed once, written
    beside the tables and then moved into them under its number; repeated after a failure it replaces what it had moved.
    """

    def add(records: DataFrame, number: int) -> None:
        with staged(records) as rows:
            for name, build in BUILDERS.items():
                beside = f"{root}/_incoming/{name}-{number}"
                write_table(build(rows), beside, ROWS_PER_FILE[name], "overwrite")
                adopt(rows.sparkSession, beside, f"{root}/{name}", f"batch{number:010d}-")

    source = spark.readStream.schema(schema).option("mode", "FAILFAST").json(folder)
    return source.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
