"""Batching, grouping and interval operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakeloom.operators.shared import scratch


def ranked(df: DataFrame, order: str, name: str = "position") -> DataFrame:
    """A column with each row's place in ``order``, from 0 on; nulls come first, ties in any order that then holds.

    The rows are cut in ranges of equal size, each sorted and written as a file of the shared folder; a row's place is its
    place in the file and the rows of the files before. No task sees all rows, whatever the order's distribution.
    """
    spark = df.sparkSession
    path = scratch(spark, "ranked")
    df.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), order).sortWithinPartitions(order).write.option("maxRecordsPerFile", 0).parquet(path)
    rows = spark.read.schema(df.schema).parquet(path).select("*", F.col("_metadata.file_name").alias("_f"), F.col("_metadata.row_index").alias("_i"))
    counts = rows.groupBy("_f").agg(F.count(F.lit(1)).alias("_n"))
    before = counts.select("_f", F.coalesce(F.sum("_n").over(Window.orderBy("_f").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_b"))
    return rows.join(F.broadcast(before), "_f").withColumn(name, F.col("_b") + F.col("_i")).drop("_f", "_i", "_b")  # a row a file


def batches(df: DataFrame, order: str, size: int) -> DataFrame:
    """A column batch: rows 0..size-1 in ``order`` are batch 0, and so on; the last may be short (DF-01)."""
    return ranked(df, order, "batch").withColumn("batch", F.floor(F.col("batch") / F.lit(size)).cast("long"))


def overlaps(a: DataFrame, b: DataFrame, keys: list[str], start: str = "start_pos", end: str = "end_pos", width: int | None = None, extra: Callable[[], Column] | None = None) -> DataFrame:
    """Pairs of rows (aliases a and b) of equal keys whose closed intervals overlap (JOIN-06).

    ``width``: intervals are also put in bins of that many positions, and bins are joined: for keys that hold very many
    intervals. A pair is met in each bin both cover and is kept in the one where the later of the two starts.
    """
    x, y = a.alias("a"), b.alias("b")
    on = [F.col(f"a.{k}") == F.col(f"b.{k}") for k in keys]
    on += [F.col(f"a.{start}") <= F.col(f"b.{end}"), F.col(f"b.{start}") <= F.col(f"a.{end}")]
    if extra is not None:
        on.append(extra())
    if width:
        bins = lambda df: df.where(F.col(start) <= F.col(end)).withColumn("_bin", F.explode(F.sequence(F.floor(F.col(start) / width), F.floor(F.col(end) / width))))
        x, y = bins(a).alias("a"), bins(b).alias("b")
        on += [F.col("a._bin") == F.col("b._bin"), F.col("a._bin") == F.floor(F.greatest(F.col(f"a.{start}"), F.col(f"b.{start}")) / width)]
    cond = on[0]
    for c in on[1:]:
        cond = cond & c
    return x.join(y, cond)
