"""Readers of Parquet lakes, their files and their footers."""

from __future__ import annotations

import io
import urllib.request
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

FOOTER = "path string, format_version string, created_by string, num_row_groups int, num_rows long, num_columns int, arrow_schema string"
ROW_GROUP = "path string, row_group int, num_rows long, column_index int, column string, compression string, compressed_size long, uncompressed_size long, min_value string, max_value string, null_count long"


def read_lake(spark: SparkSession, root: str, table: str | None = None) -> DataFrame:
    """A Hive-partitioned table; partition values keep their text (SRC-07, SRC-10, SRC-14)."""
    path = f"{root}/{table}" if table else root
    df = spark.read.parquet(path)
    return df.withColumns({k: F.col(k).cast("string") for k in ("review_status", "tax_division") if k in df.columns and df.schema[k].dataType != T.StringType()})


def read_union(spark: SparkSession, files: list[str], root: str | None = None) -> DataFrame:
    """Files of different schemas by name; what a file lacks is null (SRC-08, SET-01)."""
    reader = spark.read.option("mergeSchema", True)
    return (reader.option("basePath", root) if root else reader).parquet(*files)


def read_partition(spark: SparkSession, root: str, **keys: str) -> DataFrame:
    """One partition, or all under a prefix of the keys, without listing the others (SRC-12, SRC-13)."""
    path = root + "".join(f"/{k}={v}" for k, v in keys.items())
    return spark.read.option("basePath", root).parquet(path)


def list_files(spark: SparkSession, root: str, suffix: str = ".parquet") -> DataFrame:
    """(path, size) of all files below, sorted, empty files too; a table that isn't there has none (SRC-19, SRC-20)."""
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(root)
    fs = p.getFileSystem(sc._jsc.hadoopConfiguration())
    rows = []
    if fs.exists(p):
        walk = fs.listFiles(p, True)
        while walk.hasNext():
            x = walk.next()
            if x.getPath().getName().endswith(suffix):
                rows.append((x.getPath().toString(), x.getLen()))
    return spark.createDataFrame(sorted(rows), "path string, size long")


def file_system(path: str):
    """Arrow's file system for a path or URI, and the path there; names of local files may hold anything."""
    import pyarrow.fs as fs

    local = path.removeprefix("file://") if path.startswith("file://") else path.removeprefix("file:")
    return (fs.LocalFileSystem(), local) if "://" not in local else fs.FileSystem.from_uri(path)


def _open(path: str):
    system, name = file_system(path)
    return system.open_input_file(name)


def _over_files(spark: SparkSession, files: DataFrame | list[str], schema: str, rows_of) -> DataFrame:
    paths = files.select("path") if isinstance(files, DataFrame) else spark.createDataFrame([(f,) for f in files], "path string")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.strip().split(" ")[0] for c in schema.split(",")]
        for b in batches:
            yield pd.DataFrame([r for p in b["path"] for r in rows_of(p)], columns=names)

    return paths.repartition(min(200, max(1, spark.sparkContext.defaultParallelism)), "path").mapInPandas(run, schema)


def file_metadata(spark: SparkSession, files: DataFrame | list[str]) -> DataFrame:
    """A row a file: what its footer says of it (SRC-16). Footers are read by the executors."""

    def rows(path: str) -> list[tuple]:
        import pyarrow.parquet as pq

        with _open(path) as f:
            p = pq.ParquetFile(f)
            m = p.metadata
            return [(path, m.format_version, m.created_by, m.num_row_groups, m.num_rows, m.num_columns, str(p.schema_arrow))]

    return _over_files(spark, files, FOOTER, rows)


def row_groups(spark: SparkSession, files: DataFrame | list[str], first_columns: int | None = None) -> DataFrame:
    """A row for each column chunk of each row group (SRC-17); ``first_columns`` leaves out later columns (LIM-04)."""

    def rows(path: str) -> list[tuple]:
        import pyarrow.parquet as pq

        out = []
        with _open(path) as f:
            m = pq.ParquetFile(f).metadata
            for g in range(m.num_row_groups):
                r = m.row_group(g)
                for c in range(r.num_columns if first_columns is None else min(first_columns, r.num_columns)):
                    x = r.column(c)
                    s = x.statistics
                    has = s is not None and s.has_min_max
                    out.append((path, g, r.num_rows, c, x.path_in_schema, x.compression, x.total_compressed_size, x.total_uncompressed_size, str(s.min) if has else None, str(s.max) if has else None, s.null_count if s is not None and s.has_null_count else None))
        return out

    return _over_files(spark, files, ROW_GROUP, rows)


def compression(spark: SparkSession, files: DataFrame | list[str]) -> DataFrame:
    """Total sizes and uncompressed / compressed, 0 for no files (SRC-18, AGG-19)."""
    total = row_groups(spark, files).agg(F.coalesce(F.sum("compressed_size"), F.lit(0)).alias("compressed"), F.coalesce(F.sum("uncompressed_size"), F.lit(0)).alias("uncompressed"))
    return total.withColumn("ratio", F.coalesce(F.try_divide(F.col("uncompressed").cast("double"), F.col("compressed").cast("double")), F.lit(0.0)))


class RangeFile(io.RawIOBase):
    """A file over HTTP that reads byte ranges."""

    def __init__(self, url: str) -> None:
        self.url, self.at = url, 0
        with urllib.request.urlopen(urllib.request.Request(url, method="HEAD")) as r:
            self.size = int(r.headers["Content-Length"])

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def tell(self) -> int:
        return self.at

    def seek(self, offset: int, whence: int = 0) -> int:
        self.at = offset + (0, self.at, self.size)[whence]
        return self.at

    def read(self, size: int = -1) -> bytes:
        end = self.size if size < 0 else min(self.size, self.at + size)
        if end <= self.at:
            return b""
        with urllib.request.urlopen(urllib.request.Request(self.url, headers={"Range": f"bytes={self.at}-{end - 1}"})) as r:
            data = r.read()
            if r.status == 200:
                data = data[self.at : end]
        self.at += len(data)
        return data

    def readinto(self, buffer) -> int:
        data = self.read(len(buffer))
        buffer[: len(data)] = data
        return len(data)


class _Group(InputPartition):
    def __init__(self, url: str, group: int) -> None:
        super().__init__((url, group))
        self.url, self.group = url, group


class _HttpReader(DataSourceReader):
    def __init__(self, urls: list[str], columns: list[str]) -> None:
        self.urls, self.columns = urls, columns

    def partitions(self) -> list[InputPartition]:
        import pyarrow.parquet as pq

        return [_Group(u, g) for u in self.urls for g in range(pq.ParquetFile(RangeFile(u)).num_row_groups)]

    def read(self, partition: _Group):
        import pyarrow.parquet as pq

        yield from pq.ParquetFile(RangeFile(partition.url)).read_row_group(partition.group, columns=self.columns).to_batches()


class HttpParquetSource(DataSource):
    """Format ``http_parquet``: Parquet files by URL, a task a row group, only the bytes of the columns asked for (SRC-09)."""

    @classmethod
    def name(cls) -> str:
        return "http_parquet"

    def _columns(self) -> list[str]:
        return [c for c in self.options.get("columns", "").split(",") if c]

    def schema(self) -> T.StructType:
        import pyarrow.parquet as pq
        from pyspark.sql.pandas.types import from_arrow_schema

        whole = from_arrow_schema(pq.ParquetFile(RangeFile(self.options["path"].split(",")[0])).schema_arrow)
        return T.StructType([whole[c] for c in self._columns()]) if self._columns() else whole

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _HttpReader(self.options["path"].split(","), schema.names)


def read_http(spark: SparkSession, urls: str | list[str], columns: list[str] | None = None) -> DataFrame:
    spark.dataSource.register(HttpParquetSource)
    return spark.read.format("http_parquet").option("columns", ",".join(columns or [])).load(urls if isinstance(urls, str) else ",".join(urls))
