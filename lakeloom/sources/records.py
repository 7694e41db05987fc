"""Readers of JSON records: wrapped arrays, JSON lines, and a streaming data source for arrays too large for one row."""

from __future__ import annotations

import gzip
import io
import json
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from lakeloom.sources.parquet import file_system


def read_wrapped(spark: SparkSession, path: str | list[str], field: str = "results", schema: T.StructType | None = None) -> DataFrame:
    """Rows of documents ``{"results": [...]}``, plain or .gz (SRC-01, JSN-03). A top-level list is taken as it is."""
    reader = spark.read.option("multiLine", True)
    if schema is not None:
        reader = reader.schema(T.StructType([T.StructField(field, T.ArrayType(schema))]))
    df = reader.json(path)
    return df.select(F.inline(field)) if field in df.columns else df


def read_lines(spark: SparkSession, path: str | list[str], schema: T.StructType | None = None, strict: bool = True) -> DataFrame:
    """JSON lines, also .gz and .zst, with a given schema or one inferred by a full scan (SRC-03 to SRC-06, TYP-01).

    A value that doesn't fit the schema is an error, or null with ``strict=False``; keys not in the schema are dropped.
    """
    reader = spark.read.option("mode", "FAILFAST" if strict else "PERMISSIVE")
    return reader.schema(schema).json(path) if schema is not None else reader.option("samplingRatio", 1.0).json(path)


def parse_lines(text: DataFrame, schema: T.StructType, column: str = "value") -> DataFrame:
    """Records from a column of JSON strings (JSN-01)."""
    return text.select(F.from_json(column, schema).alias("r")).select("r.*")


def _binary(path: str):
    system, name = file_system(path)
    return system.open_input_stream(name, compression=None)


def elements(path: str, field: str = "results", chunk: int = 1 << 20) -> Iterator[dict]:
    """The elements of the array under ``field`` of one document (or of a top-level array), one at a time.

    Holds one chunk and one element. Floats stay floats.
    """
    decoder = json.JSONDecoder()
    with _binary(path) as raw, io.TextIOWrapper(gzip.open(raw) if path.endswith(".gz") else raw, encoding="utf-8") as f:
        buffer, at = f.read(chunk), 0

        def more() -> bool:
            nonlocal buffer, at
            new = f.read(chunk)
            buffer, at = buffer[at:] + new, 0
            return bool(new)

        def skip() -> str:
            nonlocal at
            while True:
                while at < len(buffer) and buffer[at] in " \t\r\n":
                    at += 1
                if at < len(buffer):
                    return buffer[at]
                if not more():
                    return ""

        def value() -> object:
            nonlocal at
            skip()
            while True:
                try:
                    found, end = decoder.raw_decode(buffer, at)
                    if end < len(buffer) or not more():  # a number may go on in the next chunk
                        at = end
                        return found
                except json.JSONDecodeError:
                    if not more():
                        raise

        if skip() == "{":
            at += 1
            while True:
                c = skip()
                if c in ("}", ""):
                    raise ValueError(f"no array under {field!r} in {path}" if c else f"{path} ends before {field!r}")
                if c == ",":
                    at += 1
                    continue
                name = value()
                if skip() != ":":
                    raise ValueError(f"no value for {name!r} in {path}")
                at += 1
                if name == field:
                    break
                value()
        if skip() != "[":
            raise ValueError(f"no array under {field!r} in {path}")
        at += 1
        while True:
            c = skip()
            if c == "]":
                return
            if c == "":
                raise ValueError(f"the array in {path} doesn't end")
            if c == ",":
                at += 1
                continue
            yield value()  # type: ignore[misc]


class _OneFile(InputPartition):
    def __init__(self, path: str) -> None:
        super().__init__(path)
        self.path = path


class _ArrayReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.paths, self.field = json.loads(options["files"]), options.get("field", "results")

    def partitions(self) -> list[InputPartition]:
        return [_OneFile(p) for p in self.paths]

    def read(self, partition: _OneFile) -> Iterator[tuple]:
        for r in elements(partition.path, self.field):
            yield (json.dumps(r, separators=(",", ":"), ensure_ascii=False),)


class JsonArraySource(DataSource):
    """Format ``json_array``: a row (value string) for each element; a task a file, memory of one element."""

    @classmethod
    def name(cls) -> str:
        return "json_array"

    def schema(self) -> str:
        return "value string"

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _ArrayReader(self.options)


def stream_array(spark: SparkSession, paths: str | list[str], schema: T.StructType, field: str = "results") -> DataFrame:
    """Records of documents too large to be one row."""
    spark.dataSource.register(JsonArraySource)
    text = spark.read.format("json_array").option("field", field).option("files", json.dumps([paths] if isinstance(paths, str) else list(paths))).load()
    return parse_lines(text, schema)


def taxon_map(path: str) -> dict[int, str]:
    """A YAML file of taxid and name (SRC-22)."""
    import yaml

    with open(path) as f:
        return {int(k): v for k, v in (yaml.safe_load(f) or {}).items()}
