"""Schemas: inference, merging, and the type strings that schema files hold (S-01 to S-06)."""

from __future__ import annotations

import json
import re
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SIMPLE = {
    "VARCHAR": T.StringType(), "TEXT": T.StringType(), "BOOLEAN": T.BooleanType(), "TINYINT": T.ByteType(), "SMALLINT": T.ShortType(),
    "INTEGER": T.IntegerType(), "BIGINT": T.LongType(), "HUGEINT": T.DecimalType(38, 0), "FLOAT": T.FloatType(), "DOUBLE": T.DoubleType(),
    "DATE": T.DateType(), "TIMESTAMP": T.TimestampNTZType(), "JSON": T.VariantType(), "BLOB": T.BinaryType(),
}
#: Of two types the one that stands later holds both; nested and unknown types stand where OTHER does.
OTHER = "..."
WIDER = ("BOOLEAN", "TINYINT", "SMALLINT", "INTEGER", "BIGINT", "HUGEINT", "FLOAT", "DOUBLE", "DATE", "TIMESTAMP", OTHER, "JSON", "VARCHAR")
_TOKEN = re.compile(r'\s*("(?:[^"]|"")*"|[A-Za-z_]\w*|\d+|\[\]|[(),])')


def parse_type(text: str) -> T.DataType:
    """The Spark type of a type string: scalars, T[], STRUCT(name T, "quoted name" T), MAP(K, V), DECIMAL(p, s) (S-04)."""
    tokens, at = [], 0
    while at < len(text.rstrip()):
        m = _TOKEN.match(text, at)
        if not m:
            raise ValueError(f"unexpected {text[at : at + 10]!r} in type {text!r}")
        tokens.append(m[1])
        at = m.end()
    pos = 0

    def take(want: str | None = None) -> str:
        nonlocal pos
        if pos >= len(tokens) or want is not None and tokens[pos] != want:
            raise ValueError(f"expected {want or 'more'} in type {text!r}")
        pos += 1
        return tokens[pos - 1]

    def one() -> T.DataType:
        name = take().upper()
        if name == "STRUCT":
            take("(")
            fields = []
            while True:
                field = take()
                fields.append(T.StructField(field[1:-1].replace('""', '"') if field[0] == '"' else field, one()))
                if take() == ")":
                    break
            out: T.DataType = T.StructType(fields)
        elif name == "MAP":
            take("(")
            key = one()
            take(",")
            out = T.MapType(key, one())
            take(")")
        elif name in ("DECIMAL", "NUMERIC"):
            out = T.DecimalType(18, 3)
            if pos < len(tokens) and tokens[pos] == "(":
                take("(")
                p = int(take())
                s = int(take()) if take() == "," else 0
                if tokens[pos - 1] != ")":
                    take(")")
                out = T.DecimalType(p, s)
        elif name in SIMPLE:
            out = SIMPLE[name]
        else:
            raise ValueError(f"unknown type {name}")
        arrays = 0
        while pos < len(tokens) and tokens[pos] == "[]":
            take()
            arrays += 1
        for _ in range(arrays):
            out = T.ArrayType(out)
        return out

    out = one()
    if pos != len(tokens):
        raise ValueError(f"more after the type in {text!r}")
    return out


def type_string(kind: T.DataType) -> str:
    """The type string of a Spark type: the inverse of ``parse_type``."""
    if isinstance(kind, T.StructType):
        name = lambda n: n if re.fullmatch(r"[A-Za-z_]\w*", n) else '"' + n.replace('"', '""') + '"'
        return "STRUCT(" + ", ".join(f"{name(f.name)} {type_string(f.dataType)}" for f in kind.fields) + ")"
    if isinstance(kind, T.ArrayType):
        return type_string(kind.elementType) + "[]"
    if isinstance(kind, T.MapType):
        return f"MAP({type_string(kind.keyType)}, {type_string(kind.valueType)})"
    if isinstance(kind, T.DecimalType):
        return "HUGEINT" if (kind.precision, kind.scale) == (38, 0) else f"DECIMAL({kind.precision},{kind.scale})"
    if isinstance(kind, T.TimestampType):
        return "TIMESTAMP"
    return next((n for n, t in SIMPLE.items() if t == kind), "VARCHAR")


def reader_schema(columns: dict[str, str]) -> T.StructType:
    """The schema for a reader from a dict of column and type string."""
    return T.StructType([T.StructField(n, parse_type(t)) for n, t in columns.items()])


def merge_types(types: Iterable[str]) -> str:
    """One type string for several: the widest, of those as wide the longest, of those as long the first (S-02, mode 'reference')."""
    kinds = list(dict.fromkeys(types))

    def wide(kind: str) -> tuple[int, int]:
        name = kind.upper()
        return WIDER.index(name if name in WIDER else OTHER), len(kind)

    widest = sorted(kinds, key=wide, reverse=True)[0]
    return widest.upper() if len(kinds) > 1 and widest.upper() == WIDER[-1] else widest


def merge_deep(a: T.DataType, b: T.DataType) -> T.DataType:
    """The type that holds both: fields of structs are united, scalars go by rank, unlike kinds become strings."""
    if a == b:
        return a
    if isinstance(a, T.NullType) or isinstance(b, T.NullType):
        return b if isinstance(a, T.NullType) else a
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        right = {f.name: f.dataType for f in b.fields}
        fields = [T.StructField(f.name, merge_deep(f.dataType, right.pop(f.name)) if f.name in right else f.dataType) for f in a.fields]
        return T.StructType(fields + [T.StructField(n, t) for n, t in right.items()])
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(merge_deep(a.elementType, b.elementType))
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        return T.MapType(merge_deep(a.keyType, b.keyType), merge_deep(a.valueType, b.valueType))
    nested = (T.StructType, T.ArrayType, T.MapType)
    if isinstance(a, nested) or isinstance(b, nested):
        return T.VariantType()
    x, y = type_string(a), type_string(b)
    if {x, y} & {"DATE", "TIMESTAMP"} and not {x, y} <= {"DATE", "TIMESTAMP"}:
        return T.StringType()
    return parse_type(merge_types([x, y]))


def merge_schemas(schemas: list[dict[str, str]], mode: str = "deep") -> dict[str, str]:
    """All columns of all schemas, in the order first seen, each with its merged type (S-03)."""
    seen: dict[str, list[str]] = {}
    for s in schemas:
        for column, kind in s.items():
            seen.setdefault(column, []).append(kind)
    if mode == "reference":
        return {c: merge_types(kinds) for c, kinds in seen.items()}
    out = {}
    for c, kinds in seen.items():
        merged = parse_type(kinds[0])
        for k in kinds[1:]:
            merged = merge_deep(merged, parse_type(k))
        out[c] = type_string(merged)
    return out


def _string_leaves(kind: T.DataType, path: tuple[str, ...] = ()) -> Iterable[tuple[str, ...]]:
    if isinstance(kind, T.StringType):
        yield path
    elif isinstance(kind, T.StructType):
        for f in kind.fields:
            yield from _string_leaves(f.dataType, (*path, f.name))


def _with_dates(kind: T.DataType, dates: set[tuple[str, ...]], path: tuple[str, ...] = ()) -> T.DataType:
    if path in dates:
        return T.DateType()
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _with_dates(f.dataType, dates, (*path, f.name))) for f in kind.fields])
    return kind


def infer(spark: SparkSession, paths: str | list[str], dates: bool = True, variants: tuple[str, ...] = ()) -> T.StructType:
    """The schema of JSON lines by a full scan (S-01, SRC-05). String fields outside arrays whose every value is a date
    become dates, in one more pass; columns named in ``variants`` are kept as they are in the JSON."""
    df = spark.read.option("samplingRatio", 1.0).json(paths)
    found = T.StructType([T.StructField(f.name, _opaque(f.dataType) if f.name in variants else f.dataType) for f in df.schema.fields])
    leaves = [p for p in _string_leaves(found) if p] if dates else []
    if not leaves:
        return found
    checks = []
    for i, p in enumerate(leaves):
        c = F.col(".".join("`" + x.replace("`", "``") + "`" for x in p))
        is_date = c.rlike(r"^\d{4}-\d{2}-\d{2}$") & F.try_to_timestamp(c, F.lit("yyyy-MM-dd")).isNotNull()
        checks.append(F.coalesce(F.bool_and(F.when(c.isNotNull(), F.coalesce(is_date, F.lit(False)))), F.lit(False)).alias(f"c{i}"))
    row = df.agg(*checks).first()
    return _with_dates(found, {p for i, p in enumerate(leaves) if row[f"c{i}"]})  # type: ignore[return-value]


def _opaque(kind: T.DataType) -> T.DataType:
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType):
        return T.ArrayType(T.MapType(T.StringType(), T.VariantType()))
    return T.MapType(T.StringType(), T.VariantType()) if isinstance(kind, T.StructType) else T.VariantType()


def to_file(schema: T.StructType, path: str, indent: int = 2) -> None:
    """A schema file: a JSON object of column and type string (SNK-09)."""
    with open(path, "w") as f:
        json.dump({x.name: type_string(x.dataType) for x in schema.fields}, f, indent=indent)


def from_file(path: str) -> T.StructType:
    with open(path) as f:
        return reader_schema(json.load(f))


def describe(df: DataFrame) -> DataFrame:
    """(column_name, column_type) in order (S-05)."""
    rows = [(i, f.name, type_string(f.dataType)) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "position int, column_name string, column_type string")
