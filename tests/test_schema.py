"""Type strings, merging and inference."""

from __future__ import annotations

import gzip
import json

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import types as T

from lakeloom.operators import schema as S

MERGES = [
    (["BIGINT", "BIGINT"], "BIGINT"), (["BIGINT", "DOUBLE"], "DOUBLE"), (["BOOLEAN", "BIGINT"], "BIGINT"), (["BIGINT", "VARCHAR"], "VARCHAR"), (["JSON", "VARCHAR"], "VARCHAR"),
    (["STRUCT(a BIGINT)", "STRUCT(a BIGINT, b VARCHAR)"], "STRUCT(a BIGINT, b VARCHAR)"), (["STRUCT(a BIGINT)", "JSON"], "JSON"), (["BIGINT", "STRUCT(a BIGINT)"], "STRUCT(a BIGINT)"),
    (["DATE", "TIMESTAMP"], "TIMESTAMP"), (["DATE", "BIGINT"], "DATE"), (["BIGINT[]", "DOUBLE"], "BIGINT[]"), (["STRUCT(a BIGINT)", "STRUCT(b BIGINT)"], "STRUCT(a BIGINT)"),
]


@pytest.mark.parametrize(("types", "want"), MERGES)
def test_merge_types(types, want):
    assert S.merge_types(types) == want


kinds = st.recursive(
    st.sampled_from([k for k in S.SIMPLE.values()] + [T.DecimalType(12, 3)]),
    lambda k: st.one_of(k.map(T.ArrayType), k.map(lambda v: T.MapType(T.StringType(), v)), st.lists(st.tuples(st.sampled_from(["a", "end", "Cross-link", 'say "x"', "two words"]), k), min_size=1, max_size=3, unique_by=lambda x: x[0]).map(lambda fs: T.StructType([T.StructField(n, t) for n, t in fs]))),
    max_leaves=6,
)


@given(kinds)
def test_type_strings_round_trip(kind):
    assert S.parse_type(S.type_string(kind)) == kind


def test_bad_type_strings():
    for text in ("", "STRUCT(", "NOSUCH", "BIGINT BIGINT", "STRUCT(a)", "MAP(VARCHAR)"):
        with pytest.raises(ValueError):
            S.parse_type(text)


def test_deep_merge_loses_no_field():
    a, b = {"x": "STRUCT(a BIGINT, b STRUCT(c DATE))", "y": "BIGINT"}, {"z": "VARCHAR[]", "x": "STRUCT(b STRUCT(d DOUBLE), a DOUBLE)"}
    assert S.merge_schemas([a, b]) == {"x": "STRUCT(a DOUBLE, b STRUCT(c DATE, d DOUBLE))", "y": "BIGINT", "z": "VARCHAR[]"}
    assert S.merge_schemas([a, b], "reference")["x"] == max(a["x"], b["x"], key=len)


def test_infer_and_files(spark, tmp_path):
    rows = [{"id": "a", "day": "2024-01-31", "n": 1, "o": {"d": "2020-02-29", "e": "2020-02-30"}, "c": [{"k": 1}]}, {"id": "b", "day": None, "n": 1.5, "c": [{"k": "x"}]}]
    with gzip.open(tmp_path / "r.jsonl.gz", "wt") as f:
        f.write("\n".join(map(json.dumps, rows)))
    got = S.infer(spark, str(tmp_path / "r.jsonl.gz"), variants=("c",))
    assert {f.name: S.type_string(f.dataType) for f in got.fields} == {"c": "MAP(VARCHAR, JSON)[]", "day": "DATE", "id": "VARCHAR", "n": "DOUBLE", "o": "STRUCT(d DATE, e VARCHAR)"}
    S.to_file(got, str(tmp_path / "s.json"))
    assert S.from_file(str(tmp_path / "s.json")) == got
    assert [r["column_type"] for r in S.describe(spark.createDataFrame([(1, "x")], "a long, b string")).orderBy("position").collect()] == ["BIGINT", "VARCHAR"]
