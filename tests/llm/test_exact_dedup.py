from __future__ import annotations

import re

from pyspark.sql import functions as F

from lakeloom.llm import exact_dedup, queries
from lakeloom.llm.common import scratch
from tests.conftest import SF
from tests.llm.helpers import docs


def test_whole_table(spark):
    table = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    first: dict = {}
    for i, t in sorted(table):
        first.setdefault(t, i)
    got = sorted(r["doc_id"] for r in queries.op3_exact_dedup(spark, SF).collect())
    assert got == sorted(first.values())


def test_defined_results(spark):
    long = "z" * 400_000
    rows = [(5, "a"), (3, "a"), (None, "a"), (1, None), (2, None), (7, ""), (6, ""), (8, "b"), (8, "b"), (9, "x"), (9, "y"), (10, long), (11, long), (None, "only")]
    df = docs(spark, rows).selectExpr("*", "1 AS file", "2 AS row", "3 AS digest", "4 AS slice")
    out = exact_dedup.drop_copies(df)
    assert out.columns == df.columns
    got = sorted(((r["doc_id"] or 0, "null" if r["text"] is None else r["text"][:5]) for r in out.collect()))
    assert got == sorted([(3, "a"), (1, "null"), (2, "null"), (6, ""), (8, "b"), (9, "x"), (9, "y"), (10, "zzzzz"), (0, "only")])
    assert exact_dedup.drop_copies(df.limit(0)).count() == 0


def test_bytes_decide_where_digests_meet(spark):
    rows = [(i, f"text {i % 7}") for i in range(40)]
    weak = lambda text: F.unhex(F.substring(F.sha2(text, 256), 1, 1))  # noqa: E731  (16 digests for all)
    out = exact_dedup.drop_copies(docs(spark, rows), digest_of=weak)
    assert sorted(r["doc_id"] for r in out.collect()) == list(range(7))


def test_the_stream_goes_on_where_it_was(spark):
    """Texts of an earlier run are still known: state doesn't expire, and what comes later loses even with a lesser id."""
    folder, home = scratch(spark, "in"), scratch(spark, "home")
    docs(spark, [(5, "a"), (6, "b"), (7, "a")]).write.parquet(folder)
    df = spark.read.parquet(folder)
    assert sorted(r["doc_id"] for r in exact_dedup.drop_copies(df, folder, home).collect()) == [5, 6]
    docs(spark, [(1, "a"), (8, "c"), (9, "b")]).write.mode("append").parquet(folder)
    df = spark.read.parquet(folder)
    assert sorted(r["doc_id"] for r in exact_dedup.drop_copies(df, folder, home).collect()) == [5, 6, 8]


def test_a_task_sends_on_the_first_of_its_copies():
    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(0)
    rows = [(bytes([int(rng.integers(0, 6))]), None if rng.random() < 0.1 else int(rng.integers(0, 9)), "f", i) for i in range(200)]
    batches = [pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows[a : a + 30]], t) for k, t in enumerate((pa.binary(), pa.int64(), pa.string(), pa.int64()))], ["digest", "doc_id", "file", "row"]) for a in range(0, 200, 30)]
    got = [tuple(r.values()) for b in exact_dedup.first_of_task(iter(batches)) for r in b.to_pylist()]
    assert sorted(r[3] for r in got) == list(range(200))
    for d in {r[0] for r in rows}:
        first = min((r for r in rows if r[0] == d), key=lambda r: exact_dedup.order_of(*r[1:]))
        assert [r[:4] for r in got if r[0] == d and not r[4]] == [first]


def test_folders_whose_names_are_patterns(spark):
    folder = scratch(spark, "in[1]{x}*")
    docs(spark, [(i, f"text {i % 20}") for i in range(50)]).write.parquet(folder)
    df = spark.read.parquet(re.sub(r"([\[\]{}*])", r"\\\1", folder))
    assert sorted(r["doc_id"] for r in exact_dedup.drop_copies(df, folder).collect()) == list(range(20))
