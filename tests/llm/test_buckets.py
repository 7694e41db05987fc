"""Packed buckets against dictionaries, hot keys and large buckets included."""

from __future__ import annotations

from collections import defaultdict
from itertools import combinations

import numpy as np
import pytest

from lakeloom.llm import buckets as B


def pairs_of(rows):
    by = defaultdict(set)
    for b, i in rows:
        by[b].add(i)
    return {p for s in by.values() for p in combinations(sorted(s), 2)}, by


def test_groups_of_pairs():
    rng = np.random.default_rng(0)
    keys, ids = rng.integers(1, 900, 3000).astype(np.uint64), rng.integers(0, 400, 3000)
    want = defaultdict(set)
    for k, i in zip(keys.tolist(), ids.tolist(), strict=True):
        want[k].add(i)
    name, got = B.grouped(keys, ids)
    _, by = pairs_of(zip(name.tolist(), got.tolist(), strict=True))
    assert {frozenset(s) for s in by.values()} == {frozenset(s) for s in want.values() if len(s) > 1}
    assert B.grouped(np.zeros(0, np.uint64), np.zeros(0, np.int64))[0].size == 0


@pytest.mark.parametrize("hot", [10**9, 40])
def test_buckets_and_hot_keys(spark, monkeypatch, hot):
    """A key that a third of the rows have is cut in cells; those that matter to each other (values next to each other) still meet."""
    monkeypatch.setattr(B, "HOT", hot)
    monkeypatch.setattr(B, "LOOK", 1.0001)
    rng = np.random.default_rng(1)
    rows = [(i, 7 if i % 3 == 0 else int(rng.integers(100, 300)), int(rng.integers(0, 1000))) for i in range(600)]

    def make(batch):
        k = batch.column(1).to_numpy().astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return batch.column(0).to_numpy(), k[:, None]

    def cells(batch, at):
        v = batch.column(2).to_numpy()[at]
        return np.stack([v // 50, (v + 50) // 50], 1)

    df = spark.createDataFrame(rows, "id long, key long, value long")
    got, by = pairs_of((r["bucket"], r["id"]) for r in B.buckets(df, make, 1, cells).collect())
    want = {(a[0], b[0]) for a, b in combinations(rows, 2) if a[1] == b[1] and (abs(a[2] - b[2]) <= 50)}
    assert want <= got and all(rows[a][1] == rows[b][1] for a, b in got)
    assert max(map(len, by.values())) > 150 or hot == 40 and max(map(len, by.values())) < 60


def test_large_buckets_in_blocks(spark):
    rows = [(1, i) for i in range(50)] + [(2, i) for i in range(5)]
    got, by = pairs_of((r["bucket"], r["id"]) for r in B.in_blocks(spark.createDataFrame(rows, "bucket long, id long"), 10).collect())
    assert got == set(combinations(range(50), 2)) and max(map(len, by.values())) < 40
