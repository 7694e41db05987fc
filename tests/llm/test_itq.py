from __future__ import annotations

import numpy as np

from lakeloom.llm import itq, queries
from tests.conftest import SF
from tests.llm.helpers import groups


def brute(ids, x, threshold):
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    s = x @ x.T
    pairs = [(ids[i], ids[j]) for i in range(len(ids)) for j in range(i) if s[i, j] >= threshold - 1e-12]
    return pairs


def test_rotation_lowers_the_quantisation_error(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 16)) @ rng.normal(size=(16, 16))
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")

    def error(rounds):
        mean, p = itq.learn(rows, 16, 12, rounds)
        z = (x / np.linalg.norm(x, axis=1, keepdims=True) - mean) @ p
        return ((np.where(z >= 0, 1, -1) * np.abs(z).mean() - z) ** 2).sum(), p

    before, after = error(0), error(12)
    assert after[0] < before[0]
    assert np.allclose(after[1].T @ after[1], np.eye(12), atol=1e-8)


def test_pairs_against_all_pairs(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(150, 48))
    x = np.concatenate([base, base[:100] + rng.normal(size=(100, 48)) * rng.uniform(0.02, 0.4, (100, 1))])
    ids = list(range(len(x)))
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in zip(ids, x, strict=True)], "vec_id long, embedding array<float>")
    pairs = brute(ids, x.astype(np.float32).astype(float), itq.THRESHOLD)
    got = {r["vec_id"]: r["component"] for r in itq.near_groups(rows).collect()}
    met = sum(a in got and b in got and got[a] == got[b] for a, b in pairs)
    assert len(pairs) > 30 and met >= 0.95 * len(pairs)
    want = groups(pairs)
    assert all(want[i] <= c for i, c in got.items())  # nothing is tied that isn't near


def test_whole_table(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    pairs = brute([r["vec_id"] for r in table], np.array([r["embedding"] for r in table], float), itq.THRESHOLD)
    got = {r["vec_id"]: r["keeper"] for r in queries.op5_itq_dedup(spark, SF).collect()}
    assert len(got) == len(table)
    assert not pairs or sum(got[a] == got[b] for a, b in pairs) >= 0.9 * len(pairs)
    want = groups(pairs, got)
    assert all(want[i] <= k for i, k in got.items())


def test_defined_results(spark):
    v = [1.0, 2.0, 3.0, 4.0]
    rows = [(1, v), (2, v), (2, v), (3, None), (4, [1.0, None, 2.0, 3.0]), (5, [float("nan")] * 4), (6, [0.0] * 4), (7, [1.0, 2.0]), (None, v), (8, [-1.0, 2.0, -3.0, 1.0]), (9, [2.0, 4.0, 6.0, 8.0]), (10, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 AS keeper", "2 AS component", "3 AS node")
    got = sorted(((r["vec_id"] or 0, r["keeper"], r["kept"]) for r in itq.near_dedup(df).collect()), key=str)
    assert [x for x in got if x[0] in (1, 2, 9)] == [(1, 1, True), (2, 1, False), (2, 1, False), (9, 1, False)]
    assert (0, None, True) in got
    assert all(k == i and keep for i, k, keep in got if i in (3, 4, 5, 6, 7, 8, 10))
    assert itq.near_dedup(df.limit(0)).count() == 0
