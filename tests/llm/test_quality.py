from __future__ import annotations

import numpy as np

from lakeloom.llm import quality
from tests.conftest import SF
from tests.llm.helpers import docs

LABELS = "doc_id long, quality int, toxic int"


def test_likelihood_gradient_and_order():
    """On data made from known weights and thresholds, the fit finds ordered thresholds and the order of scores."""
    rng = np.random.default_rng(0)
    index, value, grade, truth = [], [], [], []
    for _ in range(1500):
        i = rng.choice(40, 6, replace=False)
        s = float((np.arange(40)[i] / 10 - 2).sum() / 2)
        index.append(i.astype(np.int64))
        value.append(np.ones(6))
        truth.append(s)
        grade.append(int((s + rng.logistic() * 0.5 > -1)) + int(s + rng.logistic() * 0.5 > 1))
    m = quality.fit(index, value, np.array(grade))
    score = np.array([m.weights[i].sum() for i in index])
    assert m.thresholds[0] < m.thresholds[1]
    assert np.corrcoef(score, truth)[0, 1] > 0.95
    p = m.tails(score)
    assert (p[:, 0] >= p[:, 1]).all()


def test_held_out_accuracy(spark):
    """Trained on half of the labelled documents, right on the other half; clean documents stay."""
    d, labels = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    half = labels.where("doc_id % 2 = 0")
    got = {r["doc_id"]: r for r in quality.quality(d, half).collect()}
    held = [(got[r["doc_id"]], r["quality"]) for r in labels.where("doc_id % 2 = 1").collect() if r["doc_id"] in got]
    assert len(held) > 80
    good = [g["keep"] for g, q in held if q == 1]
    bad = [g["keep"] for g, q in held if q == 0]
    assert np.mean(good) >= 0.98
    assert np.mean(bad) <= 0.25


def test_held_out_toxic_documents_go(spark):
    """Trained on half of the labelled documents: toxic ones of the other half go, clean ones stay; both ways to decide agree."""
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    d = spark.read.parquet(f"{sf}/documents.parquet").join(labels.select("doc_id").distinct(), "doc_id", "left_semi")
    half = labels.where("doc_id % 2 = 0")
    got = {r["doc_id"]: r["keep"] for r in quality.quality(d, half, reject_toxic=True).collect()}
    held = [(got[r["doc_id"]], r["toxic"]) for r in labels.where("doc_id % 2 = 1 AND quality = 1").collect() if r["doc_id"] in got]
    toxic, clean = [k for k, t in held if t == 1], [k for k, t in held if t == 0]
    assert len(toxic) > 150 and np.mean(toxic) <= 0.15 and np.mean(clean) >= 0.98, (np.mean(toxic), np.mean(clean))
    assert {i for i, k in got.items() if k} == {r["doc_id"] for r in quality.select(d, half, reject_toxic=True).collect()}


def test_defined_results(spark):
    rows = [(1, None), (2, ""), (3, "good plain words"), (3, "good plain words"), (None, "x"), (4, "w " * 100_000)]
    df = docs(spark, rows).selectExpr("*", "1 AS keep", "2 AS tail_1", "3 AS grade")
    labels = spark.createDataFrame([(3, 1, 0), (3, 0, 0), (2, None, 0), (1, 1, None)], LABELS)
    out = quality.quality(df, labels)
    assert out.count() == len(rows)
    assert quality.select(df, labels).columns == df.columns
    none = spark.createDataFrame([], LABELS)
    assert all(r["keep"] for r in quality.quality(df, none).collect())
    assert quality.quality(df.limit(0), labels).count() == 0
    assert quality.select(df, none).count() == len(rows)


def test_selection_is_the_decision(spark):
    d, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    kept = sorted(r["doc_id"] for r in quality.quality(d, labels).where("keep").collect())
    assert kept == sorted(r["doc_id"] for r in quality.select(d, labels).collect())


def test_scores_against_plain_python(spark):
    """Score, tails, expected grade and decision of every document, token by token from the model's own numbers."""
    import math
    import re

    import xxhash

    d, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    m = quality.train(d, labels)
    w = m.weights.astype(np.float32)
    got = {r["doc_id"]: r for r in quality.score(d, m).collect()}
    marks = set(m.marks.tolist())
    for r in d.collect():
        tokens, total, seen, last = r["text"].split(), 0.0, set(), None
        for t in tokens:
            word = t.lower().strip(".,;:!?\"'()[]{}|-_*#$%&")
            shape = re.sub(r"([^a0])\1+", r"\1", re.sub(r"\d+", "0", re.sub(r"[^\W\d_]+", "a", t)))
            both = tuple(xxhash.xxh32_intdigest(x) % 2**18 for x in ("w" + word, "s" + shape))
            total += float(w[both[0]]) + float(w[both[1]]) + (float(w[2**18]) if both == last else 0.0)
            last = both
            seen |= set(both)
        score = total / max(len(tokens), 1)
        p = [1 / (1 + math.exp(-max(-40.0, min(40.0, score - t)))) for t in m.thresholds]
        if seen & marks:
            p[1] *= 1 - m.toxic
        g = got[r["doc_id"]]
        assert abs(g["tail_1"] - p[0]) < 1e-4 and abs(g["tail_2"] - p[1]) < 1e-4 and abs(g["expected_grade"] - sum(p)) < 2e-4
        assert g["toxic"] == bool(seen & marks and p[1] < quality.KEEP_TAIL)


def test_other_case_and_long_shapes(spark):
    df = docs(spark, [(1, "some words"), (2, None)]).withColumnRenamed("text", "Text")
    assert quality.select(df, spark.createDataFrame([], LABELS)).columns == df.columns
    assert quality._feature("a/0/a/0/a/0/a/0/a") != quality._feature("a/0/a/0/a/0/a/0/!")
