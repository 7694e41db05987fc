"""MinHash groups against all pairs by exact Jaccard similarity."""

from __future__ import annotations

import numpy as np

from lakeloom.llm import minhash, queries
from lakeloom.llm.components import components
from tests.conftest import SF
from tests.llm.helpers import docs, groups, jaccard_pairs, shingle_set


def test_components_of_any_graph(spark):
    rng = np.random.default_rng(1)
    edges = [tuple(map(int, e)) for e in rng.integers(0, 300, (220, 2))] + [(i, i + 1) for i in range(1000, 1200)] + [(5, 5), (7, 8), (7, 8)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame([*edges, (None, 3)], "u long, v long")).collect()}
    want = groups([e for e in edges if e[0] != e[1]])
    assert got == want
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_signatures_estimate_similarity():
    a = " ".join(f"w{i}" for i in range(400))
    b = " ".join(f"w{i}" if i % 40 else f"z{i}" for i in range(400))
    x, n = minhash.shingles([a, b, "", "one two", "one two"])
    sig = minhash.signatures(x, n)
    assert n.tolist() == [398, 398, 0, 1, 1]
    want = len(shingle_set(a) & shingle_set(b)) / len(shingle_set(a) | shingle_set(b))
    assert abs((sig[0] == sig[1]).mean() - want) < 0.12
    assert (sig[2] == sig[3]).all()


def test_minima_are_those_of_the_hashes():
    x, n = minhash.shingles(["a b c d e f", "c d e"])
    sig = minhash.signatures(x, n)
    for row, part in zip(sig, (x[: n[0]], x[n[0] :]), strict=True):
        for k in (0, 7, minhash.PERMUTATIONS - 1):
            assert int(row[k]) == min(((int(h) * int(minhash.A[k]) + int(minhash.B[k])) % 2**64) >> 32 for h in part)


def test_whole_table(spark):
    table = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    kept = {r["doc_id"] for r in queries.op8_minhash_dedup(spark, SF).collect()}
    pairs = jaccard_pairs(table)
    sure = groups([p for p, s in pairs.items() if s >= 0.6], table)
    loose = groups([p for p, s in pairs.items() if s >= 0.35], table)
    due = {i for i, g in sure.items() if g != i}
    assert len(due) > 10
    assert len(due - kept) >= 0.95 * len(due)  # copies go
    assert {i for i in table if loose[i] == i} <= kept  # what is like nothing else stays
    assert {loose[i] for i in table} <= {loose[i] for i in kept}  # something of each group stays


def test_defined_results(spark):
    text = " ".join(f"word{i}" for i in range(60))
    rows = [(1, text), (2, text), (3, None), (4, ""), (5, ""), (6, "..."), (7, None), (None, text), (8, text + " more"), (9, "w " * 50_000), (10, "w " * 50_000), (2, text), (11, "lone words here")]
    df = docs(spark, rows).selectExpr("*", "1 AS sig", "2 AS component", "3 AS key")
    out = minhash.drop_near_copies(df)
    assert out.columns == df.columns
    assert sorted((r["doc_id"] or 0) for r in out.collect()) == [0, 1, 3, 4, 5, 6, 7, 9, 11]
    assert minhash.drop_near_copies(df.limit(0)).count() == 0


def test_whole_buckets_are_searched():
    rng = np.random.default_rng(2)
    sig = rng.integers(0, 3, (60, 20)).astype(np.uint32)
    ids = np.arange(60)
    want = groups([(i, j) for i in range(60) for j in range(i) if (sig[i] == sig[j]).mean() >= 0.6], ids.tolist())
    got = groups(minhash.ties(ids, sig, 0.6), ids.tolist())
    assert got == want


def test_repeated_rows_and_ids(spark):
    """A row that repeats the least document, one doc_id with two texts, and ids that aren't numbers."""
    t = " ".join(f"word{i}" for i in range(60))
    u = " ".join(f"other{i}" for i in range(60))
    kept = lambda rows: sorted((r["doc_id"], r["text"][:1]) for r in minhash.drop_near_copies(docs(spark, rows)).collect())
    assert kept([(3, t), (7, t), (7, u)]) == [(3, "w"), (7, "o")]
    assert kept([(1, t), (1, t), (2, u)]) == [(1, "w"), (2, "o")]
    assert kept([(1, t), (1, t), (1, t + " more"), (5, u), (5, u), (6, "...")]) in ([(1, "w"), (5, "o"), (6, ".")],)
    names = spark.createDataFrame([("a", t), ("b", t), ("12", u), ("13", u)], "doc_id string, text string")
    assert sorted(r["doc_id"] for r in minhash.drop_near_copies(names).collect()) == ["12", "a", "b"]


def test_large_buckets_are_cut_in_blocks(spark, monkeypatch):
    """Near copies that are all unlike in their signatures, more than a block holds."""
    monkeypatch.setattr(minhash, "BLOCK_ROWS", 10)
    base = [f"word{i}" for i in range(80)]
    rows = [(i, " ".join([*base[:i], f"own{i}", *base[i + 1 :]])) for i in range(60)] + [(100, "a text that is like no other one")]
    assert sorted(r["doc_id"] for r in minhash.drop_near_copies(docs(spark, rows)).collect()) == [0, 100]
