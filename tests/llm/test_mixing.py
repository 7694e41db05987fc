from __future__ import annotations

from collections import Counter

import numpy as np

from lakeloom.llm import mixing, queries
from tests.conftest import SF
from tests.llm.helpers import docs


def test_quotas_are_exact_and_as_large_as_can_be():
    assert mixing.quotas({"a": 100, "b": 10}, {"a": 0.5, "b": 0.5}) == {"a": 10, "b": 10}
    q = mixing.quotas({"a": 1000, "b": 333, "c": 50}, {"a": 0.6, "b": 0.3, "c": 0.1})
    total = sum(q.values())
    assert total == 500 and all(abs(q[s] - w * total) < 1 for s, w in {"a": 0.6, "b": 0.3, "c": 0.1}.items())
    assert mixing.quotas({"a": 3}, {"b": 1.0}) == mixing.quotas({}, {}) == {}


def test_tree_keeps_quotas_and_follows_the_law():
    quota = np.array([30, 7, 63])
    leaves = mixing.split(quota, 8, 1)
    assert (leaves.sum(0) == quota).all() and leaves.sum(1).max() - leaves.sum(1).min() <= 1 and leaves.min() >= 0
    # the share of a source in the first shard is hypergeometric: mean and variance
    first = np.array([mixing.split(quota, 8, s)[0][0] for s in range(3000)])
    n = int(leaves[0].sum())
    mean, var = n * 0.3, n * 0.3 * 0.7 * (100 - n) / 99
    assert abs(first.mean() - mean) < 4 * (var / 3000) ** 0.5
    assert abs(first.var() / var - 1) < 0.15


def test_drawn_blocks_are_disjoint_and_in_proportion(spark):
    rows = [(i, f"t{i}", "abc"[min(i % 6, 2)]) for i in range(3000)]
    weights = {"a": 0.25, "b": 0.25, "c": 0.5}
    got = mixing.mix(docs(spark, rows), weights, block_docs=8, shard_docs=256).collect()
    assert len({r["doc_id"] for r in got}) == len(got)
    blocks = {(r["source"], r["block"]): r["shard"] for r in got}
    assert all(blocks[r["source"], r["block"]] == r["shard"] for r in got)  # a block is in one shard
    n = Counter(s for s, _ in blocks)
    total = sum(n.values())
    assert all(abs(n[s] - w * total) <= 1 for s, w in weights.items())
    sizes = Counter(blocks.values())
    assert max(sizes.values()) - min(sizes.values()) <= 1
    for k in sizes:
        assert sorted(r["position"] for r in got if r["shard"] == k) == list(range(1, sum(r["shard"] == k for r in got) + 1))


def test_whole_table(spark):
    """The query against the same law worked out in Python: quotas of blocks by source."""
    table = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = queries.op6_mixing(spark, SF).collect()
    sizes = Counter(r["source"] for r in table)
    want = mixing.quotas({s: -(-n // mixing.BLOCK_DOCS) for s, n in sizes.items()}, {s: n**mixing.FLATTEN for s, n in sizes.items()})
    assert Counter(s for s, _ in {(r["source"], r["block"]) for r in got}) == {s: n for s, n in want.items() if n}
    assert {(r["doc_id"], r["text"]) for r in got} <= {(r["doc_id"], r["text"]) for r in table}


def test_tiny_sources_do_not_bound_the_mix(spark):
    """One tiny and one null source beside a hot one: both are whole, and the others are drawn as without them."""
    many = {"hot": 5_000_000} | {f"s{i}": 250_000 for i in range(19)}
    alone, beside = mixing.targets(many, 16), mixing.targets(many | {"tiny": 16, "": 3} | {f"t{i}": 5 for i in range(300)}, 16)
    assert {s: beside[s] for s in many} == alone and 0.69 < sum(alone.values()) * 16 / 9_750_000 < 0.71
    assert beside["tiny"] == beside[""] == beside["t7"] == 1
    rows = [(i, f"t{i}", "hot") for i in range(4000)] + [(10_000 + i, "x", f"s{i % 4}") for i in range(1600)] + [(20_000 + i, "y", "tiny") for i in range(3)] + [(30_000 + i, "z", None) for i in range(2)]
    got = Counter(r["source"] for r in mixing.drawn(docs(spark, rows)).collect())
    assert got["tiny"] == 3 and got[None] == 2 and all(got[f"s{i}"] == 400 for i in range(4))
    assert abs(got["hot"] - 400 * 10**0.7) <= 16


def test_defined_results(spark):
    rows = [(1, None, None), (2, "", None), (3, "x", "s"), (3, "x", "s"), (None, "y", "s"), (4, "w " * 50_000, "s"), (5, "q", None)]
    df = docs(spark, rows).selectExpr("*", "1 AS block", "2 AS shard", "3 AS mix_id", "4 AS h")
    out = mixing.mix(df)
    assert len(out.columns) == len({c.lower() for c in out.columns}) == len(df.columns) + 3
    assert sorted(r["doc_id"] or 0 for r in out.collect()) == [0, 1, 2, 3, 3, 4, 5]
    assert sorted(r["doc_id"] or 0 for r in mixing.drawn(df).collect()) == [0, 1, 2, 3, 3, 4, 5]
    assert mixing.drawn(df).columns == df.columns
    assert mixing.mix(df.limit(0)).count() == 0
    assert mixing.mix(df, {"nowhere": 1.0}).count() == 0
    assert sorted(r["doc_id"] for r in mixing.mix(df, {"": 1.0}).collect()) == [1, 2, 5]


def test_blocks_are_permuted():
    for n in (1, 2, 3, 7, 64, 1000, 4097):
        assert sorted(mixing.permuted(np.arange(n), n, 5).tolist()) == list(range(n))
    seen = Counter(tuple(mixing.permuted(np.arange(4), 4, k).tolist()) for k in range(2400))
    assert len(seen) == 24 and min(seen.values()) > 40  # all orders come, none rarely


def test_shards_hold_what_the_tree_deals(spark):
    """Quotas by plain arithmetic, and the blocks of every shard and source against the leaves of the tree."""
    rows = [(i, f"t{i}", "abc"[min(i % 6, 2)]) for i in range(3000)]
    weights = {"a": 0.2, "b": 0.3, "c": 0.5}
    got = mixing.mix(docs(spark, rows), weights, block_docs=10, shard_docs=100).collect()
    have = {"a": 50, "b": 50, "c": 200}
    total = max(t for t in range(301) if all(t * w <= have[s] + 1e-9 for s, w in weights.items()))
    blocks = Counter((r["shard"], r["source"]) for r in {(r["shard"], r["source"], r["block"]): r for r in got}.values())
    by_source = Counter()
    for (_, s), n in blocks.items():
        by_source[s] += n
    assert all(abs(by_source[s] - total * w) < 1 for s, w in weights.items()) and sum(by_source.values()) == total
    leaves = mixing.split(np.array([by_source[s] for s in "abc"]), len({k for k, _ in blocks}), mixing.SEED)
    assert all(blocks.get((k, s), 0) == leaves[k][j] for k in range(len(leaves)) for j, s in enumerate("abc"))


def test_drawn_rows_lie_in_shards(spark):
    df = docs(spark, [(i, f"t{i}", "s") for i in range(600)])
    mixed = {r["doc_id"]: (r["shard"], r["position"]) for r in mixing.mix(df, {"s": 1.0}, shard_docs=100).collect()}
    parts = mixing.drawn(df, {"s": 1.0}, shard_docs=100).rdd.glom().collect()
    assert sorted(r["doc_id"] for p in parts for r in p) == sorted(mixed)
    for p in parts:
        assert [mixed[r["doc_id"]] for r in p] == sorted(mixed[r["doc_id"]] for r in p)
    assert all(len({k for k, p in enumerate(parts) for r in p if mixed[r["doc_id"]][0] == s}) == 1 for s in {s for s, _ in mixed.values()})
