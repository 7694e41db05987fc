"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Each source is put in a keyed random order and cut into blocks of ``block_docs`` documents (the last may be short).
Quotas: the largest number of blocks N for which every source s has its exact share w_s N (by largest remainders)
without repeating any block. Without given weights, targets are ``targets``: scarce sources are taken whole and don't
bound the others, which are drawn to weights that hold large sources back. The tree halves the range of output shards; at each node the left half's blocks of every
source are drawn by the multivariate hypergeometric law, and quotas stay exact at every level. A shard then draws its own
disjoint run of its sources' permuted blocks (a keyed Feistel network permutes them) and shuffles their documents locally.

Everything that looks at all documents carries (doc_id, source) and hashes only; the driver holds counts by source and
the top of the tree, whose lower levels the executors split.

Defined results: a null source is a source of its own, named '' in weights. A document is a doc_id with its source, or
where doc_id is null the text with its source; rows that repeat one are drawn together and stay in one shard. Sources without
a weight get none. Null, empty or very long texts are documents like others, and the texts of documents with an id aren't
looked at. Extra columns are carried along. An empty table gives an empty one.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakeloom.llm.common import forget, fresh, quoted, saved, ship

BLOCK_DOCS, SHARD_DOCS, BUCKET_DOCS = 16, 4096, 20_000
#: Weights, where none are given, are proportional to this power of a source's documents: large sources are held back.
FLATTEN = 0.7
#: Where no weights are given, a source is scarce that has less than SCARCE of the documents of the source in which, from the
#: smallest source on, the TAIL-th part of all documents lies.
TAIL, SCARCE = 0.05, 0.25
SEED = 11
BROADCAST_ROWS = 200_000
TOP_NODES = 256


def quotas(blocks: dict[str, int], weights: dict[str, float]) -> dict[str, int]:
    """Blocks of each source in the mix: shares of the largest total that needs no block twice."""
    live = {s: w for s, w in weights.items() if w > 0 and blocks.get(s, 0) > 0}
    if not live:
        return {}
    z = math.fsum(live.values())
    total = int(min(blocks[s] * z / w for s, w in live.items()) + 1e-9)
    exact = {s: total * w / z for s, w in live.items()}
    out = {s: min(int(x + 1e-9), blocks[s]) for s, x in exact.items()}
    for s in sorted(live, key=lambda s: (out[s] - exact[s], s)):
        if sum(out.values()) >= total:
            break
        if out[s] < blocks[s]:
            out[s] += 1
    return out


def targets(sizes: dict[str, int], block_docs: int) -> dict[str, int]:
    """Blocks of each source where no weights are given: scarce sources whole, the others by quotas of their flattened sizes."""
    blocks = {s: -(-k // block_docs) for s, k in sizes.items()}
    tail, before = 0, 0
    for k in sorted(sizes.values()):
        tail, before = k, before + k
        if before >= TAIL * sum(sizes.values()):
            break
    rest = {s: k for s, k in sizes.items() if k >= SCARCE * tail}
    return {s: b for s, b in blocks.items() if s not in rest} | quotas({s: blocks[s] for s in rest}, {s: k**FLATTEN for s, k in rest.items()})


def permuted(ranks: np.ndarray, n: int, key: int) -> np.ndarray:
    """A keyed permutation of 0 to n - 1: a Feistel network of six rounds, walked on where it leads out of the range."""
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    mask, out = np.uint64((1 << half) - 1), ranks.astype(np.uint64)
    at = np.arange(len(out))
    while len(at):
        low, high = out[at] & mask, out[at] >> np.uint64(half)
        for r in range(6):
            x = (low + np.uint64((key * 0x9E3779B97F4A7C15 + r * 0xD6E8FEB86659FD93) % (1 << 64))) * np.uint64(0xBF58476D1CE4E5B9)
            x = (x ^ (x >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
            low, high = high ^ ((x ^ (x >> np.uint64(29))) & mask), low
        out[at] = low | high << np.uint64(half)
        at = at[out[at] >= n]
    return out.astype(np.int64)


Node = tuple[int, int, list[int], list[int]]  # shards from a up to z, their blocks by source, and the blocks before them


def halves(node: Node, ends: Callable[[int], int], seed: int) -> tuple[Node, Node]:
    """The two children of a node of two shards or more; the left one's blocks are drawn."""
    a, z, have, low = node
    m = (a + z) // 2
    rng = np.random.default_rng([seed, a, z])  # a node's draw depends on nothing but its place
    take, left, want = [], sum(have), ends(m) - ends(a)
    for h in have:
        left -= h
        t = int(rng.hypergeometric(h, left, want)) if h and want and left else min(h, want)
        take.append(t)
        want -= t
    return (a, m, take, low), (m, z, [h - t for h, t in zip(have, take, strict=True)], [x + t for x, t in zip(low, take, strict=True)])


def leaves(node: Node, ends: Callable[[int], int], seed: int) -> Iterator[Node]:
    todo = [node]
    while todo:
        n = todo.pop()
        if n[1] - n[0] == 1:
            yield n
        else:
            todo += halves(n, ends, seed)


def split(quota: np.ndarray, shards: int, seed: int) -> np.ndarray:
    """Blocks by shard and source: the tree's leaves. Shard sizes differ by one block at most."""
    total = int(quota.sum())
    out = np.zeros((shards, len(quota)), np.int64)
    for a, _, have, _ in leaves((0, shards, quota.tolist(), [0] * len(quota)), lambda k: total * k // shards, seed):
        out[a] = have
    return out


def dealt_blocks(spark: SparkSession, names: list[str], blocks: list[int], quota: list[int], shards: int, seed: int) -> DataFrame:
    """(source, block, shard): the blocks that each shard has of each source, a run of them in their permuted order.

    The top of the tree is split here until there are TOP_NODES nodes; the executors go on from there.
    """
    total = sum(quota)
    ends = lambda k: total * k // shards
    todo: list[Node] = [(0, shards, quota, [0] * len(quota))]
    while len(todo) < TOP_NODES and any(z - a > 1 for a, z, _, _ in todo):
        todo = [c for n in todo for c in (halves(n, ends, seed) if n[1] - n[0] > 1 else (n,))]

    def grow(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for node in b.itertuples(index=False):
                for a, _, have, low in leaves((node.a, node.z, list(node.have), list(node.low)), ends, seed):
                    for s, (h, x) in enumerate(zip(have, low, strict=True)):
                        if h:
                            yield pd.DataFrame({"source": names[s], "block": permuted(np.arange(x, x + h), blocks[s], seed * 1_000_003 + s), "shard": a})

    nodes = spark.createDataFrame(todo, "a long, z long, have array<long>, low array<long>")
    return nodes.repartition(min(len(todo), spark.sparkContext.defaultParallelism), "a").mapInPandas(grow, "source string, block long, shard long")


def assignment(docs: DataFrame, weights: dict[str, float] | None = None, block_docs: int = BLOCK_DOCS, shard_docs: int = SHARD_DOCS, seed: int = SEED) -> DataFrame:
    """(doc_id, source, own, block, shard, position) of every document drawn; ``own`` tells those without doc_id apart."""
    spark = docs.sparkSession
    ship(spark)
    base = docs.select(F.col("doc_id").alias("doc_id"), *identity(docs)).distinct()
    base = saved(base.withColumn("h", F.xxhash64(F.lit(seed), "source", "doc_id", "own")), "mix-keys")
    n = base.count()
    bits = max(1, min(24, math.ceil(math.log2(max(2, n / BUCKET_DOCS)))))
    keyed = base.withColumn("bucket", F.shiftrightunsigned("h", 64 - bits).cast("int"))
    counts = keyed.groupBy("source", "bucket").count()
    # the documents before each bucket in its source's order: sources x buckets rows
    before = counts.withColumn("before", F.sum("count").over(Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))).select("source", "bucket", F.coalesce("before", F.lit(0)).alias("before"))
    sizes = {r["source"]: r["n"] for r in counts.groupBy("source").agg(F.sum("count").alias("n")).orderBy("source").collect()}
    blocks = {s: -(-k // block_docs) for s, k in sizes.items()}
    quota = quotas(blocks, weights) if weights is not None else targets(sizes, block_docs)
    names = sorted(quota)
    total = sum(quota.values())
    shards = max(1, -(-total * block_docs // shard_docs))
    side = lambda df, rows: F.broadcast(df) if rows <= BROADCAST_ROWS else df
    order = Window.partitionBy("source", "bucket").orderBy("h", "doc_id", "own")
    placed = keyed.join(side(before, len(names) << bits), ["source", "bucket"]).withColumn("block", F.floor((F.col("before") + F.row_number().over(order) - 1) / block_docs).cast("long"))
    # a row a block; documents meet their block by an equi-join
    runs = dealt_blocks(spark, names, [blocks[s] for s in names], [quota[s] for s in names], shards, seed)
    dealt = placed.join(side(runs, total), ["source", "block"])
    local = Window.partitionBy("shard").orderBy(F.xxhash64(F.lit(seed + 1), "h"), "doc_id", "source", "own")
    out = saved(dealt.withColumn("position", F.row_number().over(local)).select("doc_id", "source", "own", "block", "shard", "position"), "mix-assignment")
    forget(base)
    return out


def identity(docs: DataFrame) -> tuple[Column, Column]:
    """What tells the rows of ``docs`` apart besides doc_id: source, and a hash of the text where there is no doc_id."""
    return F.coalesce(docs["source"].cast("string"), F.lit("")).alias("source"), F.when(docs["doc_id"].isNull(), F.xxhash64(docs["text"])).alias("own")


def mix(docs: DataFrame, weights: dict[str, float] | None = None, **how: int) -> DataFrame:
    """The drawn rows of ``docs`` with block, shard and position in the shard (named with more _ in front where taken)."""
    a = assignment(docs, weights, **how)
    i, s, o, block, shard, position = fresh(docs, "mix_id", "mix_source", "mix_own", "block", "shard", "position")
    # most documents are drawn, so the assignment grows as they do: a join by doc_id, never a broadcast
    side = a.toDF(i, s, o, block, shard, position).hint("merge")
    source, own = identity(docs)
    return docs.join(side, docs["doc_id"].eqNullSafe(F.col(i)) & (source == F.col(s)) & own.eqNullSafe(F.col(o))).drop(quoted(i), quoted(s), quoted(o))


def drawn(docs: DataFrame, weights: dict[str, float] | None = None, **how: int) -> DataFrame:
    """The rows of ``docs`` that the mix draws, with the columns they came with: shards whole, in their order and shuffled."""
    mixed = mix(docs, weights, **how)
    shard, position = mixed.columns[-2:]
    return mixed.repartition(quoted(shard)).sortWithinPartitions(quoted(shard), quoted(position)).select(*map(quoted, docs.columns))


def write_shards(mixed: DataFrame, path: str) -> None:
    """Writes a mix as shards in their order: one shuffle by shard, then a local sort."""
    mixed.repartition("shard").sortWithinPartitions("shard", "position").write.partitionBy("shard").parquet(path)
