"""Near-duplicate embeddings by iterative quantisation and multi-index Hamming tables.

Vectors are scaled to length 1 and centred; principal directions come from the covariance of all of them. A rotation is
learned by alternating signs B = sign(V R) with R from the singular vectors of B'V, the sums of which every round takes
over all vectors, part by part. The signs of V R are codes of up to BITS bits, balanced by the centring. Codes are cut in
TABLES substrings; each code enters each table under its substring and under all that differ in one bit, so two that
differ by up to two bits there meet: any pair within Hamming distance 3 * TABLES - 1 is met, and more by chance. A bucket of
codes falls apart in those that a chain of distances up to NEAR bits joins: at a cosine of THRESHOLD a pair of 63 bits differs
in 6.4 on average, and in more than NEAR once in a thousand times. The vectors of codes that are left together, and those of one
code, are compared by their original coordinates, and those of cosine THRESHOLD or more are tied. Within a bucket a
breadth-first search compares every member with those not yet reached: no cap, and about one comparison each in a dense
group; of a bucket of more than BLOCK_ROWS each two blocks are searched by a task of their own. Equal vectors are tied first
and one stands for them. Components of the ties are the groups; the least vec_id of a group stays.

Defined results: null vectors, those with a null or non-finite coordinate, of zero length, or of another dimension than
most (the greater of two as frequent), are alone. Null ids, and ids that aren't whole numbers, are alone. Rows that repeat a vec_id are one vertex: if their
vectors agree they count once, else each can tie it. Extra columns don't matter. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.buckets import buckets, in_blocks, whole_groups
from lakeloom.llm.common import made, saved, ship, sweep
from lakeloom.llm.components import components

BITS, TABLES, ROUNDS, THRESHOLD, SEED, NEAR = 63, 3, 12, 0.95, 3, 15
#: Vectors of a bucket that one task compares.
BLOCK_ROWS = 50_000


def _matrix(batch: pa.RecordBatch, dim: int, column: int = 1) -> np.ndarray:
    x = batch.column(column).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _summed(vectors: DataFrame, dim: int, size: int, per_batch) -> np.ndarray:
    """The sum over all vectors of an array of ``size`` numbers, made a batch at a time and added up in Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for b in batches:
            if b.num_rows:
                total += per_batch(_matrix(b, dim)).ravel()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size), pa.int32()), pa.array(total)], ["i", "x"])

    got = vectors.mapInArrow(run, "i int, x double").groupBy("i").agg(F.sum("x").alias("x")).orderBy("i").toArrow()
    return got["x"].to_numpy() if got.num_rows else np.zeros(size)


def usable(vectors: DataFrame) -> tuple[DataFrame, int]:
    """(vec_id, embedding) of the vectors that can be compared, and their dimension."""
    kind = vectors.schema["embedding"].dataType.simpleString()
    kind = kind if kind == "array<float>" else "array<double>"  # floats are kept as they are: half the bytes
    rows = vectors.select(F.col("vec_id").try_cast("long").alias("vec_id"), F.col("embedding").cast(kind).alias("embedding"))
    fine = F.expr("forall(embedding, x -> x is not null and not isnan(x) and abs(cast(x as double)) < 1e150) and exists(embedding, x -> abs(cast(x as double)) > 1e-150)")
    rows = rows.where("vec_id is not null and embedding is not null").where(fine)
    most = rows.groupBy(F.size("embedding").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    dim = most["dim"] if most else 1
    return rows.where(F.size("embedding") == dim).distinct(), dim


def learn(vectors: DataFrame, dim: int, bits: int = BITS, rounds: int = ROUNDS, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """The mean and the projection whose signs are the codes."""
    n = max(vectors.count(), 1)
    both = _summed(vectors, dim, dim * dim + dim, lambda x: np.concatenate([x.sum(0), (x.T @ x).ravel()]))
    mean = both[:dim] / n
    cov = both[dim:].reshape(dim, dim) / n - np.outer(mean, mean)
    bits = min(bits, dim)
    values, directions = np.linalg.eigh(cov)
    w = directions[:, np.argsort(-values)[:bits]]
    w *= np.where(w[np.abs(w).argmax(0), np.arange(bits)] < 0, -1, 1)
    r, _ = np.linalg.qr(np.random.default_rng(seed).normal(size=(bits, bits)))
    for _ in range(rounds):

        def meet(x: np.ndarray, r: np.ndarray = r) -> np.ndarray:
            v = (x - mean) @ w
            return np.where(v @ r >= 0, 1.0, -1.0).T @ v

        s, _, t = np.linalg.svd(_summed(vectors, dim, bits * bits, meet).reshape(bits, bits))
        r = (s @ t).T
    return mean, w @ r


def codes(x: np.ndarray, mean: np.ndarray, projection: np.ndarray) -> np.ndarray:
    """Bits, a row a vector."""
    return (x - mean) @ projection >= 0


def packed_codes(bits: np.ndarray) -> np.ndarray:
    return bits @ (np.int64(1) << np.arange(bits.shape[1], dtype=np.int64))


def table_keys(codes: np.ndarray, bits: int, tables: int = TABLES) -> np.ndarray:
    """For each code its keys: in every table its substring and those with one bit turned."""
    out = []
    for k, part in enumerate(np.array_split(np.arange(bits), tables)):
        if not len(part):
            continue
        own = codes >> np.int64(part[0]) & np.int64((1 << len(part)) - 1)
        every = np.concatenate([own[:, None], own[:, None] ^ np.int64(1) << np.arange(len(part), dtype=np.int64)], 1).astype(np.uint64)
        x = (every * np.uint64(tables) + np.uint64(k + 1)) * np.uint64(0x9E3779B97F4A7C15)
        out.append((x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93))
    return np.concatenate(out, 1)


def hamming_parts(near: int):
    """Numbers the parts of each bucket of codes that chains of distances up to ``near`` join."""

    def refine(starts: np.ndarray, codes: np.ndarray) -> np.ndarray:
        part = np.arange(len(codes))
        n = np.diff(np.append(starts, len(codes)))
        two = starts[n == 2]
        close = np.bitwise_count(codes[two] ^ codes[two + 1]) <= near
        part[two[close] + 1] = two[close]
        for a, k in zip(starts[n > 2].tolist(), n[n > 2].tolist(), strict=True):
            rest = np.arange(a, a + k)
            while len(rest):
                first, frontier, rest = rest[0], [rest[0]], rest[1:]
                while frontier and len(rest):
                    hit = np.bitwise_count(codes[rest] ^ codes[frontier.pop()]) <= near
                    part[rest[hit]] = first
                    frontier += rest[hit].tolist()
                    rest = rest[~hit]
        return part

    return refine


def ties(ids: np.ndarray, x: np.ndarray, threshold: float) -> list[tuple[int, int]]:
    """Edges that join the members of a bucket wherever their cosine reaches the threshold."""
    rest, out = np.arange(len(ids)), []
    while len(rest):
        frontier, rest = [rest[0]], rest[1:]
        while frontier and len(rest):
            at = frontier.pop()
            near = x[rest] @ x[at] >= threshold - 1e-12
            out += [(int(ids[at]), int(ids[j])) for j in rest[near]]
            frontier += rest[near].tolist()
            rest = rest[~near]
    return out


def near_groups(vectors: DataFrame, threshold: float = THRESHOLD, bits: int = BITS, tables: int = TABLES, rounds: int = ROUNDS) -> DataFrame:
    """(vec_id, component) of the vectors that aren't alone."""
    spark = vectors.sparkSession
    ship(spark)
    before = made()
    rows, dim = usable(vectors)
    rows = saved(rows, "itq-vectors")
    bits = min(bits, dim)
    shared = spark.sparkContext.broadcast(learn(rows, dim, bits, rounds))

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mean, projection = shared.value
        for b in batches:
            if b.num_rows:
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(packed_codes(codes(_matrix(b, dim), mean, projection)), pa.int64())], ["vec_id", "embedding", "code"])

    # equal vectors: the least stands for all, whatever their number
    alike = (F.xxhash64("embedding").alias("k1"), F.xxhash64(F.lit(7), "embedding").alias("k2"))
    reps = rows.select("vec_id", *alike).groupBy("k1", "k2").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    same = saved(rows.select("vec_id", *alike).join(reps, ["k1", "k2"]).where("vec_id <> rep").select("vec_id", "rep", "k1", "k2"), "itq-alike")
    one = rows.select("vec_id", "embedding", *alike).join(same.select("vec_id", "k1", "k2"), ["vec_id", "k1", "k2"], "left_anti").select("vec_id", "embedding")
    coded = saved(one.mapInArrow(code, f"vec_id long, embedding {rows.schema['embedding'].dataType.simpleString()}, code long"), "itq-codes")
    distinct = coded.groupBy("code").agg(F.count(F.lit(1)).alias("n"))

    def keys(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        c = batch.column(0).to_numpy()
        return c, table_keys(c, bits, tables)

    met = buckets(distinct.select("code"), keys, bits + tables, refine=hamming_parts(NEAR)).distinct()
    several = distinct.where("n > 1").select(F.xxhash64(F.lit("code"), "code").alias("bucket"), F.col("code").alias("id"))
    pairs = met.unionByName(several).join(coded.select("code", "vec_id"), F.col("id") == F.col("code")).select("bucket", F.col("vec_id").alias("id"))
    pairs = saved(pairs, "itq-buckets")
    beside = in_blocks(pairs, BLOCK_ROWS).withColumnRenamed("id", "vec_id").join(coded.select("vec_id", "embedding"), "vec_id").select("bucket", "vec_id", "embedding")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in whole_groups(batches):
            if not part.num_rows:
                continue
            b, ids = part["bucket"].to_numpy(), part["vec_id"].to_numpy()
            x = np.concatenate([_matrix(p, dim, 2) for p in part.to_batches()])
            ends = np.append(np.flatnonzero(b[1:] != b[:-1]) + 1, len(b))
            a, found = 0, []
            for z in ends.tolist():
                found += ties(ids[a:z], x[a:z], threshold)
                a = z
            if found:
                yield pa.RecordBatch.from_arrays(list(map(pa.array, np.array(found, np.int64).T)), ["u", "v"])

    edges = beside.repartition("bucket").sortWithinPartitions("bucket", "vec_id").mapInArrow(verify, "u long, v long")
    tied = edges.unionByName(same.select(F.col("vec_id").alias("u"), F.col("rep").alias("v")))
    out = saved(components(tied).select(F.col("node").alias("vec_id"), "component"), "itq-groups")
    sweep(spark, before, out)
    return out


def near_dedup(vectors: DataFrame, threshold: float = THRESHOLD, **how: int) -> DataFrame:
    """(vec_id, keeper) of every vector; it stays if it is its own keeper. Null ids have a null keeper and stay."""
    groups = near_groups(vectors, threshold, **how).withColumnRenamed("vec_id", "node")
    met = vectors.select(F.col("vec_id").try_cast("long").alias("vec_id")).join(groups, F.col("vec_id") == F.col("node"), "left")
    return met.select("vec_id", F.coalesce("component", "vec_id").alias("keeper"), F.coalesce(F.col("vec_id") == F.col("component"), F.lit(True)).alias("kept"))
