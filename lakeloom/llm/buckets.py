"""Buckets of ids that share a key, without a row for each (key, id) in the plan.

The executors turn their rows to (key, id) pairs of numbers and send them on as packed arrays, one row for each part that
the keys are cut in; a part is then sorted and searched as arrays. Most keys belong to one id only and end there. A key that
holds more than HOT ids is cut by the caller's ``cells``, which must put any two ids that matter to each other in one cell
at least, so no part and no bucket grows with the table for the sake of one key.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Pairs that a task packs at once; bytes that a part should have; ids by which a key is hot.
PACK, PART_BYTES, HOT = 2_000_000, 48 << 20, 4_000_000
PAIR = np.dtype([("low", np.uint32), ("mid", np.uint8), ("id", np.int64)])
#: One row in this many is read to find hot keys; it decides how a key is cut, never what is found.
LOOK = 64

Made = tuple[np.ndarray, np.ndarray]  # ids, and a row of unsigned 64-bit keys for each


def _parts_of(keys: np.ndarray, parts: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)


def _blobs(keys: np.ndarray, ids: np.ndarray, parts: int) -> pa.RecordBatch:
    to = _parts_of(keys, parts).astype(np.int32)
    order = np.argsort(to, kind="stable")
    pairs = np.empty(len(keys), PAIR)
    pairs["low"], pairs["mid"], pairs["id"] = keys[order] & np.uint64(0xFFFFFFFF), (keys[order] >> np.uint64(32)) & np.uint64(0xFF), ids[order]
    n = np.bincount(to, minlength=parts)
    used = np.flatnonzero(n)
    ends = np.cumsum(n[used])
    raw = pairs.tobytes()
    blobs = [raw[(z - k) * PAIR.itemsize : z * PAIR.itemsize] for z, k in zip(ends.tolist(), n[used].tolist(), strict=True)]
    return pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(blobs, pa.binary())], ["part", "pairs"])


Refine = Callable[[np.ndarray, np.ndarray], np.ndarray]


def grouped(keys: np.ndarray, ids: np.ndarray, refine: Refine | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, id) of all keys with several ids, sorted; a bucket's number is a hash of its members, equal sets count once.

    ``refine(starts, ids)`` numbers the parts of each bucket that are looked at apart, where members of a key don't all matter
    to each other.
    """
    bits = max(10, int(len(keys)).bit_length() + 2)
    slot = ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.int64)
    some = np.bincount(slot, minlength=1 << bits)[slot] > 1  # a slot of one pair is a key of one pair
    keys, ids = keys[some], ids[some]
    order = np.lexsort((ids, keys))
    keys, ids = keys[order], ids[order]
    once = np.ones(len(keys), bool)
    once[1:] = (keys[1:] != keys[:-1]) | (ids[1:] != ids[:-1])
    keys, ids = keys[once], ids[once]
    if not len(keys):
        return np.zeros(0, np.int64), ids
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    n = np.diff(np.append(starts, len(keys)))
    if refine is not None:
        some = np.repeat(n > 1, n)
        keys, ids = keys[some], ids[some]
        if not len(keys):
            return np.zeros(0, np.int64), ids
        starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        part = refine(starts, ids)
        order = np.lexsort((ids, part, keys))
        keys, ids, part = keys[order], ids[order], part[order]
        starts = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]) | (part[1:] != part[:-1])]))
        n = np.diff(np.append(starts, len(keys)))
    x = ids.view(np.uint64) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    name = np.add.reduceat(x ^ (x >> np.uint64(29)), starts) + n.astype(np.uint64)
    first = np.zeros(len(starts), bool)
    first[np.unique(name, return_index=True)[1]] = True
    take = np.repeat((n > 1) & first, n)
    return np.repeat(name, n)[take].view(np.int64), ids[take]


def hot_keys(rows: DataFrame, make: Callable[[pa.RecordBatch], Made]) -> np.ndarray:
    """Keys that hold about HOT ids or more, by a look at one row in LOOK; so many at most as HOT goes into all pairs."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                k, n = np.unique(make(b)[1].ravel(), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(k.view(np.int64)[n > 1]), pa.array(n[n > 1])], ["key", "n"])

    seen = rows.sample(1 / LOOK, 1).mapInArrow(look, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") >= HOT // LOOK)
    return np.array(sorted(r["key"] for r in seen.select("key").collect()), np.int64).view(np.uint64)


def buckets(rows: DataFrame, make: Callable[[pa.RecordBatch], Made], width: int, cells: Callable[[pa.RecordBatch, np.ndarray], np.ndarray] | None = None, refine: Refine | None = None) -> DataFrame:
    """(bucket, id) of the ids that share a key with others.

    ``make`` gives ids and ``width`` keys of each row of a batch (key 0 is none); ``cells(batch, row)`` gives the cells, a
    row of numbers each, that hot keys of the rows are cut in. A set of ids comes once for each part that it is found in.
    """
    spark = rows.sparkSession
    n = rows.count()
    parts = max(spark.sparkContext.defaultParallelism, -(-n * width * PAIR.itemsize // PART_BYTES))
    hot = hot_keys(rows, make) if cells is not None and n > HOT else np.zeros(0, np.uint64)
    shared = spark.sparkContext.broadcast(hot)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot = shared.value
        held: list[Made] = []
        size = 0
        for b in batches:
            if not b.num_rows:
                continue
            ids, keys = make(b)
            at = np.repeat(np.arange(len(ids)), keys.shape[1])
            keys = keys.ravel()
            at, keys = at[keys != 0], keys[keys != 0]
            if len(hot):
                is_hot = np.isin(keys, hot)
                if is_hot.any():
                    into = cells(b, at[is_hot]).astype(np.uint64)
                    x = (keys[is_hot][:, None] ^ (into + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xBF58476D1CE4E5B9)
                    x ^= x >> np.uint64(29)
                    more = np.repeat(at[is_hot], into.shape[1])
                    at, keys = np.concatenate([at[~is_hot], more]), np.concatenate([keys[~is_hot], x.ravel()])
            held.append((keys, ids[at]))
            size += len(keys)
            if size >= PACK:
                yield _blobs(*map(np.concatenate, zip(*held, strict=True)), parts)
                held, size = [], 0
        if size:
            yield _blobs(*map(np.concatenate, zip(*held, strict=True)), parts)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_part: dict[int, list[bytes]] = {}
        for b in batches:
            for p, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                by_part.setdefault(p, []).append(x)
        for p in sorted(by_part):
            pairs = np.frombuffer(b"".join(by_part.pop(p)), PAIR)
            name, ids = grouped(pairs["low"].astype(np.uint64) | pairs["mid"].astype(np.uint64) << np.uint64(32), pairs["id"].astype(np.int64), refine)
            for a in range(0, len(ids), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(name[a : a + 100_000]), pa.array(ids[a : a + 100_000])], ["bucket", "id"])

    packed = rows.mapInArrow(pack, "part int, pairs binary").repartitionById(parts, F.col("part"))
    return packed.mapInArrow(search, "bucket long, id long")


def in_blocks(members: DataFrame, rows: int) -> DataFrame:
    """(bucket, id) again, large buckets replaced by one for each two of their blocks of ``rows`` members."""
    large = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > rows)
    large = large.select("bucket", F.ceil(F.col("n") / rows).alias("blocks"))  # a row for so many members at most
    met = members.join(large, "bucket", "left").withColumn("own", F.coalesce(F.pmod(F.xxhash64("id"), "blocks"), F.lit(0)))
    cut = met.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("blocks", F.lit(1)) - 1)).alias("other"))
    return cut.select(F.when(F.col("blocks").isNull(), F.col("bucket")).otherwise(F.xxhash64("bucket", F.least("own", "other"), F.greatest("own", "other"))).alias("bucket"), "id")


def whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows again, cut so that no group (equal first column, sorted) goes over an end."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        b = batch.column(0).to_numpy()
        cut = int(np.searchsorted(b, b[-1]))
        if cut or (held and held[-1].column(0)[-1].as_py() != b[0]):
            yield pa.Table.from_batches([*held, batch.slice(0, cut)]).combine_chunks()
            held = []
        held.append(batch.slice(cut))
    if held:
        yield pa.Table.from_batches(held).combine_chunks()
