"""Near-duplicate documents by MinHash.

Words are lower-cased runs of letters and digits; a document is the set of its runs of three words (of all its words, if
it has fewer). PERMUTATIONS universal hashes, (a x + b) mod 2^64 with odd a and the upper half kept, give the signature of
minima; BANDS bands of ROWS minima give candidates; those whose signatures agree in a share of THRESHOLD or more are tied,
and components of the ties, by alternating large-star and small-star, are the groups. The least doc_id of a group stays.

Documents of one signature are tied first and stand for one, so a bucket holds different signatures only. Within a bucket of
a band all members are compared with the members not yet reached (a breadth-first search), so every tie that can join
components is found, with no cap, and a group of near copies costs about one comparison each. Of a bucket of more than
BLOCK_ROWS members each two blocks are searched by a task of their own.

At Jaccard similarity 0.5 a pair shares a band with probability 0.92, at 0.6 with 0.996.

Defined results: null texts and texts without words have no signature and always stay. Rows without doc_id, or with one that
isn't a whole number, always stay. A document is a doc_id with its text: rows that repeat both are one document, of which one
row stays at most (the least by a hash of all columns); texts of one doc_id are told apart by a hash, are as like or unlike
as those of others, and go alone; among them the lesser hash is first. Texts are taken whole, very long ones too. Extra
columns are carried along. An empty table gives an empty one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakeloom.llm.buckets import buckets, in_blocks, whole_groups
from lakeloom.llm.common import cache, claim, forget, fresh, made, quoted, saved, ship, sweep
from lakeloom.llm.components import components
from lakeloom.llm.spm import REMEMBERED, steps

SHINGLE, BANDS, ROWS = 3, 40, 4
PERMUTATIONS = BANDS * ROWS
THRESHOLD = 0.47
#: Up to so many ids of dropped documents are sent to all executors; more are joined by a shuffle.
BROADCAST_IDS = 500_000
#: Shingles hashed at once: they stay in a core's cache.
BLOCK = 1 << 15
#: Members of a bucket, with their signatures, that one task searches.
BLOCK_ROWS = 50_000

_rng = np.random.default_rng(20240229)
A = _rng.integers(1, 1 << 63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
B = _rng.integers(0, 1 << 63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2)
MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)
_WORD = re.compile(r"\w+")
_hashes: dict[str, int] = cache("minhash", {})


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def shingles(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles, text after text, and how many each text has."""
    words: list[str] = []
    ends = []
    for t in texts:
        words += _WORD.findall(t.lower())
        ends.append(len(words))
    if len(_hashes) > REMEMBERED:
        _hashes.clear()
    for w in set(words) - _hashes.keys():
        _hashes[w] = xxhash.xxh64_intdigest(w)
    h = np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))
    n = np.diff(ends, prepend=0)
    # each word begins a shingle; those that would leave the text are dropped, unless the text is all one shingle
    left = np.repeat(np.array(ends), n) - np.arange(len(h))
    x = h * MIX[0]
    for j in range(1, SHINGLE):
        x[:-j] += np.where(left[:-j] > j, h[j:] * MIX[j], np.uint64(0))
    first = left == np.repeat(n, n)
    return _mixed(x[(left >= SHINGLE) | first]), np.where(n > 0, np.maximum(n - SHINGLE + 1, 1), 0)


def signatures(x: np.ndarray, n: np.ndarray) -> np.ndarray:
    """A row of minima (upper halves) for each text that has shingles."""
    n = n[n > 0]
    out = np.empty((len(n), PERMUTATIONS), np.uint32)
    ends = np.cumsum(n)
    a = 0
    while a < len(n):
        start = int(ends[a] - n[a])
        z = max(a + 1, int(np.searchsorted(ends, start + BLOCK, "right")))
        part, at = x[start : int(ends[z - 1])], (ends[a:z] - n[a:z] - start)
        v = np.empty_like(part)
        for k in range(PERMUTATIONS):
            np.multiply(part, A[k], out=v)
            np.add(v, B[k], out=v)
            out[a:z, k] = np.minimum.reduceat(v, at) >> np.uint64(32)
        a = z
    return out


def band_keys(sig: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band of each signature; the band's number goes into it."""
    s = sig.reshape(len(sig), BANDS, ROWS).astype(np.uint64)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64) * MIX[1], s.shape[:2]).copy()
    for j in range(ROWS):
        key = _mixed(key * MIX[0] + s[:, :, j])
    return key.view(np.int64)


def signed(docs: DataFrame) -> DataFrame:
    """(doc_id, tk, sig, keys) of the documents that have words and an id; tk is a hash of the text."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("minhash")
        for part, texts in steps(batches, 2):
            x, n = shingles(texts)
            sig = signatures(x, n)
            raw, width = sig.tobytes(), 4 * PERMUTATIONS
            keys = band_keys(sig)
            some = pa.array(n > 0)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0).filter(some),
                    part.column(1).filter(some),
                    pa.Array.from_buffers(pa.binary(), len(sig), [None, pa.array(np.arange(len(sig) + 1) * width, pa.int32()).buffers()[1], pa.py_buffer(raw)]),
                    pa.ListArray.from_arrays(pa.array(np.arange(len(sig) + 1) * BANDS, pa.int32()), pa.array(keys.ravel())),
                ],
                ["doc_id", "tk", "sig", "keys"],
            )

    rows = docs.select(F.col("doc_id").try_cast("long").alias("doc_id"), F.xxhash64("text").alias("tk"), F.col("text").cast("string").alias("text"))
    return rows.where("doc_id is not null and text is not null").mapInArrow(run, "doc_id long, tk long, sig binary, keys array<long>")


def keys_of(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return batch.column(0).to_numpy(), batch.column(1).flatten().to_numpy().reshape(-1, BANDS).view(np.uint64)


def ties(ids: np.ndarray, sig: np.ndarray, threshold: float) -> list[tuple[int, int]]:
    """Edges that join the members of a bucket wherever signatures agree enough: a spanning forest of all such pairs."""
    least = int(np.ceil(threshold * sig.shape[1] - 1e-9))
    rest = np.arange(len(ids))
    out = []
    while len(rest):
        frontier, rest = [rest[0]], rest[1:]
        while frontier and len(rest):
            at = frontier.pop()
            near = (sig[rest] == sig[at]).sum(1) >= least
            hit = rest[near]
            out += [(int(ids[at]), int(ids[j])) for j in hit]
            frontier += hit.tolist()
            rest = rest[~near]
    return out


def _verify(threshold: float):
    edge = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def flush(ids: np.ndarray, sig: np.ndarray, n: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        least = int(np.ceil(threshold * PERMUTATIONS - 1e-9))
        at = np.cumsum(n) - n
        two = at[n == 2]
        ok = (sig[two] == sig[two + 1]).sum(1) >= least
        yield ids[two][ok], ids[two + 1][ok]
        for a, k in zip(at[n > 2].tolist(), n[n > 2].tolist(), strict=True):
            e = ties(ids[a : a + k], sig[a : a + k], threshold)
            yield np.array([u for u, _ in e], np.int64), np.array([v for _, v in e], np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in whole_groups(batches):
            if not part.num_rows:
                continue
            b = part["bucket"].to_numpy()
            ids = part["doc_id"].to_numpy()
            sig = np.frombuffer(b"".join(part["sig"].to_pylist()), np.uint32).reshape(-1, PERMUTATIONS)
            starts = np.flatnonzero(np.concatenate([[True], b[1:] != b[:-1]]))
            for u, v in flush(ids, sig, np.diff(np.append(starts, len(b)))):
                if len(u):
                    yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], schema=edge)

    return run


def members(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, tk, keep_id, keep_tk) of the documents in groups of several, a row for each row of ``docs``; the least stays."""
    before = made()
    sigs = saved(signed(docs).select(F.monotonically_increasing_id().alias("node"), "doc_id", "tk", "sig", "keys", F.xxhash64("sig").alias("k1"), F.xxhash64(F.lit(7), "sig").alias("k2")), "minhash-signatures")
    one = F.struct("doc_id", "tk", "node")
    reps = sigs.groupBy("k1", "k2").agg(F.min(one).alias("rep"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    same = sigs.select("node", "doc_id", "tk", "k1", "k2").join(reps, ["k1", "k2"]).where("node <> rep.node")
    same = saved(same.select("node", "doc_id", "tk", F.col("rep.node").alias("rep"), F.col("rep.doc_id").alias("rep_id"), F.col("rep.tk").alias("rep_tk")), "minhash-alike")
    met = saved(buckets(sigs.select("node", "keys").join(same.select("node"), "node", "left_anti"), keys_of, BANDS).distinct(), "minhash-buckets")
    # both sides grow with the documents: a merge at every size
    beside = in_blocks(met, BLOCK_ROWS).join(sigs.select(F.col("node").alias("id"), "sig").hint("merge"), "id").repartition("bucket").sortWithinPartitions("bucket", "id").select("bucket", F.col("id").alias("doc_id"), "sig")
    found = components(beside.mapInArrow(_verify(threshold), "u long, v long"))
    tied = found.join(sigs.select("node", "doc_id", "tk"), "node")
    least = tied.groupBy("component").agg(F.min(F.struct("doc_id", "tk")).alias("keep"))
    tied = saved(tied.join(least, "component").select("node", "doc_id", "tk", F.col("keep.doc_id").alias("keep_id"), F.col("keep.tk").alias("keep_tk")), "minhash-tied")
    # those alike follow the one that stands for them, which may be alone with them
    keep = tied.select(F.col("node").alias("rep"), "keep_id", "keep_tk")
    rest = same.join(keep, "rep", "left").select("doc_id", "tk", F.coalesce("keep_id", "rep_id").alias("keep_id"), F.coalesce("keep_tk", "rep_tk").alias("keep_tk"))
    heads = same.select("rep", "rep_id", "rep_tk").distinct().join(keep, "rep", "left_anti").select(F.col("rep_id").alias("doc_id"), F.col("rep_tk").alias("tk"), F.col("rep_id").alias("keep_id"), F.col("rep_tk").alias("keep_tk"))
    out = saved(tied.drop("node").unionByName(rest).unionByName(heads), "minhash-groups")
    sweep(docs.sparkSession, before, out)
    return out


def groups(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, component) of the documents that aren't alone; the component is its least doc_id."""
    return members(docs, threshold).select("doc_id", F.col("keep_id").alias("component")).distinct()


def drop_near_copies(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without all but the least document of each group; of rows with one doc_id and one text one stays."""
    every = members(docs, threshold)
    i, k, row = fresh(docs, "near_id", "near_tk", "near_row")
    lost = saved(every.where("doc_id <> keep_id or tk <> keep_tk").select(F.col("doc_id").alias(i), F.col("tk").alias(k)).distinct(), "minhash-dropped")
    again = saved(every.where("doc_id = keep_id and tk = keep_tk").groupBy(F.col("doc_id").alias(i), F.col("tk").alias(k)).count().where("count > 1").drop("count"), "minhash-repeated")
    forget(every)
    own = (F.col("doc_id").try_cast("long") == F.col(i)) & (F.xxhash64("text") == F.col(k))
    side = lambda t: F.broadcast(t) if t.count() <= BROADCAST_IDS else t
    out = docs.join(side(lost), own, "left_anti")
    if not again.count():
        return out
    repeated = out.join(side(again), own)
    order = Window.partitionBy(i, k).orderBy(F.xxhash64(*map(quoted, docs.columns)))
    one = repeated.withColumn(row, F.row_number().over(order)).where(F.col(row) == 1).select(*map(quoted, docs.columns))
    return out.join(side(again), own, "left_anti").unionByName(one)
