"""Exact deduplication as a stateful stream.

The stream carries (digest, doc_id, locator) of each row, never the text: its state holds, for every digest ever seen
and without expiry, the stable identifier and the content locator (file and row) of the document that was first. The
state lives in RocksDB, so it is bounded by disk, and is keyed by a slice of the digest with one map entry a digest, so a
hot document is one entry however many copies come. A task that reads copies sends on the first of them only as a candidate
for the state; the others can't be first and are dealt evenly, so no slice has a hot document's rows. A row whose digest is
there is a hit: its bytes and the first one's
are read by their locators and compared in full, by folding the least and the greatest text of a digest. Should they
differ, the texts of that digest are grouped by their bytes themselves, which is exact.

All files that are there when the stream starts make one epoch; within an epoch the least doc_id is first, between epochs
the earlier one. Files that come later are a later epoch of the same stream, if ``home`` is given again.

Defined results: a null text equals nothing, so its row stays; empty texts equal one another. Of repeated rows (one
doc_id, one text) one stays, of one doc_id with different texts each text. Null ids come last among copies. Extra columns
are carried along, whatever their names. A doc_id that isn't a whole number counts as null. Texts are taken whole, very
long ones too. An empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from lakeloom.llm.common import delete, fresh, quoted, saved, scratch, ship

#: Slices of the digest that key the state: the unit of parallel work, fixed for the life of a stream's state. A new
#: stream has one for each SLICE_BYTES of its first input, SLICES at least, so that a slice's rows fit a worker.
SLICES, SLICE_BYTES = 1024, 64 << 20
#: Up to so many digests of hits are sent to all executors; more are joined by a shuffle.
BROADCAST_DIGESTS = 200_000

SEEN = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("file", T.StringType()), T.StructField("row", T.LongType())])
OUT = "slice int, digest binary, doc_id bigint, file string, row bigint, first_id bigint, first_file string, first_row bigint"


def digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def order_of(doc_id: int | None, file: str, row: int) -> tuple:
    return doc_id is None, doc_id or 0, file, row


def first_of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (digest, doc_id, file, row) again, with ``copy``: whether this task has had one of the same digest that is before it."""
    best: dict[bytes, tuple] = {}
    made = lambda rows, copy: pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.binary(), pa.int64(), pa.string(), pa.int64()))] + [pa.array([copy] * len(rows), pa.bool_())], ["digest", "doc_id", "file", "row", "copy"])
    for b in batches:
        copies = []
        for r in zip(*(c.to_pylist() for c in b.columns), strict=True):
            other = best.setdefault(r[0], r)
            if other is not r:
                if order_of(*r[1:]) < order_of(*other[1:]):
                    best[r[0]], r = r, other
                copies.append(r)
        if copies:
            yield made(copies, True)
    first = list(best.values())
    for a in range(0, len(first), 10_000):
        yield made(first[a : a + 10_000], False)


class FirstSeen(StatefulProcessor):
    """Emits each row with what the state holds as the first of its digest; the first itself has its own locator. Copies that
    were found before they came here have none."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.first = handle.getMapState("first", T.StructType([T.StructField("digest", T.BinaryType())]), SEEN)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        got = []
        for r in rows:
            if r.copy:
                yield Row(slice=key[0], digest=r.digest, doc_id=r.doc_id, file=r.file, row=r.row, first_id=None, first_file=None, first_row=None)
            else:
                got.append(r)
        got.sort(key=lambda r: (bytes(r.digest), *order_of(r.doc_id, r.file, r.row)))
        last, first = None, None
        for r in got:
            d = bytes(r.digest)
            if d != last:
                last, first = d, self.first.getValue((d,))
                if first is None:
                    first = (r.doc_id, r.file, r.row)
                    self.first.updateValue((d,), first)
            yield Row(slice=key[0], digest=r.digest, doc_id=r.doc_id, file=r.file, row=r.row, first_id=first[0], first_file=first[1], first_row=first[2])

    def close(self) -> None:
        pass


@contextmanager
def settings(spark: SparkSession, **values: str) -> Iterator[None]:
    """Session settings for the length of the block."""
    names = {k.replace("__", "."): v for k, v in values.items()}
    old = {k: spark.conf.get(k, None) for k in names}
    try:
        for k, v in names.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def slices_of(spark: SparkSession, path: str, home: str) -> int:
    """The number of slices of the stream at ``home``, which a name in its folder keeps; a new one's goes by its input."""
    hadoop, conf = spark.sparkContext._jvm.org.apache.hadoop.fs, spark.sparkContext._jsc.hadoopConfiguration()
    at = hadoop.Path(home)
    fs = at.getFileSystem(conf)
    kept = fs.globStatus(hadoop.Path(f"{home}/slices-*"))
    if kept is not None and len(kept):
        return int(kept[0].getPath().getName().rpartition("-")[2])
    source = hadoop.Path(path)
    n = max(SLICES, -(-source.getFileSystem(conf).getContentSummary(source).getLength() // SLICE_BYTES))
    fs.mkdirs(at)
    fs.create(hadoop.Path(f"{home}/slices-{n}")).close()
    return n


def first_seen(spark: SparkSession, path: str, schema: T.StructType, home: str, digest_of=digest) -> DataFrame:
    """Runs the stream over the files under ``path`` that it hasn't had and returns all rows it has decided, of earlier runs too."""
    ship(spark)
    n = slices_of(spark, path, home)
    keyed = (
        spark.readStream.schema(schema).parquet(f"{path[:-1]}[{path[-1]}]")  # a pattern may stand for one file, a path only for a folder
        .select(digest_of(F.col("text")).alias("digest"), F.col("doc_id").try_cast("long").alias("doc_id"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
        .where("digest is not null")
        .mapInArrow(first_of_task, "digest binary, doc_id long, file string, row long, copy boolean")
        .withColumn("slice", F.pmod(F.when(F.col("copy"), F.xxhash64("file", "row")).otherwise(F.xxhash64("digest")), F.lit(n)).cast("int"))
    )
    decided = keyed.groupBy("slice").transformWithState(FirstSeen(), OUT, "append", "none")
    out = f"{home}/decided"
    with settings(
        spark,
        spark__sql__streaming__stateStore__providerClass="org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        spark__sql__streaming__stateStore__rocksdb__changelogCheckpointing__enabled="true",
        spark__sql__streaming__stateStore__rocksdb__boundedMemoryUsage="true",
        spark__sql__streaming__stateStore__rocksdb__maxMemoryUsageMB="256",
    ):
        run = decided.writeStream.format("parquet").option("checkpointLocation", f"{home}/checkpoint").option("path", out).trigger(availableNow=True).outputMode("append").start()
        run.awaitTermination()
    return spark.read.schema(OUT).parquet(out)


def drop_copies(docs: DataFrame, path: str | None = None, home: str | None = None, digest_of=digest) -> DataFrame:
    """The rows of ``docs`` without those whose text an earlier one has.

    ``path``: the Parquet files that ``docs`` is, if it is a plain read of them; else they are written to the shared
    folder, for the stream reads files; so they are if the path could be read as a pattern. ``home``: the stream's own folder,
    kept between runs that continue each other.
    """
    spark = docs.sparkSession
    if path is not None and set(path) & set("[]{}*?\\"):
        if home is not None:
            raise ValueError(f"{path} would be read as a pattern")
        path = None
    if path is None:
        docs = saved(docs, "exact-input")
        path = docs.inputFiles()[0].rpartition("/")[0] if docs.inputFiles() else None
        if path is None:
            return docs
    own = home or scratch(spark, "exact-stream")
    rows = first_seen(spark, path, docs.schema, own, digest_of)
    itself = F.col("file").eqNullSafe(F.col("first_file")) & F.col("row").eqNullSafe(F.col("first_row"))
    hits = rows.where(~itself)
    # what is read again and compared: every row of a digest that has a hit
    struck = saved(hits.select("digest").distinct(), "exact-hits")
    n = struck.count()
    where, at, dig = fresh(docs, "file", "row", "digest")
    placed = spark.read.schema(docs.schema).parquet(path).select("*", F.col("_metadata.file_path").alias(where), F.col("_metadata.row_index").alias(at))
    if n:
        side = F.broadcast(struck) if n <= BROADCAST_DIGESTS else struck
        whole = spark.read.schema(docs.schema).parquet(path)
        read = whole.select(digest_of(F.col("text")).alias("digest"), "text")
        if home is not None:  # first ones of earlier runs may lie elsewhere
            here = whole.select(F.col("_metadata.file_path").alias("f")).distinct()
            there = [r["f"] for r in rows.select(F.col("first_file").alias("f")).where("f is not null").distinct().join(here, "f", "left_anti").collect()]  # a row a file
            if there:
                read = read.unionByName(spark.read.schema(docs.schema).parquet(*map(unquote, there)).select(digest_of(F.col("text")).alias("digest"), "text"))
        read = read.join(side, "digest")
        differ = read.groupBy("digest").agg(F.min("text").alias("low"), F.max("text").alias("high")).where("low <> high").select("digest")
        differ = saved(differ, "exact-collisions")
        gone = hits.join(differ, "digest", "left_anti").select("file", "row")
        if differ.count():  # digests that stand for several texts: the bytes themselves are the key
            texts = placed.select(quoted(where).alias("file"), quoted(at).alias("row"), F.col("doc_id").alias("doc_id"), F.col("text").alias("text"), digest_of(F.col("text")).alias("digest")).join(differ, "digest")
            least = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "file", "row")).alias("least")
            same = texts.groupBy("text").agg(least)
            gone = gone.unionByName(texts.join(same, "text").where(~(F.col("file") == F.col("least.file")) | ~(F.col("row") == F.col("least.row"))).select("file", "row"))
        lost = saved(gone.select(F.col("file").alias(where), F.col("row").alias(at)), "exact-copies")
        m = lost.count()
        side = F.broadcast(lost) if m <= BROADCAST_DIGESTS else lost
        placed = placed.join(side, [where, at], "left_anti")
    if home is None:
        delete(spark, own)
    return placed.drop(quoted(where), quoted(at))


def folder_of(docs: DataFrame) -> str | None:
    """The one folder whose Parquet files ``docs`` reads whole and unchanged; None if that can't be told from its plan."""
    node = docs._jdf.queryExecution().analyzed()
    if node.getClass().getSimpleName() != "LogicalRelation" or not docs.inputFiles():
        return None
    roots = node.relation().location().rootPaths()
    return unquote(roots.head().toString()) if roots.size() == 1 else None
