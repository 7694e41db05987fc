"""Shared plumbing of the corpus operators: shared-folder tables, shipping the package, and text helpers."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_shipped: set[str] = set()


class _Made(threading.local):
    """Folders of the shared folder that this thread made and hasn't deleted."""

    def __init__(self) -> None:
        self.paths: set[str] = set()


_made = _Made()


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir`` of the session.

    Where it is unset, a fresh temporary folder is used in local mode only; on a cluster its absence is an error,
    because a machine-local folder can't be read by the other executors.
    """
    sc = spark.sparkContext
    where = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if where:
        return where.rstrip("/")
    if not sc.master.startswith("local[") and sc.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="lakeloom-"))
    return sc._jsc.sc().getCheckpointDir().get().rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _made.paths.add(path)
    return path


def delete(spark: SparkSession, path: str) -> None:
    _made.paths.discard(path)
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def saved(df: DataFrame, name: str) -> DataFrame:
    """Cuts the lineage: writes ``df`` as a Parquet table of the shared folder and reads it again."""
    return reread(df, scratch(df.sparkSession, name))


def reread(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.saved_at = path
    return out


def forget(*tables: DataFrame) -> None:
    """Deletes tables of ``saved`` that no result reads any more."""
    for t in tables:
        if getattr(t, "saved_at", None):
            delete(t.sparkSession, t.saved_at)


def made() -> set[str]:
    return set(_made.paths)


def clean(spark: SparkSession) -> None:
    """Deletes all that this thread has written to the shared folder: results that weren't written elsewhere end with it."""
    for path in sorted(_made.paths):
        delete(spark, path)


def sweep(spark: SparkSession, before: set[str], keep: DataFrame) -> None:
    """Deletes what this thread wrote to the shared folder since ``made()`` gave ``before``, except ``keep``."""
    for path in sorted(_made.paths - before - {keep.saved_at}):
        delete(spark, path)


def ship(spark: SparkSession) -> None:
    """Makes this package importable by the Python workers, wherever the driver found it."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parents[1]
    target = os.path.join(tempfile.mkdtemp(prefix="lakeloom-code-"), "lakeloom.zip")
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    sc.addPyFile(target)
    _shipped.add(sc.applicationId)


_sent: set[tuple[str, str]] = set()
_caches: dict[str, list] = {}


def cache(owner: str, store):
    """Registers what a worker remembers for ``owner`` between tasks, to be given up when another takes over."""
    _caches.setdefault(owner, []).append(store)
    return store


def claim(owner: str) -> None:
    """Workers are used again by stage after stage: only the stage at work keeps what it remembers."""
    for name, stores in _caches.items():
        if name != owner:
            for s in stores:
                s.clear()


def send(spark: SparkSession, path: str) -> None:
    """Sends a file of the driver to all executors, once."""
    if (spark.sparkContext.applicationId, path) not in _sent:
        spark.sparkContext.addFile(path)
        _sent.add((spark.sparkContext.applicationId, path))


def received(path: str) -> str:
    """Where a worker finds a file that was sent."""
    from pyspark import SparkFiles

    here = SparkFiles.get(os.path.basename(path))
    return here if os.path.exists(here) else path


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that no column of ``df`` has, whatever the case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n = "_" + n
        taken.add(n.lower())
        out.append(n)
    return out


def quoted(name: str) -> Column:
    """The column of this literal name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")
