"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Folders that this process has named, to be deleted when it ends.
_made: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    Taken from ``spark.checkpoint.dir``; where that is unset, a local session
    (tests, a laptop) gets a folder of this machine, and a cluster an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        checkpoint = spark.sparkContext._jsc.sc().getCheckpointDir()
        if checkpoint.isDefined():
            return checkpoint.get()
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = f"file://{tempfile.mkdtemp(prefix='prefmill-')}"
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A name for a folder in the shared one; it is deleted when the driver's process ends, if not before."""
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if not _made:
        atexit.register(_delete_all)
    _made.append((spark, path))
    return path


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder through Spark's file systems."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def _delete_all() -> None:
    for spark, path in _made:
        try:
            delete(spark, path)
        except Exception:  # noqa: BLE001  the session has ended: the folder stays, as any checkpoint would
            return


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: lineage ends here.

    Unlike a cache it survives lost executors.
    """
    spark = df.sparkSession
    path = fresh_dir(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def discard(df: DataFrame) -> None:
    """Delete what ``stored`` wrote for this table; nothing that still has to be computed may read it."""
    path = getattr(df, "_stored_at", None)
    if path:
        delete(df.sparkSession, path)
        _made[:] = [(s, p) for s, p in _made if p != path]
