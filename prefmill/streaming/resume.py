"""Incremental results: a file stream of scored rows folded into a keyed table.

The table lies in buckets by a hash of the key. Each micro-batch is an
idempotent upsert that writes new versions of the buckets it touches, from
versions before its epoch, so a batch that runs twice leaves the same rows. The
versions that count are named by a small pointer file written last.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from prefmill.operators.candidates import upsert


#: Parts of a table by a hash of the key; a batch rewrites those it touches.
BUCKETS = 64


def _newest(spark: SparkSession, folder: str, before: int | None = None) -> dict[int, str]:
    """bucket -> path of its newest complete version (of an epoch below ``before``); at most a row a bucket."""
    try:
        pointers = spark.read.schema("version string, n long, bucket int").option("recursiveFileLookup", "true").json(f"{folder}/pointers")
        if before is not None:
            pointers = pointers.where(F.col("n") < before)
        rows = pointers.groupBy("bucket").agg(F.max_by("version", "n").alias("version")).collect()
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        rows = []
    return {r["bucket"]: f"{folder}/{r['version']}/_bucket={r['bucket']}" for r in rows}


def _rows(spark: SparkSession, paths: list[str], schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def current(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """The rows of each bucket's newest complete version; empty before the first."""
    return _rows(spark, sorted(_newest(spark, folder).values()), schema)


def fold(folder: str, keys: list[str], schema: str, buckets: int = BUCKETS):
    """A foreachBatch function that folds a batch into the table."""

    def run(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        version = f"version-{epoch:08d}"
        bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
        new = batch.dropDuplicates(keys)
        touched = sorted(r[0] for r in new.select(bucket).distinct().collect())
        if not touched:
            return
        have = _newest(spark, folder, epoch)
        old = _rows(spark, [have[b] for b in touched if b in have], schema)
        upsert(old, new, keys).withColumn("_bucket", bucket).write.mode("overwrite").partitionBy("_bucket").parquet(f"{folder}/{version}")
        spark.createDataFrame([(version, epoch, b) for b in touched], "version string, n long, bucket int").coalesce(1).write.mode("overwrite").json(f"{folder}/pointers/{version}")

    return run


def start(spark: SparkSession, inbox: str, folder: str, schema: str, keys: list[str]) -> StreamingQuery:
    """Take up all files that are in the inbox now; a later call takes up the later ones."""
    stream = spark.readStream.schema(schema).json(inbox)
    return stream.writeStream.foreachBatch(fold(folder, keys, schema)).option("checkpointLocation", f"{folder}/_checkpoint").trigger(availableNow=True).start()
