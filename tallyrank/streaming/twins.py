"""Structured Streaming twins of the operators that are online by nature.

The stream reads the same files as the batch form and ends at the same state. Files are
taken with ``availableNow``; on a live source only the reader and the trigger change.

A caller who names a ``state`` folder can stop at any point: a later call with the same folder goes on after the
last batch that was finished, also in another application. Without one the state is new and the stream starts over.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from tallyrank.operators import bandit, profiles


def state_folder(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, where the cluster keeps shared state."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="tallyrank-stream-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _path(spark: SparkSession, name: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def _finished(spark: SparkSession, folder: str) -> bool:
    """Whether a table was written there to its end."""
    files, path = _path(spark, f"{folder}/_SUCCESS")
    return files.exists(path)


def _remove(spark: SparkSession, folder: str) -> None:
    files, path = _path(spark, folder)
    files.delete(path, True)


def _last(spark: SparkSession, folder: str) -> int | None:
    """The largest n for which folder/batch=n was written to its end."""
    files, path = _path(spark, folder)
    if not files.exists(path):
        return None
    numbers = [int(f.getPath().getName().partition("=")[2]) for f in files.listStatus(path) if f.getPath().getName().startswith("batch=")]
    return max((n for n in numbers if _finished(spark, f"{folder}/batch={n}")), default=None)


def read_files(spark: SparkSession, path: str, schema: StructType, files_per_batch: int | None = None) -> DataFrame:
    """A file stream over one parquet file or a folder of them."""
    folder, name = os.path.split(path.rstrip("/"))
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if name.endswith(".parquet"):
        return reader.option("pathGlobFilter", name).parquet(folder)
    return reader.parquet(path)


def stream_arm_sums(
    spark: SparkSession, path: str, schema: StructType, to_log: Callable[[DataFrame], DataFrame], features: list[str],
    state: str | None = None,
) -> DataFrame:
    """The per-arm sums of the linear bandit after the stream has been read.

    A streaming ``groupBy(arm)`` of plain sums: its state is one row per arm. Every
    micro-batch writes the full state, the last one is returned and the one before it kept for a replay.
    """
    sums = bandit.linucb_sums(to_log(read_files(spark, path, schema)), "arm", features, "reward")
    state = state or state_folder(spark, "arm-state")
    out = f"{state}/sums"

    def save(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")
        _remove(spark, f"{out}/batch={number - 2}")

    run = (
        sums.writeStream.outputMode("complete").foreachBatch(save)
        .option("checkpointLocation", f"{state}/checkpoint")
        .trigger(availableNow=True).start()
    )
    run.awaitTermination()
    return spark.read.parquet(f"{out}/batch={_last(spark, out)}")


def stream_profile_upsert(
    spark: SparkSession, path: str, schema: StructType, to_changes: Callable[[DataFrame], DataFrame],
    base: DataFrame, key: str, version: list[str], payload: list[str], op: str = "op",
    rows_per_bucket: int = 100_000, files_per_batch: int | None = None, state: str | None = None,
) -> DataFrame:
    """Profiles after a stream of changes.

    The profiles lie in hash buckets of the key, as many as the base table asks for. A micro-batch
    writes new versions of the buckets its keys fall into, next to the old ones, and then a table
    that names the version of every bucket. Readers go by that table, so a batch that fails in
    the middle leaves nothing half written, and its replay overwrites its own files only. Merging
    keeps the newest version per key, so a replayed batch changes nothing; deletes stay as
    markers, so a late older change cannot bring a key back. Versions that neither the last table of
    versions nor the one before it names are removed. With a ``state`` folder that already holds a table of versions,
    the base is not read and the stream goes on from there.
    """
    state = state or state_folder(spark, "profile-state")
    out, pointers = f"{state}/profiles", f"{state}/versions"
    columns = [key, *version, op, *payload]
    last = _last(spark, pointers)
    if last is None:
        first = profiles.latest_versions(base, key, version, [op, *payload]).persist()
        buckets = max(1, -(-first.count() // rows_per_bucket))
    else:
        first, buckets = None, spark.read.parquet(f"{pointers}/batch={last}").count()

    def bucketed(df: DataFrame) -> DataFrame:
        return df.select(columns).withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))

    def save(df: DataFrame, number: int) -> None:
        rows = bucketed(df).repartition("bucket").withColumn("batch", F.lit(number))
        writer = rows.write.mode("overwrite").partitionBy("bucket", "batch")
        writer.option("partitionOverwriteMode", "dynamic").parquet(out)

    def versions(number: int) -> DataFrame:
        return spark.read.parquet(f"{pointers}/batch={number}")

    if first is not None:
        save(first, -1)
        first.unpersist()
        spark.range(buckets).select(F.col("id").cast("int").alias("bucket"), F.lit(-1).alias("batch")).write.mode("overwrite").parquet(f"{pointers}/batch=-1")
    kept = StructType([*bucketed(base.select(columns)).schema, StructField("batch", IntegerType())])

    def merge(batch: DataFrame, number: int) -> None:
        changes = bucketed(batch).persist()
        touched = changes.select("bucket").distinct().persist()
        before = versions(number - 1)
        current = spark.read.schema(kept).parquet(out).join(before.join(touched, "bucket"), ["bucket", "batch"], "left_semi")
        both = current.select(columns).unionByName(changes.select(columns))
        save(profiles.latest_versions(both, key, version, [op, *payload]), number)
        now = before.join(touched.withColumn("_new", F.lit(number)), "bucket", "left")
        now.select("bucket", F.coalesce("_new", "batch").alias("batch")).write.mode("overwrite").parquet(f"{pointers}/batch={number}")
        if _last(spark, pointers) == number and number > 0:
            # a replay of this batch reads the versions before it, and nothing reads older ones
            old = versions(number - 2).join(before.withColumnRenamed("batch", "_next"), "bucket").where(F.col("batch") != F.col("_next"))
            for row in old.select("bucket", "batch").collect():
                _remove(spark, f"{out}/bucket={row.bucket}/batch={row.batch}")
            _remove(spark, f"{pointers}/batch={number - 2}")
        changes.unpersist()
        touched.unpersist()

    run = (
        to_changes(read_files(spark, path, schema, files_per_batch)).writeStream.foreachBatch(merge)
        .option("checkpointLocation", f"{state}/checkpoint")
        .trigger(availableNow=True).start()
    )
    run.awaitTermination()
    final = spark.read.schema(kept).parquet(out).join(versions(_last(spark, pointers)), ["bucket", "batch"], "left_semi")
    return final.where(F.col(op) != "delete").select(key, *version, *payload)
