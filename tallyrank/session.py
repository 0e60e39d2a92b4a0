"""Session settings and lineage cuts."""

from __future__ import annotations

import gc
import os
import tempfile
import time
import uuid
import zipfile

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "tallyrank", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution and skew handling on, pinned to UTC."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    }
    settings.update({key.replace("__", "."): value for key, value in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``, which all executors share. A private
    folder is made only where none is named, as in local tests."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="tallyrank-checkpoint-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder, so a lost executor does not replay every earlier
    round of an iterative operator."""
    shared_folder(df.sparkSession)
    tidy(df.sparkSession)  # what this round's frames do not read is that of finished ones
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)  # the write would otherwise run the plan twice
    saved = kept.checkpoint(eager=True)
    kept.unpersist()
    return saved


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a Parquet table of its own in the shared folder and read again."""
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    saved = spark.read.parquet(path)
    saved._tallyrank_path = path
    return saved


def discard(saved: DataFrame | None) -> None:
    """Removes the table behind a frame of ``written`` that nothing reads any more. Other frames stay as they are."""
    path = getattr(saved, "__dict__", {}).get("_tallyrank_path")
    if path:
        context = saved.sparkSession.sparkContext
        target = context._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(context._jsc.hadoopConfiguration()).delete(target, True)


def forget(spark: SparkSession) -> None:
    """Lets Spark remove the shuffle files and checkpoints of finished rounds now: it does so once the driver has
    collected the plans that made them."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


#: Seconds between two collections, so that short rounds do not wait for them.
TIDY_SECONDS = 0.5


def tidy(spark: SparkSession) -> None:
    """``forget``, unless that was just done: rounds that take long leave much behind."""
    context = spark.sparkContext
    if time.monotonic() - getattr(context, "_tallyrank_tidied", 0.0) >= TIDY_SECONDS:
        forget(spark)
        context._tallyrank_tidied = time.monotonic()


def ship_package(spark: SparkSession) -> None:
    """Sends this package to the executors, once for each application, so that functions run there
    wherever the driver was started. Needless, and harmless, where it is installed on all nodes."""
    context = spark.sparkContext
    if getattr(context, "_tallyrank_shipped", False):
        return
    here = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="tallyrank-package-"), "tallyrank.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(here):
            for name in sorted(n for n in names if n.endswith(".py")):
                path = os.path.join(folder, name)
                out.write(path, os.path.relpath(path, os.path.dirname(here)))
    context.addPyFile(archive)
    context._tallyrank_shipped = True


def hold(df: DataFrame) -> DataFrame:
    """Keep a frame that several branches of one plan read, in executor memory with spill
    to disk. Blocks lost with an executor are computed again from the frame's lineage.
    ``release`` drops everything held once the results are written."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def release(spark: SparkSession) -> None:
    spark.catalog.clearCache()
