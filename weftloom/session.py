"""Session helpers: where lineage is cut, and what may be broadcast."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Where it is unset, a folder is set only if this one machine is all there is (master ``local`` or ``local[n]``).
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="weftloom-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers this package and its neighbours, once in an application, as a zip from the driver."""
    context, root = spark.sparkContext, Path(__file__).resolve().parent.parent
    if getattr(context, "weftloom_shipped", False) or not root.is_dir():
        return
    folder = tempfile.mkdtemp(prefix="weftloom-")  # the driver serves the file from here
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = Path(folder, "weftloom.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for package in ("weftloom", "workloads"):
            for file in sorted((root / package).rglob("*.py")):
                out.write(file, file.relative_to(root))
    context.addPyFile(str(archive))
    context.weftloom_shipped = True


def scratch_path(spark: SparkSession) -> str:
    """A new path in this application's part of the shared folder, which may be deleted once it has ended."""
    return f"{checkpoint_root(spark)}/weftloom-{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"


def tidy_driver(spark: SparkSession, share: float = 0.2) -> None:
    """Have the driver's JVM collect garbage once that fills ``share`` of its heap.

    Plans, broadcasts and shuffles of ended jobs are only let go of by such a collection; long series of jobs else grow the heap to its limit
    and leave shuffle files on the executors' disks.
    """
    runtime = spark._jvm.java.lang.Runtime.getRuntime()
    if runtime.totalMemory() - runtime.freeMemory() > share * runtime.maxMemory():
        spark._jvm.java.lang.System.gc()


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    This cuts lineage for loops and keeps the result when executors are lost. Being a
    Parquet table, it also gives later joins true sizes and prunes columns.
    """
    spark = df.sparkSession
    path = scratch_path(spark)
    df.write.parquet(path)
    tidy_driver(spark)
    return spark.read.schema(df.schema).parquet(path)


def discard(*frames: DataFrame) -> None:
    """Delete the tables that ``materialize`` wrote for ``frames``, which nothing will read any more."""
    for frame in frames:
        spark = frame.sparkSession
        for folder in {file.rsplit("/", 1)[0] for file in frame.inputFiles()}:
            if f"/weftloom-{spark.sparkContext.applicationId}/" in folder:
                path = spark._jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def broadcast_if_small(df: DataFrame, max_rows: int = 100_000) -> DataFrame:
    """Hint a broadcast only after counting that ``df`` has at most ``max_rows`` narrow rows."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def small_or_sorted(df: DataFrame, max_rows: int = 100_000) -> DataFrame:
    """``df``, cheap to count, as the other side of a join: broadcast if it has at most ``max_rows`` narrow rows, else sorted and merged.

    Left alone, Spark goes by the size of the files, and the few MB of a table of ids can take a GB in the memory of the driver and of every task.
    """
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df.hint("merge")
