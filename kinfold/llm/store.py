"""Cutting lineage in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Shuffle files of an execution are deleted when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder.

    Where spark.checkpoint.dir is unset, a folder of this machine stands in for it, but only in a
    session without other machines; on a cluster that is an error.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None and not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir has to name a folder that driver and executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="kinfold-"))
    return sc.getCheckpointDir()


def _path(spark: SparkSession, folder: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


@contextmanager
def _setting(spark: SparkSession, name: str, value: str):
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


@contextmanager
def arrow_batches(spark: SparkSession, rows: int):
    """Arrow batches of at most so many rows for the actions within: whole texts are large rows."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(rows, int(before))) if int(before) > 0 else str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def settle(df: DataFrame, batch: int = 10_000) -> DataFrame:
    """Write ``df`` once as a table in the shared folder and go on from the files.

    Unlike checkpoint() this computes the plan a single time and keeps columns compressed;
    the files outlive any executor, and the shuffles behind them go as soon as they are written.  What forget() hasn't deleted goes when the driver ends.
    """
    spark = df.sparkSession
    folder = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    path, files = _path(spark, folder)
    with arrow_batches(spark, batch), _setting(spark, CLEANUP, "true"):
        # a plan takes the setting when it is made, so this one is made anew
        df.select("*").write.parquet(folder)
    files.deleteOnExit(path)
    return spark.read.schema(df.schema).parquet(folder)


def forget(spark: SparkSession, *tables: DataFrame) -> None:
    """Delete tables written by settle() that no later step reads."""
    for df in tables:
        for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
            path, files = _path(spark, folder)
            files.delete(path, True)
