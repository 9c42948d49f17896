"""Where jobs keep tables that outlive one query."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


# Readers cut large files, but not a row group: a file holds one of bounded size.
ROWS_PER_FILE = 500_000

_paths: dict[str, list[str]] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder named by `spark.checkpoint.dir`.

    Only a local session may run without that setting; it gets a fresh
    temporary folder. A cluster must name a folder every executor can reach.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="offerwise-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    _paths.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def clear_stored(spark: SparkSession) -> int:
    """Delete the stored tables of this application, and say how many there were.

    Call it when the results of all jobs are written: frames that read the tables fail
    afterwards.
    """
    paths = _paths.pop(spark.sparkContext.applicationId, [])
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for path in map(hadoop, paths):
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    return len(paths)


def store(df: DataFrame, name: str) -> DataFrame:
    """Write `df` as Parquet in the shared folder and read it back.

    Cuts the lineage durably: a lost executor costs a re-read, and values that
    are fixed only once computed (such as a partition number) stay fixed.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.option("maxRecordsPerFile", ROWS_PER_FILE).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
