"""Intermediate tables in a folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Only in local mode, where all are one process, may it be unset."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    kept = getattr(shared_dir, "own", None)
    if kept is None:
        kept = shared_dir.own = "file://" + tempfile.mkdtemp(prefix="gridloom-")
    return kept


def _place(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def spool(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """Write df to the shared folder and read it back: the lineage ends there and survives lost executors.

    by: a column of numbers whose values get folders of their own, so that a filter on it reads only its own. The
    table is removed by discard, or when the driver ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    (df.write.partitionBy(by) if by else df.write).parquet(path)
    place, files = _place(spark, path)
    files.deleteOnExit(place)
    out = spark.read.schema(df.schema).parquet(path)
    out._spooled = path
    return out


def spool_large(df: DataFrame, name: str) -> DataFrame:
    """spool for rows that take far more memory than their files say: no join sends them through the driver."""
    return spool(df, name).hint("merge")


def discard(df: DataFrame) -> None:
    """Remove a table that spool returned, once nothing that is still to run reads it."""
    place, files = _place(df.sparkSession, df._spooled)
    files.delete(place, True)
