"""Tables in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

ROW_GROUP = 128 << 20  # bytes of one, as writers make them


def shared_folder(spark: SparkSession) -> str:
    """A new folder under the one that driver and executors share; a temporary one in local mode only, where none is named. It goes when the driver ends."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir names no folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="spark-textloom-")
        spark.conf.set("spark.checkpoint.dir", base)
    path = f"{base}/textloom/{uuid.uuid4().hex}"
    atexit.register(removed, spark, path)
    return path


def removed(spark: SparkSession, path: str) -> None:
    """Takes a folder away, if the session still runs."""
    sc = spark.sparkContext
    if sc._jsc is None:
        return
    try:
        where = sc._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(sc._jsc.hadoopConfiguration()).delete(where, True)
    except Exception:  # the JVM may have ended; the folder is the cluster's to clear
        pass


def exists(spark: SparkSession, path: str) -> bool:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def dealt(spark: SparkSession, source: str, by: str | None = None) -> DataFrame:
    """A Parquet table for costly functions of its rows. A file of one row group is one task however many cores there are; so a table of less than a row group for each core is dealt over
    them first, by ranges of `by` if it is given. A larger one has row groups enough and is read as it lies."""
    cores, rows = spark.sparkContext.defaultParallelism, spark.read.parquet(source)
    if source_state(spark, source)[2] >= cores * ROW_GROUP:
        return rows
    return rows.repartitionByRange(cores, by) if by else rows.repartition(cores)


def source_state(spark: SparkSession, source: str) -> tuple:
    """What tells one state of a table's files from another in a session: their number, size and time."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(source)
    fs = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    held = fs.getContentSummary(where)
    return spark.sparkContext.applicationId, source, held.getLength(), held.getFileCount(), fs.getFileStatus(where).getModificationTime()


def written(df: DataFrame, path: str | None = None) -> DataFrame:
    """The frame as a table that is read again, so that all that is built on it sees the same rows in the same parts."""
    path = path or shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
