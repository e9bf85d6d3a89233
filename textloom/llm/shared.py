"""Helpers that several operators share: input, tables in the shared folder, row batches."""

from __future__ import annotations

import atexit
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share. Only in local mode, where they are one process, a temporary one is set where none is named."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir names no folder that driver and executors share")
        named = tempfile.mkdtemp(prefix="spark-textloom-")
        spark.conf.set("spark.checkpoint.dir", named)
    return named


BROADCAST_ROWS = 200_000  # rows of a few numbers each that every task may hold


def near(few: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """A frame of a few numbers a row, marked for broadcast if it has `most` rows or fewer (they are counted); a larger one is joined by a shuffle."""
    return F.broadcast(few) if few.count() <= most else few


class Scratch:
    """Tables written to the shared folder to cut lineage. They go when dropped or when the driver ends."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.base = f"{shared_folder(spark)}/textloom/{label}-{uuid.uuid4().hex}"
        atexit.register(self._remove, self.base)

    def table(self, df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{self.base}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.base}/{name}")

    def read(self, name: str, schema: str) -> DataFrame:
        """What was written under a name, its parts (name/n=...) together."""
        return self.spark.read.schema(schema).parquet(f"{self.base}/{name}").drop("n")

    def drop(self, *names: str) -> None:
        for name in names:
            self._remove(f"{self.base}/{name}")

    def _remove(self, path: str) -> None:
        try:
            sc = self.spark.sparkContext
            if sc._jsc is None:
                return
            where = sc._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(sc._jsc.hadoopConfiguration()).delete(where, True)
        except Exception:  # the JVM may have ended; the folder is the cluster's to clear
            pass


def keyed_text(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id and the text as bytes, null as empty; every other column is left behind."""
    return docs.select(
        F.col(key).cast("long").alias("doc_id"),
        F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"),
    )


def by_bytes(blobs: list[bytes], most: int = 1 << 20):
    """Ranges of a batch that hold about `most` bytes each, one document at least."""
    start, held = 0, 0
    for i, blob in enumerate(blobs):
        if held and held + len(blob) > most:
            yield start, i
            start, held = i, 0
        held += len(blob) + 1
    if start < len(blobs):
        yield start, len(blobs)


def free_prefix(df: DataFrame, prefix: str = "_") -> str:
    """A prefix that no column of the frame begins with."""
    while any(c.startswith(prefix) for c in df.columns):
        prefix += "_"
    return prefix


def slices(batches, rows: int = 512):
    """Record batches in smaller pieces, so that few texts are held as Python objects at a time."""
    for batch in batches:
        for a in range(0, batch.num_rows, rows):
            yield batch.slice(a, rows)


def arrow_schema(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def in_batches(df: DataFrame, out: T.StructType, rows_of) -> DataFrame:
    """mapInArrow with rows_of(list of doc_id, list of bytes) -> columns, over a (doc_id, text) frame."""
    names = [f.name for f in out.fields]
    spark_schema = out

    def run(batches):
        target = arrow_schema(spark_schema)
        for batch in slices(batches):
            ids = batch.column(0)
            blobs = batch.column(1).to_pylist()
            for a, b in by_bytes(blobs):
                columns = rows_of(ids.slice(a, b - a), blobs[a:b])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, type=target.field(n).type) if not isinstance(c, pa.Array) else c.cast(target.field(n).type) for n, c in zip(names, columns)],
                    schema=target,
                )

    return df.mapInArrow(run, out)


def join_same(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join in which null keys meet; the columns of left, then those of right without the keys."""
    other = right.select([F.col(c).alias(f"_right_{c}") if c in keys else F.col(c) for c in right.columns])
    on = F.lit(True)
    for c in keys:
        on = on & F.col(c).eqNullSafe(F.col(f"_right_{c}"))
    return left.join(other, on, how).drop(*[f"_right_{c}" for c in keys])
