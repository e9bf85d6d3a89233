"""Readers and writers: JSON lines, whole files, tab-separated rows, blobs with digests, record files, row-limited Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def json_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Whole records only: a line torn by a stopped writer, or any other that doesn't parse, is left out."""
    known = T.StructType([*schema.fields, T.StructField("_torn", T.StringType())])
    rows = spark.read.schema(known).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_torn").json(path)
    return rows.where(F.col("_torn").isNull()).drop("_torn")


def whole_texts(spark: SparkSession, path: str) -> DataFrame:
    """(name, text): one row a file, named by the file's stem."""
    stem = F.regexp_replace(F.element_at(F.split(F.url_decode(F.input_file_name()), "/"), -1), r"\.[^.]*$", "")
    return spark.read.text(path, wholetext=True).select(stem.alias("name"), F.col("value").alias("text"))


def tab_rows(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Strings; missing columns at a row's end are null, and no quotes are read."""
    return spark.read.schema(", ".join(f"`{c}` string" for c in columns)).option("sep", "\t").option("quote", "").csv(path)


def blobs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", "length", F.sha2("content", 256).alias("sha256"), F.col("content").alias("data"))


def records(spark: SparkSession, path: str, tag: str, schema: str) -> DataFrame:
    """Elements of an XML file as rows."""
    return spark.read.format("xml").option("rowTag", tag).schema(schema).load(path)


def write_rows(df: DataFrame, path: str, rows: int = 1000) -> None:
    """Parquet files of at most so many rows."""
    df.write.option("maxRecordsPerFile", rows).option("compression", "zstd").parquet(path)
