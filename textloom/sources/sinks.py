"""Sinks that are read back: appended JSON lines, slices, keyed merges, tables of pipes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.operators import keyed as K


def append_json(df: DataFrame, path: str) -> None:
    """Rows as JSON lines after those that are there. Files appear whole, by Spark's commit; a failed write leaves none."""
    df.write.mode("append").json(path)


def write_slices(df: DataFrame, key: str, rows: int, path: str) -> None:
    """Slices of `rows` rows in key order, a folder each."""
    K.numbered_batches(df, key, rows).withColumnRenamed("batch", "slice").repartition("slice").write.partitionBy("slice").parquet(path)


def merged(old: DataFrame, new: DataFrame, key: str, last_wins: bool) -> DataFrame:
    """A keyed table after a batch: rows of the batch replace those of their key, or are left out where the key is known. Of a batch's own rows with one key the least counts."""
    once = K.first_by(new, [key], [F.col(c) for c in new.columns if c != key])
    return K.upsert(old, once, [key]) if last_wins else K.insert_or_ignore(old, once, key)


def pipe_table(df: DataFrame, order: list[str]) -> DataFrame:
    """A small frame as one Markdown table, in the given order; for reports, whose rows are few."""
    line = lambda cells: F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |"))
    rows = df.select(F.struct(*order).alias("_o"), line([F.coalesce(F.replace(F.col(c).cast("string"), F.lit("|"), F.lit("\\|")), F.lit("")) for c in df.columns]).alias("_l"))
    head = line([F.lit(c) for c in df.columns]), F.lit("|" + " --- |" * len(df.columns))
    body = rows.agg(F.array_sort(F.collect_list(F.struct("_o", "_l"))).alias("_a"))
    return body.select(F.concat_ws("\n", *head, F.array_join("_a._l", "\n")).alias("table"))
