"""Running sums over a whole ordered frame, without one task that orders all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.sources.folders import written


def running(df: DataFrame, order: list[str], value: Column, name: str, parts: int | None = None) -> DataFrame:
    """df with the sum of `value` over the rows before each one, nulls of the order first.

    Rows are dealt by ranges of the order and written with the number of their range, once: two exchanges of one frame may
    sample other bounds, so ranges that are worked out twice need not be the same. Each range's total is summed from the written
    rows, sums run inside a range, and a range starts from the totals before it, of which there is a row a range.
    """
    n = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(c).asc_nulls_first() for c in order]
    x = written(df.withColumn("_value", value).repartitionByRange(n, *keys).withColumn("_part", F.spark_partition_id()))
    totals = x.groupBy("_part").agg(F.sum("_value").alias("_t"))
    before = F.sum("_t").over(Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("_t")
    inside = Window.partitionBy("_part").orderBy(*keys).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = x.withColumn(name, F.sum("_value").over(inside) - F.col("_value")).join(F.broadcast(totals.select("_part", before.alias("_b"))), "_part")
    return out.withColumn(name, F.col(name) + F.col("_b")).drop("_part", "_value", "_b")
