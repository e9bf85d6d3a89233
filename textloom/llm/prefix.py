"""Global running sums over an ordered frame without putting it, or a group of it, into one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import Scratch


def in_ranges(df: DataFrame, order: list[str], scratch: Scratch, name: str, parts: int | None = None) -> DataFrame:
    """df range-partitioned by `order`, with the partition's number in `_part`, written so that the numbers stay."""
    n = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *[F.col(c).asc_nulls_first() for c in order])
    return scratch.table(ranged.withColumn("_part", F.spark_partition_id()), name)


def part_starts(totals: DataFrame, value: str, group: list[str], part: str = "_part") -> DataFrame:
    """From one row per part: the sum of `value` in the parts before (`_before`) and in all of them (`_all`).

    Only per-partition totals meet here, never rows of the data.
    """
    w = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    return totals.withColumn(
        "_before", F.sum(value).over(w.orderBy(part).rowsBetween(Window.unboundedPreceding, 0)) - F.col(value)
    ).withColumn("_all", F.sum(value).over(w))
