"""Keyed operators with an explicit order: firsts, latests, merges, diffs, ledgers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.operators.running import running


def first_by(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key; never an arbitrary one."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def insert_or_ignore(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    return old.unionByName(new.join(old.select(key), key, "left_anti"))


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of new replace those of old with the same key."""
    both = old.withColumn("_p", F.lit(0)).unionByName(new.withColumn("_p", F.lit(1)))
    return first_by(both, keys, [F.desc("_p")]).drop("_p")


def multiset_diff(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """How often a row of a stands beyond its copies in b."""
    ca, cb = a.groupBy(*keys).agg(F.count("*").alias("na")), b.groupBy(*keys).agg(F.count("*").alias("nb"))
    out = ca.join(cb, keys, "left").withColumn("extra", F.greatest(F.col("na") - F.coalesce("nb", F.lit(0)), F.lit(0)))
    return out.where("extra > 0").select(*keys, "extra")


def numbered_batches(df: DataFrame, key: str, size: int) -> DataFrame:
    """batch = place div size in key order; rows of a null key come first."""
    return running(df, [key], F.lit(1).cast("long"), "_before").withColumn("batch", F.expr(f"_before div {size}")).drop("_before")


def facets(**wanted) -> Column:
    """Conjunction of the equality predicates that are given."""
    return reduce(lambda a, b: a & b, [F.col(k) == v for k, v in wanted.items() if v is not None], F.lit(True))
