"""Samples whose positions a named generator draws, of the rows of each group in order."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.operators.running import running


def positions(counts: dict[str, int], takes: list[int], seed: int) -> list[tuple[str, int, int, int]]:
    """(group, take, place, position from 0): one generator draws for all takes one after another, in each for the groups by name, as many as there are at most."""
    rng = random.Random(seed)
    return [(g, n, i, p) for n, most in enumerate(takes) for g in sorted(counts) for i, p in enumerate(rng.sample(range(counts[g]), min(most, counts[g])))]


def drawn(rows: DataFrame, group: str, key: str, takes: list[int], seed: int = 42) -> DataFrame:
    """(group, take, place, key) of the rows that the generator draws from each group's rows in key order; keys are unique in a group, rows of a null group or key are left out.

    Only numbers come to the driver: a count a group. Rows get their place in the group from running sums over even ranges of (group, key), so a group of
    any size is never in one task.
    """
    ordered = rows.where(F.col(group).isNotNull() & F.col(key).isNotNull()).select(group, key)
    counts = {r[0]: r[1] for r in ordered.groupBy(group).agg(F.count("*")).collect()}
    starts, before = [], 0
    for g in sorted(counts):
        starts.append((g, before))
        before += counts[g]
    spark = rows.sparkSession
    kind = dict(rows.dtypes)[group]
    of = spark.createDataFrame(starts, f"_g {kind}, _start long")
    want = spark.createDataFrame(positions(counts, takes, seed), f"_g {kind}, take int, place int, _at long").join(of, "_g").select("_g", "take", "place", (F.col("_start") + F.col("_at")).alias("_row"))
    numbered = running(ordered, [group, key], F.lit(1).cast("long"), "_row")
    return numbered.join(want, "_row").select(group, "take", "place", key)
