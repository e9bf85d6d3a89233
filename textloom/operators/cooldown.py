"""Suppression of alerts that follow another of their key too soon."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def suppressed(events: DataFrame, key: list[str], ts: str, tie: str, minutes: Column) -> DataFrame:
    """The alerts that go out: each is let through unless the last one let through of its key is less than `minutes` ago.

    A gap of the whole cooldown before an alert always lets it through, whatever came before, so the runs between such
    gaps are independent of each other. They are dealt over the tasks; each is read in time order with one time in mind, so neither a
    busy key nor a long run has to fit in memory. `minutes` may depend on the key only. Rows with a null key or time are none.
    """
    w = Window.partitionBy(*key).orderBy(ts, tie)
    x = events.where(" and ".join(f"{c} is not null" for c in [*key, ts])).withColumn("_t", F.unix_micros(F.col(ts).cast("timestamp"))).withColumn("_pause", minutes.cast("long") * 60000000)
    x = x.withColumn("_cut", F.coalesce(F.col("_t") - F.lag("_t").over(w) >= F.col("_pause"), F.lit(True)))
    x = x.withColumn("_run", F.sum(F.col("_cut").cast("long")).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    x = x.repartition(*key, "_run").sortWithinPartitions(*key, "_run", "_t", tie)

    def run(frames):
        last = None
        for frame in frames:
            keep = []
            for t, cut, pause in zip(frame["_t"], frame["_cut"], frame["_pause"]):
                out = bool(cut) or last is None or t - last >= pause
                last = t if out else last
                keep.append(out)
            yield frame.loc[pd.Series(keep, index=frame.index, dtype=bool)]

    return x.mapInPandas(run, x.schema).drop("_t", "_pause", "_cut", "_run")
