"""Chunks in groups as an embedder takes them, and their vectors by the stand-in."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions.records import embedded

GROUP_CHARS = 60_000


def grouped(chunks: DataFrame, key: str, number: str, text: str, limit: int = GROUP_CHARS) -> DataFrame:
    """All columns and `group`: a text's chunks in order fill groups from 0 on, and one that would pass `limit` characters begins the next; a longer one is a group by itself.

    Lengths alone are dealt by text and read in order with one sum in mind, so a text of any number of chunks needs no memory. Chunks of a null key are left out, a null chunk has
    no characters. Numbers are unique in a text.
    """
    sizes = chunks.where(F.col(key).isNotNull()).select(key, number, F.coalesce(F.length(text), F.lit(0)).alias("group"))

    def run(frames):
        last, fill, group = None, 0, 0
        for frame in frames:
            out = []
            for k, size in zip(frame[key], frame["group"]):
                if k != last:
                    last, fill, group = k, 0, 0
                elif fill + size > limit:
                    fill, group = 0, group + 1
                fill += size
                out.append(group)
            yield frame.assign(group=out)

    placed = sizes.repartition(key).sortWithinPartitions(key, number).mapInPandas(run, sizes.schema)
    return chunks.join(placed, [key, number])


def vectors(text: Column, size: int) -> Column:
    """The stand-in's vector of each text, a batch of rows at a time; a null text has the vector of an empty one."""

    @F.pandas_udf("array<double>")
    def made(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: embedded(t or "", size))

    return made(text)
