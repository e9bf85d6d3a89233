"""Streams of files into keyed tables, which replays leave as they are."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.sources.folders import shared_folder
from textloom.sources.keyed_table import IGNORE, RELOAD, REPLACE, KeyedTable


def taken_in(stream: DataFrame, checkpoint: str, batch: Callable[[DataFrame, int], None]) -> None:
    """Runs `batch` over what is there, a micro-batch at a time, and ends. After a failure a run begins with the batch that didn't end."""
    stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def ingest(spark: SparkSession, source: str, key: str, stamp: str, table: KeyedTable, checkpoint: str) -> None:
    """Takes in what is new at `source`: of each key the first row by `stamp`, whenever a key comes again."""
    schema = spark.read.parquet(source).schema
    rows = spark.readStream.schema(schema).parquet(f"{source[:-1]}[{source[-1]}]")  # as a pattern, a path may name one file too
    taken_in(rows, checkpoint, lambda df, n: table.merge(df, n, IGNORE, [stamp]))


def reload(spark: SparkSession, rows: DataFrame, table: KeyedTable, checkpoint: str) -> None:
    """A stream of papers' rows: each batch takes the place of all earlier rows of its papers. A paper's rows come in one file."""
    taken_in(rows, checkpoint, lambda df, n: table.merge(df, n, RELOAD))


class Manifest:
    """Ingest of a manifest of fetched files: (paper, format, stamp, digest, failure) rows.

    Files go to `sources`, a row per paper and format, the newest by stamp; papers that no list has named are adopted into `papers`; failures go to
    `failures` and hold up nothing. The three tables commit one by one and know their batches, so a batch that stopped between them is done where it wasn't.
    """

    def __init__(self, spark: SparkSession, base: str, buckets: int = 16):
        self.spark = spark
        self.papers = KeyedTable(spark, f"{base}/papers", "paper string, state string", ["paper"], buckets)
        self.sources = KeyedTable(spark, f"{base}/sources", "paper string, format string, stamp timestamp, digest string", ["paper", "format"], buckets)
        self.failures = KeyedTable(spark, f"{base}/failures", "paper string, format string, stamp timestamp, failure string", ["paper", "format", "stamp", "failure"], buckets)

    def listed(self, papers: DataFrame, batch: int = -1) -> None:
        """Brings in papers of a list, as state `listed`; batches of lists have negative numbers."""
        self.papers.merge(papers.select("paper", F.lit("listed").alias("state")), batch, IGNORE)

    def batch(self, rows: DataFrame, n: int) -> None:
        rows = rows.where("paper is not null")
        self.papers.merge(rows.select("paper", F.lit("adopted").alias("state")), n, IGNORE)
        self.failures.merge(rows.where("failure is not null"), n, IGNORE)
        newest = rows.where("failure is null").join(self.sources.read().select("paper", "format", F.col("stamp").alias("_had")), ["paper", "format"], "left")
        self.sources.merge(newest.where("_had is null or stamp >= _had"), n, REPLACE, ["-stamp", "-digest"])

    def run(self, stream: DataFrame, checkpoint: str) -> None:
        taken_in(stream, checkpoint, self.batch)


def stream_ingest(spark: SparkSession, d: str) -> DataFrame:
    """All events, taken in as a stream into the shared folder and read from there."""
    base, source = shared_folder(spark), f"{d}/events.parquet"
    table = KeyedTable(spark, f"{base}/rows", spark.read.parquet(source).schema, ["event_id"])
    ingest(spark, source, "event_id", "ts", table, f"{base}/state")
    return table.read().select("event_id", "user_id", "event_type")
