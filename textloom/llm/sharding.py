"""Contiguous shards of near-equal bytes from global prefix sums.

Rows are put in key order by a range shuffle. Each partition's byte total is
summed once; the totals of the partitions before give every partition its
start, and a running sum inside the partition gives every row its place in the
global order of bytes. Cuts at equal targets then give contiguous shards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .prefix import in_ranges, part_starts
from .shared import Scratch, documents

SHARDS = 40
ROW_BYTES = 16


def shard_by_bytes(df: DataFrame, key: str, size: Column, shards: int = SHARDS, keep: list[str] | None = None, parts: int | None = None) -> DataFrame:
    """`key`, `size`, the columns `keep`, `shard` and `slot` (place in the shard, gapless from 0).

    A row goes to the shard that holds the middle of its bytes, so a shard is off
    the target by half of the two rows at its cuts at most. Null keys come
    first; rows with one key are ordered by their kept columns, and rows that are
    equal in these too are interchangeable. An empty frame gives an empty result.
    """
    keep = keep or []
    scratch = Scratch(df.sparkSession, "shards")
    rows = df.select(F.col(key).alias("_key"), size.cast("long").alias("size"), *[F.col(c) for c in keep])
    order = ["_key", *keep, "size"]
    rows = in_ranges(rows, order, scratch, "rows", parts)
    totals = rows.groupBy("_part").agg(F.sum("size").alias("_bytes"))
    starts = part_starts(totals, "_bytes", []).select("_part", "_before", "_all")
    inside = Window.partitionBy("_part").orderBy(*[F.col(c).asc_nulls_first() for c in order])
    upto = F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    middle = F.col("_before") + F.col("_upto") - F.col("size") / 2
    placed = (
        rows.withColumn("_upto", upto)
        .withColumn("_row", F.row_number().over(inside))
        .join(starts, "_part")
        .withColumn("shard", F.least(F.lit(shards - 1), F.floor(middle * shards / F.greatest(F.col("_all"), F.lit(1)))).cast("int"))
    )
    placed = scratch.table(placed.select("_part", "_row", "_key", "size", *keep, "shard"), "placed")
    # The first slot of a (partition, shard) piece is the number of the shard's rows in the partitions before.
    pieces = placed.groupBy("shard", "_part").agg(F.count("*").alias("_n"), F.min("_row").alias("_first"))
    pieces = part_starts(pieces, "_n", ["shard"]).select("shard", "_part", "_first", F.col("_before").alias("_slots"))
    return placed.join(pieces, ["shard", "_part"]).select(
        F.col("_key").alias(key), "size", *keep, "shard", (F.col("_slots") + F.col("_row") - F.col("_first")).cast("long").alias("slot")
    )


def assign(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, text) with their size, checksum, shard and slot, law `bytes`; a null text has 0 bytes, and rows are told apart by their doc_id and checksum."""
    body = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select("doc_id", F.octet_length(body).alias("_bytes"), F.crc32(body).alias("text_crc32"))
    out = shard_by_bytes(rows, "doc_id", F.col("_bytes") + ROW_BYTES, SHARDS, keep=["text_crc32"])
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op10: all documents in shards 0 to 39. DuckDB has no crc32, so there is no SQL; tests compute every column by hand."""
    return assign(documents(spark, sf_dir).select("doc_id", "text"))
