"""Running sums, batches and shards over millions of rows of several columns."""

from pyspark.sql import functions as F

from textloom.operators import keyed
from textloom.operators.chunks import byte_shards
from textloom.operators.running import running


def wide(spark, n):
    """Rows out of order, with columns of several types, and sizes that differ."""
    k = (F.col("id") * 7919) % n
    return spark.range(0, n, 1, 16).select(k.alias("k"), F.concat(F.lit("row "), F.col("id")).alias("name"), F.sha2(F.col("id").cast("string"), 256).alias("h"), (k % 97 + 1).alias("size"), F.rand(3).alias("x"))


def test_two_million_rows(spark):
    n = 2_000_000
    out = running(wide(spark, n), ["k"], F.lit(1).cast("long"), "before", 32)
    row = out.agg(F.count("*").alias("n"), F.count_if(F.col("before") != F.col("k")).alias("off"), F.count_distinct("name").alias("names")).first()
    assert (row.n, row.off, row.names) == (n, 0, n)
    sizes = keyed.numbered_batches(wide(spark, n), "k", 1000).groupBy("batch").agg(F.count("*").alias("m"), F.min("k").alias("lo"), F.max("k").alias("hi"))
    row = sizes.agg(F.count("*").alias("n"), F.count_if((F.col("m") != 1000) | (F.col("lo") != F.col("batch") * 1000) | (F.col("hi") != F.col("lo") + 999)).alias("off")).first()
    assert (row.n, row.off) == (2000, 0)


def test_byte_shards_of_many_columns(spark):
    n = 500_000
    out = byte_shards(wide(spark, n), "k", F.col("size"), 1_000_000).select("k", "shard")
    # Bytes before row k: 97 rows of 1 to 97 make a round.
    before = F.expr("(k div 97) * (97 * 98 div 2) + (k % 97) * (k % 97 + 1) div 2")
    assert out.where(F.col("shard") != F.floor(before / 1_000_000)).count() == 0 and out.count() == n


def test_null_and_equal_keys(spark):
    df = spark.createDataFrame([(None, 5), (1, 2), (None, 1), (1, 4), (0, 3)], "k int, v int")
    got = sorted((r.b, r.k is None, r.v) for r in running(df, ["k"], F.col("v").cast("long"), "b", 3).collect())
    assert sum(r[2] for r in got) == 15 and got[0][1] and got[1][1] and got[2][0] == 6 and got[3][0] == 9
    assert running(df.limit(0), ["k"], F.lit(1).cast("long"), "b").count() == 0
