"""Cooldowns against a plain loop."""

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from textloom.operators.cooldown import suppressed
from textloom.plans import prose


def test_cooldown(spark):
    rng = random.Random(5)
    began = datetime(2024, 1, 1)
    rows = [(i, "hot" if rng.random() < 0.7 else rng.choice("ab"), began + timedelta(minutes=rng.randrange(0, 4000))) for i in range(600)]
    want, last = set(), {}
    for i, k, ts in sorted(rows, key=lambda r: (r[1], r[2], r[0])):
        if k not in last or ts - last[k] >= timedelta(minutes=60 if k == "a" else 20):
            want.add(i)
            last[k] = ts
    df = spark.createDataFrame([*rows, (-1, None, began), (-2, "a", None)], "id long, k string, ts timestamp")
    out = suppressed(df, ["k"], "ts", "id", F.when(F.col("k") == "a", 60).otherwise(20))
    assert out.columns == ["id", "k", "ts"] and {r.id for r in out.collect()} == want
    assert suppressed(df.limit(0), ["k"], "ts", "id", F.lit(20)).count() == 0


def test_section_buckets(spark, tmp_path):
    spark.createDataFrame([(1, "<h1>2. Methods of Study</h1>"), (2, "<h1>Results</h1>"), (3, "")], "page_id long, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = {r.page_id: (r.section, r.genre) for r in prose.section_buckets(spark, str(tmp_path)).collect()}
    assert got == {1: ("methods", "method"), 2: ("results", "results"), 3: ("", "other")}
