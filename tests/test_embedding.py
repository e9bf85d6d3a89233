"""Groups of chunks against one pass in order; vectors against the plain function."""

import random

import pytest
from pyspark.sql import functions as F

from textloom.functions.records import embedded
from textloom.operators import embedding


def test_groups_like_one_pass(spark):
    rng = random.Random(3)
    sizes = {d: [rng.choice([0, 1, 5, 9, 10, 11, 30]) for _ in range(rng.randint(0, 40))] for d in ("a", "b", "c", "d")} | {"e": [10, 0, 10, 11, 0, 1]}
    rows = [(d, n, "é" * s if s else None) for d, c in sizes.items() for n, s in enumerate(c)] + [(None, 0, "x")]
    rng.shuffle(rows)
    got = embedding.grouped(spark.createDataFrame(rows, "doc string, n int, text string").withColumn("x", F.lit(1)), "doc", "n", "text", 10)
    assert got.columns == ["doc", "n", "text", "x", "group"]
    want = []
    for d, c in sizes.items():
        groups, now, fill = [], [], 0
        for n, s in enumerate(c):
            if fill + s > 10 and now:
                groups.append(now)
                now, fill = [], 0
            now.append(n)
            fill += s
        want += [(d, n, g) for g, ns in enumerate([*groups, now]) for n in ns]
    assert sorted((r.doc, r.n, r.group) for r in got.collect()) == sorted(want)
    assert embedding.grouped(got.drop("group").limit(0), "doc", "n", "text").count() == 0


def test_vectors(spark):
    texts = ["", None, "one two two", "É x", "a " * 3000]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", embedding.vectors(F.col("t"), 8).alias("v")).collect()
    assert all(r.v == pytest.approx(embedded(r.t or "", 8)) for r in got)
