"""Streams with state: late rows, restarts and crashes against a fold over all rows in order."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from textloom.streaming import stateful as S

SCHEMA = "id long, ts timestamp, k string, bad boolean"
START = dt.datetime(2024, 1, 1)


@pytest.fixture
def few(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield spark
    spark.conf.set("spark.sql.shuffle.partitions", before)


def events(n=240, seed=5):
    rng, at, out = random.Random(seed), START, []
    for i in range(n):
        at += dt.timedelta(seconds=rng.choice([0, 5, 60, 600]))
        out.append((i, at, rng.choice("aab"), rng.random() < 0.6))
    return out


def put(spark, rows, path):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def folded(rows, step):
    state, out = {}, []
    for i, ts, k, bad in sorted(rows, key=lambda r: (r[1], r[0])):
        micros = int((ts - START).total_seconds() * 1_000_000)
        state[k], made = step(state.get(k), (micros, i, bad))
        out += [(k, *m) for m in made]
    return sorted(out)


def test_late_rows_and_a_restart(few, tmp_path):
    """Rows of half an hour swap files; a run ends in the middle, the next one goes on; what is later than the delay is dropped."""
    path, rows = str(tmp_path / "in"), events()
    rng = random.Random(1)
    shuffled = sorted(rows, key=lambda r: r[1] + dt.timedelta(minutes=rng.uniform(0, 30)))
    stream = lambda: S.in_order(S.feed(few, path, F_SCHEMA), ["k"], "ts", "id", ["bad"], "flags string", "id long, rate double, stop boolean", S.rolling_rate)
    put(few, shuffled[:80], path)
    F_SCHEMA = few.read.parquet(path).schema
    put(few, shuffled[80:160], path)
    S.run(stream(), str(tmp_path / "out"), str(tmp_path / "state"))
    first = few.read.parquet(str(tmp_path / "out")).count()
    assert 0 < first < 160  # what the watermark hasn't passed waits
    put(few, shuffled[160:], path)
    put(few, [(9999, START, "a", True)], path)  # hours too late
    S.ended(few, F_SCHEMA, "ts", rows[-1][1], path)
    S.run(stream(), str(tmp_path / "out"), str(tmp_path / "state"))
    got = sorted((r.k, r.id, r.rate, r.stop) for r in few.read.parquet(str(tmp_path / "out")).collect())
    assert got == folded(rows, S.rolling_rate) and any(r[3] for r in got)
    S.run(stream(), str(tmp_path / "out"), str(tmp_path / "state"))  # nothing new
    assert few.read.parquet(str(tmp_path / "out")).count() == len(rows)


def test_a_crash_in_the_middle(few, tmp_path):
    path, rows, mended = str(tmp_path / "in"), events(120), str(tmp_path / "mended")
    table = few.createDataFrame(rows, SCHEMA)
    S.fed(table, "ts", path, slices=3)

    def step(state, row):
        import os

        if row[1] == 70 and not os.path.exists(mended):
            raise RuntimeError("a worker is lost")
        return S.breaker(state, row)

    stream = lambda: S.in_order(S.feed(few, path, table.schema), ["k"], "ts", "id", ["bad"], "now long, longest long, stop long", "longest long, stop long", step)
    with pytest.raises(Exception, match="lost"):
        S.run(stream(), str(tmp_path / "out"), str(tmp_path / "state"))
    open(mended, "w").close()
    S.run(stream(), str(tmp_path / "out"), str(tmp_path / "state"))
    assert sorted(tuple(r) for r in few.read.parquet(str(tmp_path / "out")).collect()) == folded(rows, S.breaker)


def test_rules():
    flags = [True] * 60 + [False] + [True] * 3
    state, went = None, []
    for i, bad in enumerate(flags):
        state, out = S.breaker(state, (i, i, bad))
        went += out
    assert went[-1] == (60, 49) and [s for n, s in went if n == 49] == [None]
    state, out = None, []
    for t in (0, 9, 10, 19, 20, 25, 31):
        state, made = S.cached(state, (t, t, 10))
        out += made
    assert out == [(0, False), (9, True), (10, False), (19, True), (20, False), (25, True), (31, False)]
    assert S.pause_over((5, 10)) == 15
    assert S.latest(("a", 3), (0, 0, "b")) == (("b", 4), [("b", 4)])


def test_windows_take_late_rows(few, tmp_path):
    path, rows = str(tmp_path / "in"), events(150)
    rng = random.Random(3)
    late = sorted(rows, key=lambda r: r[1] + dt.timedelta(minutes=rng.uniform(0, 50)))
    for i in range(0, 150, 50):
        put(few, late[i : i + 50], path)
    schema = few.read.parquet(path).schema
    S.ended(few, schema, "ts", rows[-1][1], path)
    counts = S.feed(few, path, schema).withWatermark("ts", "1 hour").groupBy(F.window("ts", "1 hour")).agg(F.count("id").alias("n")).select(F.col("window.start").alias("at"), "n")
    S.run(counts, str(tmp_path / "out"), str(tmp_path / "state"))
    want = few.createDataFrame(rows, SCHEMA).groupBy(F.window("ts", "1 hour")["start"].alias("at")).agg(F.count("*").alias("n"))
    got = few.read.parquet(str(tmp_path / "out")).where("n > 0")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
