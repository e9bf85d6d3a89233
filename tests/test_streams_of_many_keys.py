"""Streams of many keys: what the state holds, feeds of several files a batch, keys with nulls."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from textloom.streaming import stateful as S

START = dt.datetime(2024, 1, 1)
KEYS = 3000


@pytest.fixture
def rocks(spark):
    names = ("spark.sql.shuffle.partitions", "spark.sql.streaming.stateStore.providerClass")
    before = [spark.conf.get(n) for n in names]
    for n, v in zip(names, ("2", S.ROCKS)):
        spark.conf.set(n, v)
    yield spark
    for n, v in zip(names, before):
        spark.conf.set(n, v)


def table(spark):
    """Two rows a key, ten minutes apart, and one three days later."""
    at = F.lit(START) + F.make_dt_interval(mins=F.col("id") % 600 + F.when(F.col("id") < 2 * KEYS, F.col("id") % 2 * 10).otherwise(4320))
    return spark.range(3 * KEYS).select("id", at.alias("ts"), (F.floor(F.col("id") / 2) % KEYS).alias("k"), F.lit(30 * 60_000_000).cast("long").alias("ttl"))


def test_state_of_many_keys(rocks, tmp_path, monkeypatch):
    """A key costs no call of its own: the state has as many rows as groups, two and a few; a batch is as many files as a slice has; what is over goes."""
    monkeypatch.setattr(S, "FILE_ROWS", 1000)
    rows, path = table(rocks), str(tmp_path / "in")
    files = S.fed(rows, "ts", path, slices=2)
    assert files == 3
    stream = S.in_order(S.feed(rocks, path, rows.schema, files), ["k"], "ts", "id", ["ttl"], "at long, ttl long", "id long, cached boolean", S.cached, S.pause_over)
    query = stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start(str(tmp_path / "out"))
    query.awaitTermination()
    held = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress]
    assert 0 < max(held) <= 3 * S.GROUPS < KEYS and held[-1] == 0
    state, want = {}, []
    for i, ts, k, ttl in sorted(map(tuple, rows.collect()), key=lambda r: (r[1], r[0])):
        state[k], made = S.cached(state.get(k), (int((ts - START).total_seconds() * 1_000_000), i, ttl))
        want += [(k, *m) for m in made]
    got = sorted(map(tuple, rocks.read.parquet(str(tmp_path / "out")).collect()))
    assert got == sorted(want) and {c for _, _, c in got} == {False, True}


def test_large_ids_beside_nulls(rocks, tmp_path):
    """A mark's nulls make no floats of the ids that come with it."""
    big, path = 2**60 + 1, str(tmp_path / "in")
    rows = rocks.createDataFrame([(big + i, START + dt.timedelta(minutes=i), big, "x") for i in range(5)], "id long, ts timestamp, k long, e string")
    last = rocks.createDataFrame([(None, START + dt.timedelta(days=9), None, None)], rows.schema)
    rows.unionByName(last).coalesce(1).write.parquet(path)
    S.ended(rocks, rows.schema, "ts", START + dt.timedelta(days=9), path)
    S.run(S.in_order(S.feed(rocks, path, rows.schema), ["k"], "ts", "id", ["e"], "state string, n long", "state string, n long", S.latest), str(tmp_path / "out"), str(tmp_path / "state"))
    assert sorted(map(tuple, rocks.read.parquet(str(tmp_path / "out")).collect())) == [(big, "x", n) for n in range(1, 6)]
