"""Keyed tables: replays, crashes before and after a commit, keys that come again, reloads, adopted papers and failures."""

import pytest
from pyspark.sql import functions as F

from textloom.sources.keyed_table import IGNORE, RELOAD, REPLACE, KeyedTable
from textloom.streaming import ingest as I
from textloom.streaming import stateful as S

SCHEMA = "k string, at timestamp, v int"


def rows(spark, *items):
    return spark.createDataFrame(list(items), "k string, at string, v int").withColumn("at", F.col("at").cast("timestamp"))


def held(table):
    return sorted((r.k, r.v) for r in table.read().collect())


def test_merges_and_replays(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), SCHEMA, ["k"], 4)
    assert held(table) == []
    first = rows(spark, ("a", "2024-01-01", 1), ("b", "2024-01-01", 2), ("a", "2023-01-01", 3), (None, "2024-01-01", 9))
    assert table.merge(first, 0, IGNORE, ["at"]) and held(table) == [("a", 3), ("b", 2)]
    assert not table.merge(rows(spark, ("z", "2024-01-01", 1)), 0)  # the ledger knows the number
    assert table.merge(rows(spark, ("a", "2030-01-01", 8), ("c", "2024-01-01", 4)), 1) and held(table) == [("a", 3), ("b", 2), ("c", 4)]
    assert table.merge(rows(spark, ("a", "2030-01-01", 8), ("a", "2031-01-01", 9)), 2, REPLACE, ["-at"]) and held(table) == [("a", 9), ("b", 2), ("c", 4)]
    assert table.merge(rows(spark, ("a", "2030-01-01", 1), ("a", "2031-01-01", 2)), 7, RELOAD) and held(table) == [("a", 1), ("a", 2), ("b", 2), ("c", 4)]
    assert table.merge(rows(spark).limit(0), 8, RELOAD) and table.commits() == [0, 1, 2, 7, 8]
    assert table.vacuum() > 0 and held(table) == [("a", 1), ("a", 2), ("b", 2), ("c", 4)]


@pytest.mark.parametrize("how", [IGNORE, REPLACE, RELOAD])
def test_a_crash_between_write_and_commit(spark, tmp_path, how, monkeypatch):
    table = KeyedTable(spark, str(tmp_path / "t"), SCHEMA, ["k"], 2)
    table.merge(rows(spark, ("a", "2024-01-01", 1)), 0, how)
    with monkeypatch.context() as m:
        m.setattr(table, "_commit", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            table.merge(rows(spark, ("b", "2024-01-01", 2), ("a", "2024-01-02", 5)), 1, how)
    assert held(table) == [("a", 1)]  # nothing has taken effect
    assert table.merge(rows(spark, ("b", "2024-01-01", 2), ("a", "2024-01-02", 5)), 1, how)
    assert held(table) == [("a", 1 if how == IGNORE else 5), ("b", 2)]


def test_ingest_takes_a_key_once(spark, tmp_path):
    """The same file twice, and a key that comes again two days later."""
    src, at = str(tmp_path / "in"), str(tmp_path / "at")
    table = KeyedTable(spark, str(tmp_path / "t"), SCHEMA, ["k"])
    for part in ([("a", "2024-01-01", 1), ("b", "2024-01-01", 2)], [("a", "2024-01-01", 1), ("b", "2024-01-01", 2)], [("a", "2024-01-03", 7), ("c", "2024-01-03", 3)]):
        rows(spark, *part).coalesce(1).write.mode("append").parquet(src)
        I.ingest(spark, src, "k", "at", table, at)
    assert held(table) == [("a", 1), ("b", 2), ("c", 3)]


def test_a_batch_that_stops_is_done_again(spark, tmp_path, monkeypatch):
    """The second table of a batch fails after the first has committed; the run after it ends with each row once."""
    schema = "paper string, format string, stamp timestamp, digest string, failure string"
    part = lambda *items: spark.createDataFrame(list(items), schema.replace("timestamp", "string")).withColumn("stamp", F.col("stamp").cast("timestamp"))
    src, at = str(tmp_path / "in"), str(tmp_path / "at")
    made = I.Manifest(spark, str(tmp_path / "tables"), 4)
    made.listed(spark.createDataFrame([("p1",)], "paper string"))
    made.listed(spark.createDataFrame([("p1",)], "paper string"))  # the same list again
    first = part(("p1", "pdf", "2024-01-02", "new", None), ("p1", "pdf", "2024-01-01", "old", None), ("p2", "xml", "2024-01-01", "x", None), ("p3", "pdf", "2024-01-01", None, "timeout"), (None, "pdf", "2024-01-01", "q", None))
    first.coalesce(1).write.parquet(src)
    with monkeypatch.context() as m:
        m.setattr(made.sources, "merge", lambda *a, **b: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(Exception, match="lost"):
            made.run(S.feed(spark, src, first.schema), at)
    assert made.papers.commits() == [-1, 0] and made.sources.commits() == []
    made.run(S.feed(spark, src, first.schema), at)
    part(("p1", "pdf", "2023-01-01", "older", None), ("p3", "pdf", "2024-02-01", "ok", None), ("p3", "pdf", "2024-01-01", None, "timeout")).coalesce(1).write.mode("append").parquet(src)
    made.run(S.feed(spark, src, first.schema), at)
    assert sorted(map(tuple, made.papers.read().collect())) == [("p1", "listed"), ("p2", "adopted"), ("p3", "adopted")]
    assert sorted((r.paper, r.format, r.digest) for r in made.sources.read().collect()) == [("p1", "pdf", "new"), ("p2", "xml", "x"), ("p3", "pdf", "ok")]
    assert [(r.paper, r.failure) for r in made.failures.read().collect()] == [("p3", "timeout")]
