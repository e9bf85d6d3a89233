"""Scans of a database file by partitions with filters, and statement files that appear whole or not at all."""

import datetime as dt
import decimal
import sqlite3

import pytest
from pyspark.sql import functions as F

from textloom.sources import database as D


@pytest.fixture
def papers(tmp_path):
    path = str(tmp_path / "p.db")
    with sqlite3.connect(path) as db:
        db.execute("create table papers (doi text primary key, year int, score real, raw blob, state varchar(9))")
        db.executemany("insert into papers values (?, ?, ?, ?, ?)", [(f"10.1/{i:04}", None if i % 7 == 0 else 1990 + i % 30, i / 4, bytes([i % 256]), "o'k" if i % 2 else None) for i in range(1000)])
        db.execute("delete from papers where rowid between 300 and 600")
        db.execute("create table none (a int)")
    return path


def test_scan(spark, papers):
    df = D.scan(spark, papers, "papers", 6)
    assert df.schema.simpleString() == "struct<doi:string,year:bigint,score:double,raw:binary,state:string>"
    assert df.rdd.getNumPartitions() == 6 and df.count() == 699
    with sqlite3.connect(papers) as db:
        for where in ("year >= 2000 and year < 2005", "year in (1991, 1999)", "year is null", "state = 'o''k' and score > 200.5", "doi like '10.1/00%'", "state is not null and doi <= '10.1/0100'", "year % 2 = 1"):
            want = sorted(db.execute(f"select doi, score from papers where {where}").fetchall())
            assert sorted(map(tuple, df.where(where).select("doi", "score").collect())) == want, where
    assert D.scan(spark, papers, "none").count() == 0
    with pytest.raises(Exception, match="no table"):
        D.scan(spark, papers, "absent")


def test_filters_go_down(papers):
    reader = D.DatabaseReader(papers, "papers", ["doi"], 2)
    left = list(reader.pushFilters([D.EqualTo(("year",), 2000), D.In(("state",), ("a", "b")), D.EqualTo(("nested", "year"), 1), D.StringStartsWith(("doi",), "10.1/00")]))
    assert [f.attribute for f in left] == [("nested", "year")]
    assert reader.statement().endswith('where rowid between ? and ? and "year" = ? and "state" in (?, ?) and substr("doi", 1, ?) = ?')
    assert reader.partitions() == [D.Rows(1, 500), D.Rows(501, 1000)]
    with pytest.raises(ValueError):
        D.local("hdfs://store/p.db")


def test_statements(spark, tmp_path):
    out, db = str(tmp_path / "sql"), str(tmp_path / "o.db")
    with sqlite3.connect(db) as con:
        con.execute("create table t (k integer primary key, v text, x real, b blob, d text, m text)")
    odd = ["it's", "two;\nlines;\n", "", None, "é日🙂", "');--\n"]
    rows = [(i, odd[i % 6], i / 3, bytes([i % 256, 0]), dt.datetime(2024, 1, 1, i % 24), decimal.Decimal("1.50")) for i in range(530)]
    df = spark.createDataFrame(rows, "k int, v string, x double, b binary, d timestamp, m decimal(4,2)").repartition(4)
    D.write_statements(df, out, "t")
    files = sorted((tmp_path / "sql").iterdir())
    assert len(files) == 4 and all(f.name.startswith("part-") for f in files)
    assert D.applied(out, db) == sum(-(-f.read_text().count("\n(") // 50) for f in files)
    with sqlite3.connect(db) as con:
        got = con.execute("select k, v, x, b, d, m from t order by k").fetchall()
    assert [r[:4] for r in got] == [r[:4] for r in rows] and got[5][4] == "2024-01-01 05:00:00"
    again = df.where("k < 60").withColumn("v", F.lit("new"))
    D.write_statements(again, str(tmp_path / "ignore"), "t", True)
    D.applied(str(tmp_path / "ignore"), db)
    with sqlite3.connect(db) as con:
        assert con.execute("select count(*) from t where v = 'new'").fetchone() == (0,)
    D.write_statements(again, str(tmp_path / "replace"), "t", False)
    D.applied(str(tmp_path / "replace"), db)
    with sqlite3.connect(db) as con:
        assert con.execute("select count(*), count(case when v = 'new' then 1 end) from t").fetchone() == (530, 60)


def test_a_killed_task_leaves_nothing(spark, tmp_path):
    out = str(tmp_path / "sql")
    D.write_statements(spark.range(10), out, "t")
    before = sorted(p.name for p in (tmp_path / "sql").iterdir())
    bad = spark.range(0, 400, 1, 4).withColumn("id", F.expr("case when id = 390 then cast(raise_error('killed') as bigint) else id end"))
    with pytest.raises(Exception, match="killed"):
        D.write_statements(bad, out, "t")
    assert sorted(p.name for p in (tmp_path / "sql").iterdir()) == before
    D.write_statements(spark.range(3), out, "t", mode="overwrite")
    assert sum(p.read_text().count("(") - 1 for p in (tmp_path / "sql").iterdir() if p.read_text()) == 3
