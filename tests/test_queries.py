"""Every query with SQL against DuckDB on the smallest tables, and text functions on small cases."""

import duckdb
import pytest
from pyspark.sql import functions as F

from textloom.functions import text as T
from textloom.operators import keyed as K
from textloom.plans import catalogue

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    return round(v, 6) if isinstance(v, float) else v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as from '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_against_sql(spark, duck, name):
    df = catalogue.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted((tuple(map(plain, r)) for r in df.select(*cols).collect()), key=repr)
    rel = duck.sql(catalogue.ORACLES[name])
    assert sorted(rel.columns) == cols
    assert got == sorted((tuple(map(plain, r)) for r in rel.select(*[f'"{c}"' for c in cols]).fetchall()), key=repr)


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES.keys() - catalogue.ORACLES.keys()))
def test_without_sql(spark, name):
    df = catalogue.QUERIES[name](spark, SF)
    rows = df.collect()
    assert rows and len(rows[0]) == len(df.columns) == len(set(df.columns))
    if name == "sink_roundtrip":
        assert all(r.same for r in rows), [r.sink for r in rows if not r.same]


def one(spark, value, fn):
    return spark.createDataFrame([(value,)], "v string").select(fn(F.col("v"))).first()[0]


@pytest.mark.parametrize("heading,bucket", [("## 4. Discussion and Concluding Remarks", "discussion"), ("Abstract", "abstract"), ("2.1 Data", "methods"), ("Summary", "abstract"), ("Introduction", "introduction"), ("The Model: theory", "the"), ("A. Proof", "a."), ("", "")])
def test_section(spark, heading, bucket):
    assert one(spark, heading, T.section_of) == bucket


@pytest.mark.parametrize("heading,genre", [("Monte Carlo Study", "simulation"), ("Estimation Results", "results"), ("Empirical Example", "application"), ("Study 2", "application"), ("Model", "method"), ("Simulation Design", "simulation"), ("Notation", "other")])
def test_genre(spark, heading, genre):
    assert one(spark, heading, T.genre_of) == genre


@pytest.mark.parametrize("raw,doi", [("https://doi.org/10.1111/EMIP.70050", "10.1111/emip.70050"), ("doi:10.1016/X", "10.1016/x"), ("10.1000/a%2Fb", "10.1000/a/b")])
def test_doi(spark, raw, doi):
    assert one(spark, raw, T.normalize_doi) == doi


def test_html_page_and_failures(spark):
    assert one(spark, '<p>a</p><script>var t="</p>"</script><!--x-->b', T.clean_html) == "<p>a</p>b"
    assert one(spark, "the reli-\n  ability of\n test scores", T.page_text) == "the reliability of test scores"
    assert one(spark, None, T.error_category) == "unknown"
    assert one(spark, "Docling conversion failed: x", T.error_category) == "docling-pdf-failed"
    assert one(spark, "zzz", T.error_category) == "other:zzz"


def test_multiset_diff(spark):
    a = spark.createDataFrame([(1, x) for x in "aab"], "d int, l string")
    b = spark.createDataFrame([(1, x) for x in "ac"], "d int, l string")
    assert {tuple(r) for r in K.multiset_diff(a, b, ["d", "l"]).collect()} == {(1, "a", 1), (1, "b", 1)}
    assert K.multiset_diff(a, a, ["d", "l"]).count() == 0


def test_quantiles(spark):
    row = spark.range(1).select(F.array(*[F.lit(i) for i in range(1, 11)]).alias("a"))
    assert [row.select(T.quantile(F.col("a"), q)).first()[0] for q in (0.1, 0.25, 0.75, 0.9, 0.99)] == [2, 3, 8, 10, 10]


def test_no_query_hides_another():
    assert sum(len(p.QUERIES) for p in catalogue._PARTS) == len(catalogue.QUERIES)
    assert {"seeded_sample", "seeded_sample_sources"} <= catalogue.QUERIES.keys()
    with pytest.raises(ValueError):
        catalogue.merged([{"a": 1}, {"a": 2}])
