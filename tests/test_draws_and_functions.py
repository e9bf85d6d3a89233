"""Seeded draws against the generator itself, functions that SQL calls, blocks before the back matter."""

import random

import pytest
from pyspark.sql import functions as F

from textloom.functions import registered
from textloom.functions import text as T
from textloom.operators import draws
from textloom.operators.chunks import chunks
from textloom.operators.lint import prose_blocks, shared_terms


def test_draws_like_the_generator(spark):
    ids = {"b": [f"b{i:03}" for i in range(300)], "a": [f"a{i:03}" for i in range(50)], "c": ["c0"]}
    rows = [(g, k) for g, ks in ids.items() for k in ks] + [(None, "x"), ("a", None)]
    random.Random(1).shuffle(rows)
    got = draws.drawn(spark.createDataFrame(rows, "journal string, name string").repartition(5), "journal", "name", [120, 60]).collect()
    rng = random.Random(42)
    want = [(g, n, i, name) for n, most in enumerate((120, 60)) for g in sorted(ids) for i, name in enumerate(rng.sample(sorted(ids[g]), min(most, len(ids[g]))))]
    assert sorted((r.journal, r.take, r.place, r.name) for r in got) == sorted(want)
    assert draws.drawn(spark.createDataFrame([], "g string, k string"), "g", "k", [3]).count() == 0


def test_functions_in_sql(spark):
    registered.register(spark)
    row = spark.sql("select tl_doi_id('10.1/A/b') a, tl_normalize_doi('https://doi.org/10.1111/EMIP.70050') b, tl_valid_doi('10.1111/x') c, tl_valid_doi('x') d, tl_query_terms('Ab-c  1') e, tl_excerpt('a  b c d', 4) f, tl_lines('a\nb\nc', 2, 3) g").first()
    assert tuple(row) == ("10.1:a:b", "10.1111/emip.70050", True, False, ["ab", "c", "1"], "a b ...", "b\nc")
    md = "# A\n\nwords of a paragraph that is long enough\n\n## B\n\nand another one that is just as long\n"
    spark.createDataFrame([(1, md), (2, None)], "id long, text string").createOrReplaceTempView("tl_texts")
    got = spark.sql("select id, c.* from tl_texts, lateral chunk_md(tl_texts.text, 2000) c order by id, chunk_no").collect()
    assert [tuple(r)[1:] for r in got if r.id == 1] == [(n, *c) for n, c in enumerate(chunks(md, 2000))]
    got = spark.sql("select id, b.* from tl_texts, lateral lint_blocks(tl_texts.text) b where id = 1 order by line_start").collect()
    assert [tuple(r)[1:] for r in got] == [tuple(b) for b in prose_blocks(md)]


def test_find_phrase(spark):
    registered.register(spark)
    pages = [(d, p, f"Page {p} of  the\nTEST of the test {d}") for d in ("x", "y") for p in range(5)]
    spark.createDataFrame(pages, "doc string, n int, page string").createOrReplaceTempView("tl_pages")
    got = spark.sql("select * from find_phrase(table(select doc, n, page from tl_pages) partition by doc order by (n), 'the test', 3) order by doc, hit").collect()
    assert [(r.doc, r.hit, r.place) for r in got] == [(d, h, p) for d in "xy" for h, p in ((1, 10), (2, 22), (3, 10))]
    assert got[0].snippet == "Page 0 of the TEST of the test x"
    for bad in ("table(select doc from tl_pages), 'x', 3", "table(tl_pages), '', 3"):
        with pytest.raises(Exception, match="find_phrase wants"):
            spark.sql(f"select * from find_phrase({bad})").collect()


@pytest.mark.parametrize("md,want", [
    ("a\n\nb\n\n## References\n\nc", (4, 2, "references")), ("## References\n\na\n\nb\n\nc\n\nd\n\ne", (6, 6, "")), ("a\n\nb\n## Biographies\nc", (4, 2, "biographies")),
    ("## Biographies\n\na\n\nb", (3, 3, "")), ("a\n\n## References\n\nb\n\n## Bibliography 3\n\n## Authors", (5, 3, "references")), (None, (0, 0, "")), ("a\n \t\nb", (2, 2, "")),
])
def test_back_matter(spark, md, want):
    assert tuple(spark.createDataFrame([(md,)], "m string").select(T.back_matter(F.col("m")).alias("x")).select("x.*").first()) == want


def test_whole_rules(spark):
    rng = random.Random(2)
    words = [f"w{i}" for i in range(40)]
    blocks = [(i, sorted({rng.choice(words) for _ in range(rng.randint(0, 60))})) for i in range(80)] + [(900, None)]
    rules = [(i, sorted({rng.choice(words[: rng.choice([8, 40])]) for _ in range(rng.randint(1, 12))})) for i in range(30)] + [(99, words)]
    for least in (0.75, 0.3, 1.0):
        got = shared_terms(spark.createDataFrame(blocks, "k long, t array<string>"), spark.createDataFrame(rules, "rule long, r array<string>"), ["k"], least).collect()
        want = {(k, n): len(set(t) & set(r)) / len(r) for k, t in blocks[:-1] for n, r in rules if len(set(t) & set(r)) / len(r) >= least}
        assert {(r.k, r.rule): r.p for r in got} == {x: round(p, 6) for x, p in want.items()}
