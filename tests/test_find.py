"""Substring find in stored pages against a reading of every page."""

import random
import re

import pytest

from textloom.operators import find as F

PAGES = [
    (1, "The reli-\nability of the  test scores. The reliability of the test scores."), (2, "test of scores and the long, long reliability"), (3, "scores test reliability the of"), (4, None), (5, ""), (6, "aaaaaaa aab"),
    (7, "unreliable pre-test (scored) é日本 x"), (8, "a b c a b c"), (9, "ΑΒΓ straße É"), (10, "scoresheet\ttestify"), (None, "scores"),
]


def brute(pages, questions):
    norm = lambda s: re.sub(r"\s+", " ", re.sub(r"(\w)-\s*\n\s*", r"\1", s)).strip()
    pages = sorted((d, norm(t)) for d, t in pages if d is not None and t is not None)
    out = []
    for item, text in questions:
        q = norm(text or "").lower()
        hits = []
        for d, page in pages:
            at = page.lower().find(q) if q else -1
            while at >= 0:
                hits.append((d, at))
                at = page.lower().find(q, at + len(q))
        if hits:
            out += [(item, "phrase", i + 1, *h) for i, h in enumerate(hits[:8])]
            continue
        words = [w for w in dict.fromkeys(re.split("[^a-z0-9]+", q)) if len(w) > 1]
        loose = []
        for d, page in pages:
            low = page.lower()
            if words and all(w in low for w in words):
                first, last = min(low.find(w) for w in words), max(low.rfind(w) + len(w) for w in words)
                loose.append((last - first, d, first))
        out += [(item, "words", i + 1, d, first) for i, (_, d, first) in enumerate(sorted(loose)[:8])]
    return sorted(out)


QUESTIONS = [
    "Reliability of the test", "scores reliability test", "absent words", "", None, "liab", "a", "aa", "b c", "est sco", "-", "é日", "(scored)", "core test", "of", "SCORES", "x y", "c a b", "test scores the", "ß", "zz", "  ", "e\nr", "re sc te", "aab aaaa",
]


def test_find(spark, tmp_path):
    held = F.PageIndex.build(spark.createDataFrame(PAGES, "doc_id long, text string"), str(tmp_path / "p"), 4, 2)
    questions = list(enumerate(QUESTIONS))
    asked = spark.createDataFrame(questions, "item_id long, text string")
    got = held.find(asked).collect()
    assert sorted((r.item_id, r.mode, r["rank"], r.doc_id, r.place) for r in got) == brute(PAGES, questions)
    assert next(r.snippet for r in got if r.item_id == 0) == "The reliability of the test scores. The reliability of the test scores."
    assert held.find(asked.limit(0)).count() == 0


def test_random_texts(spark, tmp_path):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcé") for _ in range(rng.randint(1, 4)))
    pages = [(i, " ".join(word() for _ in range(rng.randint(0, 25)))) for i in range(120)]
    questions = [(i, " ".join(word() for _ in range(rng.randint(1, 4)))) for i in range(60)] + [(100 + i, (pages[i][1] or "x")[2:12]) for i in range(40)]
    held = F.PageIndex.build(spark.createDataFrame(pages, "doc_id long, text string"), str(tmp_path / "p"), 4, 16)
    got = held.find(spark.createDataFrame(questions, "item_id long, text string")).collect()
    assert sorted((r.item_id, r.mode, r["rank"], r.doc_id, r.place) for r in got) == brute(pages, questions)
    assert {r.mode for r in got} == {"phrase", "words"}


def test_empty_pages_and_what_is_read(spark, tmp_path):
    empty = F.PageIndex.build(spark.createDataFrame([], "doc_id long, text string"), str(tmp_path / "e"), 2)
    asked = spark.createDataFrame([(1, "one word")], "item_id long, text string")
    assert empty.find(asked).count() == 0
    held = F.PageIndex.build(spark.createDataFrame([(i, f"page{i} word") for i in range(50)], "doc_id long, text string"), str(tmp_path / "p"), 8)
    read = held.read(spark.createDataFrame([(1, 7)], "item_id long, doc_id long"), asked)
    assert "PartitionFilters" in (plan := read._jdf.queryExecution().executedPlan().toString()) and re.search(r"PartitionFilters: \[[^\]]*\(bucket#\d+ = \d\)", plan)
    assert [r.page for r in read.collect()] == ["page7 word"]


@pytest.mark.parametrize("piece,grams", [("ab", {"a", "b", "ab"}), ("abcd", {"a", "b", "c", "d", "ab", "bc", "cd", "abc", "bcd"}), ("", set()), ("é日", {"é", "日", "é日"})])
def test_grams(spark, piece, grams):
    from pyspark.sql import functions as C

    assert set(spark.createDataFrame([(piece,)], "p string").select(F.grams_of(C.col("p"))).first()[0]) == grams
