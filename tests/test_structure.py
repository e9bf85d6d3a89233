"""Chunks, ids, readers and the stream on small cases."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.operators import chunks as C
from textloom.operators import keyed as K
from textloom.plans import structure
from textloom.sources import readers


def test_chunks():
    assert C.chunks(None) == C.chunks("") == C.chunks("\n \n") == []
    assert C.chunks("aaaa\n\nbbbb\n\ncccc", 8) == [("", 1, 1, "aaaa"), ("", 3, 3, "bbbb"), ("", 5, 5, "cccc")]
    assert C.chunks("a\n\n## H\nx\n\n| t |\n| u |\n\nb") == [("", 1, 4, "a\n\n## H\nx"), ("", 6, 7, "| t |\n| u |"), ("", 9, 9, "b")]  # a heading is a block of one line
    assert C.chunks("aaaa\n\nbbbb\n\ncccc", 8, True) == [("", 1, 3, "aaaa"), ("", 1, 5, "bbbb"), ("", 1, 5, "cccc")]
    assert [c[3] for c in C.chunks("One two. Three four. Five\n\nsix", 12)] == ["One two.", "Three four.", "Five\n\nsix"]
    assert [c[3] for c in C.chunks("# T\n\naa\n\nbb @@eq0001@@", 7)] == ["# T\n\naa", "bb [formula]"]
    md = "# T\n\nIntro one.\n\n## 2. Methods\n\nAlpha beta.\n\nGamma delta.\n\n| a | b |\n| - | - |\n\nTail."
    want = [("", "# T\n\nIntro one."), ("2. Methods", "## 2. Methods\n\nAlpha beta."), ("2. Methods", "Gamma delta."), ("2. Methods", "| a | b |\n| - | - |"), ("2. Methods", "Tail.")]
    assert [(h, t) for h, _, _, t in C.chunks(md, 30)] == want
    assert [c[1:3] for c in C.chunks(md, 30)] == [(1, 3), (5, 7), (9, 9), (11, 12), (14, 14)]
    assert [c[1:3] for c in C.chunks(md, 30, True)] == [(1, 3), (5, 9), (5, 9), (11, 12), (14, 14)]
    rng = random.Random(1)
    for _ in range(200):
        text = "".join(rng.choice(["ab", ". C", "\n", "\n\n", "## H", "| x |", " "]) for _ in range(rng.randint(0, 60)))
        assert all(len(t) <= 20 or t.startswith("|") or t.startswith("#") or not C._CUT.search(t) for _, _, _, t in C.chunks(text, 20))


def test_running_sums(spark):
    rows = [(None, 5), (7, 1), (10**15, 2), (-3, 4), (8, 0), (None, 1)] + [(i * i * 1009, i) for i in range(300)]
    df = spark.createDataFrame(rows, "k long, v long").repartition(5)
    got = sorted(((r.k is not None, r.k or 0, r.v), r.shard) for r in C.byte_shards(df, "k", F.col("v"), 10).collect())
    ordered, before, want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)), 0, []
    for k, v in ordered:
        if k is not None:
            want.append(((True, k, v), before // 10))
        before += v
    assert [g for g in got if g[0][0]] == sorted(want) and len(got) == len(rows)
    batches = K.numbered_batches(df, "k", 7).groupBy("batch").count().collect()
    assert sorted((r.batch, r["count"]) for r in batches) == [(i, min(7, len(rows) - 7 * i)) for i in range(-(-len(rows) // 7))]
    assert C.byte_shards(df.limit(0), "k", F.col("v"), 10).count() == 0


def fnv(s):
    h = 0xCBF29CE484222325
    for b in s.encode():
        h = (h ^ b) * 0x100000001B3 % (1 << 64)
    h %= 1 << 63
    return h - (1 << 63) if h >> 62 else h


def test_ids(spark):
    names = ["", "a", "é#c001", *map(str, range(40))]
    rows = spark.createDataFrame([(n,) for n in names], "v string").select("v", C.fnv_id(F.col("v")).alias("h")).collect()
    assert {r.v: r.h for r in rows} == {n: fnv(n) for n in names}


def test_readers(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"id": 1}\n\n{"id": 2}\n{"id":')
    schema = T.StructType([T.StructField("id", T.LongType())])
    assert sorted(r.id for r in readers.json_lines(spark, str(tmp_path / "a.jsonl"), schema).collect()) == [1, 2]
    (tmp_path / "t.tsv").write_text('a\t"b\nc\n')
    assert [tuple(r) for r in readers.tab_rows(spark, str(tmp_path / "t.tsv"), ["x", "y"]).collect()] == [("a", '"b'), ("c", None)]
    (tmp_path / "md").mkdir()
    (tmp_path / "md" / "p.q.md").write_text("x\ny\n")
    assert [tuple(r) for r in readers.whole_texts(spark, str(tmp_path / "md")).collect()] == [("p.q", "x\ny\n")]
    (tmp_path / "o.xml").write_text("<l><record><id>7</id></record><record><id>8</id></record></l>")
    assert sorted(r.id for r in readers.records(spark, str(tmp_path / "o.xml"), "record", "id long").collect()) == [7, 8]
    assert readers.blobs(spark, str(tmp_path / "md")).first().length == 4
    readers.write_rows(spark.range(10).coalesce(1), str(tmp_path / "w"), 4)
    assert len(list((tmp_path / "w").glob("*.parquet"))) == 3


def test_chunk_sizes(spark):
    sf = "/root/testdata/sf0.001"
    texts = [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    sizes = sorted(len(c[3]) for t in texts for c in C.chunks(t))
    assert tuple(structure.chunk_size_summary(spark, sf).first()) == (len(sizes), sizes[len(sizes) // 2], sizes[len(sizes) * 95 // 100], sizes[-1])
