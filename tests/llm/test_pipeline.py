"""The pipeline over small tables: odd rows, empty tables, and each stage by itself."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from textloom.llm import pieces

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """A folder with documents and labels: those of the smallest tables with nulls, empty texts, repeated rows and a column more."""
    base = str(tmp_path_factory.mktemp("odd"))
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(None, "no id but some more words than ten stand here in this text", None, None, None), (10**9, None, "en", "src0", 0), (10**9 + 1, "", "en", "src0", 0), (10**9 + 2, " ".join(f"Word{i} and more." for i in range(30000)), "en", None, 1)], docs.schema)
    docs = docs.unionByName(docs.where("doc_id % 7 = 0")).unionByName(odd).withColumn("score", F.lit("clash"))
    docs.coalesce(2).write.parquet(f"{base}/documents.parquet")
    spark.read.parquet(f"{SF}/labels.parquet").write.parquet(f"{base}/labels.parquet")
    return base


def test_every_stage(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet").cache()
    columns, before = docs.columns, docs
    key = [c for c in columns if c != "score"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, tables).cache()
        assert after.columns == columns and after.exceptAll(before).isEmpty(), name  # rows as they are, none more often than before
        assert 0 < after.count() <= before.count(), name
        if name == "near_copies":
            ids = after.where("doc_id is not null").groupBy("doc_id").count()
            assert ids.where("count > 1").isEmpty()
            texts = after.where("length(text) > 0").select(F.lower("text").alias("text"))
            assert texts.distinct().count() == texts.count()
        if name == "mixing":
            assert after.where("text is null or text = ''").isEmpty()
        before = after
    assert key and [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "quality", "near_copies", "mixing", "encoding"]


def test_run_and_empty_tables(spark, tables, tmp_path):
    import sentencepiece

    out = corpus_pipeline.run(spark, tables).collect()
    coder = sentencepiece.SentencePieceProcessor(model_file=pieces.model_path())
    for r in out[:40]:
        assert list(r.piece_ids) == coder.encode(r.text, add_eos=True)
    docs, labels = (spark.read.parquet(f"{tables}/{n}.parquet") for n in ("documents", "labels"))
    for name, d, l in (("none", docs.limit(0), labels.limit(0)), ("unlabelled", docs, labels.limit(0)), ("labels", docs.limit(0), labels)):
        d.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        l.write.parquet(f"{tmp_path}/{name}/labels.parquet")
        got = corpus_pipeline.run(spark, f"{tmp_path}/{name}")
        assert set(docs.columns) < set(got.columns) and (got.count() > 0) == (name == "unlabelled")
