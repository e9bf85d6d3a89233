"""Inputs that queries met on larger tables."""

from pyspark.sql import functions as F

from textloom.operators import lint
from textloom.plans import style


def test_likelihoods_round_as_in_sql(spark):
    """printf rounds the binary value: 0.825 lies below the middle, 0.875 on it."""
    rows = [(0.825, "0.82"), (0.875, "0.88"), (0.765, "%.2f" % 0.765), (0.785, "%.2f" % 0.785), (0.995, "0.99"), (1.0, "1.00")]
    hits = spark.createDataFrame([(i, 1, 1, "t", 7, "x", p) for i, (p, _) in enumerate(rows)], "doc_id long, start int, end int, text string, rule long, instruction string, p double")
    got = {r.doc_id: r.lines.split("\n")[2] for r in lint.rendered(hits, "d", ["doc_id"]).collect()}
    assert got == {i: f"  R07  p={text}  x" for i, (_, text) in enumerate(rows)}


def test_paragraphs_without_a_sentence(spark, tmp_path):
    """Eight words and more, but no sentence of three: a paragraph without a closing sentence."""
    rows = [(1, 1, "user", "One two. Three four! Five six? Seven eight. Nine ten."), (1, 2, "user", "Some words come first here and then more. However it ends."), (2, 1, "assistant", None)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    assert [tuple(r) for r in style.closing_sentences(spark, str(tmp_path)).collect()] == [("user", 2, 1)]
