"""Markdown, repairs, keys and classes on small cases."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from textloom.functions import markup as M


def one(spark, value, fn):
    return spark.createDataFrame([(value,)], "v string").select(fn(F.col("v"))).first()[0]


def test_html_to_md(spark):
    html = '<html><head><title>x</title></head><body><h1>A &amp; B</h1><p>one <b>two</b>\n three<br>four</p><ul><li>i</li><li>j</li></ul><a class="k" href="u">l</a><script>p("</p>")</script></body></html>'
    assert one(spark, html, M.html_to_md) == "# A & B\n\none **two** three\nfour\n\n- i\n- j\n\n[l](u)"
    assert one(spark, "", M.html_to_md) == "" and one(spark, None, M.html_to_md) is None


def test_heading_levels(spark):
    rows = spark.createDataFrame(list(enumerate(["1 Intro", "1.1 A", "1.1.1 B", "Discussion", "2.1.1 X"])), "p long, h string")
    out = rows.withColumn("level", M.clamped_level(M.heading_depth(F.col("h")), F.col("p"), Window.orderBy("p")))
    assert [r.level for r in out.orderBy("p").collect()] == [2, 3, 4, 2, 3]


@pytest.mark.parametrize("text,want", [
    ("The e ect", ("The effect", 0, 0, 0, 1)), ("di erent", ("different", 0, 0, 0, 1)), ("an e ect", ("an e ect", 0, 0, 0, 0)), ("ﬁt", ("fit", 0, 0, 1, 0)),
    ("o\ue000er \ue123", ("offer \ue123", 1, 1, 0, 0)), ("", ("", 0, 0, 0, 0)), (None, (None, 0, 0, 0, 0)),
])
def test_ligatures(spark, text, want):
    assert M.mend(text) == want
    assert tuple(one(spark, text, M.ligatures)) == want


@pytest.mark.parametrize("name,want", [("José Schönenberger Jr.", ("schonenberger", "j")), ("Plato", ("plato", "")), ("", None), (None, None), ("L. S. Feldt III", ("feldt", "l")), ("van der Linden", ("linden", "v"))])
def test_name_key(spark, name, want):
    got = one(spark, name, M.name_key)
    assert (tuple(got) if got else got) == want


@pytest.mark.parametrize("kind,status,size,head,want", [
    ("xml", 403, 0, "", "blocked"), ("xml", 200, 30000, "<article>", "ok"), ("xml", 200, 5000, "<article>", "absent"), ("xml", 404, 0, "", "absent"),
    ("pdf", 404, 0, "", "fail"), ("pdf", 200, 90000, "<html>", "error"), ("pdf", 200, 90000, "%PDF-1.4", "ok"), ("pdf", 200, 90, "Just a moment", "blocked"),
])
def test_response_class(spark, kind, status, size, head, want):
    row = spark.range(1).select(M.response_class(F.lit(kind), F.lit(status), F.lit(size), F.lit(head), F.lit(False)))
    assert row.first()[0] == want
