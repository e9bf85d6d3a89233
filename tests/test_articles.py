"""TeX, XML and splices on small cases."""

from pyspark.sql import functions as F

from textloom.functions import sources as S
from textloom.operators import lint
from textloom.operators.equations import equation_splice
from textloom.operators.gates import gate_diff
from textloom.operators.splice import splice


def one(spark, value, fn):
    return spark.createDataFrame([(value,)], "v string").select(fn(F.col("v"))).first()[0]


def test_tex(spark):
    tex = "\\documentclass{a}\n\\begin{document}\n\\section{A}\\label{s} \\textbf{b} \\emph{c} 5\\% % gone\n\\begin{itemize}\\item x\n\\item y\\end{itemize}\n\\begin{equation}z\\end{equation}\\cite{k}\n\\end{document} tail"
    assert one(spark, tex, S.tex_to_md) == "## A\n\n**b** *c* 5%\n\n- x\n\n- y\n\n$$\nz\n$$\n\n[k]"
    assert one(spark, None, S.tex_to_md) is None and one(spark, "", S.tex_to_md) == ""


def test_xml(spark):
    xml = "<article><front><article-title>T</article-title></front><body><sec><title>A</title><p>x <bold>y</bold>\n z</p><sec><title>B</title><list><list-item><p>i</p></list-item><list-item>j</list-item></list><disp-formula>$a$</disp-formula><table><tr><th>h</th></tr><tr><td>c|d</td></tr></table></sec></sec></body></article>"
    want = "# T\n\n## A\n\nx **y** z\n\n### B\n\n- i\n- j\n\n$$\na\n$$\n\n| h |\n| - |\n| c\\|d |"
    assert S.article_md(xml) == want and one(spark, xml, S.xml_to_md) == want
    assert one(spark, None, S.xml_to_md) is None and one(spark, "<a>", S.xml_to_md) is None and one(spark, "", S.xml_to_md) is None


def test_splice(spark):
    texts = [(1, "a@@tab01@@b@@tab02@@"), (2, "@@tab5@@x@@tab6@@"), (3, "@@tab5@@x"), (4, "plain"), (5, None), (6, ""), (7, "@@tab1@@@@tab1@@")]
    groups = [(1, 2, "two"), (1, 9, "nine"), (2, 1, "p"), (2, 2, "q"), (3, 1, "p"), (3, 2, "q"), (4, 1, "p"), (7, 1, "y"), (7, 1, "x"), (None, 1, "z"), (1, None, "z"), (1, 1, None)]
    a, b = spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(groups, "doc_id long, number int, body string")
    got = {r.doc_id: (r.text, r.spliced) for r in splice(a, b).collect()}
    assert got == {1: ("a@@tab01@@btwo", 1), 2: ("pxq", 2), 3: ("@@tab5@@x", 0), 4: ("plain", 0), 5: (None, 0), 6: ("", 0), 7: ("xx", 2)}
    assert splice(a.limit(0), b).count() == 0


def test_jats_parts():
    xml = '<article xmlns:x="http://www.w3.org/1999/xlink"><front><article-meta><article-title>T</article-title><summary><p>s</p></summary></article-meta></front><body><sec><label>1</label><title>A</title><fig><label>Fig 1</label><caption><p>c</p></caption><graphic x:href="f.png"/></fig><code>a\n b</code><list list-type="order"><list-item><p>i</p></list-item></list><table-wrap><label>Tab 1</label><table id="t"><tr><td colspan="2">x</td></tr></table></table-wrap></sec></body><back><ref-list><title>R</title></ref-list></back></article>'
    assert S.article_md(xml) == "# T\n\n## Summary\n\ns\n\n## 1 A\n\n![Fig 1 c](f.png)\n\n```\na\n b\n```\n\n1. i\n\n**Tab 1** (table t)"


def test_equations(spark):
    texts = [(1, "a @@eq0001@@ b\n@@eq0002@@\nc"), (2, "@@eq1@@ @@eq2@@"), (3, "@@eq1@@"), (4, "none"), (5, None), (6, "x @@eq2@@")]
    read = [(1, 1, "ok", "p"), (1, 2, "ok", "q"), (2, 1, "ok", "p"), (2, 2, "failed", None), (3, 9, "ok", "z"), (4, 1, "ok", "z"), (6, 2, "ok", "b"), (6, 2, "ok", "a")]
    a, b = spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(read, "doc_id long, number int, state string, tex string")
    got = {r.doc_id: (r.text, r.spliced, r.kept) for r in equation_splice(a, b).collect()}
    assert got == {1: ("a $p$ b\n$$q$$\nc", 2, 0), 2: ("$p$ @@eq2@@", 1, 1), 3: ("@@eq1@@", 0, 0), 4: ("none", 0, 0), 5: (None, 0, 0), 6: ("x $a$", 1, 0)}


def test_gate(spark):
    old = {1: "a\nb", 2: "x \ny", 3: "![C](10.1111:j-fig01)", 4: "old prose", 5: "![A](10.1:x-fig1)\n![B](10.1:x-tab1)", 6: "| a |\n**Table 1.** t", 7: "![A](10.1:x-fig1)"}
    new = {1: "a\nb", 2: "x\ny", 3: "![C](fig01)", 4: "new prose", 5: "![B](tab9)\n\n![A](fig9)", 6: "![T](tab1)", 7: "![Z](fig9)"}
    frame = lambda d: spark.createDataFrame(list(d.items()), "doc_id long, text string")
    got = {r.doc_id: (r.whitespace, r.renamed, r.rest, r["pass"]) for r in gate_diff(frame(old), frame(new), True).collect()}
    assert got == {1: (0, 0, "identical", True), 2: (1, 0, "explained", True), 3: (0, 1, "explained", True), 4: (0, 0, "unexpected", False), 5: (0, 0, "ref-layout", True), 6: (0, 0, "splice-revert", True), 7: (0, 0, "unexpected", False)}
    assert {r.doc_id: r.rest for r in gate_diff(frame(old), frame(new)).collect()}[6] == "unexpected"


def test_lint_blocks():
    long = "words of a paragraph that is long enough"
    md = f"---\nt: x\n---\n# Abstract {{#a}}\n{long}\nand more\n\n- {long}\n  goes on\n- short\n```\n{long}\n\n{long}\n```\n> {long}\n\n| {long} |\n\n$$\n{long}\n$$\n\n::: div\n{long}\n\n## References\n{long}\n## M ##\n1. {long}\ntail of it\n\n{long}"
    got = lint.prose_blocks(md)
    assert [b[:4] for b in got] == [(5, 6, "abstract", "abstract"), (8, 9, "Abstract", "list"), (30, 31, "M", "list"), (33, 33, "M", "body")]
    assert got[0][4] == f"{long}\nand more" and lint.prose_blocks(None) == lint.prose_blocks("") == []


def test_rules():
    text = "# c\n12:\n  section: results\n  before: 'a: b'\n  after: null\n  judgement: >-\n    one\n    two: three\n3:\n  lesson: l\n"
    assert lint.parsed_rules(text) == [(3, *[None] * 7, "l"), (12, None, "results", None, "a: b", None, None, "one two: three", None)]
    try:
        lint.parsed_rules("1:\n  before: x\n")
        raise AssertionError
    except ValueError:
        pass
