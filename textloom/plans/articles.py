"""TeX and XML articles made of the documents, turned to Markdown; tables put back by number."""

from __future__ import annotations

from pyspark.sql import functions as F

from textloom.functions import sources as S
from textloom.operators.splice import splice
from textloom.plans.markdown import _chain


def t(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def latex_to_md(spark, d):
    """Each document as a TeX file with sections, and from that Markdown."""
    tex = F.concat(F.lit("\\documentclass{article}\n\\begin{document}\n\\section{"), "source", F.lit("}\n\\label{s}\\emph{"), "lang", F.lit("} % note\n"), "text", F.lit("\n\\begin{equation}x\\end{equation}\n\\end{document}\n"))
    return t(spark, d, "documents").select("doc_id", S.tex_to_md(tex).alias("md"))


def xml_to_md(spark, d):
    """Each document as an article of XML, a paragraph a line, and from that Markdown."""
    safe = F.col("text")
    for char, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        safe = F.replace(safe, F.lit(char), F.lit(name))
    body = F.array_join(F.transform(F.split(safe, "\n"), lambda x: F.concat(F.lit("<p>"), x, F.lit("</p>"))), "")
    xml = F.concat(F.lit("<article><front><article-title>"), "source", F.lit("</article-title></front><body><sec><title>"), "lang", F.lit("</title>"), body, F.lit("</sec></body></article>"))
    return t(spark, d, "documents").select("doc_id", S.xml_to_md(xml).alias("md"))


def table_splice(spark, d):
    """Each document with a token after every line, and the turns of the conversation of its id put there by number."""
    lines = F.transform(F.split("text", "\n"), lambda x, i: F.concat(x, F.lit("@@tab"), i.cast("string"), F.lit("@@")))
    texts = t(spark, d, "documents").select("doc_id", F.array_join(lines, "\n").alias("text"))
    groups = t(spark, d, "conversations").select(F.col("conv_id").alias("doc_id"), F.col("turn").alias("number"), F.col("text").alias("body"))
    return splice(texts, groups)


def formula_cleanup(spark, d):
    """Formulas made of the documents' texts, without what their pages left in them."""
    tex = F.concat(F.lit("\\documentclass[12pt]{minimal} \\usepackage{amsmath} \\begin{document}$$ x\\,=\\quad "), F.col("text"), F.lit(" \\;y $$\\end{document}"))
    return t(spark, d, "documents").select("doc_id", S.clean_formula(tex).alias("tex"))


_TEX = "'\\documentclass{article}' || chr(10) || '\\begin{document}' || chr(10) || '\\section{' || source || '}' || chr(10) || '\\label{s}\\emph{' || lang || '} % note' || chr(10) || text || chr(10) || '\\begin{equation}x\\end{equation}' || chr(10) || '\\end{document}' || chr(10)"
ORACLES = {
    "latex_to_md": f"select doc_id, {_chain(_TEX, [(p, q.replace('$$$$', '$$')) for p, q in S.FROM_TEX])} as md from documents",
    "xml_to_md": "with l as (select doc_id, list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(regexp_replace(x, '\\s+', ' ', 'g'))), lambda x: x <> '') as l, source, lang from documents where text is not null) select doc_id, array_to_string(['# ' || source, '## ' || lang] || l, chr(10) || chr(10)) as md from l",
    "formula_cleanup": "select doc_id, trim(regexp_replace('x = ' || text || ' y', '\\s+', ' ', 'g')) as tex from documents",
    "table_splice": "with g as (select conv_id as doc_id, turn, min(text) as body from conversations where text is not null group by all), n as (select doc_id, count(*) as groups, min(turn) as low from g group by 1), l as (select doc_id, unnest(string_split(text, chr(10))) as line, unnest(range(len(string_split(text, chr(10))))) as p from documents), r as (select l.*, body from l left join g on g.doc_id = l.doc_id and turn = p) select doc_id, string_agg(line || coalesce(body, '@@tab' || p || '@@'), chr(10) order by p) as text, count(body) as spliced from r group by 1",
}
QUERIES = {n: globals()[n] for n in ORACLES}
