"""Style and structure statistics, text functions and page queries."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from textloom.functions import text as T


def t(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def doc_md_stats(spark, d):
    """Size, headings, marks and flags of each document as Markdown."""
    x = t(spark, d, "documents").select("doc_id", T.md_stats(F.col("text")).alias("x")).select("doc_id", "x.*")
    return x.withColumn("flags", F.array_join("flags", "|"))


def lines_to_blocks(spark, d):
    """Runs of lines that hold text, numbered in order with their first and last line: one pass over a document's lines."""
    zero = F.struct(F.array().cast("array<struct<start:bigint,end:bigint>>").alias("done"), F.lit(0).cast("long").alias("at"), F.lit(0).cast("long").alias("start"))
    close = lambda s: F.when(s["start"] > 0, F.array_append(s["done"], F.struct(s["start"].alias("start"), s["at"].alias("end")))).otherwise(s["done"])

    def step(s, line):
        held, at = F.trim(line) != "", s["at"] + 1
        return F.struct(F.when(held, s["done"]).otherwise(close(s)).alias("done"), at.alias("at"), F.when(~held, F.lit(0)).when(s["start"] > 0, s["start"]).otherwise(at).alias("start"))

    runs = F.aggregate(F.split("text", "\n"), zero, step, close)
    x = t(spark, d, "documents").select("doc_id", F.posexplode(runs).alias("n", "b"))
    return x.select("doc_id", (F.col("n") + 1).alias("block"), "b.start", "b.end", (F.col("b.end") - F.col("b.start") + 1).alias("n_lines"))


def section_buckets(spark, d):
    """Buckets and genres of the pages' headings, with a number before them."""
    h = F.regexp_extract("html", r"(?s)<h1>(.*?)</h1>", 1)
    return t(spark, d, "pages").select("page_id", T.section_of(F.concat(F.lit("## 2.1 "), h)).alias("section"), T.genre_of(h).alias("genre"))


def clean_html(spark, d):
    return t(spark, d, "pages").select("page_id", T.clean_html(F.col("html")).alias("html"))


def html_coverage(spark, d):
    """Marks of formulas, figures and tables, and words of the body, from its first section to the references; more than 1,500 words are full text.

    Pages have no sections here: their article is taken as one, and some get marks and a list of references.
    """
    made = F.concat(F.replace("html", F.lit("<article"), F.lit("<section")), F.when(F.col("page_id") % 2 == 0, '<div class="tex-math"></div><div class="fig-ada">').otherwise(""), F.when(F.col("page_id") % 3 > 0, '<ol id="references">').otherwise(""))
    start, end = F.position(F.lit("<section"), F.col("h")) - 1, F.position(F.lit('id="references"'), F.col("h")) - 1
    # Where a mark is missing its place is the one before the last character.
    size = F.length("h")
    a, b = F.when(start < 0, size - 1).otherwise(start), F.when(end < 0, size - 1).otherwise(end)
    body = F.when(b > a, F.substring(F.col("h"), a + 1, b - a)).otherwise("")
    n = lambda p: F.regexp_count("h", F.lit(p)).cast("long")
    x = t(spark, d, "pages").select("page_id", made.alias("h"))
    x = x.select("page_id", n('class="tex-math').alias("tex_math"), n('class="fig-ada"').alias("figures"), n("table-wrap-ada").alias("tables"), F.size(F.split(F.regexp_replace(body, "<[^>]+>", " "), r"\s+", -1)).cast("long").alias("words"))
    return x.withColumn("fulltext", F.col("words") > 1500)


def listing_links(spark, d):
    """Papers of listing pages: the year of their block, address, title and the DOI that stands before the next link; one without a DOI is none, and of one DOI's the first counts."""
    link = lambda x, i: F.concat(F.when(i % 3 == 0, F.concat(F.lit('<h2 aria-label="Toggle visibility for '), (F.lit(2000) + i).cast("string"), F.lit(" - Volume "), i.cast("string"), F.lit('">'))).otherwise(""), F.lit('<a class="part-link" href="'), x, F.lit('"><b> Paper</b>\n'), x, F.lit("</a><i>"), F.when(i % 2 == 0, F.concat(F.lit('<span data-doi="10.1234/X'), x, F.lit('">'))).otherwise(""))
    made = F.array_join(F.transform(F.regexp_extract_all("html", F.lit(r'<a href="([^"]*)"'), F.lit(1)), link), "")
    blocks = t(spark, d, "pages").select("page_id", F.posexplode(F.slice(F.split(made, 'aria-label="Toggle visibility for '), 2, 1 << 30)).alias("n", "b"))
    pieces = blocks.select("page_id", "n", F.regexp_extract("b", r"^([0-9]{4}) - Volume [0-9]+", 1).try_cast("int").alias("year"), F.posexplode(F.slice(F.split("b", '<a class="part-link" href="'), 2, 1 << 30)).alias("m", "p"))
    title = F.btrim(F.regexp_replace(F.regexp_replace(F.regexp_extract("p", r'(?s)^[^"]*">(.*?)</a>', 1), "<[^>]+>", ""), r"\s+", " "))
    x = pieces.select("page_id", "n", "m", "year", F.regexp_extract("p", '^([^"]*)"', 1).alias("href"), title.alias("title"), F.lower(F.regexp_extract("p", r'(?s)</a>.*?data-doi="(10\.[0-9]{4,}/[^"]+)"', 1)).alias("doi")).where("doi <> '' and year is not null")
    first = F.row_number().over(Window.partitionBy("page_id", "doi").orderBy("n", "m"))
    return x.withColumn("r", first).where("r = 1").select("page_id", "year", "href", "title", "doi")


def link_extract(spark, d):
    links = F.regexp_extract_all("html", F.lit(r'<a href="([^"]*)"'), F.lit(1))
    return t(spark, d, "pages").select("page_id", F.posexplode(links).alias("n", "href"))


def normalize_url_id(spark, d):
    bare = F.regexp_replace(F.regexp_replace(F.lower("url"), r"^https?://", ""), r"[?#].*$", "")
    return t(spark, d, "pages").select("page_id", F.replace(bare, F.lit("/"), F.lit(":")).alias("url_id"), F.regexp_replace(bare, r"[^a-z0-9._-]", "_").alias("file_id"))


def excerpts(spark, d):
    p = F.length("text") / 1000.0
    return t(spark, d, "conversations").select("conv_id", "turn", T.excerpt(F.col("text")).alias("excerpt"), F.when(p >= 0.45, "supported").when(p < 0.40, "unsupported").otherwise("open").alias("band"))


def line_span_slice(spark, d):
    return t(spark, d, "documents").select("doc_id", T.line_span(F.col("text"), F.lit(1), F.lit(2)).alias("span"))


def formula_transform(spark, d):
    x = F.regexp_replace(F.regexp_replace("text", r"@@eq\d{4}@@", "[formula]"), r"[\x00-\x1f]", " ")
    return t(spark, d, "documents").select("doc_id", F.left(x, F.lit(16000)).alias("text"))


_CLEAN = "regexp_replace(regexp_replace(html, '(?is)<script\\b[^>]*>.*?</script\\s*>|<style\\b[^>]*>.*?</style\\s*>|<svg\\b[^>]*>.*?</svg\\s*>|<noscript\\b[^>]*>.*?</noscript\\s*>', '', 'g'), '(?s)<!--.*?-->', '', 'g')"
#: Flags of a Markdown text in SQL, in order.
FLAGS_SQL = "[case when bytes < 2048 then 'tiny' end, case when headings = 0 then 'no-headings' end, case when formula_tokens > 20 then 'formula-heavy' end, case when contains(text, 'ltx_') then 'ltx-residual' end, case when regexp_matches(text, '(?i)<(span|div|figure|embed|img|math|table)\\b') then 'raw-leak' end]"
STATS_SQL = "select doc_id, source, text, strlen(text) as bytes, len(regexp_extract_all(text, '(?m)^#{1,6} .')) as headings, len(regexp_extract_all(text, '\\$\\$')) as math_blocks, len(regexp_extract_all(text, '\\[formula\\]')) as formula_tokens from documents"
ORACLES = {
    "doc_md_stats": f"with x as ({STATS_SQL}) select doc_id, bytes, headings, math_blocks, formula_tokens, array_to_string(list_filter({FLAGS_SQL}, lambda f: f is not null), '|') as flags from x",
    "lines_to_blocks": "with l as (select doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as p from documents), g as (select *, sum((trim(line) = '')::int) over (partition by doc_id order by p) as g from l), b as (select doc_id, g, min(p) as start, max(p) as \"end\", count(*) as n_lines from g where trim(line) <> '' group by all) select doc_id, row_number() over (partition by doc_id order by start) as block, start, \"end\", n_lines from b",
    "section_buckets": "with h as (select page_id, '## 2.1 ' || regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1) as h from pages), b as (select page_id, lower(h) as low, trim(lower(regexp_replace(regexp_replace(h, '^#+\\s*', ''), '^[0-9.\\s]+', ''))) as b from h) select page_id, case "
    + " ".join(f"when regexp_matches(b, '{p}') then '{n}'" for n, p in T.SECTIONS) + " else regexp_split_to_array(b, '[\\s:;,(]')[1] end as section, case " + " ".join(f"when regexp_matches(low, '{'|'.join(p)}') then '{n}'" for n, p in T.GENRES) + " else 'other' end as genre from b",
    "clean_html": f"select page_id, {_CLEAN} as html from pages",
    "html_coverage": """with x as (select page_id, replace(html, '<article', '<section') || case when page_id % 2 = 0 then '<div class="tex-math"></div><div class="fig-ada">' else '' end || case when page_id % 3 > 0 then '<ol id="references">' else '' end as h from pages),
y as (select *, case when strpos(h, '<section') = 0 then length(h) - 1 else strpos(h, '<section') - 1 end as a, case when strpos(h, 'id="references"') = 0 then length(h) - 1 else strpos(h, 'id="references"') - 1 end as b from x)
select page_id, len(regexp_extract_all(h, 'class="tex-math')) as tex_math, len(regexp_extract_all(h, 'class="fig-ada"')) as figures, len(regexp_extract_all(h, 'table-wrap-ada')) as tables, len(regexp_split_to_array(regexp_replace(case when b > a then substring(h, a + 1, b - a) else '' end, '<[^>]+>', ' ', 'g'), '\\s+')) as words, len(regexp_split_to_array(regexp_replace(case when b > a then substring(h, a + 1, b - a) else '' end, '<[^>]+>', ' ', 'g'), '\\s+')) > 1500 as fulltext from y""",
    "listing_links": """with l as (select page_id, unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) as href, unnest(range(len(regexp_extract_all(html, '<a href="([^"]*)"', 1)))) as i from pages), x as (select page_id, 2000 + i // 3 * 3 as year, href, trim(regexp_replace(' Paper' || chr(10) || href, '\\s+', ' ', 'g')) as title, lower('10.1234/X' || href) as doi, i from l where i % 2 = 0)
select page_id, year::int as year, href, title, doi from x qualify row_number() over (partition by page_id, doi order by i) = 1""",
    "link_extract": "select page_id, unnest(range(len(l))) as n, unnest(l) as href from (select page_id, regexp_extract_all(html, '<a href=\"([^\"]*)\"', 1) as l from pages)",
    "normalize_url_id": "with x as (select page_id, regexp_replace(regexp_replace(lower(url), '^https?://', ''), '[?#].*$', '') as b from pages) select page_id, replace(b, '/', ':') as url_id, regexp_replace(b, '[^a-z0-9._-]', '_', 'g') as file_id from x",
    "excerpts": "with x as (select conv_id, turn, trim(regexp_replace(text, '\\s+', ' ', 'g')) as l, length(text) / 1e3 as p from conversations) select conv_id, turn, case when length(l) > 120 then concat(left(l, 120), '...') else l end as excerpt, case when p >= 45e-2 then 'supported' when p < 40e-2 then 'unsupported' else 'open' end as band from x",
    "line_span_slice": "select doc_id, array_to_string(string_split(text, chr(10))[1:2], chr(10)) as span from documents",
    "formula_transform": "select doc_id, left(regexp_replace(regexp_replace(text, '@@eq\\d{4}@@', '[formula]', 'g'), '[\\x00-\\x1f]', ' ', 'g'), 16000) as text from documents",
}
QUERIES = {n: globals()[n] for n in ORACLES}
