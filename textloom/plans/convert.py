"""Gates of converters, spliced equations, harvested records, found pages, lint runs."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from textloom.functions import records as R
from textloom.functions import text as T
from textloom.operators import find, lint
from textloom.operators.equations import equation_splice as spliced
from textloom.operators.retrieval import dense
from textloom.plans.markdown import html_to_md


def t(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _article(spark, d):
    """Each document as a short article in Markdown, with what its gates look for."""
    head = F.concat(F.lit("# "), "source", F.lit("\n\n"), F.when(F.col("doc_id") % 2 == 0, "## Abstract\n\n").otherwise(""))
    math = F.when(F.col("doc_id") % 3 == 0, "\n\n$$a$$ and $b$, $`c`$\n\n```math\nd\n```").otherwise("")
    tail = F.when(F.col("doc_id") % 5 == 0, "\n\n### Method 1.2\n\nmore\n\n## References\n\nold").otherwise("")
    return t(spark, d, "documents").select("doc_id", F.concat(head, F.col("text"), math, tail).alias("md"))


def docx_gates(spark, d):
    """What the gates of a word processor's converter say: counts, and whether an article is a fragment, has no sections, or passes."""
    x = _article(spark, d).select("doc_id", R.docx_stats(F.col("md")).alias("s"), F.octet_length("md").cast("long").alias("bytes")).select("doc_id", "bytes", "s.*")
    return x.withColumn("category", F.when(F.col("bytes") < 1500, "fragment").when(F.col("h2") == 0, "no-sections").otherwise("ok"))


def heading_names(spark, d):
    """Headings without numbers and signs, and how many articles have each."""
    lines = _article(spark, d).select("doc_id", F.explode(F.regexp_extract_all("md", F.lit(r"(?m)^#{1,6}[ \t]+([^\n]+)$"), F.lit(1))).alias("h"))
    return lines.select("doc_id", R.heading_name(F.col("h")).alias("heading")).where("heading <> ''").groupBy("heading").agg(F.count("*").alias("n"), F.count_distinct("doc_id").alias("articles"))


def article_summaries(spark, d):
    """The summary of each article that has one of thirty words and more: its first three words, and whether it says we or our."""
    x = _article(spark, d).select("doc_id", T.prose(R.summary_of(F.col("md"))).alias("a")).withColumn("w", T.tokens(F.col("a"))).where(F.size("w") >= 30)
    return x.select("doc_id", F.size("w").cast("long").alias("words"), F.array_join(F.slice("w", 1, 3), " ").alias("opens"), (T.count_words(F.lower("a"), "we|our") > 0).alias("we"))


def equation_splice(spark, d):
    """Each document with an equation token after every line, and the turns of the conversation of its id as what was read from the pictures."""
    lines = F.transform(F.split("text", "\n"), lambda x, i: F.concat(x, F.when(i % 2 == 0, "\n").otherwise(" "), F.lit("@@eq"), F.format_string("%04d", i), F.lit("@@")))
    texts = t(spark, d, "documents").select("doc_id", F.array_join(lines, "\n").alias("text"))
    said = t(spark, d, "conversations").select(F.col("conv_id").alias("doc_id"), F.col("turn").alias("number"), F.when(F.col("turn") == 1, "failed").otherwise("ok").alias("state"), F.col("text").alias("tex"))
    return spliced(texts, said)


def live_urls(spark, d):
    """Picture addresses of an old kind replaced by the live one of the same file name, where the page has one; the first of the page counts."""
    x = t(spark, d, "pages").select("page_id", "url", F.expr("transform(regexp_extract_all(html, 'href=\"([^\"]*)\"', 1), (x, i) -> struct(i as i, x as live))").alias("s"))
    live = x.select("page_id", F.explode("s").alias("s")).select("page_id", "s.*").withColumn("name", F.regexp_replace(F.substring_index("live", "/", -1), r"\?.*$", ""))
    first = live.groupBy("page_id", "name").agg(F.min(F.struct("i", "live")).alias("f")).select("page_id", "name", F.col("f.live").alias("live"))
    dead = live.select("page_id", F.concat(F.when(F.col("i") % 2 == 0, "https://h.example/doi/x/").otherwise("https://h.example/cms/"), F.when(F.col("i") % 3 == 0, F.col("name")).otherwise(F.concat("name", F.lit("z")))).alias("old"))
    asked = dead.withColumn("name", F.when(F.col("old").contains("/doi/"), F.substring_index("old", "/", -1)))
    rewritten = F.when(F.col("live").startswith("http"), F.col("live")).otherwise(F.concat(F.lit("https://h.example"), F.col("live")))
    return asked.join(first, ["page_id", "name"], "left").select("page_id", "old", F.coalesce(F.when(F.col("live").isNotNull(), rewritten), F.col("old")).alias("url"), F.col("live").isNotNull().alias("rewritten")).distinct()


def oai_records(spark, d):
    """Harvested records as rows: each document is written as a record of XML first."""
    safe = lambda c: F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit("'"), F.lit("&#39;"))
    cats = F.when(F.col("doc_id") % 3 == 0, F.lit("")).otherwise(F.concat(F.lit("<categories>stat."), F.upper("lang"), F.lit(" math.ST</categories>")))
    body = F.concat(
        F.lit("<identifier>oai:arXiv.org:"), F.col("doc_id").cast("string"), F.when(F.col("doc_id") % 4 == 0, "v2").otherwise(""), F.lit("</identifier><setSpec>stat:stat:"), F.upper("lang"), F.lit("</setSpec><setSpec>cs</setSpec><created>"),
        (F.lit(1990) + F.col("n_chars") % 35).cast("string"), F.lit("-01-02</created>"), cats, F.lit("<title>"), safe("text"), F.lit("</title><author><keyname>Muster</keyname> <forenames>"), F.col("source"), F.lit(" A.</forenames></author>"),
    )
    pages = t(spark, d, "documents").groupBy(F.floor(F.col("doc_id") / 20).alias("page")).agg(F.array_join(F.array_sort(F.collect_list(F.concat(F.lit("<record>"), body, F.lit("</record>")))), "").alias("xml"))  # pages of a harvest
    return R.oai_rows(pages.select("xml"))


def page_find(spark, d):
    """Documents that hold a benchmark passage, or all of its words, with snippets."""
    return find.index_of(spark, f"{d}/documents.parquet").find(t(spark, d, "benchmark"))


def _rules(spark, d):
    """Passages as rules: a field for each piece of the passage, some of them null."""
    part = lambda i, n: F.array_join(F.slice(F.split("text", " "), i, n), " ")
    k = F.col("item_id")
    return t(spark, d, "benchmark").select(
        F.col("item_id").alias("rule"), "text", F.when(k % 2 == 0, "results").alias("section"), F.when(k % 3 == 0, part(1, 3)).alias("prefix"), F.when(k % 4 > 0, part(4, 3)).alias("before"), F.when(k % 5 > 0, part(7, 3)).alias("after"),
        F.lit("  ").alias("suffix"), F.when(k % 7 > 0, part(10, 4)).alias("judgement"), F.when(k % 7 != 1, part(14, 5)).alias("lesson"),
    ).where("lesson is not null or judgement is not null")


def rule_instructions(spark, d):
    """Rules spelled out: lesson, section, the edit, and the comment."""
    return _rules(spark, d).select(F.col("rule").alias("item_id"), lint.instruction().alias("instruction"))


def lint_cross_score(spark, d):
    """Each document against every rule, a passage with all its terms, by the share of them that it has, from the threshold on; a stand-in for a judge."""
    rules = t(spark, d, "benchmark").select(F.col("item_id").alias("rule"), F.array_distinct(T.terms(F.col("text"))).alias("r")).where(F.size("r") > 0)
    blocks = t(spark, d, "documents").select("doc_id", F.array_distinct(T.terms(F.col("text"))).alias("t"))
    return lint.shared_terms(blocks, rules, ["doc_id"]).withColumnRenamed("rule", "item_id")


def lint_render(spark, d):
    """The lint run of each document as text: where it stands in its source, its excerpt, its hits by likelihood."""
    rules = _rules(spark, d).select("rule", lint.instruction().alias("instruction"))
    blocks = t(spark, d, "documents").select("doc_id", "source", F.lit(1).alias("start"), F.size(F.split("text", "\n")).alias("end"), "text")
    hits = lint_cross_score(spark, d).withColumnRenamed("item_id", "rule").join(rules, "rule").join(blocks, "doc_id")
    return lint.rendered(hits, "doc.md", ["doc_id", "source"]).select("doc_id", "source", "lines")


def lint_paragraphs(spark, d):
    """Blocks of the pages' Markdown that are judged: paragraphs and list items, with section and role."""
    return lint.block_table(html_to_md(spark, d), "page_id")


def dense_cli_query(spark, d, k: int = 10, per_label: int = 3, prefer: int = 3):
    """A question answered by the vectors alone: embedded, fetched with room to spare, boosted by label, capped by label, and shown with lines of its document."""
    vector = R.embedded("the reliability of the test scores was estimated using coefficient alpha", 64)
    hits = dense(t(spark, d, "embeddings"), vector, k=max(k * 5, k * 3), boost=F.when(F.col("label") == prefer, 0.03).otherwise(0.0))
    order = Window.partitionBy("label").orderBy(F.desc("score"), "vec_id")
    top = hits.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= per_label).orderBy(F.desc("score"), "vec_id").limit(k)
    docs = t(spark, d, "documents").select(F.col("doc_id").alias("vec_id"), "source", T.line_span(F.col("text"), F.lit(1), F.lit(3)).alias("passage"))
    return F.broadcast(top).join(docs, "vec_id", "left").select("vec_id", "label", "score", "source", "passage")  # k rows


def overfetch_cap(spark, d):
    """The ten nearest vectors, three of a label at most, of five times as many fetched."""
    from textloom.plans.search import probe

    hits = dense(t(spark, d, "embeddings"), probe(spark, d), k=50)
    capped = hits.withColumn("rn", F.row_number().over(Window.partitionBy("label").orderBy(F.desc("score"), "vec_id"))).where("rn <= 3")
    return capped.orderBy(F.desc("score"), "vec_id").limit(10)


def meta_tags(spark, d):
    """Citation tags of pages: title, all authors, the date or else the one online, keywords; each page gets some made of its own data."""
    tag = lambda n, v: F.concat(F.lit(f'<meta name="{n}" content="'), v, F.lit('">'))
    made = F.concat(
        tag("citation_title", F.regexp_replace(F.regexp_extract("html", r"(?s)<title>(.*?)</title>", 1), '"', "")), tag("citation_author", F.concat(F.lit("Muster, A"), F.col("page_id").cast("string"))),
        F.when(F.col("page_id") % 2 == 0, tag("citation_author", F.lit("Other, B"))).otherwise(""), F.when(F.col("page_id") % 3 == 0, tag("citation_publication_date", F.lit("2001/05"))).otherwise(""), F.when(F.col("page_id") % 5 > 0, tag("citation_online_date", F.lit("2000/01"))).otherwise(""),
    )
    x = t(spark, d, "pages").select("page_id", F.regexp_extract("html", r'<html lang="([a-z]+)"', 1).alias("lang"), F.concat(made, F.col("html")).alias("html"))
    one = lambda n: F.get(F.regexp_extract_all("html", F.lit(rf'(?i)<meta name="{n}"\s+content="([^"]*)"'), F.lit(1)), 0)
    authors = F.regexp_extract_all("html", F.lit(r'(?i)<meta name="citation_author"\s+content="([^"]*)"'), F.lit(1))
    return x.select("page_id", "lang", one("citation_title").alias("title"), F.nullif(F.array_join(authors, "; "), F.lit("")).alias("authors"), F.coalesce(one("citation_publication_date"), one("citation_online_date")).alias("date"), one("citation_keywords").alias("keywords"))


def pii_strip(spark, d):
    """Texts without addresses, and without lines that are researchers' ids in footnotes."""
    made = F.concat(F.col("text"), F.when(F.col("doc_id") % 3 == 0, "\n[^1]: https://orcid.org/0000-0001-2345-6789\nend").otherwise(""))
    kept = F.array_join(F.filter(F.split(made, "\n"), lambda x: ~x.rlike(r"^\[\^[0-9]+\]:.*orcid\.org")), "\n")
    return t(spark, d, "documents").select("doc_id", F.regexp_replace(kept, r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}", "").alias("text"))


def page_ranges(spark, d):
    """Pages from-to of each document, whose lines are pages here; the range is clamped to those there are."""
    pages = F.split("text", "\n")
    x = t(spark, d, "documents").select("doc_id", F.when(F.btrim(F.element_at(pages, -1)) == "", F.slice(pages, 1, F.size(pages) - 1)).otherwise(pages).alias("p"), (F.col("doc_id") % 7).cast("int").alias("a"), (F.col("doc_id") % 11).cast("int").alias("b")).where(F.size("p") > 0)
    clamp = lambda v, lo: F.greatest(F.lit(lo) if isinstance(lo, int) else lo, F.least(v, F.size("p")))
    x = x.withColumn("from", clamp(F.coalesce(F.nullif("a", F.lit(0)), F.lit(1)), 1))
    x = x.withColumn("to", clamp(F.coalesce(F.nullif("b", F.lit(0)), F.col("from")), F.col("from")))
    return x.select("doc_id", F.size("p").cast("long").alias("pages"), F.col("from").cast("long").alias("from"), F.col("to").cast("long").alias("to"), F.array_join(F.expr("slice(p, `from`, `to` - `from` + 1)"), "\f").alias("text"))


def sorted_kinds(spark, d):
    """Documents by year and id, and kinds in falling order: ranks of two sorts by several keys."""
    x = t(spark, d, "documents").select("doc_id", "lang", (F.lit(1950) + F.col("n_chars") % 75).alias("year"))
    ranked = x.groupBy("year", "lang").agg(F.min("doc_id").alias("first"), F.count("*").alias("n"))
    return ranked.orderBy("year", F.desc("lang"), "first")


_ART = "concat('# ', source, chr(10), chr(10), case when doc_id % 2 = 0 then concat('## Abstract', chr(10), chr(10)) else '' end, text, case when doc_id % 3 = 0 then concat(chr(10), chr(10), '$$a$$ and $b$, $`c`$', chr(10), chr(10), '```math', chr(10), 'd', chr(10), '```') else '' end, case when doc_id % 5 = 0 then concat(chr(10), chr(10), '### Method 1.2', chr(10), chr(10), 'more', chr(10), chr(10), '## References', chr(10), chr(10), 'old') else '' end)"
_n = lambda p, c="md": f"len(regexp_extract_all({c}, '{p}'))"
_PAGE = "trim(regexp_replace(regexp_replace(text, '([A-Za-z0-9_])-\\s*\\n\\s*', '\\1', 'g'), '\\s+', ' ', 'g'))"
_PART = lambda i, n: f"array_to_string(string_split(text, ' ')[{i}:{i + n - 1}], ' ')"
_R = f"r as (select item_id as rule, text, case when item_id % 2 = 0 then 'results' end as section, case when item_id % 3 = 0 then {_PART(1, 3)} end as prefix, case when item_id % 4 > 0 then {_PART(4, 3)} end as before, case when item_id % 5 > 0 then {_PART(7, 3)} end as after, case when item_id % 7 > 0 then {_PART(10, 4)} end as judgement, case when item_id % 7 <> 1 then {_PART(14, 5)} end as lesson from benchmark)"
_I = "i as (select rule, trim(coalesce(lesson, judgement)) as l, nullif(trim(section), '') as section, concat_ws(chr(10), case when trim(prefix) <> '' then 'Context before: ' || trim(prefix) end, case when trim(before) <> '' then 'Before: ' || trim(before) end, case when trim(after) <> '' then 'After: ' || trim(after) end) as pair, nullif(trim(judgement), '') as j from r where lesson is not null or judgement is not null), n as (select rule, concat_ws(chr(10) || chr(10), l, 'Learned from the ' || section || ' section.', case when pair <> '' then 'The calibrated edit this rule was distilled from:' || chr(10) || pair end, case when j <> l then 'The expert''s comment: ' || j end) as instruction from i)"
_LINT = "s as (select doc_id, item_id, len(list_intersect(r, t)) / len(r) as p from (select item_id, list_distinct(regexp_extract_all(lower(text), '[a-z0-9]+')) as r from benchmark) b, (select doc_id, list_distinct(regexp_extract_all(lower(text), '[a-z0-9]+')) as t from documents) c where len(r) > 0)"
ORACLES = {
    "docx_gates": f"with x as (select doc_id, {_ART} as md from documents), y as (select doc_id, strlen(md) as bytes, {_n('(?m)^## ')} as h2, {_n('(?m)^### ')} as h3, regexp_matches(md, '(?m)^## Abstract') as summary_heading, {_n('[$][$]')} // 2 as math_display, {_n('(?m)^```math')} as math_fences, {_n('[$]`')} as backtick_math, not regexp_matches(md, '(?im)^#{{2,3}} .*references?[ ]*$') as refs_stripped, trim(regexp_extract(md, '(?m)^# ([^\\n]+)$', 1)) as title from x) select *, case when bytes < 1500 then 'fragment' when h2 = 0 then 'no-sections' else 'ok' end as category from y",
    "heading_names": f"with x as (select doc_id, {_ART} as md from documents), h as (select doc_id, unnest(regexp_extract_all(md, '(?m)^#{{1,6}}[ \\t]+([^\\n]+)$', 1)) as h from x), n as (select doc_id, trim(regexp_replace(regexp_replace(trim(regexp_replace(lower(trim(h)), '^[0-9]+(\\.[0-9]+)*[.\\s]*', '')), '[^a-z0-9 &/-]', '', 'g'), '[0-9]+', '', 'g')) as heading from h) select heading, count(*) as n, count(distinct doc_id) as articles from n where heading <> '' group by 1",
    "equation_splice": "with l as (select doc_id, unnest(string_split(text, chr(10))) as line, unnest(range(len(string_split(text, chr(10))))) as p from documents), g as (select conv_id as doc_id, turn, turn = 1 as failed, min(text) as tex from conversations group by all), j as (select l.*, g.doc_id is not null as known, failed, tex from l left join g on g.doc_id = l.doc_id and turn = p), k as (select *, bool_and(known) over (partition by doc_id) as ready from j) select doc_id, string_agg(line || case when p % 2 = 0 then chr(10) else ' ' end || case when ready and not failed then case when p % 2 = 0 then '$$' || tex || '$$' else '$' || tex || '$' end else '@@eq' || printf('%04d', p) || '@@' end, chr(10) order by p) as text, count(*) filter (ready and not failed) as spliced, count(*) filter (ready and failed) as kept from k group by 1",
    "oai_records": "select doc_id::varchar as arxiv_id, '10.48550/arXiv.' || doc_id as doi, trim(regexp_replace(text, '\\s+', ' ', 'g')) as title, source || ' A. Muster' as authors, 1990 + n_chars % 35 as year, 'stat.' || upper(lang) as \"primary\", case when doc_id % 3 = 0 then 1 else 2 end::bigint as n_cats from documents",
    "live_urls": r"""with s as (select page_id, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) as live, unnest(range(len(regexp_extract_all(html, 'href="([^"]*)"', 1)))) as i from pages),
n as (select *, regexp_replace(string_split(live, '/')[-1], '\?.*$', '') as name from s), f as (select page_id, name, arg_min(live, i) as live from n group by all),
o as (select page_id, concat(case when i % 2 = 0 then 'https://h.example/doi/x/' else 'https://h.example/cms/' end, case when i % 3 = 0 then name else concat(name, 'z') end) as old from n),
a as (select page_id, old, case when contains(old, '/doi/') then string_split(old, '/')[-1] end as name from o)
select distinct a.page_id, old, case when live is null then old when starts_with(live, 'http') then live else concat('https://h.example', live) end as url, live is not null as rewritten from a left join f on f.page_id = a.page_id and f.name = a.name""",
    "page_find": f"""with q as (select item_id, lower({_PAGE}) as q from benchmark), d as (select doc_id, {_PAGE} as page from documents), dl as (select doc_id, page, lower(page) as low, list_distinct(list_filter(regexp_split_to_array(lower(page), '[^a-z0-9]+'), lambda w: length(w) > 1)) as dw from d),
h as (select item_id, doc_id, page, length(q) as n, string_split(low, q) as s from q join dl on contains(low, q)), p as (select item_id, doc_id, page, n, unnest(range(1, len(s))) as i, s from h), a as (select item_id, doc_id, page, n, (i - 1) * n + list_sum(list_transform(s[1:i], lambda x: length(x)))::bigint as place from p),
b as (select *, row_number() over (partition by item_id order by doc_id, place) as rank from a qualify rank <= 8),
w as (select item_id, q, list_distinct(list_filter(regexp_split_to_array(q, '[^a-z0-9]+'), lambda w: length(w) > 1)) as w from q where item_id not in (select item_id from b)),
c as (select item_id, doc_id, page, list_min(list_transform(w, lambda t: strpos(low, t) - 1)) as place, list_max(list_transform(w, lambda t: length(low) - strpos(reverse(low), reverse(t)) + 1)) as e from w join dl on len(w) > 0 and len(list_filter(w, lambda t: not contains(low, t))) = 0),
e as (select *, row_number() over (partition by item_id order by e - place, doc_id) as rank from c qualify rank <= 8)
select item_id, 'phrase' as mode, rank, doc_id, place, trim(substring(page, greatest(place - 160, 0) + 1, place + n + 160 - greatest(place - 160, 0))) as snippet from b
union all select item_id, 'words', rank, doc_id, place, trim(substring(page, greatest(place - 80, 0) + 1, e + 80 - greatest(place - 80, 0))) from e""",
    "rule_instructions": f"with {_R}, {_I} select rule as item_id, instruction from n",
    "lint_cross_score": f"with {_LINT} select doc_id, item_id, round(p, 6) as p from s where p >= 75e-2",
    "lint_render": f"""with {_R}, {_I}, {_LINT}, h as (select doc_id, item_id, p from s where p >= 75e-2),
x as (select doc_id, source, trim(regexp_replace(text, '\\s+', ' ', 'g')) as flat, len(string_split(text, chr(10))) as n, -round(p, 6) as o, item_id, concat('  R', case when item_id < 10 then '0' else '' end, item_id, '  p=', printf('%.2f', round(p, 6)), '  ', trim(regexp_replace(instruction, '\\s+', ' ', 'g'))) as line from h join n on rule = item_id join documents using (doc_id))
select doc_id, source, concat('doc.md:1', case when n > 1 then concat('-', n) else '' end, '  ', count(*), ' violation(s)', chr(10), '  ', left(flat, 120), case when length(flat) >= 120 then '...' else '' end, chr(10), string_agg(line, chr(10) order by o, item_id)) as lines from x group by doc_id, source, flat, n""",
    "overfetch_cap": "with qv as (select embedding as q from embeddings order by vec_id limit 1), de as (select vec_id, label, round(list_cosine_similarity(embedding::double[], q::double[]), 6) as score from embeddings, qv order by 3 desc, 1 limit 50), c as (select *, row_number() over (partition by label order by score desc, vec_id) as rn from de qualify rn <= 3) select * from c order by score desc, vec_id limit 10",
    "meta_tags": "select page_id, regexp_extract(html, '<html lang=\"([a-z]+)\"', 1) as lang, replace(regexp_extract(html, '(?s)<title>(.*?)</title>', 1), '\"', '') as title, concat('Muster, A', page_id, case when page_id % 2 = 0 then '; Other, B' else '' end) as authors, case when page_id % 3 = 0 then '2001/05' when page_id % 5 > 0 then '2000/01' end as date, null::varchar as keywords from pages",
    "pii_strip": "select doc_id, regexp_replace(concat(text, case when doc_id % 3 = 0 then concat(chr(10), 'end') else '' end), '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}', '', 'g') as text from documents",
    "page_ranges": "with x as (select doc_id, case when trim(string_split(text, chr(10))[-1]) = '' then string_split(text, chr(10))[:-2] else string_split(text, chr(10)) end as p from documents), y as (select *, greatest(1, least(case when doc_id % 7 = 0 then 1 else doc_id % 7 end, len(p))) as f from x where len(p) > 0), z as (select *, greatest(f, least(case when doc_id % 11 = 0 then f else doc_id % 11 end, len(p))) as t from y) select doc_id, len(p) as pages, f as \"from\", t as \"to\", array_to_string(p[f:t], chr(12)) as text from z",
    "sorted_kinds": "select 1950 + n_chars % 75 as year, lang, min(doc_id) as first, count(*) as n from documents group by all order by year, lang desc, first",
}
QUERIES = {n: globals()[n] for n in [*ORACLES, "article_summaries", "lint_paragraphs", "dense_cli_query"]}
