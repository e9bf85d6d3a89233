"""Pages as Markdown, its blocks, sections and gates; lexicon counts, keys, samples and repairs over documents."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from textloom.functions import markup as M
from textloom.functions import text as T


def t(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Auxiliaries and participles of the passive count.
AUXILIARIES = ["is", "are", "was", "were", "been", "be"]
PARTICIPLES = ["estimated", "assumed", "defined", "given", "obtained", "used", "proposed", "considered", "noted", "shown", "derived", "computed", "fitted", "fit",
               "modeled", "modelled", "specified", "presented", "discussed", "described", "developed", "applied"]
#: How results are reported, and Latin terms.
REPORTS = [("p <", r"p\s*<"), ("p =", r"p\s*="), ("M =", r"\bM\s*="), ("SD =", r"\bSD\s*="), ("SE =", r"\bSE\s*="), ("95% CI", r"(?i)95\s*%\s*CI"),
           ("b/beta =", r"(?i)\bb\s*=|\bbeta\s*="), ("chi-sq", r"(?i)chi-?square|chi-?squared|χ2"), ("t(", r"\bt\s*\("), ("F(", r"\bF\s*\(")]
LATIN = ["e.g.", "i.e.", "cf.", "et al.", "vs.", "w.r.t.", "iff", "etc."]
SEED, SAMPLE = 42, 20
CONTEST_LENGTH = 2000


def html_to_md(spark, d):
    return t(spark, d, "pages").select("page_id", M.html_to_md(F.col("html")).alias("md"))


def _lines(spark, d):
    """Lines of the pages' Markdown with their kind; null for one without text."""
    x = html_to_md(spark, d).select("page_id", F.posexplode(F.split("md", "\n")).alias("p", "line"))
    return x.withColumn("p", F.col("p").cast("long")).withColumn("kind", M.line_kind(F.col("line")))


def typed_blocks(spark, d):
    """Runs of lines of one kind with their first and last line; a heading is a block of its own."""
    w = Window.partitionBy("page_id").orderBy("p")
    cut = (F.col("kind") == "heading") | ~F.col("kind").eqNullSafe(F.lag("kind").over(w))
    x = _lines(spark, d).withColumn("block", F.sum(cut.cast("int")).over(w)).where("kind is not null")
    return x.groupBy("page_id", "block", "kind").agg((F.min("p") + 1).alias("start"), (F.max("p") + 1).alias("end"))


def _carried(spark, d):
    title = F.when(F.col("kind") == "heading", F.regexp_replace("line", r"^#+ ", ""))
    w = Window.partitionBy("page_id").orderBy("p")
    return _lines(spark, d).withColumn("heading", F.last(title, True).over(w))


def heading_carry(spark, d):
    """Every line that holds text, with the heading that it stands under."""
    return _carried(spark, d).where("kind is not null").select("page_id", "p", "kind", "heading")


def segments_by_heading(spark, d):
    """Lines and words under each heading; what stands before the first is the intro."""
    words = F.size(F.filter(F.split("line", r"[^A-Za-z']+"), lambda w: w != ""))
    x = _carried(spark, d).where("kind is not null and kind <> 'heading'")
    return x.groupBy("page_id", F.coalesce("heading", F.lit("intro")).alias("heading")).agg(F.count("*").alias("n_lines"), F.sum(words).alias("words"))


def lint_blocks(spark, d):
    """Paragraph lines and list items of 30 characters and more with their section, none of the references."""
    x = _carried(spark, d).where("kind in ('para', 'list')").withColumn("section", F.coalesce("heading", F.lit("")))
    x = x.withColumn("text", F.regexp_replace("line", r"^([-*+]|[0-9]+[.)]) ", ""))
    return x.where((F.length("text") >= 30) & ~F.col("section").rlike("(?i)^(references|bibliography)$")).select("page_id", F.col("p") + 1, "kind", "section", "text").toDF("page_id", "line", "kind", "section", "text")


def md_contract(spark, d):
    """Whether a page's Markdown has one title, skips no level and holds no reference list."""
    level = F.length(F.regexp_extract("line", r"^(#+) ", 1))
    h = _lines(spark, d).withColumn("level", F.when(F.col("kind") == "heading", level))
    h = h.where("level is not null").withColumn("up", F.lag("level", 1, 0).over(Window.partitionBy("page_id").orderBy("p")))
    g = h.groupBy("page_id").agg(F.count_if(F.col("level") == 1).alias("titles"), F.count_if(F.col("level") > F.col("up") + 1).alias("skips"), F.count_if(F.col("line").rlike("(?i)^#+ (references|bibliography)$")).alias("references"))
    x = t(spark, d, "pages").select("page_id").join(g, "page_id", "left").fillna(0)
    return x.withColumn("ok", (F.col("titles") == 1) & (F.col("skips") == 0) & (F.col("references") == 0))


def heading_levels(spark, d):
    """The levels of each document's lines as headings, none more than one deeper than the one before it. Lines ask for depths by their length here."""
    x = t(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("p", "line"))
    number = F.concat(F.lit("1"), F.repeat(F.lit(".1"), (F.length("line") % 4).cast("int")), F.lit(" "))
    x = x.select("doc_id", F.col("p").cast("long").alias("p"), M.heading_depth(F.concat(number, "line")).alias("asked"))
    return x.withColumn("level", M.clamped_level(F.col("asked"), F.col("p"), Window.partitionBy("doc_id").orderBy("p"))).select("doc_id", "p", "asked", "level")


def conversion_contest(spark, d):
    """A page's Markdown against the document of the same id as the earlier one: shipped where it passes the gate and is no worse."""
    count = lambda c, p: F.regexp_count(c, F.lit(p))
    new = html_to_md(spark, d)
    old = t(spark, d, "documents").select(F.col("doc_id").alias("page_id"), F.col("text").alias("old"))
    x = new.join(old, "page_id", "left").withColumn("old", F.coalesce("old", F.lit("")))
    x = x.select("page_id", F.length("md").cast("long").alias("n"), F.length("old").alias("o"), count("md", M.HEADINGS).cast("long").alias("h"), count("old", M.HEADINGS).cast("long").alias("old_h"), count("md", r"\$\$").alias("math"), count("old", r"\$\$").alias("old_math"))
    gate = (F.col("n") > CONTEST_LENGTH) & (F.col("h") > 0)
    wins = gate & (F.col("h") >= F.col("old_h")) & ((F.col("math") > F.col("old_math")) | (F.col("o") == 0))
    return x.select("page_id", "n", "h", "old_h", F.when(wins, "shipped").when(F.col("o") == 0, "gate-fail").otherwise("kept").alias("status"))


def passive_bigrams(spark, d):
    """Auxiliaries before participles in each language, and all pairs of neighbouring words."""
    x = t(spark, d, "documents").select("lang", T.tokens(F.col("text")).alias("w"))
    pairs = F.transform("w", lambda w, i: F.struct(w.alias("w"), F.get(F.col("w"), i + 1).alias("n")))
    passive = F.size(F.filter(pairs, lambda p: p["w"].isin(AUXILIARIES) & p["n"].isin(PARTICIPLES)))
    return x.groupBy("lang").agg(F.sum(F.greatest(F.size("w") - 1, F.lit(0))).alias("pairs"), F.sum(passive).alias("passive"))


def _tally(spark, d, column, counted):
    """Rows of (lang, name, n) from sums of all counts over one scan."""
    g = t(spark, d, "documents").groupBy("lang").agg(*[F.sum(n).alias(f"n{i}") for i, (_, n) in enumerate(counted)])
    return g.select("lang", F.explode(F.array(*[F.struct(F.lit(name).alias(column), F.col(f"n{i}").alias("n")) for i, (name, _) in enumerate(counted)])).alias("x")).select("lang", "x.*")


def report_patterns(spark, d):
    return _tally(spark, d, "pattern", [(n, F.regexp_count("text", F.lit(p))) for n, p in REPORTS])


def latin_terms(spark, d):
    low = F.lower("text")
    return _tally(spark, d, "term", [(w, ((F.length(low) - F.length(F.replace(low, F.lit(w), F.lit("")))) / len(w)).cast("long")) for w in LATIN])


def sentence_length_dist(spark, d):
    """Sentences of three words and more: their number, mean, middle and the values at shares of the order, from counts of lengths."""
    x = t(spark, d, "documents").select("lang", F.explode(F.transform(T.plain_sentences(F.col("text")), lambda s: F.size(T.words(s)))).alias("k"))
    c = x.groupBy("lang", "k").agg(F.count("*").alias("c"))
    w = Window.partitionBy("lang")
    c = c.withColumn("hi", F.sum("c").over(w.orderBy("k"))).withColumn("n", F.sum("c").over(w))
    at = lambda pos: F.min(F.when(F.col("hi") > pos, F.col("k")))
    shares = [at(F.floor(F.col("n") * q / 100)).cast("long").alias(f"p{q}") for q in (10, 25, 50, 75, 90, 99)]
    return c.groupBy("lang").agg(F.max("n").alias("n"), F.round(F.sum(F.col("k") * F.col("c")) / F.max("n"), 6).alias("mean"), *shares)


def tex_metrics(spark, d):
    """Pairs of display marks and commands outside display formulas, and these a thousand characters."""
    outside = F.regexp_replace("text", r"\$\$[^$]*\$\$", "")
    x = t(spark, d, "documents").select("doc_id", F.length("text").alias("size"), F.floor(F.regexp_count("text", F.lit(r"\$\$")) / 2).alias("displays"), F.regexp_count(outside, F.lit(r"\\[a-zA-Z]+")).cast("long").alias("commands"))
    return x.select("doc_id", "displays", "commands", F.when(F.col("size") > 0, F.round(F.col("commands") * 1000.0 / F.col("size"), 6)).alias("density"))


def response_class(spark, d):
    """Pages as answers of a fetch, of two kinds and several statuses: whether the whole came, is absent, or was blocked."""
    k = F.col("page_id")
    status = F.element_at(F.array(*[F.lit(x) for x in (200, 403, 404, 429, 200, 500)]), (k % 6 + 1).cast("int"))
    kind = F.when(k % 4 < 3, "xml").otherwise("pdf")
    head = F.concat(F.when(k % 13 == 0, "Just a moment...").when(k % 17 == 0, "%PDF-1.4 ").otherwise(""), F.col("html"))
    return t(spark, d, "pages").select("page_id", M.response_class(kind, status, F.octet_length("html") * 8, head, k % 11 == 0).alias("verdict"))


def name_keys(spark, d):
    """The key that each document's first three words would have as a name."""
    key = M.name_key(F.array_join(F.slice(F.split("text", " "), 1, 3), " "))
    return t(spark, d, "documents").select("doc_id", key.alias("k")).select("doc_id", "k.last", "k.first")


def seeded_sample(spark, d):
    """Twenty documents of each language, drawn by a seeded hash of the id."""
    draw = F.md5(F.concat(F.lit(f"{SEED}:"), F.col("doc_id").cast("string")))
    w = Window.partitionBy("lang").orderBy("draw", "doc_id")
    return t(spark, d, "documents").select("lang", "doc_id", draw.alias("draw")).withColumn("r", F.row_number().over(w)).where(F.col("r") <= SAMPLE).select("lang", "doc_id", F.col("r").cast("long").alias("r"))


def id_parse(spark, d):
    """Names of parts taken apart again: the document's, the number, and a handle."""
    name = F.concat(F.replace("url", F.lit("/"), F.lit(":")), F.lit("#c"), F.repeat(F.lit("0"), F.greatest(3 - F.length(F.col("page_id").cast("string")), F.lit(0))), F.col("page_id").cast("string"))
    x = t(spark, d, "pages").select("page_id", name.alias("name"))
    return x.select("page_id", F.substring_index("name", "#c", 1).alias("owner"), F.substring_index("name", "#c", -1).cast("long").alias("number"), F.regexp_replace("name", "[^a-zA-Z0-9._-]", "_").alias("file"))


def ligature_repair(spark, d):
    return t(spark, d, "documents").select("doc_id", M.ligatures(F.col("text")).alias("x")).select("doc_id", "x.*")


def _chain(column, steps):
    for pattern, put in steps:
        put = put.replace("$1", r"\1").replace("$2", r"\2")
        column = "regexp_replace({}, '{}', '{}', 'g')".format(column, pattern.replace("'", "''"), put.replace("'", "''"))
    return column


_CLEAN = [*[(rf"(?is)<{n}\b[^>]*>.*?</{n}\s*>", "") for n in ("script", "style", "svg", "noscript")], (r"(?s)<!--.*?-->", "")]
_in = lambda xs: ", ".join(f"'{x}'" for x in xs)
_MD = f"m as (select page_id, {_chain('html', _CLEAN + M.TO_MARKDOWN)} as md from pages)"
_KIND = "case when trim(line) = '' then null " + " ".join(f"when regexp_matches(line, '{p}') then '{n}'" for n, p in M.KINDS) + " else 'para' end"
_L = f"{_MD}, l0 as (select page_id, unnest(string_split(md, chr(10))) as line, unnest(range(len(string_split(md, chr(10))))) as p from m), l as (select *, {_KIND} as kind from l0)"
_C = f"{_L}, c as (select *, last_value(case when kind = 'heading' then regexp_replace(line, '^#+ ', '') end ignore nulls) over (partition by page_id order by p rows unbounded preceding) as heading from l)"
_count = lambda c, p: f"len(regexp_extract_all({c}, '{p}'))"
_ORDER = "list_sort(list(k))"
_WORD = "[A-Za-z'']+"
ORACLES = {
    "html_to_md": f"with {_MD} select * from m",
    "typed_blocks": f"with {_L}, b as (select *, (kind = 'heading' or kind is distinct from lag(kind) over w) as cut from l window w as (partition by page_id order by p)), g as (select *, sum(coalesce(cut, false)::int) over (partition by page_id order by p) as block from b) select page_id, block::bigint as block, kind, min(p) + 1 as start, max(p) + 1 as \"end\" from g where kind is not null group by all",
    "heading_carry": f"with {_C} select page_id, p, kind, heading from c where kind is not null",
    "segments_by_heading": f"with {_C} select page_id, coalesce(heading, 'intro') as heading, count(*) as n_lines, sum({_count('line', _WORD)})::bigint as words from c where kind <> 'heading' group by page_id, coalesce(heading, 'intro')",
    "lint_blocks": f"with {_C}, x as (select page_id, p + 1 as line, kind, coalesce(heading, '') as section, regexp_replace(line, '^([-*+]|[0-9]+[.)]) ', '') as text from c where kind in ('para', 'list')) select * from x where length(text) >= 30 and lower(section) not in ('references', 'bibliography')",
    "md_contract": f"with {_L}, h as (select page_id, line, level, coalesce(lag(level) over (partition by page_id order by p), 0) as up from (select *, length(regexp_extract(line, '^(#+) ', 1)) as level from l where kind = 'heading')), g as (select page_id, count(*) filter (level = 1) as titles, count(*) filter (level > up + 1) as skips, count(*) filter (regexp_matches(line, '(?i)^#+ (references|bibliography)$')) as \"references\" from h group by 1), x as (select page_id, coalesce(titles, 0) as titles, coalesce(skips, 0) as skips, coalesce(\"references\", 0) as \"references\" from pages left join g using (page_id)) select *, titles = 1 and skips = 0 and \"references\" = 0 as ok from x",
    "heading_levels": "with a as (select doc_id, list_transform(string_split(text, chr(10)), lambda x: least(4, 2 + length(x) % 4)::bigint) as a from documents where text is not null), f as (select doc_id, a, list_reduce(list_prepend([1::bigint], list_transform(a, lambda x: [x])), lambda acc, x: list_append(acc, least(x[1], acc[len(acc)] + 1))) as f from a) select doc_id, unnest(range(len(a))) as p, unnest(a) as asked, unnest(f[2:]) as level from f",
    "conversion_contest": f"with {_MD}, x as (select page_id, length(md) as n, {_count('md', M.HEADINGS)} as h, {_count('coalesce(text, chr(32))', M.HEADINGS)} as old_h, {_count('md', chr(92) + '$' + chr(92) + '$')} as math, {_count('coalesce(text, chr(32))', chr(92) + '$' + chr(92) + '$')} as old_math, coalesce(length(text), 0) as o from m left join documents on doc_id = page_id) select page_id, n, h, old_h, case when n > {CONTEST_LENGTH} and h > 0 and h >= old_h and (math > old_math or o = 0) then 'shipped' when o = 0 then 'gate-fail' else 'kept' end as status from x",
    "passive_bigrams": f"with x as (select lang, regexp_extract_all(lower(text), '[a-z][a-z''\\-]*') as w from documents) select lang, sum(greatest(len(w) - 1, 0))::bigint as pairs, sum(len(list_filter(range(1, len(w)), lambda i: w[i] in ({_in(AUXILIARIES)}) and w[i + 1] in ({_in(PARTICIPLES)}))))::bigint as passive from x group by 1",
    "report_patterns": " union all ".join(f"select lang, '{n}' as pattern, sum({_count('text', p)})::bigint as n from documents group by 1" for n, p in REPORTS),
    "latin_terms": " union all ".join(f"select lang, '{w}' as term, sum((length(lower(text)) - length(replace(lower(text), '{w}', ''))) // {len(w)})::bigint as n from documents group by 1" for w in LATIN),
    "sentence_length_dist": f"with s as (select lang, unnest(string_split(regexp_replace(text, '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1))) as s from documents), k as (select lang, {_count('s', _WORD)} as k from s where {_count('s', _WORD)} >= 3), a as (select lang, {_ORDER} as l, avg(k) as mean from k group by 1) select lang, len(l) as n, round(mean, 6) as mean, " + ", ".join(f"l[len(l) * {q} // 100 + 1] as p{q}" for q in (10, 25, 50, 75, 90, 99)) + " from a",
    "tex_metrics": f"with x as (select doc_id, length(text) as size, {_count('text', chr(92) + '$' + chr(92) + '$')} // 2 as displays, len(regexp_extract_all(regexp_replace(text, '\\$\\$[^$]*\\$\\$', '', 'g'), '\\\\[a-zA-Z]+')) as commands from documents) select doc_id, displays, commands, case when size > 0 then round(commands * 1000e0 / size, 6) end as density from x",
    "response_class": "with x as (select page_id, (['200', '403', '404', '429', '200', '500'])[page_id % 6 + 1]::int as status, case when page_id % 4 < 3 then 'xml' else 'pdf' end as kind, case when page_id % 13 = 0 then 'Just a moment...' when page_id % 17 = 0 then '%PDF-1.4 ' else '' end || html as head, strlen(html) * 8 as n from pages) select page_id, case when page_id % 11 = 0 then 'error' when regexp_matches(head, '(?i)just a moment|attention required') then 'blocked' when regexp_matches(head, '(?i)you have been blocked|access denied') then 'blockpage' when status in (403, 429) then 'blocked' when kind = 'xml' then case when status = 200 and n > 20000 and contains(head, '<article') then 'ok' when status in (200, 404) then 'absent' else 'error' end when status = 200 and starts_with(head, '%PDF') and n > 20000 then 'ok' when status = 404 then 'fail' else 'error' end as verdict from x",
    "name_keys": "with x as (select doc_id, list_filter(regexp_split_to_array(lower(strip_accents(array_to_string(string_split(text, ' ')[1:3], ' '))), '[^a-z]+'), lambda w: w not in ('', 'jr', 'sr', 'ii', 'iii', 'iv')) as w from documents) select doc_id, w[len(w)] as \"last\", case when len(w) > 1 then left(w[1], 1) when len(w) = 1 then '' end as \"first\" from x",
    "seeded_sample": f"select lang, doc_id, row_number() over (partition by lang order by md5('{SEED}:' || doc_id), doc_id) as r from documents qualify r <= {SAMPLE}",
    "id_parse": "select page_id, replace(url, '/', ':') as owner, page_id as number, regexp_replace(replace(url, '/', ':') || '#c' || repeat('0', greatest(3 - length(page_id::varchar), 0)) || page_id, '[^a-zA-Z0-9._-]', '_', 'g') as file from pages",
}
QUERIES = {n: globals()[n] for n in [*ORACLES, "ligature_repair"]}
