"""Style of prose: sentences, openers, hedges, stock phrases, persons, tenses; paragraphs and how neighbouring sentences overlap."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from textloom.functions import text as T
from textloom.sources.folders import dealt


def t(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Connectives that may open a sentence.
CONNECTIVES = (
    "however", "moreover", "furthermore", "nevertheless", "nonetheless", "therefore", "thus", "hence", "consequently", "additionally",
    "specifically", "notably", "importantly", "interestingly", "alternatively", "finally", "second", "third", "first", "next",
    "note", "indeed", "clearly", "obviously", "instead", "similarly", "likewise", "also", "again", "overall", "briefly",
)
#: Hedges.
HEDGES = (
    "may", "might", "could", "appears", "appear", "seems", "seem", "suggests", "suggest", "likely", "unlikely", "tends", "tend",
    "generally", "typically", "often", "usually", "relatively", "somewhat", "quite", "very", "clearly", "obviously", "certainly",
    "indeed", "importantly", "notably",
)
#: Stock phrases.
STOCK = (
    "it is worth noting", "it should be noted", "note that", "it is well known", "as mentioned above", "as described in",
    "in the sense that", "with respect to", "in terms of", "on the other hand", "in contrast", "in particular",
    "for example", "for instance", "such that", "so that", "in order to", "due to", "based on", "as follows",
    "the remainder of this", "is organized as follows", "without loss of generality", "it turns out", "it follows that",
    "as can be seen", "as shown in", "in line with", "consistent with", "in the context of",
)
#: Persons; I is told from i.
PERSONS = (("we", "we"), ("our", "our"), ("I", "I"), ("the authors", "the authors"), ("this paper/article/study", "this (?:paper|article|study)"))
#: What tables and figures do.
FIGURE_VERBS = ("shows", "presents", "reports", "displays", "summarizes", "summarises", "contains", "lists", "gives", "provides")
#: Verbs of the tense count with their past forms.
TENSES = {
    "propose": "proposed", "present": "presented", "consider": "considered", "use": "used", "assume": "assumed", "show": "showed",
    "develop": "developed", "examine": "examined", "investigate": "investigated", "evaluate": "evaluated", "compare": "compared",
    "conduct": "conducted", "perform": "performed", "apply": "applied", "discuss": "discussed", "find": "found", "demonstrate": "demonstrated",
}
#: How a paragraph or sentence may open.
OPENERS = ["however", "thus", "therefore", "moreover", "furthermore", "in addition", "additionally", "specifically", "note that", "first", "second", "third", "finally",
           "for example", "for instance", "in particular", "in contrast", "by contrast", "similarly", "consequently", "as a consequence", "hence", "also", "indeed",
           "nevertheless", "nonetheless", "overall", "in sum", "in summary", "in other words", "that is", "instead", "next", "again", "alternatively", "as expected", "to summarize"]
ANAPHORA = ["this", "these", "such"]
LOCATIVE = ["in this", "in the present", "in the following", "in section"]
#: Fixed value: paragraphs that are headings, tables, quotes or lists.
NO_PARAGRAPH = r"^(#|\||>|- |\* )"


def _prose(spark, d):
    return dealt(spark, f"{d}/documents.parquet").select("doc_id", "lang", T.prose(F.col("text")).alias("text"))


def _sentences(spark, d):
    return _prose(spark, d).select("doc_id", "lang", F.explode(T.sentences(F.col("text"))).alias("s")).select("doc_id", "lang", T.tokens(F.col("s")).alias("w")).where(F.size("w") > 0)


def text_clean(spark, d):
    """Prose without references, images, link targets, marks, formulas, code and lines that are no prose."""
    return t(spark, d, "documents").select("doc_id", T.prose(F.col("text")).alias("clean"))


def _top_openers(s, w):
    """The 25 most frequent values of w, per language and over all, with rates per 10,000 sentences."""
    g = s.select("lang", w.alias("w")).groupBy("lang", "w").agg(F.count("*").alias("n"))
    both = g.unionByName(g.groupBy("w").agg(F.sum("n").alias("n")).withColumn("lang", F.lit("all")))
    total = F.sum("n").over(Window.partitionBy("lang"))
    top = both.withColumn("total", total).where("w is not null").withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "w"))).where("r <= 25")
    return top.select("lang", "w", "n", F.round(F.col("n") * 10000.0 / F.col("total"), 4).alias("rate"))


def sentence_openers(spark, d):
    """First words of sentences, per language and over all, with rates per 10,000 sentences."""
    return _top_openers(_sentences(spark, d), F.get("w", 0))


def opener_pairs(spark, d):
    """First two words of sentences; one-word sentences count in the totals only."""
    return _top_openers(_sentences(spark, d), F.when(F.size("w") >= 2, F.concat_ws(" ", F.slice("w", 1, 2))))


def connective_openers(spark, d):
    """Sentences and those that open with a connective, per language and over all."""
    s = _sentences(spark, d).rollup("lang").agg(F.count("*").alias("sentences"), F.count_if(F.get("w", 0).isin(*CONNECTIVES)).alias("connective"))
    return s.select(F.coalesce("lang", F.lit("all")).alias("lang"), "sentences", "connective")


def hedge_rates(spark, d):
    x = _prose(spark, d).select("lang", T.tokens(F.col("text")).alias("t"))
    x = x.select("lang", F.size("t").alias("n"), F.size(F.filter("t", lambda w: w.isin(*HEDGES))).alias("h"))
    g = x.groupBy("lang").agg(F.sum("n").alias("tokens"), F.sum("h").alias("hedges"))
    return g.select("lang", "tokens", "hedges", F.round(F.coalesce(F.col("hedges") * 10000.0 / F.nullif("tokens", F.lit(0)), F.lit(0.0)), 4).alias("rate"))


def _tally(x, column, counted):
    """Rows of (lang, name, n) from sums of all counts over one scan."""
    g = x.groupBy("lang").agg(*[F.sum(n).alias(f"n{i}") for i, (_, n) in enumerate(counted)])
    return g.select("lang", F.explode(F.array(*[F.struct(F.lit(name).alias(column), F.col(f"n{i}").cast("long").alias("n")) for i, (name, _) in enumerate(counted)])).alias("x")).select("lang", "x.*")


def stock_phrase_rates(spark, d):
    """How often each stock phrase stands in the prose of a language; a phrase ends at a word limit."""
    x = _prose(spark, d).select("lang", F.lower("text").alias("low"))
    return _tally(x, "phrase", [(p, T.count_words(F.col("low"), p, True)) for p in STOCK])


def person_rates(spark, d):
    """Persons: all in lower-cased prose, but I in the text before formulas are taken out."""
    raw = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.coalesce("text", F.lit("")), *T.NO_PROSE[0]), *T.NO_PROSE[1]), *T.NO_PROSE[2])
    x = t(spark, d, "documents").select("lang", raw.alias("raw"), F.lower(T.prose(F.col("text"))).alias("low"))
    return _tally(x, "person", [(name, T.count_words(F.col("raw" if name == "I" else "low"), p)) for name, p in PERSONS])


def figure_verbs(spark, d):
    """Tables and figures that are named, and what they are said to do."""
    x = _prose(spark, d).select("lang", "text", F.lower("text").alias("low"))
    refs = [(k, F.regexp_count("text", F.lit(rf"(?<![{T.INSIDE}]){k} [0-9]+"))) for k in ("Table", "Figure")]
    return _tally(x, "pattern", refs + [(f"{k} ... {v}", T.count_words(F.col("low"), f"{k} [0-9]+ {v}")) for k in ("table", "figure") for v in FIGURE_VERBS])


def tense_ratio(spark, d):
    """How often `we` stands before a verb and before its past form; each language's ratio: inf without past forms, - without either."""
    x = _prose(spark, d).select("lang", F.lower("text").alias("low"))
    g = x.groupBy("lang").agg(F.sum(T.count_words(F.col("low"), "we (?:" + "|".join(TENSES) + ")")).alias("present"), F.sum(T.count_words(F.col("low"), "we (?:" + "|".join(TENSES.values()) + ")")).alias("past"))
    ratio = F.when(F.col("past") > 0, F.round(F.col("present") / F.col("past"), 6).cast("string")).when(F.col("present") > 0, "inf").otherwise("-")
    return g.withColumn("ratio", ratio)


def sentence_length_stats(spark, d):
    """Words a sentence: mean, median of the middle two, the index-based 90th percentile, and the share of 40 words and more."""
    c = _sentences(spark, d).groupBy("lang", F.size("w").alias("k")).agg(F.count("*").alias("c"))  # lengths are few, so counts of them stand for the rows
    w = Window.partitionBy("lang")
    c = c.withColumn("hi", F.sum("c").over(w.orderBy("k"))).withColumn("n", F.sum("c").over(w))
    at = lambda pos: F.min(F.when(F.col("hi") > pos, F.col("k")))
    mid = lambda p: F.floor(p / 2)
    return c.groupBy("lang").agg(
        F.max("n").alias("n"), F.round(F.sum(F.col("k") * F.col("c")) / F.max("n"), 6).alias("mean"),
        ((at(mid(F.col("n") - 1)) + at(mid(F.col("n")))) / 2).alias("median"),
        at(F.least(F.floor(F.col("n") * 9 / 10), F.col("n") - 1)).alias("p90"),
        F.round(F.sum(F.when(F.col("k") >= 40, F.col("c")).otherwise(0)) * 100.0 / F.max("n"), 6).alias("long_share"),
    )


def paragraphs(text):
    """Paragraphs of eight words and more that are no heading, table, quote or list."""
    return F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), r"\n[ \t\r\f]*\n"), lambda p: F.btrim(p)), lambda p: ~p.rlike(NO_PARAGRAPH) & (F.size(T.words(p)) >= 8))


def _words(text):
    return F.transform(T.words(text), lambda w: F.lower(w))


def adjacent_jaccard(spark, d):
    """Mean overlap of the longer words of neighbouring sentences of a document's paragraphs; a paragraph's first sentence has no neighbour before it."""
    long_words = lambda s: F.array_distinct(F.filter(_words(s), lambda w: F.length(w) > 4))
    sets = F.transform(paragraphs(F.col("text")), lambda p: F.transform(T.plain_sentences(p), long_words))
    both = lambda a, b: F.struct(F.size(F.array_intersect(a, b)).alias("same"), (F.size(a) + F.size(b)).alias("all"))
    pairs = lambda q: F.flatten(F.transform(F.filter(q, lambda x: F.size(x) > 1), lambda x: F.zip_with(F.slice(x, F.lit(1), F.size(x) - 1), F.slice(x, F.lit(2), F.size(x) - 1), both)))
    mean = lambda p: F.aggregate(p, F.lit(0.0), lambda s, x: s + x["same"] / (x["all"] - x["same"])) / F.size(p)
    # A generator of one row a document: what stands before it is worked out once, though its result is both tested and returned.
    counted = F.transform(F.array(F.filter(pairs(sets), lambda x: x["all"] > 0)), lambda p: F.struct(F.size(p).cast("long").alias("pairs"), F.when(F.size(p) > 0, F.round(mean(p), 6)).alias("jaccard")))
    return dealt(spark, f"{d}/documents.parquet").select("doc_id", F.inline(counted)).where("pairs > 0")


def _opening(three, first):
    starts = lambda xs: three.rlike("^(" + "|".join(xs) + ")")
    return F.when(starts(OPENERS), "connective").when(first.isin(ANAPHORA), "anaphora").when(starts(LOCATIVE), "locative").when(first.isin("table", "figure", "algorithm"), "display").otherwise("other")


def _spoken(spark, d):
    return t(spark, d, "conversations").select("conv_id", "turn", F.explode(paragraphs(F.col("text"))).alias("p")).withColumn("w", _words(F.col("p")))


def paragraph_stats(spark, d):
    """Paragraphs of eight words and more, their words and the longest."""
    return _spoken(spark, d).groupBy("conv_id").agg(F.count("*").alias("paragraphs"), F.sum(F.size("w")).alias("words"), F.max(F.size("w")).cast("long").alias("longest"))


def opening_types(spark, d):
    """Paragraphs by how they open: the first that holds of connective, anaphora, locative, display, other."""
    three = F.array_join(F.slice("w", 1, 3), " ")
    return _spoken(spark, d).select(_opening(three, F.get("w", 0)).alias("opening")).groupBy("opening").agg(F.count("*").alias("n"))


def closing_sentences(spark, d):
    """Paragraphs and those whose last sentence opens with a connective, by role."""
    x = t(spark, d, "conversations").select("role", F.explode(paragraphs(F.col("text"))).alias("p"))
    last = _words(F.coalesce(F.try_element_at(T.plain_sentences(F.col("p")), F.lit(-1)), F.lit("")))
    x = x.select("role", F.array_join(F.slice(last, 1, 3), " ").alias("three"))
    return x.groupBy("role").agg(F.count("*").alias("paragraphs"), F.count_if(F.col("three").rlike("^(" + "|".join(OPENERS) + ")")).alias("closed"))


_in = lambda xs: ", ".join(f"'{x}'" for x in xs)
CLEAN_SQL = "coalesce(text, '')"
for _p, _put in T.NO_PROSE:
    _flags = "(?ims)" if _p.startswith("(?ims)") else ""
    CLEAN_SQL = "regexp_replace({}, '{}', '{}', 'g')".format(CLEAN_SQL, _flags + _p.removeprefix(_flags), _put.replace("$1", r"\1"))
CLEAN_SQL = f"regexp_replace(array_to_string(list_filter(list_transform(string_split({CLEAN_SQL}, chr(10)), lambda s: trim(s)), lambda s: not (regexp_matches(s, '^[#>*\\s-]*$') or regexp_matches(s, '^(\\||\\$|\\\\\\[)') or regexp_matches(s, '\\|.*\\|') or (length(s) >= 20 and length(regexp_replace(s, '[^\\p{{L}}\\p{{N}}]', '', 'g')) * 100 < length(s) * 45))), ' '), '[ \\t\\r\\n\\f]+', ' ', 'g')"
_CL = f"cl as (select doc_id, lang, {CLEAN_SQL} as text from documents)"
_HELD = "text"
for _w in T.ABBREVIATIONS:
    _HELD = f"replace({_HELD}, '{_w}', '{_w.replace('.', T.KEPT_STOP)}')"
_SENT = f"list_filter(list_transform(string_split(regexp_replace({_HELD}, '([.!?])\\s+([A-Z0-9\"''(])', '\\1' || chr(1) || '\\2', 'g'), chr(1)), lambda x: trim(replace(x, chr(2), '.'))), lambda x: length(x) > 2)"
_TOK = "regexp_extract_all(lower({}), '[a-z][a-z''\\-]*')"
_S = f"{_CL}, s0 as (select doc_id, lang, unnest({_SENT}) as s from cl), s as (select doc_id, lang, {_TOK.format('s')} as w from s0 where len({_TOK.format('s')}) > 0)"
_TOP = "g as (select lang, w, count(*) as n from o group by all), b as (select * from g union all select 'all', w, sum(n) from g group by 2), q as (select *, sum(n) over (partition by lang) as total from b) select lang, w, n::bigint as n, round(n * 10000e0 / total, 4) as rate from q where w is not null qualify row_number() over (partition by lang order by n desc, w) <= 25"
# Word limits without looking around: every character that is no letter or digit is doubled, so a match may take one of two.
_TWICE = "regexp_replace({}, '([^\\p{{L}}\\p{{N}}_])', '\\1\\1', 'g')"
_END = "([^\\p{L}\\p{N}_]|$)"


def _limits(column, pattern, open_start=False):
    return "len(regexp_extract_all({}, '{}({}){}'))".format(column, "" if open_start else "(^|[^\\p{L}\\p{N}_])", pattern.replace(" ", "  "), _END)


def _tally_sql(column, counted, source):
    return " union all ".join(f"select lang, '{name}' as {column}, sum({n})::bigint as n from {source} group by 1" for name, n in counted)


_LOW = f"{_CL}, x as (select lang, {_TWICE.format('text')} as text, {_TWICE.format('lower(text)')} as low from cl)"
_RAW = "coalesce(text, '')"
for _p, _put in T.NO_PROSE[:3]:
    _RAW = "regexp_replace({}, '{}', '{}', 'g')".format(_RAW, _p, _put.replace("$1", r"\1"))
_PARA = "list_filter(list_transform(regexp_split_to_array(coalesce(text, ''), '\\n[ \\t\\r\\f]*\\n'), lambda p: trim(p)), lambda p: not regexp_matches(p, '^(#|\\||>|- |\\* )') and len(regexp_extract_all(p, '[A-Za-z'']+')) >= 8)"
_PLAIN = "list_filter(string_split(regexp_replace({}, '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1)), lambda s: len(regexp_extract_all(s, '[A-Za-z'']+')) >= 3)"
_W = f"p as (select conv_id, role, unnest({_PARA}) as p from conversations), q as (select *, list_transform(regexp_extract_all(p, '[A-Za-z'']+'), lambda x: lower(x)) as w from p)"
_starts = lambda xs, three="array_to_string(w[1:3], ' ')": f"regexp_matches({three}, '^(" + "|".join(xs) + ")')"
ORACLES = {
    "text_clean": f"select doc_id, {CLEAN_SQL} as clean from documents",
    "sentence_openers": f"with {_S}, o as (select lang, w[1] as w from s), {_TOP}",
    "opener_pairs": f"with {_S}, o as (select lang, case when len(w) >= 2 then w[1] || ' ' || w[2] end as w from s), {_TOP}",
    "connective_openers": f"with {_S} select coalesce(lang, 'all') as lang, count(*) as sentences, count(*) filter (w[1] in ({_in(CONNECTIVES)})) as connective from s group by rollup (lang)",
    "hedge_rates": f"with {_CL}, x as (select lang, {_TOK.format('text')} as w from cl), g as (select lang, sum(len(w))::bigint as tokens, sum(len(list_filter(w, lambda x: x in ({_in(HEDGES)}))))::bigint as hedges from x group by 1) select *, case when tokens > 0 then round(hedges * 10000e0 / tokens, 4) else 0e0 end as rate from g",
    "stock_phrase_rates": f"with {_LOW} " + _tally_sql("phrase", [(p, _limits("low", p, True)) for p in STOCK], "x"),
    "person_rates": f"with {_CL}, r as (select doc_id, lang, {_TWICE.format(_RAW)} as raw from documents), x as (select r.lang, raw, {_TWICE.format('lower(text)')} as low from cl join r using (doc_id)) " + _tally_sql("person", [(n, _limits("raw" if n == "I" else "low", p)) for n, p in PERSONS], "x"),
    "figure_verbs": f"with {_LOW} " + _tally_sql("pattern", [(k, f"len(regexp_extract_all(text, '(^|[^\\p{{L}}\\p{{N}}_]){k}  [0-9]+'))") for k in ("Table", "Figure")] + [(f"{k} ... {v}", _limits("low", f"{k} [0-9]+ {v}")) for k in ("table", "figure") for v in FIGURE_VERBS], "x"),
    "tense_ratio": f"with {_LOW}, g as (select lang, sum({_limits('low', 'we (?:' + '|'.join(TENSES) + ')')})::bigint as present, sum({_limits('low', 'we (?:' + '|'.join(TENSES.values()) + ')')})::bigint as past from x group by 1) select *, case when past > 0 then round(present / past, 6)::varchar when present > 0 then 'inf' else '-' end as ratio from g",
    "sentence_length_stats": f"with {_S}, k as (select lang, len(w) as k from s), a as (select lang, list_sort(list(k)) as l, avg(k) as mean, count(*) filter (k >= 40) * 100e0 / count(*) as ls from k group by 1) select lang, len(l) as n, round(mean, 6) as mean, (l[(len(l) - 1) // 2 + 1] + l[len(l) // 2 + 1]) / 2 as median, l[least(len(l) * 9 // 10, len(l) - 1) + 1] as p90, round(ls, 6) as long_share from a",
    "adjacent_jaccard": f"with p as (select doc_id, unnest({_PARA}) as p, generate_subscripts({_PARA}, 1) as n from documents), s as (select doc_id, n, {_PLAIN.format('p')} as s from p), a as (select doc_id, n, unnest(s) as s, generate_subscripts(s, 1) as k from s), w as (select doc_id, n, k, list_distinct(list_filter(list_transform(regexp_extract_all(s, '[A-Za-z'']+'), lambda x: lower(x)), lambda x: length(x) > 4)) as a from a), b as (select doc_id, a, lag(a) over (partition by doc_id, n order by k) as b from w), x as (select doc_id, len(list_intersect(a, b)) as i, len(list_distinct(list_concat(a, b))) as u from b where b is not null) select doc_id, count(*) as pairs, round(avg(i / u), 6) as jaccard from x where u > 0 group by 1",
    "paragraph_stats": f"with {_W} select conv_id, count(*) as paragraphs, sum(len(w))::bigint as words, max(len(w)) as longest from q group by 1",
    "opening_types": f"with {_W} select case when {_starts(OPENERS)} then 'connective' when w[1] in ({_in(ANAPHORA)}) then 'anaphora' when {_starts(LOCATIVE)} then 'locative' when w[1] in ('table', 'figure', 'algorithm') then 'display' else 'other' end as opening, count(*) as n from q group by 1",
    "closing_sentences": f"with {_W}, c as (select role, ({_PLAIN.format('p')})[-1] as s from p), e as (select role, array_to_string(list_transform(regexp_extract_all(coalesce(s, ''), '[A-Za-z'']+'), lambda x: lower(x))[1:3], ' ') as three from c) select role, count(*) as paragraphs, count(*) filter ({_starts(OPENERS, 'three')}) as closed from e group by 1",
}
QUERIES = {n: globals()[n] for n in ORACLES}
