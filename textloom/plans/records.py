"""Identifiers, routes, ledgers, gates and validators over records made of the tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from textloom.functions import text as T
from textloom.operators.cooldown import suppressed
from textloom.operators.gates import gate_diff


def t(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Publishers by registrant prefix.
PUBLISHERS = [("10.1111/", "wiley"), ("10.1016/", "elsevier"), ("10.1017/", "cambridge"), ("10.1007/", "springer")]
PREFIXES = ("10.1111", "10.1016", "10.1017", "10.1007", "10.31234", "10.12")
_RAW = """case doc_id % 5 when 0 then concat('https://doi.org/', upper(d), '?ref=x') when 1 then concat('doi:', d) when 2 then concat('  ', replace(d, '/', '%2F'), ' ') when 3 then concat('https://dx.doi.org/', d) else d end"""
_DOI = "concat(element_at(array({}), cast(doc_id % 6 + 1 as int)), '/', source, '.', lang, '/', doc_id, case when doc_id % 4 = 0 then '_v2' else '' end)"


def doi_predicates(spark, d):
    """Identifiers in several written forms: normalised, tested, turned to ids, stripped of versions, routed; years, handles and limits."""
    x = t(spark, d, "documents").select("doc_id", "n_chars", F.expr(_DOI.format(", ".join(f"'{p}'" for p in PREFIXES))).alias("d"))
    x = x.withColumn("raw", F.expr(_RAW)).withColumn("doi", T.normalize_doi(F.col("raw")))
    route = F.when(F.col("doc_id") % 10 == 9, "open-access")  # a free copy goes before the publisher
    for prefix, name in PUBLISHERS:
        route = route.when(F.col("doi").startswith(prefix), name)
    year = T.year_of(F.concat((F.lit(1895) + F.col("n_chars") % 140).cast("string"), F.lit("-05-01T00:00:00Z")))
    asset = F.concat(F.replace("doi", F.lit("/"), F.lit(":")), F.element_at(F.array(*[F.lit(h) for h in ("-fig3", "-tab_12", "-eq-7", "-cover")]), (F.col("doc_id") % 4 + 1).cast("int")))
    paper = F.regexp_replace(asset, r"-(fig|tab|eq|math)[-_]?[0-9]+$", "")
    span = F.when(F.col("doc_id") % 3 == 0, F.lit(None).cast("long")).otherwise(F.lit(2000))
    return x.select(
        "doc_id", "doi", T.valid_doi(F.col("doi")).alias("valid"), T.doi_id(F.col("doi")).alias("doi_id"), F.regexp_replace("doi", "/", ":").substr(F.lit(1), F.lit(60)).alias("id_60"), T.unversioned(F.col("doi")).alias("base"), year.alias("year"),
        route.otherwise("unknown").alias("route"), F.when(paper != asset, F.substring(asset, F.length(paper) + 2, F.length(asset))).otherwise(asset).alias("handle"),
        year.between(F.coalesce(span, F.lit(1900)), F.lit(2026)).alias("in_range"), F.least(F.coalesce(F.nullif(F.col("doc_id") % 40, F.lit(0)), F.lit(10)), F.lit(20)).alias("leg_limit"),
    )


#: Which format of a family's paper is parsed, and how: (family, format or none, years up to, route, reason), the first that holds.
ROUTES = [
    ("arxiv", "tex", None, "tex", None),
    ("arxiv", "pdf", None, "pdf", None),
    ("arxiv", None, None, "none", "metadata-only"),
    ("psychometrika", "html", None, "html", None),
    ("psychometrika", "pdf", 1960, "ocr", None),
    ("psychometrika", "pdf", 2011, "pdf", None),
    ("psychometrika", "pdf", None, "none", "table-source doctrine (pdf 2012+, no html)"),
    ("psychometrika", "xml", None, "none", "aux-only xml"),
    ("psychometrika", None, None, "none", "no md-format source"),
    ("jem", "xml", None, "xml", None),
    ("jem", "pdf", 2004, "ocr", None),
    ("jem", "pdf", None, "pdf", None),
    ("jem", None, None, "none", "abstract-only html, no pdf twin"),
    ("bjmsp", "xml", None, "xml", None),
    ("bjmsp", "pdf", None, "pdf", None),
    ("bjmsp", None, None, "none", "abstract-only html, no pdf twin"),
    ("jebs", "html", None, "html", None),
    ("jebs", "xml", None, "xml", None),
    ("jebs", "pdf", None, "pdf", None),
    ("jebs", None, None, "none", "no source"),
    ("psyarxiv", "docx", None, "docx", None),
    ("psyarxiv", "pdf", None, "pdf", None),
    ("psyarxiv", None, None, "none", "no source"),
]
FAMILIES = ("arxiv", "psychometrika", "jem", "bjmsp", "jebs", "psyarxiv", "other")
FORMATS = ("tex", "pdf", "html", "xml", "docx")


def route_of(family, formats, year):
    """Struct of route, fmt and reason of a paper by family, the formats that there are, and year."""
    out = None
    for fam, fmt, upto, route, reason in ROUTES:
        test = family == fam
        test = test & F.array_contains(formats, fmt) if fmt else test
        test = test & (year <= upto) if upto else test
        value = F.struct(F.lit(route).alias("route"), F.lit("" if route == "none" else fmt).alias("fmt"), F.lit(reason).cast("string").alias("reason"))
        out = F.when(test, value) if out is None else out.when(test, value)
    return out.otherwise(F.struct(F.lit("none").alias("route"), F.lit("").alias("fmt"), F.concat(F.lit("unknown family "), family).alias("reason")))


def _routed(spark, d):
    """Papers are documents; the manifest is made of labels, and some of its rows name papers that documents don't have."""
    family = lambda k: F.element_at(F.array(*[F.lit(x) for x in FAMILIES]), (k % 7 + 1).cast("int"))
    papers = t(spark, d, "documents").select("doc_id", family(F.col("doc_id")).alias("fam"), (F.lit(1950) + F.col("n_chars") % 75).alias("year"))
    k = F.col("doc_id") * 5 + F.col("toxic") * 3 + F.col("quality")
    made = t(spark, d, "labels").select(
        F.when(F.col("doc_id") % 9 == 0, F.col("doc_id") + 1000000000).otherwise(F.col("doc_id")).alias("doc_id"),
        F.filter(F.array(*[F.when(F.shiftright(k, i) % 2 == 1, F.lit(x)) for i, x in enumerate(FORMATS)]), lambda x: x.isNotNull()).alias("formats"),
        (F.col("doc_id") * 1000003 % 900001 + 1000).alias("bytes"),
    )
    x = papers.join(made, "doc_id", "full").select("doc_id", F.coalesce("fam", family(F.col("doc_id"))).alias("fam"), F.coalesce("year", F.lit(0)).alias("year"), F.coalesce("formats", F.array().cast("array<string>")).alias("formats"), "bytes")
    return x.withColumn("r", route_of(F.col("fam"), F.col("formats"), F.col("year"))).select("doc_id", "fam", "year", "r.*", F.when(F.col("r.route") != "none", F.col("bytes")).alias("bytes"))


def route_rows(spark, d):
    """The queue: each paper with its route, the object to parse, or the reason why there is none."""
    return _routed(spark, d).withColumn("key", F.when(F.col("fmt") != "", F.concat(F.lit("raw/"), F.col("doc_id").cast("string"), F.lit("."), F.col("fmt"))).otherwise(""))


def route_queue(spark, d):
    """The census of routes: papers and their size."""
    return _routed(spark, d).groupBy("route").agg(F.count("*").alias("papers"), F.round(F.coalesce(F.sum("bytes"), F.lit(0)) / 1e6, 3).alias("mb"))


#: Messages that stand for failures, by the number of the source; `%` is the source itself.
MESSAGES = ("Docling conversion failed: %", "item was not enqueued", "OCR: %", "the ocr: % of it", "scan-quality below limit", "no main file in %", "Pandoc ladder exhausted", "tex conversion exhausted", "timeout of a very long kind that goes on and on for %", None)


def parse_ledger(spark, d):
    """Papers with their Markdown statistics where there are any: state, flags, and the class of failure where parsing failed.

    Documents are papers. Their labels say what became of them, and texts of fewer than 300 characters have no statistics.
    """
    message = F.replace(F.element_at(F.array(*[F.lit(m) for m in MESSAGES]), (F.regexp_extract("source", "([0-9]+)", 1).cast("int") % 10 + 1)), F.lit("%"), F.col("source"))
    state = F.when(F.col("quality").isNull(), "listed").when(F.col("quality") == 1, "parsed").otherwise("parsing-failed")
    papers = t(spark, d, "documents").join(t(spark, d, "labels").select("doc_id", "quality"), "doc_id", "left").select("doc_id", state.alias("state"), message.alias("error"))
    stats = t(spark, d, "documents").where("n_chars >= 300").select("doc_id", T.md_stats(F.col("text")).alias("s"))
    failed = F.col("state") == "parsing-failed"
    return papers.join(stats, "doc_id", "left").select(
        "doc_id", "state", F.col("s.bytes").alias("bytes"), F.col("s.headings").alias("headings"), F.when(F.col("s").isNull(), "no-md").otherwise(F.array_join("s.flags", "|")).alias("flags"),
        F.when(failed, T.error_category(F.col("error"))).otherwise("").alias("failure"),
    )


def latest_version(spark, d):
    """The latest version of each customer's orders: the greatest number, one without a number before all, of equal ones the later."""
    o = t(spark, d, "orders").withColumn("version", F.when(F.col("o_orderstatus") != "F", F.left("o_orderpriority", F.lit(1)).cast("long")))
    best = F.max_by("o_orderkey", F.struct(F.coalesce("version", F.lit(2**53 - 1)), "o_orderdate", "o_orderkey"))
    return o.groupBy("o_custkey").agg(best.alias("o_orderkey"), F.count("*").alias("versions"))


def ttl_dedup(spark, d):
    """Events that are answered from the cache: their user's same event was stored less than 30 minutes before. An answer from the cache doesn't renew it."""
    e = t(spark, d, "events").select("event_id", "ts", "user_id", "event_type")
    stored = suppressed(e, ["user_id", "event_type"], "ts", "event_id", F.lit(30)).select("event_id", F.lit(False).alias("_cached"))
    return e.select("event_id").join(stored, "event_id", "left").select("event_id", F.coalesce("_cached", F.lit(True)).alias("cached"))


BEAT = 6  # hours


def heartbeat_window(spark, d):
    """Progress every six hours: what is done in all, the rate a minute since the beat before, and flags.

    Errors are items still in work: STALL where some are, nothing was done and no item moved since the beat before; DEAD where none is in work and less is done than
    there is in all. One row a beat: running sums are over beats, not events.
    """
    e = t(spark, d, "events").select(F.window("ts", f"{BEAT} hours")["start"].alias("beat"), F.col("event_type").isin("signup", "purchase").alias("done"), (F.col("event_type") == "error").alias("bad"))
    seen = e.groupBy("beat").agg(F.count_if("done").alias("done"), F.count_if("bad").alias("bad"), F.count("*").alias("moved"))
    return beats(seen)


def beats(seen):
    """Rates and flags of (beat, done, bad, moved) rows, one a beat that had any; beats between them count as empty."""
    ends = seen.agg(F.min("beat").alias("lo"), F.max("beat").alias("hi"), F.sum("done").alias("expected"))
    x = ends.select("expected", F.explode(F.sequence("lo", "hi", F.expr(f"interval {BEAT} hours"))).alias("beat")).join(seen, "beat", "left").fillna(0)
    w = Window.partitionBy(F.lit(0)).orderBy("beat")  # a row a beat
    x = x.withColumn("md", F.sum("done").over(w)).withColumn("rate", F.floor((F.col("md") - F.lag("md", 1, 0).over(w)) / (BEAT * 60.0) * 1000) / 1000)
    flag = F.when((F.col("bad") > 0) & (F.col("rate") <= 0) & (F.col("moved") == F.col("bad")), "STALL").when((F.col("bad") == 0) & (F.col("md") < F.col("expected")), F.concat(F.lit("DEAD(queue-empty,"), (F.col("expected") - F.col("md")).cast("string"), F.lit("-remaining)"))).otherwise("")
    return x.select(F.date_format("beat", "yyyy-MM-dd HH").alias("beat"), "md", F.col("bad").alias("running"), F.round("rate", 3).alias("rate"), flag.alias("flags"))


def _changed(col, n):
    """How the new form of a document differs, by its id: not, by white space, by a renamed asset, by their order, by a table, by prose."""
    k = F.col("doc_id") % 6
    line = lambda *x: F.concat(F.col("text"), F.lit("\n"), *[F.lit(v) if isinstance(v, str) else v for v in x])
    if n == "old":
        return F.when(k == 2, line("![", F.col("source"), "](10.1111:j-fig3)")).when(k == 3, line("![A](10.1111:j-fig1)\n![B](10.1111:j-tab1)")).when(k == 4, line("| a | b |\n**Table 1.** ", F.col("lang"))).when(k == 5, line("old prose")).otherwise(F.col("text"))
    return F.when(k == 1, F.concat("text", F.lit("  "))).when(k == 2, line("![", F.col("source"), "](fig3)")).when(k == 3, line("![B](tab2)\n![A](fig7)")).when(k == 4, line("![T](tab1)\n")).when(k == 5, line("new prose")).otherwise(F.col("text"))


def gate_classify(spark, d):
    """New forms of documents against the old ones: which lines differ, and how; a gate passes where nothing is unexpected."""
    docs = t(spark, d, "documents")
    return gate_diff(docs.select("doc_id", _changed("text", "old").alias("text")), docs.select("doc_id", _changed("text", "new").alias("text")), allow_revert=True)


def symmetric_difference(spark, d):
    """Ids that only documents or only labels have, and those that both have."""
    a, b = t(spark, d, "documents").select("doc_id", F.lit(1).alias("a")), t(spark, d, "labels").select((F.col("doc_id") + F.col("quality") * 3).alias("doc_id"), F.lit(1).alias("b")).distinct()
    side = F.when(F.col("b").isNull(), "only-documents").when(F.col("a").isNull(), "only-labels").otherwise("both")
    return a.join(b, "doc_id", "full").groupBy(side.alias("side")).agg(F.count("*").alias("n"))


def source_coalesce(spark, d):
    """Three sources of a value and a language, any of which may lack a document: the first that has one counts."""
    a = t(spark, d, "labels").select("doc_id", F.when(F.col("quality") == 1, F.lit(100)).cast("long").alias("a"), F.lit(None).cast("string").alias("a_lang"))
    b = t(spark, d, "documents").where("n_chars % 3 > 0").select("doc_id", F.when(F.col("n_chars") > 500, F.col("n_chars")).alias("b"), F.col("lang").alias("b_lang"))
    c = t(spark, d, "documents").select((F.col("doc_id") + 5).alias("doc_id"), F.col("n_chars").alias("c"), F.upper("lang").alias("c_lang"))
    x = a.join(b, "doc_id", "full").join(c, "doc_id", "full")
    return x.select("doc_id", F.coalesce("a", "b", "c", F.lit(0)).alias("value"), F.coalesce("a_lang", "b_lang", "c_lang", F.lit("en")).alias("lang"))


def page_validators(spark, d):
    """Whether a page passes as a body of XML or as full text of HTML in either of two readings, and what its bytes are."""
    size, sections, refs = F.octet_length("html"), F.regexp_count("html", F.lit("<p>")), F.regexp_count("html", F.lit("<li>"))
    x = t(spark, d, "pages").select("page_id", "html", size.alias("n"), sections.alias("s"), refs.alias("r"))
    body = F.length("html") > 50000
    return x.select(
        "page_id", ((F.col("n") > 20000) & F.col("html").contains("<article")).alias("xml_ok"), ((F.col("n") > 40960) & ((F.col("s") > 4) | (F.col("r") > 0))).alias("html_ok"),
        ((F.col("n") > 40960) & ((F.col("s") >= 3) | (F.col("r") >= 10))).alias("html_strict"), (body & F.col("html").rlike('<div[^>]*[ \\n]class="([^"]*[ \\n])?(body|ad)([ \\n][^"]*)?"')).alias("fulltext"),
        T.sniffed(F.encode("html", "UTF-8"), F.when(F.col("page_id") % 5 == 0, "application/pdf").otherwise("text/html")).alias("format"),
    )


def spot_check(spark, d):
    """Five keys drawn by a seed, with whether anything is stored under them."""
    draw = F.md5(F.concat(F.lit("7:"), F.col("page_id").cast("string")))
    return t(spark, d, "pages").orderBy(draw, "page_id").limit(5).select("page_id", (F.octet_length("html") > 0).alias("stored"))


def prefix_counts(spark, d):
    """The seven registrant prefixes that most documents have."""
    x = t(spark, d, "documents").select(F.concat(F.element_at(F.array(*[F.lit(p) for p in PREFIXES]), (F.col("n_chars") % 6 + 1).cast("int")), F.lit(":"), F.col("source")).alias("id"))
    return x.groupBy(F.substring_index("id", ":", 1).alias("prefix")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "prefix").limit(7)


def base64_export(spark, d):
    """Each passage's bytes as base64, with their number."""
    return t(spark, d, "benchmark").select("item_id", F.octet_length("text").cast("long").alias("bytes"), F.regexp_replace(F.base64(F.encode("text", "UTF-8")), "[\r\n]", "").alias("base64"))


def first_author_qc(spark, d):
    """Of the papers of one first author the earliest is kept, of equal dates the one of the least id; a missing date comes last, and one without an author is kept.

    Suppliers' names and numbers stand for authors, and orders for papers.
    """
    name = F.when(F.col("o_orderkey") % 97 > 0, F.concat(F.element_at(F.array(*[F.lit(x) for x in ("José ", "Anna M. ", "van der ", "L. S. ", "")]), (F.col("o_custkey") % 5 + 1).cast("int")), F.lit("Schönenberger"), F.translate((F.col("o_custkey") % 300).cast("string"), "0123456789", "abcdefghij"), F.when(F.col("o_orderkey") % 3 == 0, " Jr.").otherwise("")))
    o = t(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 50 > 0, F.col("o_orderdate")).alias("created"), M.name_key(name).alias("k"), name.isNull().alias("none"))
    w = Window.partitionBy("k.last", "k.first", F.when(F.col("none"), F.col("o_orderkey"))).orderBy(F.coalesce("created", F.lit("9999-01-01").cast("timestamp")), "o_orderkey")
    return o.select("o_orderkey", F.when(~F.col("none"), F.concat_ws(",", "k.last", "k.first")).alias("author"), (F.row_number().over(w) == 1).alias("kept"))


from textloom.functions import markup as M  # noqa: E402

_list = lambda xs: "[" + ", ".join(f"'{x}'" for x in xs) + "]"
_D = f"concat(({_list(PREFIXES)})[doc_id % 6 + 1], '/', source, '.', lang, '/', doc_id, case when doc_id % 4 = 0 then '_v2' else '' end)"
_CASES = " ".join("when fam = '{}'{}{} then {}".format(f, f" and list_contains(formats, '{m}')" if m else "", f" and year <= {y}" if y else "", "{'route': '%s', 'fmt': '%s', 'reason': %s}" % (r, "" if r == "none" else m, f"'{why}'" if why else "null::varchar")) for f, m, y, r, why in ROUTES)
_FAM = f"({_list(FAMILIES)})[doc_id % 7 + 1]"
_ROUTED = f"""p as (select doc_id, {_FAM} as fam, 1950 + n_chars % 75 as year from documents),
m as (select case when doc_id % 9 = 0 then doc_id + 1000000000 else doc_id end as doc_id, list_filter([{", ".join(f"case when ((doc_id * 5 + toxic * 3 + quality) >> {i}) % 2 = 1 then '{x}' end" for i, x in enumerate(FORMATS))}], lambda x: x is not null) as formats, doc_id * 1000003 % 900001 + 1000 as bytes from labels),
j as (select doc_id, coalesce(fam, {_FAM}) as fam, coalesce(year, 0) as year, coalesce(formats, []::varchar[]) as formats, bytes from p full join m using (doc_id)),
c as (select doc_id, fam, year, bytes, case {_CASES} else {{'route': 'none', 'fmt': '', 'reason': concat('unknown family ', fam)}} end as r from j),
q as (select doc_id, fam, year, r.route as route, r.fmt as fmt, r.reason as reason, case when r.route <> 'none' then bytes end as bytes from c)"""
_MSG = "[" + ", ".join("null" if m is None else f"'{m}'" for m in MESSAGES) + "]"
_FAIL = " ".join(f"when {'starts_with' if p == 'ocr:' else 'contains'}(lower(error), '{p}') then '{n}'" for n, p in T.FAILURES)
_PAUSE = "interval 30 minute"
_OLD = "case doc_id % 6 when 2 then text || chr(10) || '![' || source || '](10.1111:j-fig3)' when 3 then text || chr(10) || '![A](10.1111:j-fig1)' || chr(10) || '![B](10.1111:j-tab1)' when 4 then text || chr(10) || '| a | b |' || chr(10) || '**Table 1.** ' || lang when 5 then text || chr(10) || 'old prose' else text end"
_NEW = "case doc_id % 6 when 1 then text || '  ' when 2 then text || chr(10) || '![' || source || '](fig3)' when 3 then text || chr(10) || '![B](tab2)' || chr(10) || '![A](fig7)' when 4 then text || chr(10) || '![T](tab1)' || chr(10) when 5 then text || chr(10) || 'new prose' else text end"
_REF, _NEWREF = r"^!\[.*\]\(10\.[0-9]+:[^)]*-(fig|tab|eq)[0-9]+\)$", r"^!\[.*\]\((fig|tab|eq)[0-9]+\)$"
_NAME = "case when o_orderkey % 97 > 0 then concat((['José ', 'Anna M. ', 'van der ', 'L. S. ', ''])[o_custkey % 5 + 1], 'Schönenberger', translate((o_custkey % 300)::varchar, '0123456789', 'abcdefghij'), case when o_orderkey % 3 = 0 then ' Jr.' else '' end) end"


def _lines(name, sql):
    return f"{name} as (select doc_id, line, count(*) as n from (select doc_id, unnest(string_split({sql}, chr(10))) as line from documents) group by all)"


ORACLES = {
    "doi_predicates": f"""with a as (select *, {_D} as d from documents), b as (select *, {_RAW} as raw from a), c as (select *, lower(url_decode(regexp_replace(regexp_replace(trim(raw), '(?i)^https?://[^/?#]*/*([^?#]*).*$', '\\1'), '(?i)^doi:', ''))) as doi from b),
e as (select *, 1895 + n_chars % 140 as year, replace(doi, '/', ':') || (['-fig3', '-tab_12', '-eq-7', '-cover'])[doc_id % 4 + 1] as asset from c), f as (select *, regexp_replace(asset, '-(fig|tab|eq|math)[-_]?[0-9]+$', '') as paper from e)
select doc_id, doi, regexp_matches(doi, '^10\\.[0-9]{{4,9}}/.') as valid, replace(doi, '/', ':') as doi_id, left(replace(doi, '/', ':'), 60) as id_60, regexp_replace(doi, '_?v[0-9]+$', '') as base, year,
case when doc_id % 10 = 9 then 'open-access' {" ".join(f"when starts_with(doi, '{p}') then '{n}'" for p, n in PUBLISHERS)} else 'unknown' end as route, case when paper <> asset then substring(asset, length(paper) + 2) else asset end as handle,
year between case when doc_id % 3 = 0 then 1900 else 2000 end and 2026 as in_range, least(coalesce(nullif(doc_id % 40, 0), 10), 20) as leg_limit from f""",
    "route_rows": f"with {_ROUTED} select *, case when fmt <> '' then concat('raw/', doc_id, '.', fmt) else '' end as key from q",
    "route_queue": f"with {_ROUTED} select route, count(*) as papers, round(coalesce(sum(bytes), 0) / 1e6, 3) as mb from q group by 1",
    "parse_ledger": f"""with x as (select doc_id, case when quality is null then 'listed' when quality = 1 then 'parsed' else 'parsing-failed' end as state, replace(({_MSG})[regexp_extract(source, '([0-9]+)', 1)::int % 10 + 1], '%', source) as error, n_chars,
 text, strlen(text) as bytes, len(regexp_extract_all(text, '(?m)^#{{1,6}} .')) as headings, len(regexp_extract_all(text, '\\[formula\\]')) as formula_tokens from documents left join labels using (doc_id))
select doc_id, state, case when n_chars >= 300 then bytes end as bytes, case when n_chars >= 300 then headings end as headings, case when n_chars >= 300 then array_to_string(list_filter({{FLAGS}}, lambda f: f is not null), '|') else 'no-md' end as flags,
case when state <> 'parsing-failed' then '' when error is null or error = '' then 'unknown' {_FAIL} else concat('other:', left(error, 50)) end as failure from x""",
    "latest_version": "select o_custkey, arg_max(o_orderkey, (case when o_orderstatus <> 'F' then left(o_orderpriority, 1)::bigint else 9007199254740991 end, o_orderdate, o_orderkey)) as o_orderkey, count(*) as versions from orders group by 1",
    "ttl_dedup": f"with recursive k as (select user_id, event_type, min(ts) as ts from events group by all union all select e.user_id, e.event_type, min(e.ts) from k join events e on e.user_id = k.user_id and e.event_type = k.event_type and e.ts >= k.ts + {_PAUSE} group by all), s as (select min(event_id) as event_id from events join k using (user_id, event_type, ts) group by user_id, event_type, ts) select event_id, event_id not in (select event_id from s) as cached from events",
    "heartbeat_window": f"""with g as (select time_bucket(interval {BEAT} hours, ts) as beat, count(*) filter (event_type in ('signup', 'purchase')) as done, count(*) filter (event_type = 'error') as bad, count(*) as moved from events group by 1),
s as (select unnest(generate_series((select min(beat) from g), (select max(beat) from g), interval {BEAT} hours)) as beat), x as (select beat, coalesce(done, 0) as done, coalesce(bad, 0) as bad, coalesce(moved, 0) as moved from s left join g using (beat)),
y as (select *, (sum(done) over (order by beat))::bigint as md, (sum(done) over ())::bigint as expected from x), z as (select *, floor((md - coalesce(lag(md) over (order by beat), 0)) / {BEAT * 60}e0 * 1000) / 1000 as rate from y)
select strftime(beat, '%Y-%m-%d %H') as beat, md, bad as running, round(rate, 3) as rate, case when bad > 0 and rate <= 0 and moved = bad then 'STALL' when bad = 0 and md < expected then concat('DEAD(queue-empty,', expected - md, '-remaining)') else '' end as flags from z""",
    "gate_classify": f"""with {_lines('o', _OLD)}, {_lines('n', _NEW)}, r as (select doc_id, trim(line) as line, sum(greatest(coalesce(o.n, 0) - coalesce(n.n, 0), 0)) as rem, sum(greatest(coalesce(n.n, 0) - coalesce(o.n, 0), 0)) as add from o full join n using (doc_id, line) group by all),
w as (select doc_id, line, least(rem, add) as ws, rem - least(rem, add) as rem, add - least(rem, add) as add from r),
l as (select *, regexp_extract(line, '^!\\[(.*)\\]\\(.*\\)$', 1) as cap, regexp_extract(line, '(fig|tab|eq)[0-9]+\\)$', 0) as short, regexp_matches(line, '{_REF}') as old_ref, regexp_matches(line, '{_NEWREF}') as new_ref from w),
k as (select doc_id, cap, short, least(coalesce(sum(rem) filter (old_ref), 0), coalesce(sum(add) filter (new_ref), 0)) as ren from l where old_ref or new_ref group by all having least(coalesce(sum(rem) filter (old_ref), 0), coalesce(sum(add) filter (new_ref), 0)) > 0),
f as (select l.doc_id, line, ws, rem - case when old_ref then coalesce(ren, 0) else 0 end as rem, add - case when new_ref then coalesce(ren, 0) else 0 end as add, cap, old_ref or new_ref as any_ref, new_ref, short, case when old_ref then coalesce(ren, 0) else 0 end as ren from l left join k using (doc_id, cap, short)),
a as (select doc_id, list(distinct cap) filter (add > 0 and any_ref) as caps from f group by 1),
g as (select doc_id, sum(ws) as whitespace, sum(ren) as renamed, sum(rem) as rem, sum(add) as add, sum(rem) filter (line <> '') as solid_r, sum(add) filter (line <> '') as solid_a,
 bool_and(any_ref) filter (line <> '' and (rem > 0 or add > 0)) as all_refs, bool_and(cap = '' or list_contains(caps, cap)) filter (rem > 0 and line <> '') as kept, bool_and(line = '' or (new_ref and starts_with(short, 'tab'))) filter (add > 0) as tabs,
 bool_or(starts_with(line, '|') or starts_with(line, '**Table') or regexp_matches(line, '-tab[0-9]+\\.html\\)')) filter (rem > 0) as tables from f join a using (doc_id) group by 1),
v as (select doc_id, whitespace::bigint as whitespace, renamed::bigint as renamed, case when whitespace + renamed + rem + add = 0 then 'identical' when solid_r > 0 and solid_a > 0 and all_refs and kept then 'ref-layout' when add > 0 and tabs and tables then 'splice-revert' when rem + add > 0 then 'unexpected' else 'explained' end as rest from g)
select *, rest <> 'unexpected' as pass from v""",
    "symmetric_difference": "with a as (select doc_id, 1 as a from documents), b as (select distinct doc_id + quality * 3 as doc_id, 1 as b from labels) select case when b is null then 'only-documents' when a is null then 'only-labels' else 'both' end as side, count(*) as n from a full join b using (doc_id) group by 1",
    "source_coalesce": "with a as (select doc_id, case when quality = 1 then 100 end as a from labels), b as (select doc_id, case when n_chars > 500 then n_chars end as b, lang as b_lang from documents where n_chars % 3 > 0), c as (select doc_id + 5 as doc_id, n_chars as c, upper(lang) as c_lang from documents) select doc_id, coalesce(a, b, c, 0)::bigint as value, coalesce(b_lang, c_lang, 'en') as lang from a full join b using (doc_id) full join c using (doc_id)",
    "page_validators": """with x as (select page_id, html, strlen(html) as n, len(regexp_extract_all(html, '<p>')) as s, len(regexp_extract_all(html, '<li>')) as r from pages) select page_id, n > 20000 and contains(html, '<article') as xml_ok, n > 40960 and (s > 4 or r > 0) as html_ok, n > 40960 and (s >= 3 or r >= 10) as html_strict,
length(html) > 50000 and regexp_matches(html, '<div[^>]*[ \\n]class="([^"]*[ \\n])?(body|ad)([ \\n][^"]*)?"') as fulltext, case when n < 500 then 'small' when starts_with(html, '%PDF') or page_id % 5 = 0 then 'pdf' else 'unexpected' end as format from x""",
    "spot_check": "select page_id, strlen(html) > 0 as stored from pages order by md5('7:' || page_id), page_id limit 5",
    "prefix_counts": f"select ({_list(PREFIXES)})[n_chars % 6 + 1] as prefix, count(*) as n from documents group by 1 order by n desc, prefix limit 7",
    "base64_export": "select item_id, strlen(text) as bytes, base64(encode(text)) as base64 from benchmark",
    "first_author_qc": f"""with x as (select o_orderkey, case when o_orderkey % 50 > 0 then o_orderdate end as created, {_NAME} as name from orders), y as (select *, list_filter(regexp_split_to_array(lower(strip_accents(name)), '[^a-z]+'), lambda w: w not in ('', 'jr', 'sr', 'ii', 'iii', 'iv')) as w from x),
z as (select *, case when name is not null then concat(w[len(w)], ',', case when len(w) > 1 then left(w[1], 1) else '' end) end as author from y)
select o_orderkey, author, row_number() over (partition by author, case when author is null then o_orderkey end order by coalesce(created, timestamp '9999-01-01'), o_orderkey) = 1 as kept from z""",
}
from textloom.plans.prose import FLAGS_SQL as _FLAGS  # noqa: E402

ORACLES["parse_ledger"] = ORACLES["parse_ledger"].replace("{FLAGS}", _FLAGS)
QUERIES = {n: globals()[n] for n in ORACLES}
