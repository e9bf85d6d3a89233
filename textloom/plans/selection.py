"""Cooldowns, path and title filters, lean pages, code-safe stripping, cut tails and flag tallies."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from textloom.functions import registered
from textloom.functions import text as T
from textloom.operators.cooldown import suppressed
from textloom.operators.draws import drawn
from textloom.plans.prose import FLAGS_SQL, STATS_SQL, doc_md_stats

LONG_PAUSE, PAUSE = 1440, 30
#: Routes by host prefix, the first that fits.
ROUTES = [("https://www.", "www"), ("https://news", "news"), ("https://", "secure")]


def t(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cooldown_suppress(spark, d):
    """Events that would alert: half an hour's pause for each user and type, a day's for purchases."""
    minutes = F.when(F.col("event_type").startswith("p"), LONG_PAUSE).otherwise(PAUSE)
    return suppressed(t(spark, d, "events").select("event_id", "ts", "user_id", "event_type"), ["user_id", "event_type"], "ts", "event_id", minutes).select("event_id", "user_id", "event_type")


def subject_paths(spark, d):
    """Parts with a node in one of their paths that is the wanted one or holds the wanted text."""
    paths = F.array(F.split("p_type", " "), F.split("p_name", " "), F.array("p_brand"))
    hit = F.exists(paths, lambda path: F.exists(path, lambda n: (n == "Brand#12") | F.lower(n).contains("st")))
    return t(spark, d, "part").where(hit).select("p_partkey")


def title_filter(spark, d):
    """Pages whose title is no front matter, with the route of their address and a limit clamped to what a leg may give."""
    title = F.trim(F.regexp_extract("html", r"(?s)<title>(.*?)</title>", 1))
    route = F.when(F.lit(False), "")
    for prefix, name in ROUTES:
        route = route.when(F.col("url").startswith(prefix), name)
    x = t(spark, d, "pages").where(~title.rlike("(?i)^(editorial board|front matter|back matter|table of contents|issue information|erratum|corrigendum)$"))
    return x.select("page_id", route.otherwise("none").alias("route"), F.least(F.coalesce(F.nullif("page_id", F.lit(0)), F.lit(10)), F.lit(20)).alias("leg_limit"))


def references_cut(spark, d):
    """Blocks of each document as an article that stay before its references, and what the rest was cut by. Every third has more sections behind them."""
    more = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("\n\n## Author Biographies\n\n"), "source", F.lit(" writes.\n\n## Notes\n\nend"))).otherwise("")
    listed = F.when(F.col("doc_id") % 4 == 0, "\n\n## References 12\n\nOld, A. 1990.\n\nNew, B. 1991.").otherwise("")
    x = t(spark, d, "documents").select("doc_id", T.back_matter(F.concat(F.lit("# "), "source", F.lit("\n\n"), F.replace("text", F.lit("\n"), F.lit("\n\n")), listed, more)).alias("x"))
    return x.select("doc_id", F.col("x.blocks").cast("long").alias("blocks"), F.col("x.kept").cast("long").alias("kept"), "x.cut")


def seeded_draw(spark, d):
    """Twelve documents of each source and then six, drawn by one named generator."""
    return drawn(t(spark, d, "documents"), "source", "doc_id", [12, 6])


def sql_functions(spark, d):
    """Excerpts, terms and lines of documents by functions that SQL text calls."""
    registered.register(spark)
    t(spark, d, "documents").createOrReplaceTempView("textloom_documents")
    return spark.sql("select doc_id, tl_excerpt(text, 60) as excerpt, array_join(tl_query_terms(text), ' ') as terms, tl_lines(text, 2, 3) as lines, tl_doi_id(concat('10.1/', source, '/', doc_id)) as id from textloom_documents")


def flag_tallies(spark, d):
    flags = doc_md_stats(spark, d).select(F.explode(F.split("flags", r"\|")).alias("flag")).where("flag <> ''")
    return flags.groupBy("flag").agg(F.count("*").alias("n"))


_PAUSE = f"(case when event_type like 'p%' then {LONG_PAUSE} else {PAUSE} end * interval 1 minute)"
ORACLES = {
    "sql_functions": "select doc_id, case when length(trim(regexp_replace(text, '\\s+', ' ', 'g'))) > 60 then left(trim(regexp_replace(text, '\\s+', ' ', 'g')), 60) || '...' else trim(regexp_replace(text, '\\s+', ' ', 'g')) end as excerpt, array_to_string(regexp_extract_all(lower(text), '[a-z0-9]+')[1:32], ' ') as terms, array_to_string(string_split(text, chr(10))[2:3], chr(10)) as lines, concat('10.1:', source, ':', doc_id) as id from documents",
    "cooldown_suppress": f"with recursive k as (select user_id, event_type, min(ts) as ts from events group by all union all select e.user_id, e.event_type, min(e.ts) from k join events e on e.user_id = k.user_id and e.event_type = k.event_type and e.ts >= k.ts + {_PAUSE.replace('event_type', 'e.event_type')} group by all) select min(event_id) as event_id, user_id, event_type from events join k using (user_id, event_type, ts) group by user_id, event_type, ts",
    "subject_paths": "select p_partkey from part where len(list_filter(string_split(p_type, ' ') || string_split(p_name, ' ') || [p_brand], lambda n: n = 'Brand#12' or contains(lower(n), 'st'))) > 0",
    "title_filter": "select page_id, " + "case " + " ".join(f"when starts_with(url, '{p}') then '{n}'" for p, n in ROUTES) + " else 'none' end as route, least(coalesce(nullif(page_id, 0), 10), 20) as leg_limit from pages where not regexp_matches(trim(regexp_extract(html, '(?s)<title>(.*?)</title>', 1)), '(?i)^(editorial board|front matter|back matter|table of contents|issue information|erratum|corrigendum)$')",
    "references_cut": """with x as (select doc_id, concat('# ', source, chr(10), chr(10), replace(text, chr(10), chr(10) || chr(10)), case when doc_id % 4 = 0 then concat(chr(10), chr(10), '## References 12', chr(10), chr(10), 'Old, A. 1990.', chr(10), chr(10), 'New, B. 1991.') else '' end, case when doc_id % 3 = 0 then concat(chr(10), chr(10), '## Author Biographies', chr(10), chr(10), source, ' writes.', chr(10), chr(10), '## Notes', chr(10), chr(10), 'end') else '' end) as md from documents),
y as (select doc_id, list_filter(list_transform(regexp_split_to_array(regexp_replace(md, '(?m)^(#{1,6} .*)$', chr(10) || '\\1' || chr(10), 'g'), '\\n[ \\t]*\\n'), lambda b: trim(b, ' ' || chr(9) || chr(10))), lambda b: b <> '') as l from x),
z as (select doc_id, len(l) as blocks, list_max(list_transform(l, lambda b, i: case when regexp_matches(b, '(?i)^#{1,6} +(references?|bibliography|literature cited|citations|sources)[ \\t]*[0-9]*$') then i - 1 end)) as r, list_max(list_transform(l, lambda b, i: case when regexp_matches(b, '(?i)^#{1,6} +(authors?|author biograph(y|ies)|biograph(y|ies)|about the authors?)\\b') then i - 1 end)) as a from y)
select doc_id, blocks, case when r * 4 >= blocks then r when a * 2 >= blocks then a else blocks end as kept, case when r * 4 >= blocks then 'references' when a * 2 >= blocks then 'biographies' else '' end as cut from z""",
    "flag_tallies": f"with x as ({STATS_SQL}), y as (select unnest({FLAGS_SQL}) as flag from x) select flag, count(*) as n from y where flag is not null group by 1",
}
QUERIES = {n: globals()[n] for n in [*ORACLES, "seeded_draw"]}
