"""Harvested records, statistics of articles, names of headings, and a stand-in for an embedder."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions import text as T


def decoded(text: Column) -> Column:
    """Entities of XML, in the order in which they have to be read."""
    for name, char in (("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'")):
        text = F.replace(text, F.lit(name), F.lit(char))
    return text


def _line(text: Column) -> Column:
    return F.btrim(F.regexp_replace(text, r"\s+", " "))


def oai_rows(pages: DataFrame) -> DataFrame:
    """One row a record of harvested pages (xml): id without its version, title, authors, year, first category and their number.

    Categories come first; where a record has none, its sets of statistics stand for them. A record without an identifier is none.
    """
    rec = pages.select(F.explode(F.slice(F.split("xml", "<record>"), 2, 1 << 30)).alias("r"))
    one = lambda p: F.get(F.regexp_extract_all("r", F.lit(p), F.lit(1)), 0)
    names = F.transform(
        F.arrays_zip(*[F.regexp_extract_all("r", F.lit(r"(?s)<author>\s*<keyname>(.*?)</keyname>\s*<forenames>(.*?)</forenames>\s*</author>"), F.lit(i)).alias(n) for i, n in ((1, "key"), (2, "fore"))]),
        lambda a: F.btrim(F.concat_ws(" ", decoded(_line(a["fore"])), decoded(_line(a["key"])))),
    )
    listed = F.filter(F.split(F.btrim(F.coalesce(one(r"<categories>([^<]+)</categories>"), F.lit(""))), r"\s+"), lambda c: c != "")
    sets = F.transform(F.filter(F.regexp_extract_all("r", F.lit("<setSpec>([^<]+)</setSpec>"), F.lit(1)), lambda c: c.startswith("stat")), lambda c: F.regexp_replace(c, "^stat:stat:", "stat."))
    x = rec.select(one(r"<identifier>oai:arXiv\.org:([^<]+)</identifier>").alias("id"), "r", names.alias("names"), F.when(F.size(listed) > 0, listed).otherwise(sets).alias("cats")).where("id is not null")
    base = F.regexp_replace("id", r"v[0-9]+$", "")
    return x.select(
        base.alias("arxiv_id"), F.concat(F.lit("10.48550/arXiv."), base).alias("doi"), decoded(_line(F.coalesce(one(r"(?s)<title>(.*?)</title>"), F.lit("")))).alias("title"), F.array_join("names", "; ").alias("authors"),
        T.year_of(one("<created>([^<]+)</created>")).alias("year"), F.get("cats", 0).alias("primary"), F.size("cats").cast("long").alias("n_cats"),
    )


def docx_stats(md: Column) -> Column:
    """Struct of headings, title, kinds of formulas, and whether the references are gone, of an article in Markdown."""
    n = lambda p: F.regexp_count(md, F.lit(p)).cast("long")
    return F.struct(
        n(r"(?m)^## ").alias("h2"), n(r"(?m)^### ").alias("h3"), md.rlike(r"(?m)^## Abstract\b").alias("summary_heading"), F.floor(n(r"\$\$") / 2).alias("math_display"), n("(?m)^```math").alias("math_fences"), n(r"\$`").alias("backtick_math"),
        (~md.rlike(r"(?im)^#{2,3} .*references?[ ]*$")).alias("refs_stripped"), F.btrim(F.regexp_extract(md, r"(?m)^# ([^\n]+)$", 1)).alias("title"),
    )


def inline_math(md: Column) -> Column:
    """How many formulas stand in single dollar signs on one line."""
    return F.regexp_count(md, F.lit(r"(^|[^$])\$(?!\$)[^$\n]+\$(?!\$)")).cast("long")


def heading_name(heading: Column) -> Column:
    """A heading in lower case without its number, digits and signs."""
    bare = F.btrim(F.regexp_replace(F.lower(F.btrim(heading)), r"^[0-9]+(\.[0-9]+)*[.\s]*", ""))
    return F.btrim(F.regexp_replace(F.regexp_replace(bare, "[^a-z0-9 &/-]", ""), "[0-9]+", ""))


def summary_of(md: Column) -> Column:
    """What follows the word abstract up to the next heading, or else what stands before the first heading; null if there is no heading."""
    named = F.regexp_extract_all(md, F.lit(r"(?is)abstract[:\s]*\n*(.*?)(?=\n\s*#{1,6}\s)"), F.lit(1))
    before = F.regexp_extract_all(md, F.lit(r"(?s)\A(.*?)(?=\n\s*#{1,6}\s)"), F.lit(1))
    return F.coalesce(F.get(named, 0), F.get(before, 0))


def embedded(text: str, size: int) -> list[float]:
    """A stand-in for an embedder: signed counts of words by hash, scaled to length 1. One vector of a request, made by the driver."""
    out = [0.0] * size
    for word in text.lower().split():
        h = int(hashlib.md5(word.encode()).hexdigest(), 16)
        out[h % size] += 1.0 if h >> 64 & 1 else -1.0
    norm = sum(x * x for x in out) ** 0.5 or 1.0
    return [x / norm for x in out]
