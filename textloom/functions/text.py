"""Text functions as Column expressions; all stay in the JVM."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def terms(text: Column, limit: int | None = None) -> Column:
    """Lower-cased runs of a-z and 0-9; the first `limit` of them."""
    out = F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), "[^a-z0-9]+"), "")
    return F.slice(out, 1, limit) if limit else out


def tokens(text: Column) -> Column:
    """Lower-cased words that begin with a letter and may hold ' and -."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"[a-z][a-z'\-]*"), F.lit(0))


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), "[^A-Za-z']+"), "")


#: Abbreviations whose full stops end no sentence.
ABBREVIATIONS = (
    "e.g.", "i.e.", "cf.", "et al.", "vs.", "viz.", "fig.", "dr.", "mr.", "mrs.", "prof.", "st.", "approx.", "no.", "inc.", "ltd.", "jr.",
    "sr.", "resp.", "rev.", "ed.", "eds.", "vol.", "pp.", "p.", "sec.", "eq.", "eqs.", "w.r.t.", "al.", "etc.", "ca.",
)
KEPT_STOP = "\u0002"  # stands for a full stop that ends no sentence


#: A full stop of an abbreviation: the last one, or one inside of those that have several.
_STOP = r"\.(?:(?<=" + "|".join(re.escape(a) for a in ABBREVIATIONS) + r")|(?<=e\.)(?=g\.)|(?<=i\.)(?=e\.)|(?<=w\.)(?=r\.t\.)|(?<=w\.r\.)(?=t\.))"


def sentences(text: Column, least: int = 2) -> Column:
    """Sentences that end in . ! or ? before white space and an opening character, longer than `least` characters; stops of abbreviations end none."""
    held = F.regexp_replace(F.coalesce(text, F.lit("")), _STOP, KEPT_STOP)
    marked = F.regexp_replace(held, r"([.!?])\s+([A-Z0-9\"'(])", "$1\u0001$2")
    return F.filter(F.transform(F.split(marked, "\u0001"), lambda s: F.btrim(F.replace(s, F.lit(KEPT_STOP), F.lit(".")))), lambda s: F.length(s) > least)


#: What is taken out of Markdown, in order, before its prose is counted.
NO_PROSE = ((r"(?ims)^#*[ \t]*references[ \t]*$.*", ""), (r"!\[[^\]]*\]\([^)]*\)", " "), (r"\[([^\]]*)\]\([^)]*\)", "$1"), (r"\*\*|__", ""), (r"\$\$?[^$]*\$\$?", " "), (r"`[^`]*`", " "))


def prose(text: Column) -> Column:
    """Prose without references, images, link targets, marks, formulas, code and lines that are no prose, on one line."""
    x = F.coalesce(text, F.lit(""))
    for pattern, put in NO_PROSE:
        x = F.regexp_replace(x, pattern, put)
    alnum = lambda s: F.length(F.regexp_replace(s, r"[^\p{L}\p{N}]", ""))
    skip = lambda s: s.rlike(r"^[#>*\s-]*$") | s.rlike(r"^(\||\$|\\\[)") | s.rlike(r"\|.*\|") | ((F.length(s) >= 20) & (alnum(s) * 100 < F.length(s) * 45))
    lines = F.filter(F.transform(F.split(x, "\n"), lambda s: F.btrim(s)), lambda s: ~skip(s))
    return F.regexp_replace(F.array_join(lines, " "), r"[ \t\r\n\f]+", " ")


#: Letters, digits and the underscore, as word limits see them.
INSIDE = r"\p{L}\p{N}_"


def count_words(text: Column, pattern: str, open_start: bool = False) -> Column:
    """How often a pattern stands between word limits, or only before one."""
    return F.regexp_count(text, F.lit(("" if open_start else f"(?<![{INSIDE}])") + f"(?:{pattern})(?![{INSIDE}])"))


def plain_sentences(text: Column, least_words: int = 3) -> Column:
    """Sentences cut after . ! or ? and white space, with at least so many words."""
    marked = F.regexp_replace(F.coalesce(text, F.lit("")), r"([.!?])\s+", "$1\u0001")
    return F.filter(F.split(marked, "\u0001"), lambda s: F.size(words(s)) >= least_words)


def normalize_doi(raw: Column) -> Column:
    """The bare lower-case DOI of a URL, a doi: form or a plain one, percent signs decoded."""
    bare = F.regexp_replace(F.btrim(raw), r"(?i)^https?://[^/?#]*/*([^?#]*).*$", "$1")
    return F.lower(F.url_decode(F.regexp_replace(bare, r"(?i)^doi:", "")))


def doi_id(doi: Column) -> Column:
    return F.replace(F.lower(doi), F.lit("/"), F.lit(":"))


def valid_doi(doi: Column) -> Column:
    return doi.rlike(r"^10\.[0-9]{4,9}/.")


def unversioned(name: Column) -> Column:
    """An id without the version at its end, _v2 or v2."""
    return F.regexp_replace(name, r"_?v[0-9]+$", "")


def year_of(created: Column) -> Column:
    """The year that a time written as text begins with, null if there is none."""
    return F.nullif(F.left(created, F.lit(4)).try_cast("long"), F.lit(0))


def sniffed(data: Column, declared: Column) -> Column:
    """tex of a gzip head, pdf of a PDF head or declared type; small under 500 bytes, else unexpected."""
    head = F.hex(F.substring(data, 1, 4))
    kind = F.when(head.startswith("1F8B"), "tex").when(declared.contains("pdf") | (head == "25504446"), "pdf").otherwise("unexpected")
    return F.when(F.octet_length(data) < 500, "small").otherwise(kind)


#: Section buckets by the beginning of a heading, in order.
SECTIONS = [
    ("abstract", r"^(abstract|summary)"),
    ("methods", r"^(method|material|procedure|measure|instrument|sample|participant|design|estimation|data)"),
    ("results", r"^(result|finding|simulation|application|empirical|analysis|example|illustration|numerical)"),
    ("discussion", r"^(discussion|limitation|general|robustness)"),
    ("conclusion", r"^(conclusion|concluding|future|summary|final)"),
    ("backmatter", r"^(reference|bibliograph|appendix|acknowledg|supplement)"),
]


def section_of(heading: Column) -> Column:
    """The bucket of a heading without marks and leading numbers; else its first word; empty for an empty one."""
    bare = F.btrim(F.lower(F.regexp_replace(F.regexp_replace(F.coalesce(heading, F.lit("")), r"^#+\s*", ""), r"^[0-9.\s]+", "")))
    out = None
    for name, pattern in SECTIONS:
        out = F.when(bare.rlike(pattern), name) if out is None else out.when(bare.rlike(pattern), name)
    return out.otherwise(F.element_at(F.split(bare, r"[\s:;,(]"), 1))


#: Heading genres by what a heading holds, in order.
GENRES = [
    ("intro", ["introduc"]),
    ("simulation", ["simulation", "numerical", "monte carlo"]),
    ("discussion", ["discussion", "conclusion", "concluding"]),
    ("results", ["result"]),
    ("method", ["method", "design", "procedure", "estimat"]),
    ("application", ["empirical", "application", "real data", "illustrat", "example", "stud"]),
    ("method", ["model", "theor", "framework", "approach", "analysis"]),
]


def genre_of(heading: Column) -> Column:
    low = F.lower(F.coalesce(heading, F.lit("")))
    out = None
    for name, parts in GENRES:
        hit = low.rlike("|".join(parts))
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out.otherwise("other")


def clean_html(html: Column) -> Column:
    """HTML without scripts, styles, drawings, noscript parts and comments."""
    return F.regexp_replace(F.regexp_replace(html, r"(?is)<(script|style|svg|noscript)\b[^>]*>.*?</\1\s*>", ""), r"(?s)<!--.*?-->", "")


#: Classes of failures by what the lower-cased message holds, in order; `ocr:` has to begin it.
FAILURES = [
    ("docling-pdf-failed", "docling conversion failed"),
    ("no-route-assigned", "not enqueued"),
    ("ocr-failed", "ocr:"),
    ("scan-quality-terminal", "scan-quality"),
    ("tex-no-main-file", "no main file"),
    ("tex-ladder-failed", "pandoc ladder exhausted"),
    ("tex-exhausted-no-raw", "tex conversion exhausted"),
]


def error_category(error: Column) -> Column:
    """Ordered classes of failures; unknown for null or an empty message, else `other:` and its first 50 characters."""
    low = F.lower(error)
    out = F.when(error.isNull() | (error == ""), "unknown")
    for name, part in FAILURES:
        out = out.when(low.startswith(part) if part == "ocr:" else low.contains(part), name)
    return out.otherwise(F.concat(F.lit("other:"), F.left(error, F.lit(50))))


#: Tags that a converter left behind.
RAW_TAGS = r"(?i)<(span|div|figure|embed|img|math|table)\b"


def md_stats(text: Column) -> Column:
    """Struct of bytes, headings, math_blocks ($$ marks), formula_tokens and flags of a Markdown text."""
    size, headings, formulas = F.octet_length(text).cast("long"), F.regexp_count(text, F.lit(r"(?m)^#{1,6} .")).cast("long"), F.regexp_count(text, F.lit(r"\[formula\]")).cast("long")
    flags = F.array_compact(
        F.array(F.when(size < 2048, F.lit("tiny")), F.when(headings == 0, F.lit("no-headings")), F.when(formulas > 20, F.lit("formula-heavy")), F.when(text.contains("ltx_"), F.lit("ltx-residual")), F.when(text.rlike(RAW_TAGS), F.lit("raw-leak")))
    )
    return F.struct(size.alias("bytes"), headings.alias("headings"), F.regexp_count(text, F.lit(r"\$\$")).cast("long").alias("math_blocks"), formulas.alias("formula_tokens"), flags.alias("flags"))


def page_text(text: Column) -> Column:
    """Words broken at a line end joined again, white space collapsed."""
    return F.btrim(F.regexp_replace(F.regexp_replace(text, r"(\w)-\s*\n\s*", "$1"), r"\s+", " "))


#: Headings behind which an article has only references, or biographies of its authors.
REFERENCES = r"(?i)^#{1,6} +(references?|bibliography|literature cited|citations|sources)[ \t]*[0-9]*$"
BIOGRAPHIES = r"(?i)^#{1,6} +(authors?|author biograph(y|ies)|biograph(y|ies)|about the authors?)\b"


def back_matter(md: Column) -> Column:
    """A struct (blocks, kept, cut): how many blocks an article has and how many stand before its back matter.

    A heading is a block of its own, and others are parted by empty lines. The last heading of references cuts, if it stands at a quarter of the blocks or later; where none does, the last
    one of biographies at half of them or later. cut says which: references, biographies or nothing.
    """
    parts = F.split(F.regexp_replace(F.coalesce(md, F.lit("")), r"(?m)^(#{1,6} .*)$", "\n$1\n"), r"\n[ \t]*\n")
    blocks = F.filter(F.transform(parts, lambda b: F.btrim(b, F.lit(" \t\n"))), lambda b: b != "")
    last = lambda pattern: F.array_max(F.transform(blocks, lambda b, i: F.when(b.rlike(pattern), i)))
    n, refs, bios = F.size(blocks), last(REFERENCES), last(BIOGRAPHIES)
    by = F.when(refs * 4 >= n, F.struct(refs.alias("kept"), F.lit("references").alias("cut"))).when(bios * 2 >= n, F.struct(bios.alias("kept"), F.lit("biographies").alias("cut"))).otherwise(F.struct(n.alias("kept"), F.lit("").alias("cut")))
    return F.struct(n.alias("blocks"), by["kept"].alias("kept"), by["cut"].alias("cut"))


def excerpt(text: Column, size: int = 120) -> Column:
    line = F.trim(F.regexp_replace(text, r"\s+", " "))
    return F.when(F.length(line) > size, F.concat(F.left(line, F.lit(size)), F.lit("..."))).otherwise(line)


def line_span(text: Column, start: Column, end: Column) -> Column:
    return F.array_join(F.slice(F.split(text, "\n"), start, end - start + 1), "\n")


def quantile(values: Column, share: float) -> Column:
    """Index-based quantile of an array: the value at floor(share * n), clamped."""
    n = F.size(values)
    return F.element_at(F.array_sort(values), F.least(n, F.floor(n * F.lit(share)).cast("int") + 1))
