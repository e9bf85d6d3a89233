"""Markdown from HTML, kinds of lines, repaired glyphs and name keys."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column, Window
from pyspark.sql import functions as F
from pyspark.sql import types
from pyspark.sql.window import WindowSpec

from textloom.functions import text as T

#: From clean HTML to Markdown, in order: (pattern, what it becomes). Patterns hold in Java's and in DuckDB's dialect; $1 is a group.
TO_MARKDOWN = [
    (r"(?is)<head\b[^>]*>.*?</head\s*>", ""),
    (r"\s+", " "),
    *[(rf"(?i)<h{n}(\s[^>]*)?>", "\n\n" + "#" * n + " ") for n in range(1, 7)],
    (r"(?i)</h[1-6]\s*>", "\n\n"),
    (r"(?i)<li(\s[^>]*)?>", "\n- "),
    (r"(?i)<tr(\s[^>]*)?>", "\n| "),
    (r"(?i)</t[dh]\s*>", " | "),
    (r"(?i)<br\s*/?>", "\n"),
    (r"(?i)</?(p|div|ul|ol|table|article|section|nav|header|footer|blockquote)(\s[^>]*)?>", "\n\n"),
    (r'(?i)<a\s[^>]*href="([^"]*)"[^>]*>([^<]*)</a\s*>', "[$2]($1)"),
    (r"(?i)</?(b|strong)>", "**"),
    (r"(?i)</?(i|em)>", "*"),
    (r"<[^>]*>", ""),
    ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&"),
    (r"[ \t]+", " "),
    (r" ?\n ?", "\n"),
    (r"\n\n+", "\n\n"),
    (r"^\s+", ""),
    (r"\s+$", ""),
]

#: Kinds of lines by pattern, in order; a line without text has none, any other is of a paragraph.
KINDS = [("heading", r"^#{1,6} "), ("table", r"^\|"), ("list", r"^([-*+]|[0-9]+[.)]) ")]

HEADINGS = r"(?m)^#{1,6} [^\n]"


def html_to_md(html: Column) -> Column:
    out = T.clean_html(html)
    for pattern, put in TO_MARKDOWN:
        out = F.regexp_replace(out, F.lit(pattern), F.lit(put))
    return out


def line_kind(line: Column) -> Column:
    out = F.when(F.trim(line) == "", F.lit(None))
    for name, pattern in KINDS:
        out = out.when(line.rlike(pattern), name)
    return out.otherwise("para")


def heading_depth(title: Column) -> Column:
    """The depth that a heading's own dotted number asks for: two, and one more for each dot; at most four."""
    dotted = F.regexp_extract(title, r"^([0-9]+(\.[0-9]+)+)([^0-9A-Za-z_]|$)", 1)
    return F.least(F.lit(4), F.lit(2) + F.length(dotted) - F.length(F.replace(dotted, F.lit("."), F.lit("")))).cast("long")


def clamped_level(asked: Column, place: Column, order: WindowSpec) -> Column:
    """The level a heading gets, at most one deeper than the one before it; the first stands under a title of level one.

    place counts headings from 0. Each level is the least, over all headings so far, of what one asks for and how many
    headings ago that was, so a running minimum gives the chain of clamps.
    """
    return F.least(F.min(asked - place).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)), F.lit(2)) + place


def response_class(kind: Column, status: Column, size: Column, head: Column, failed: Column, least_xml: int = 20000, least_pdf: int = 20000) -> Column:
    """ok, absent, blocked, blockpage, fail or error, from a fetch's status and the beginning of its body."""
    xml = F.when((status == 200) & (size > least_xml) & head.contains("<article"), "ok").when(status.isin(200, 404), "absent").otherwise("error")
    pdf = F.when((status == 200) & head.startswith("%PDF") & (size > least_pdf), "ok").when(status == 404, "fail").otherwise("error")
    return (
        F.when(failed, "error").when(head.rlike("(?i)just a moment|attention required"), "blocked").when(head.rlike("(?i)you have been blocked|access denied"), "blockpage")
        .when(status.isin(403, 429), "blocked").when(kind == "xml", xml).otherwise(pdf)
    )


#: Glyphs that stand for ligatures.
PRIVATE = {"\ue000": "ff", "\ue001": "fi", "\ue002": "fl", "\ue003": "ffi", "\ue004": "ffl"}
UNICODE = {"\ufb00": "ff", "\ufb01": "fi", "\ufb02": "fl", "\ufb03": "ffi", "\ufb04": "ffl"}
#: Words that a lost `ff` may be put back into, and what they may end with.
FF_STEMS = frozenset((
    "effect", "effective", "affect", "effort", "offer", "offset", "differ", "difference", "different", "suffer", "sufficient",
    "coefficient", "efficient", "efficiency", "confidence", "affinity", "office", "official", "staff", "stuff", "difficult",
    "difficulty", "afford", "coffee", "tariff", "suffix", "shuffle", "scuffle", "ruffle", "waffle", "baffle", "baffling", "stifle",
    "little", "bottle", "battle", "settle", "subtle", "cattle", "kettle", "brittle", "middle", "riddle", "puzzle", "huddle", "muddle",
    "puddle", "tumble", "humble", "juggle", "nibble",
))
FF_ENDS = (
    "", "s", "es", "ed", "d", "ing", "ly", "er", "ers", "ion", "ions", "ent", "ents", "ence", "ences", "ity", "ies", "ive", "ively",
    "antly", "ently", "age", "ages", "y", "al",
)
PAIR = re.compile(r"\b([a-z]{1,4}) ([a-z]{1,10})\b")


def mend(text: str | None) -> tuple[str | None, int, int, int, int]:
    """A text with ligatures spelled out and lost `ff` put back; how many private glyphs were known and unknown, ligatures, joins."""
    if text is None:
        return None, 0, 0, 0, 0
    counts = [sum(map(text.count, PRIVATE)), 0 if text.isascii() else sum("\ue000" <= c <= "\uf8ff" for c in text), sum(map(text.count, UNICODE)), 0]
    counts[1] -= counts[0]
    text = text.translate(str.maketrans(PRIVATE | UNICODE))

    def join(m: re.Match) -> str:
        word = f"{m[1]}ff{m[2]}"
        fits = any(word.endswith(e) and word[: len(word) - len(e)] in FF_STEMS for e in FF_ENDS)
        counts[3] += fits
        return word if fits else m[0]

    return PAIR.sub(join, text), *counts


MENDED = types.StructType([types.StructField("text", types.StringType()), *[types.StructField(n, types.LongType()) for n in ("known", "unknown", "ligatures", "joins")]])


@F.pandas_udf(MENDED)
def ligatures(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([mend(t) for t in texts], columns=MENDED.names)


@F.pandas_udf(types.StringType())
def _unmarked(names: pd.Series) -> pd.Series:
    return names.map(lambda n: None if n is None else re.sub(r"[\u0300-\u036f]", "", unicodedata.normalize("NFKD", n)))


def name_key(name: Column) -> Column:
    """(last, first) of a name: its last word and its first word's initial, without marks and suffixes; null where no letter is."""
    words = F.filter(F.split(F.lower(_unmarked(name)), "[^a-z]+"), lambda w: (w != "") & ~w.isin("jr", "sr", "ii", "iii", "iv"))
    initial = F.when(F.size(words) > 1, F.left(F.get(words, F.lit(0)), F.lit(1))).otherwise("")
    return F.when(F.size(words) > 0, F.struct(F.element_at(words, -1).alias("last"), initial.alias("first")))
