"""Markdown from TeX and from article XML."""

from __future__ import annotations

import re
import xml.etree.ElementTree as ET

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: From TeX to Markdown, in order. Formulas stay. Patterns hold in Java's and in DuckDB's dialect.
FROM_TEX = [
    (r"(?s)^.*?\\begin\{document\}", ""),
    (r"(?s)\\end\{document\}.*$", ""),
    (r"(?m)(^|[^\\\n])%[^\n]*", "$1"),
    (r"\\section\*?\{([^{}]*)\}", "\n\n## $1\n\n"),
    (r"\\subsection\*?\{([^{}]*)\}", "\n\n### $1\n\n"),
    (r"\\subsubsection\*?\{([^{}]*)\}", "\n\n#### $1\n\n"),
    (r"\\(textbf|bf)\{([^{}]*)\}", "**$2**"),
    (r"\\(emph|textit)\{([^{}]*)\}", "*$2*"),
    (r"\\(cite|citep|citet|ref|eqref)\{([^{}]*)\}", "[$2]"),
    (r"\\label\{[^{}]*\}", ""),
    (r"\\begin\{(equation|align)\*?\}", "\n\n$$$$\n"),
    (r"\\end\{(equation|align)\*?\}", "\n$$$$\n\n"),
    (r"\\(begin|end)\{[a-zA-Z]+\*?\}(\[[^\]]*\])?", "\n"),
    (r"\\item\s+", "\n- "),
    (r"\\([%&_#])", "$1"),
    (r" ?\n ?", "\n"),
    (r"\n\n+", "\n\n"),
    (r"^\s+", ""),
    (r"\s+$", ""),
]


def tex_to_md(source: Column) -> Column:
    out = source
    for pattern, put in FROM_TEX:
        out = F.regexp_replace(out, F.lit(pattern), F.lit(put.replace("$$$$", r"\$\$")))
    return out


def _inline(node: ET.Element) -> str:
    marks = {"bold": "**", "b": "**", "italic": "*", "i": "*", "tex-math": "$"}
    out = node.text or ""
    for child in node:
        mark = marks.get(child.tag, "")
        out += f"{mark}{_inline(child)}{mark}" + (child.tail or "")
    return re.sub(r"\s+", " ", out)


def _cells(row: ET.Element) -> list[ET.Element]:
    return [c for c in row if c.tag in ("td", "th")]


def _table(table: ET.Element, caption: str) -> str:
    """Rows of pipes under the caption; a table with cells that span more than one place is kept as a link to itself."""
    cells = [c for row in table.iter("tr") for c in _cells(row)]
    if any(int(c.get(n) or 1) > 1 for c in cells for n in ("colspan", "rowspan")):
        return f"**{caption or 'Table'}** (table {table.get('id') or 'not shown'})"
    rows = [r for r in ([_inline(c).strip().replace("|", "\\|") for c in _cells(row)] for row in table.iter("tr")) if r]
    grid = "\n".join("| " + " | ".join(r) + " |" for r in rows[:1] + [["-"] * len(r) for r in rows[:1]] + rows[1:])
    return f"**{caption}**\n\n{grid}" if caption else grid


HIDDEN = ("ref-list", "journal-meta", "contrib-group", "permissions", "object-id", "fn-group")
PLAIN = ("article", "front", "body", "back", "article-meta", "title-group", "app-group", "list-item", "boxed-text", "disp-quote")


def _blocks(node: ET.Element, depth: int):
    for child in node:
        if child.tag in HIDDEN or child.tag == "label":
            continue
        if child.tag in ("title", "article-title"):
            label = node.find("label") if child.tag == "title" else None
            yield "#" * min(max(depth - 1, 1), 6) + " " + (f"{_inline(label).strip()} " if label is not None else "") + _inline(child).strip()
        elif child.tag == "p":
            yield _inline(child).strip()
        elif child.tag == "list":
            sign = "1." if child.get("list-type") == "order" else "-"
            yield "\n".join(f"{sign} {_inline(item).strip()}" for item in child.iter("list-item"))
        elif child.tag == "disp-formula":
            yield f"$$\n{_inline(child).replace('$', '').strip()}\n$$"
        elif child.tag in ("code", "preformat"):
            yield "```\n" + "".join(child.itertext()).strip("\n") + "\n```"
        elif child.tag in ("fig", "table-wrap"):
            caption = " ".join(_inline(x).strip() for x in (child.find("label"), child.find("caption")) if x is not None)
            graphic = next((x.get("{http://www.w3.org/1999/xlink}href") or x.get("href") or "" for x in child.iter("graphic")), None)
            tables = list(child.iter("table"))
            yield from (_table(t, caption) for t in tables)
            if not tables and graphic is not None:
                yield f"![{caption}]({graphic})"
        elif child.tag == "table":
            yield _table(child, "")
        else:
            if child.tag not in (*PLAIN, "sec") and child.find("title") is None and child.find("p") is not None:
                yield "#" * min(depth, 6) + " " + child.tag.capitalize()  # a part that has no title of its own is named by what it is
            yield from _blocks(child, depth + (child.tag not in PLAIN))


def article_md(xml: str | None) -> str | None:
    """The Markdown of one article's XML; null for a null one and for one that does not parse."""
    try:
        return None if xml is None else "\n\n".join(b for b in _blocks(ET.fromstring(xml), 2) if b)
    except ET.ParseError:
        return None


#: Noise that formulas keep from their pages, and what becomes of it.
TEX_NOISE = ((r"(?s)\\documentclass.*?\\begin\{document\}|\\end\{document\}|\\usepackage(\[[^\]]*\])?\{[^}]*\}|\\setlength\{[^}]*\}\{[^}]*\}", ""), (r"\\(?:[,;!:]|q?quad(?![a-zA-Z]))", " "), (r"^\s*\$+|\$+\s*$", ""), (r"\s+", " "))


def clean_formula(tex: Column) -> Column:
    """A formula without preamble, fences of dollar signs and spacing commands, on one line."""
    for pattern, put in TEX_NOISE:
        tex = F.regexp_replace(tex, pattern, put)
    return F.btrim(tex)


@F.pandas_udf(T.StringType())
def xml_to_md(xml: pd.Series) -> pd.Series:
    return pd.Series([article_md(x) for x in xml], index=xml.index, dtype=object)
