"""Lint rules: read from YAML, spelled out as instructions, scored against blocks, and rendered."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FIELDS = ("project", "section", "prefix", "before", "after", "suffix", "judgement", "lesson")
THRESHOLD = 0.75


RULE = "id long, " + ", ".join(f"{f} string" for f in FIELDS)


def parsed_rules(text: str) -> list[tuple]:
    """(id, the FIELDS) of a YAML text of rules, keyed by whole numbers, in order. One that has neither lesson nor judgement is an error.

    Rule files have one shape: top-level `N:` keys and one level of `field: value` below, values plain, quoted, null or folded over indented lines.
    """
    rules: dict[int, dict] = {}
    now = field = None
    for line in text.split("\n"):
        bare = line.strip()
        if not bare or bare.startswith("#"):
            continue
        if not line[0].isspace():
            now, field = rules.setdefault(int(bare.rstrip(":")), {}), None
        elif ":" in bare and bare.split(":", 1)[0] in FIELDS and len(line) - len(line.lstrip()) <= 2:
            field, value = bare.split(":", 1)
            value = value.strip()
            now[field] = None if value in ("null", "~", "") else "" if value in (">-", ">", "|") else value[1:-1] if value[0] in "\"'" and value[-1] == value[0] else value
        elif field:
            now[field] = f"{now[field] or ''} {bare}".strip()
    for n, r in rules.items():
        if not (r.get("lesson") or "").strip() and not (r.get("judgement") or "").strip():
            raise ValueError(f"rule {n} has neither lesson nor judgement")
    return [(n, *[r.get(f) for f in FIELDS]) for n, r in sorted(rules.items())]


def read_rules(texts: DataFrame) -> DataFrame:
    """The rules of YAML texts (column text), each with its instruction."""

    def run(batches):
        for b in batches:
            yield pd.DataFrame([row for x in b["text"] for row in parsed_rules(x)], columns=["id", *FIELDS])

    return texts.select("text").mapInPandas(run, RULE).withColumn("instruction", instruction())


def _said(label: str, column: str) -> Column:
    text = F.btrim(column)
    return F.when(F.length(text) > 0, F.concat(F.lit(label), text))


def instruction() -> Column:
    """A rule as text, from its FIELDS: the lesson (or else the judgement), its section, the edit it came from, and the comment where it says more."""
    lesson = F.btrim(F.coalesce("lesson", "judgement", F.lit("")))
    pair = F.concat_ws("\n", _said("Context before: ", "prefix"), _said("Before: ", "before"), _said("After: ", "after"), _said("Context after: ", "suffix"))
    judgement = F.btrim("judgement")
    return F.concat_ws(
        "\n\n", lesson, F.when(F.length(F.btrim("section")) > 0, F.concat(F.lit("Learned from the "), F.btrim("section"), F.lit(" section."))),
        F.when(pair != "", F.concat(F.lit("The calibrated edit this rule was distilled from:\n"), pair)),
        F.when((F.length(judgement) > 0) & (judgement != lesson), F.concat(F.lit("The expert's comment: "), judgement)),
    )


def shared_terms(blocks: DataFrame, rules: DataFrame, key: list[str], least: float = THRESHOLD) -> DataFrame:
    """(key, rule, p) of blocks (key, t: terms) and rules (rule, r: terms) that share a part p >= least of a rule's terms; a stand-in for a judge.

    p is at least `least` only if a block lacks at most floor((1 - least) n) of a rule's n terms. So of the rarest half of them it has all but that many, and
    rules are looked up by that half: pairs of keys are counted there, and the terms of the few that are left are compared in full. A null key or list is none.
    """
    terms = rules.select("rule", F.size("r").alias("n"), F.explode("r").alias("w"))
    often = blocks.select(F.explode("t").alias("w")).join(terms.select("w").distinct(), "w").groupBy("w").agg(F.count("*").alias("df"))
    ranked = terms.join(often, "w", "left").withColumn("_r", F.row_number().over(Window.partitionBy("rule").orderBy(F.coalesce("df", F.lit(0)), "w")))
    spare = F.floor(F.col("n") * F.lit(1 - least) + 1e-9)
    half = F.greatest(spare + 1, F.ceil(F.col("n") / 2))
    wanted = ranked.where(F.col("_r") <= half).select("rule", "w", (half - spare).alias("need"))
    found = blocks.select(*key, F.explode("t").alias("w")).join(wanted, "w").groupBy(*key, "rule", "need").agg(F.count("*").alias("_c")).where("_c >= need").select(*key, "rule")
    p = F.size(F.array_intersect("t", "r")) / F.size("r")
    return found.join(rules.select("rule", "r"), "rule").join(blocks.select(*key, "t"), key).where(p >= least).select(*key, "rule", F.round(p, 6).alias("p"))


def rendered(hits: DataFrame, header: str, key: list[str] | None = None) -> DataFrame:
    """(key, start, lines) of (key, start, end, text, rule, instruction, p) rows: a flagged block's place, excerpt and hits, the likeliest first. key: the text that a block belongs to, where there are several.

    p is rounded from its binary value, as C's printf does (0.825 gives 0.82): `format_number` does so, `format_string` would round the decimal form up.
    """
    key = key or []
    flat = lambda c: F.btrim(F.regexp_replace(c, r"\s+", " "))
    row = F.struct((-F.col("p")).alias("o"), F.col("rule").alias("k"), F.concat(F.lit("  R"), F.when(F.col("rule") < 10, "0").otherwise(""), F.col("rule").cast("string"), F.lit("  p="), F.format_number("p", 2), F.lit("  "), flat(F.col("instruction"))).alias("line"))
    excerpt = F.left(flat(F.col("text")), F.lit(120))
    g = hits.groupBy(*key, "start", "end", "text").agg(F.array_sort(F.collect_list(row)).alias("rows"))
    span = F.when(F.col("start") == F.col("end"), F.col("start").cast("string")).otherwise(F.concat_ws("-", F.col("start").cast("string"), F.col("end").cast("string")))
    head = F.concat(F.lit(f"{header}:"), span, F.lit("  "), F.size("rows").cast("string"), F.lit(" violation(s)"))
    shown = F.concat(F.lit("  "), excerpt, F.when(F.length(excerpt) >= 120, "...").otherwise(""))
    return g.select(*key, "start", F.concat_ws("\n", head, shown, F.array_join("rows.line", "\n")).alias("lines"))


LEAST = 30  # characters of a block
_ITEM = re.compile(r"\s*(?:[-*+]|\d+[.)])\s+")


def prose_blocks(md: str | None) -> list[tuple[int, int, str, str, str]]:
    """(start, end, section, role, text) of the blocks of a Markdown text that are judged: paragraphs, and list items one by one.

    The section is the nearest heading of any level; under one that is called so, paragraphs have the role abstract, others body, items list. Fenced code, quotes,
    tables, fenced divisions, tables of signs, formulas that stand alone, front matter, reference sections and blocks of fewer than LEAST characters are left out.
    """
    lines = (md or "").split("\n")
    out, section, run, role, fence, at = [], "", [], "", "", 0
    if lines[0] == "---" and "---" in lines[1:]:
        at = lines.index("---", 1) + 1

    def close() -> None:
        nonlocal run
        text, first = "\n".join(lines[i] for i in run), lines[run[0]].strip() if run else ""
        alone = re.fullmatch(r"\s*\$\$[\s\S]*\$\$\s*", text) or first.startswith((":::", "|", ">")) or re.fullmatch(r"\+[-=+ ]*-[-=+ ]*\+", first)
        if run and not alone and len(text.strip()) >= LEAST and section.strip().lower() not in ("references", "bibliography"):
            own = "abstract" if role == "body" and section.strip().lower() == "abstract" else role
            out.append((run[0] + 1, run[-1] + 1, "abstract" if own == "abstract" else section, own, text))
        run = []

    for i in range(at, len(lines)):
        line = lines[i]
        mark = re.match(r"\s*(```+|~~~+)", line)
        if fence:
            fence = "" if mark and mark[1].startswith(fence) else fence
        elif mark:
            close()
            fence = mark[1]
        elif heading := re.match(r"#{1,6}\s+(.*?)\s*(?:\{[^{}]*\})?\s*#*\s*$", line):
            close()
            section = heading[1]
        elif not line.strip():
            close()
        elif _ITEM.match(line):
            close()
            run, role = [i], "list"
        else:
            role = role if run else "body"
            run.append(i)
    close()
    return out


def block_table(texts: DataFrame, key: str) -> DataFrame:
    """The blocks of (key, md) rows; texts stay where they are."""

    def run(batches):
        for b in batches:
            yield pd.DataFrame([(k, *x) for k, m in zip(b[key], b["md"]) for x in prose_blocks(m)], columns=[key, "start", "end", "section", "role", "text"])

    return texts.select(key, "md").mapInPandas(run, f"{key} long, start long, end long, section string, role string, text string")
