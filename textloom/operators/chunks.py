"""Chunks of Markdown documents, and writers that cut their output by rows or bytes."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions import text as T
from textloom.operators.running import running

LIMIT = 1900  # characters a chunk; only a table or a single sentence may be longer
_HEADING, _TOKEN = re.compile(r"#{2,3}\s+(.*)"), re.compile(r"@@eq\d{4}@@")
_CUT = re.compile(r"(?<=[.!?])\s+(?=[A-Z0-9$(\\])")


def blocks(text: str) -> list[tuple[int, int, str]]:
    """Runs of lines that hold text: first line, last line (from 1) and the text."""
    out: list[tuple[int, list[str]]] = []
    inside = False
    for n, line in enumerate(text.split("\n"), 1):
        if line.strip():
            if not inside:
                out.append((n, []))
            out[-1][1].append(line)
        inside = bool(line.strip())
    return [(n, n + len(lines) - 1, "\n".join(lines)) for n, lines in out]


def chunks(text: str | None, limit: int = LIMIT, compat_spans: bool = False) -> list[tuple[str, int, int, str]]:
    """(heading, line_start, line_end, text) of a document's chunks.

    A block that is one line beginning with ## or ### starts a chunk and names it. A table stands alone. Of a block beyond the
    limit sentences are packed, and the last of them may be joined by what follows. Others are joined by a blank line while they fit. Equation tokens
    become [formula]. No text: no chunks. Spans are the lines that a chunk covers; with compat_spans they are those of the
    published index: they end with the block that came when the chunk was full, and begin where the heading, table or long block before them did.
    """
    out: list[tuple[str, int, int, str]] = []
    heading, held, tight, wide = "", "", (0, 0), (0, 0)

    def flush() -> None:
        nonlocal held
        if held.strip():
            out.append((heading, *(wide if compat_spans else tight), _TOKEN.sub("[formula]", held.strip())))
        held = ""

    def hold(part: str, gap: str, start: int, end: int) -> None:
        nonlocal held, tight
        tight = (tight[0] if held else start, end)
        held = f"{held}{gap}{part}" if held else part

    for start, end, body in blocks(text or ""):
        named = _HEADING.fullmatch(body)
        if named or body.startswith("|"):
            flush()
            heading = named[1].strip() if named else heading
            wide = (start, end)
            hold(body, "", start, end)
            if not named:
                flush()
            continue
        wide = (wide[0] if held else start, end)
        if len(body) <= limit:
            if len(held) + len(body) + 2 > limit:
                flush()
            hold(body, "\n\n", start, end)
            continue
        flush()
        for sentence in _CUT.split(body):
            if len(held) + len(sentence) + 1 > limit:
                flush()
            wide = (wide[0] if held else start, end)
            hold(sentence, " ", start, end)
    flush()
    return out


def chunk_table(docs: DataFrame, key: str = "doc_id", text: str = "text", limit: int = LIMIT, compat_spans: bool = False) -> DataFrame:
    """Each document's chunks, numbered from 0; documents stay where they are, nothing is shuffled."""

    def run(batches):
        for batch in batches:
            rows = [(k, n, *c) for k, t in zip(batch[key], batch[text]) for n, c in enumerate(chunks(t, limit, compat_spans))]
            yield pd.DataFrame(rows, columns=[key, "chunk_no", "heading", "line_start", "line_end", "text"])

    made = docs.select(F.col(key), F.col(text)).mapInPandas(run, f"{key} long, chunk_no int, heading string, line_start int, line_end int, text string")
    return made.withColumn("section", T.section_of(F.col("heading")))


def fnv_id(value: Column) -> Column:
    """The 64-bit FNV-1a hash of a string's bytes, its low 63 bits read as a signed number of that width.

    Products are formed from 32-bit halves, so that no step overflows a long.
    """
    low = F.lit(0xFFFFFFFF)

    def step(state: Column, pair: Column) -> Column:
        lo, hi = state["lo"].bitwiseXOR(F.conv(pair, 16, 10).cast("long")), state["hi"]
        product = lo * 0x1B3  # the prime is 2^40 + 0x1b3
        carry = F.shiftright(product, 32) + hi * 0x1B3 + F.shiftleft(lo.bitwiseAND(F.lit(0xFFFFFF)), 8)
        return F.struct(carry.bitwiseAND(low).alias("hi"), product.bitwiseAND(low).alias("lo"))

    pairs = F.regexp_extract_all(F.hex(F.encode(value, "UTF-8")), F.lit("(..)"), F.lit(1))
    start = F.struct(F.lit(0xCBF29CE4).cast("long").alias("hi"), F.lit(0x84222325).cast("long").alias("lo"))
    end = F.aggregate(pairs, start, step)
    hi = end["hi"].bitwiseAND(F.lit(0x7FFFFFFF))
    signed = F.when(hi >= 0x40000000, hi - 0x80000000).otherwise(hi)
    return signed * F.lit(1 << 32) + end["lo"]


def byte_shards(df: DataFrame, key: str, size: Column, limit: int) -> DataFrame:
    """shard = bytes before the row, in key order, div limit; rows of a null key come first."""
    return running(df, [key], F.coalesce(size.cast("long"), F.lit(0)), "_before").withColumn("shard", F.expr(f"_before div {limit}")).drop("_before")
