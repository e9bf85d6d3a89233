"""The functions that SQL text can call: scalar ones as SQL expressions, table functions over a row or a partition."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.functions import AnalyzeArgument, AnalyzeResult, udtf
from pyspark.sql.types import IntegerType, LongType, StringType, StructType

#: name -> (parameters, type, expression); they stay expressions, so Spark optimises through them.
SCALARS = {
    "tl_doi_id": ("doi string", "string", "replace(lower(doi), '/', ':')"),
    "tl_normalize_doi": ("raw string", "string", r"lower(url_decode(regexp_replace(regexp_replace(btrim(raw), '(?i)^https?://[^/?#]*/*([^?#]*).*$', '$1'), '(?i)^doi:', '')))"),
    "tl_valid_doi": ("doi string", "boolean", r"doi rlike '^10\\.[0-9]{4,9}/.'"),
    "tl_query_terms": ("q string", "array<string>", "slice(array_remove(split(lower(coalesce(q, '')), '[^a-z0-9]+'), ''), 1, 32)"),
    "tl_excerpt": ("t string, size int", "string", r"case when length(trim(regexp_replace(t, '\\s+', ' '))) > size then concat(left(trim(regexp_replace(t, '\\s+', ' ')), size), '...') else trim(regexp_replace(t, '\\s+', ' ')) end"),
    "tl_lines": ("t string, first int, last int", "string", r"array_join(slice(split(t, '\n'), first, last - first + 1), '\n')"),
}


class ChunkMd:
    """(chunk_no, heading, line_start, line_end, text) of a Markdown text."""

    def eval(self, text: str, size: int):
        from textloom.operators.chunks import chunks

        for n, c in enumerate(chunks(text or "", size)):
            yield (n, *c)


class LintBlocks:
    """(line_start, line_end, section, role, text) of the blocks of a Markdown text that are judged."""

    def eval(self, text: str):
        from textloom.operators.lint import prose_blocks

        yield from prose_blocks(text)


class FindPhrase:
    """Places of a phrase in the pages of a partition, in the order that they come in: at most `most` of them, with the columns that the pages are told apart by.

    analyze() wants a table with a column `page`, takes the key from its first column, and fixes the schema before the query runs.
    """

    def __init__(self):
        self.found = 0

    @staticmethod
    def analyze(rows: AnalyzeArgument, phrase: AnalyzeArgument, most: AnalyzeArgument) -> AnalyzeResult:
        if not rows.isTable or "page" not in rows.dataType.names:
            raise ValueError("find_phrase wants a table with a column named page")
        if not isinstance(most.value, int) or not isinstance(phrase.value, str) or not phrase.value:
            raise ValueError("find_phrase wants a phrase and a number that are known before the query runs")
        key = rows.dataType.fields[0]
        return AnalyzeResult(StructType().add(key.name, key.dataType).add("place", LongType()).add("hit", IntegerType()).add("snippet", StringType()))

    def eval(self, row, phrase: str, most: int):
        page = " ".join((row["page"] or "").split())
        low, wanted = page.lower(), phrase.lower()
        at = low.find(wanted)
        while at >= 0 and self.found < most:
            self.found += 1
            yield row[0], at, self.found, page[max(at - 160, 0) : at + len(wanted) + 160].strip()
            at = low.find(wanted, at + len(wanted))


def register(spark: SparkSession) -> None:
    """Makes all of them known to a session: `select tl_doi_id(x)`, `select * from t, lateral chunk_md(t.text, 2000)`,
    `select * from find_phrase(table(select id, page from p) partition by id order by (id), 'a phrase', 8)`."""
    for name, (parameters, kind, body) in SCALARS.items():
        spark.sql(f"create or replace temporary function {name}({parameters}) returns {kind} return {body}")
    spark.udtf.register("chunk_md", udtf(ChunkMd, returnType="chunk_no int, heading string, line_start int, line_end int, text string"))
    spark.udtf.register("lint_blocks", udtf(LintBlocks, returnType="line_start int, line_end int, section string, role string, text string"))
    spark.udtf.register("find_phrase", udtf(FindPhrase))
