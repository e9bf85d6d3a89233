"""Lines that many documents share go from all of them but the last.

Lines are exploded with their place, normalised and hashed; distinct documents are counted per hash; the places of lines over the
threshold are gathered per document, and what stands between them is put together again by position. Only hashes and places are
shuffled for the count; a text moves once, to meet the places that it loses.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import Scratch, documents, free_prefix

LEAST_CHARS = 40
LEAST_DOCS = 5
HEAVY = 1000  # a key with more than one of so many lines is heavy: so there are fewer heavy keys than this
WHITE = " \t\n\x0b\x0c\r"


def line_key(line: Column) -> Column:
    """The line without white space at its ends, A-Z lower-cased; lower() means the same where all is ASCII, and is much faster."""
    bare = F.btrim(line, F.lit(WHITE))
    ascii_only = F.octet_length(bare) == F.char_length(bare)
    return F.when(ascii_only, F.lower(bare)).otherwise(F.translate(bare, string.ascii_uppercase, string.ascii_lowercase))


def _shared_places(lines: DataFrame, least_docs: int, scratch: Scratch) -> DataFrame:
    """(doc, tag, place) of the lines to drop, from (doc, tag, place, a, b); a and b are the hash.

    A line of a third of all rows is counted by (hash, document) first, so no task gets it whole; its lines then meet its count by
    a broadcast of heavy keys, of which there are fewer than HEAVY whatever the input, and all others by a shuffle.
    """
    per_doc = lines.groupBy("a", "b", "doc").agg(F.count("*").alias("_n"))
    over = per_doc.groupBy("a", "b").agg(F.count("*").alias("_docs"), F.sum("_n").alias("_lines"), F.max("doc").alias("_last")).where(F.col("_docs") >= least_docs)
    over = scratch.table(over.select("a", "b", "_lines", "_last"), "over")
    every = lines.count()
    heavy = F.broadcast(over.where(F.col("_lines") * HEAVY > every).select("a", "b", F.col("_last").alias("_kept_in")).withColumn("_heavy", F.lit(True)))
    marked = lines.join(heavy, ["a", "b"], "left")
    light = marked.where("_heavy is null").drop("_kept_in").join(over.where(F.col("_lines") * HEAVY <= every).select("a", "b", F.col("_last").alias("_kept_in")), ["a", "b"])
    found = marked.where("_heavy").select("doc", "tag", "place", "_kept_in").unionByName(light.select("doc", "tag", "place", "_kept_in"))
    return found.where(~F.col("doc").eqNullSafe(F.col("_kept_in"))).select("doc", "tag", "place")


def dedup_lines(docs: DataFrame, text: str = "text", key: str = "doc_id", least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS) -> DataFrame:
    """All columns of docs, then `kept` (the text without shared lines), `n_lines` (before) and `n_dropped`.

    A null or empty text is one empty line. Rows that repeat a key are one document for the count and for the place that keeps
    its lines, and each has a row of its own. Rows without a key count as one document, which is never the one that keeps.
    A text of shared lines alone becomes empty. An empty frame gives an empty result. Columns of docs may have any other names.
    """
    scratch, p = Scratch(docs.sparkSession, "lines"), free_prefix(docs)
    body = F.coalesce(F.col(text), F.lit(""))
    # Rows of one key may differ in their texts, so a place belongs to the key and the text's hash.
    lines = docs.select(F.col(key).alias("doc"), F.xxhash64(body).alias("tag"), F.posexplode(F.split(body, "\n")).alias("place", "line"))
    lines = lines.where(F.char_length(F.btrim("line", F.lit(WHITE))) >= least_chars).withColumn("line", line_key(F.col("line")))
    lines = lines.select("doc", "tag", "place", F.xxhash64("line").alias("a"), F.xxhash64(F.lit(1), "line").alias("b"))
    lines = scratch.table(lines, "lines")
    lost = _shared_places(lines, least_docs, scratch).groupBy("doc", "tag").agg(F.sort_array(F.collect_set("place")).alias(f"{p}lost"))
    lost = lost.select(F.col("doc").alias(f"{p}doc"), F.col("tag").alias(f"{p}tag"), f"{p}lost")
    met = docs.join(lost, F.col(key).eqNullSafe(F.col(f"{p}doc")) & (F.xxhash64(body) == F.col(f"{p}tag")), "left")
    met = met.withColumn(f"{p}lines", F.split(body, "\n")).withColumn(f"{p}n", F.size(f"{p}lines"))
    # What stands between two lost places is one slice, so the work is in proportion to the lines.
    begins = F.concat(F.array(F.lit(0)), F.transform(f"{p}lost", lambda i: i + 1))
    ends = F.concat(f"{p}lost", F.array(f"{p}n"))
    between = F.flatten(F.zip_with(begins, ends, lambda a, b: F.slice(F.col(f"{p}lines"), a + 1, b - a)))
    return met.select(
        *[F.col(c) for c in docs.columns],
        F.when(F.col(f"{p}lost").isNull(), body).otherwise(F.array_join(between, "\n")).alias("kept"),
        F.col(f"{p}n").cast("long").alias("n_lines"),
        F.coalesce(F.size(f"{p}lost"), F.lit(0)).cast("long").alias("n_dropped"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op11: lines of 40 code points and more in 5 documents and more stay in the last of them only."""
    return dedup_lines(documents(spark, sf_dir).select("doc_id", "text")).select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


ORACLE = """
with l as (select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as place from documents),
k as (select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from l),
o as (select key, max(doc_id) as keeps from k where length(key) >= 40 group by key having count(distinct doc_id) >= 5),
m as (select k.*, coalesce(o.keeps <> k.doc_id, false) as gone from k left join o using (key))
select doc_id, count(*) as n_lines, count(*) filter (where gone) as n_dropped, sha256(coalesce(string_agg(line, chr(10) order by place) filter (where not gone), '')) as kept_sha256
from m group by doc_id
"""
