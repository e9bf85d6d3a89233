"""Clean text, paragraphs, tense, chunks, ids and gates over the tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from textloom.functions import text as T
from textloom.operators import chunks as C
from textloom.operators import embedding
from textloom.streaming.ingest import stream_ingest


def t(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sentences_chunk_rule(spark, d):
    """Sentences by the rule that chunks are packed by."""
    marked = F.regexp_replace("text", r"([.!?])\s+([A-Z0-9$(\\])", "$1\u0001$2")
    return t(spark, d, "documents").select("doc_id", F.size(F.split(marked, "\u0001")).cast("long").alias("sentences"))


def hyphen_normalise(spark, d):
    return t(spark, d, "documents").select("doc_id", F.translate("text", "‐‑­", "--").alias("text"))


def soft_hyphens(spark, d):
    """Texts without soft hyphens and the white space that one took up before a letter; each text gets some."""
    made = F.regexp_replace("text", "(th|en)(.)", "$1\u00ad $2")
    return t(spark, d, "documents").select("doc_id", F.regexp_replace(made, "\u00ad\\s*(?=[a-zA-Z])|\u00ad", "").alias("text"))


def query_terms(spark, d):
    """The first 32 terms of each passage as a question."""
    return t(spark, d, "benchmark").select("item_id", F.array_join(T.terms(F.col("text"), 32), " ").alias("terms"))


def chunk_ids(spark, d):
    """The signed 63-bit id of each document's first chunk name."""
    return t(spark, d, "documents").select("doc_id", C.fnv_id(F.concat(F.col("doc_id").cast("string"), F.lit("#c000"))).alias("id"))


def chunk_documents(spark, d):
    return C.chunk_table(t(spark, d, "documents"))


def chunk_size_summary(spark, d):
    """Count, middle, 95th percentile and largest of the chunks' sizes, from counts of sizes."""
    g = chunk_documents(spark, d).groupBy(F.length("text").alias("k")).agg(F.count("*").alias("c"))
    g = g.withColumn("hi", F.sum("c").over(Window.partitionBy(F.lit(0)).orderBy("k"))).withColumn("n", F.sum("c").over(Window.partitionBy(F.lit(0))))
    at = lambda pos: F.min(F.when(F.col("hi") > pos, F.col("k")))
    return g.agg(F.max("n").alias("n"), at(F.floor(F.col("n") / 2)).alias("median"), at(F.floor(F.col("n") * 95 / 100)).alias("p95"), F.max("k").alias("longest"))


def byte_shards(spark, d):
    return C.byte_shards(t(spark, d, "documents").select("doc_id", "text"), "doc_id", F.octet_length("text"), 1 << 20).select("doc_id", "shard")


def embed_groups(spark, d):
    """Lines of documents as chunks for an embedder, in groups of two thousand characters, and the length of each one's vector."""
    lines = t(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("chunk_no", "line"))
    x = embedding.grouped(lines, "doc_id", "chunk_no", "line", 2000).withColumn("v", embedding.vectors(F.col("line"), 16))
    return x.select("doc_id", "chunk_no", "group", F.size("v").cast("long").alias("dims"))


ORACLES = {
    "embed_groups": """with recursive l as (select doc_id, unnest(string_split(text, chr(10))) as line, unnest(range(len(string_split(text, chr(10))))) as n from documents),
g as (select doc_id, n, length(line) as fill, 0 as grp from l where n = 0 union all select l.doc_id, l.n, case when fill + length(line) > 2000 then length(line) else fill + length(line) end, grp + (fill + length(line) > 2000)::int from g join l on l.doc_id = g.doc_id and l.n = g.n + 1)
select doc_id, n::int as chunk_no, grp as "group", 16::bigint as dims from g""",
    "sentences_chunk_rule": "select doc_id, len(string_split(regexp_replace(text, '([.!?])\\s+([A-Z0-9$(\\\\])', '\\1' || chr(1) || '\\2', 'g'), chr(1))) as sentences from documents",
    "hyphen_normalise": "select doc_id, translate(text, '‐‑­', '--') as text from documents",
    "soft_hyphens": "select doc_id, regexp_replace(regexp_replace(regexp_replace(text, '(th|en)(.)', '\\1' || chr(173) || ' \\2', 'g'), chr(173) || '\\s*([a-zA-Z])', '\\1', 'g'), chr(173), '', 'g') as text from documents",
    "query_terms": "select item_id, array_to_string(regexp_extract_all(lower(text), '[a-z0-9]+')[1:32], ' ') as terms from benchmark",
    "byte_shards": "select doc_id, ((sum(strlen(text)) over (order by doc_id) - strlen(text)) // 1048576)::bigint as shard from documents",
    "chunk_ids": "with b as (select doc_id, list_transform(string_split(doc_id || '#c000', ''), lambda c: ascii(c)) as b from documents), h as (select doc_id, list_reduce(list_prepend(14695981039346656037::uhugeint, list_transform(b, lambda x: x::uhugeint)), lambda h, x: (xor(h, x) * 1099511628211::uhugeint) % 18446744073709551616::uhugeint) % 9223372036854775808::uhugeint as h from b) select doc_id, case when h >= 4611686018427387904::uhugeint then (h::hugeint - 9223372036854775808::hugeint)::bigint else h::bigint end as id from h",
    "stream_ingest": "select event_id, user_id, event_type from events",
}
QUERIES = {n: globals()[n] for n in [*ORACLES, "chunk_documents", "chunk_size_summary"]}
