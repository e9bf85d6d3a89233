"""Retrieval queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from textloom.functions import text as T
from textloom.operators import retrieval as R
from textloom.operators.index import SearchIndex, index_of
from textloom.operators.neighbours import VectorIndex
from textloom.sources.folders import shared_folder

TERMS = ["license", "under", "version", "thing", "ation"]


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def probe(spark, sf_dir) -> list[float]:
    """The query vector: the one of the least id. One row comes to the driver, as a request's vector would."""
    row = table(spark, sf_dir, "embeddings").orderBy("vec_id").select("embedding").first()
    return [float(x) for x in row.embedding] if row else []


def stored(spark, sf_dir) -> SearchIndex:
    """The stored index of the documents; the first question of a session builds it."""
    return index_of(spark, f"{sf_dir}/documents.parquet", ["lang", "source"])


def bm25_topk(spark, sf_dir):
    return stored(spark, sf_dir).bm25(TERMS, k=10)


def bm25_topk_faceted(spark, sf_dir):
    return stored(spark, sf_dir).bm25(TERMS, F.col("lang") == "en", 10)


def dense_topk_cosine(spark, sf_dir):
    return R.dense(table(spark, sf_dir, "embeddings"), probe(spark, sf_dir), k=10)


def dense_topk_faceted(spark, sf_dir):
    return R.dense(table(spark, sf_dir, "embeddings"), probe(spark, sf_dir), F.col("label") == 3, 10)


def dense_index_topk(spark, sf_dir):
    """The ten nearest vectors of every one whose id is divisible by 50, by the inverted file; approximate, with its recall in the tests."""
    vectors = table(spark, sf_dir, "embeddings")
    held = VectorIndex.build(vectors, shared_folder(spark), "vec_id", "embedding", ["label"])
    return held.search(vectors.where("vec_id % 50 = 0"), "vec_id", "embedding").select(F.col("question").alias("query_id"), F.col("id").alias("vec_id"), "rank", "score")


def soft_boost_topk(spark, sf_dir):
    return R.dense(table(spark, sf_dir, "embeddings"), probe(spark, sf_dir), k=10, boost=F.when(F.col("label") == 3, 0.03).otherwise(0.0))


def _fused(spark, sf_dir):
    sparse = R.ranked(stored(spark, sf_dir).bm25(TERMS, k=50), "doc_id")
    near = R.ranked(R.dense(table(spark, sf_dir, "embeddings"), probe(spark, sf_dir), k=50), "vec_id")
    return R.rrf(sparse, near)


def rrf_hybrid(spark, sf_dir):
    """Embeddings are paired with documents by vec_id = doc_id, a convention of these tables."""
    return _fused(spark, sf_dir).orderBy(F.desc("score"), "doc_id").limit(20)


def rrf_cap_per_group(spark, sf_dir):
    hits = _fused(spark, sf_dir).join(table(spark, sf_dir, "documents").select("doc_id", "source"), "doc_id")
    return R.cap(hits, "source", 2).select("doc_id", "source", "score", "rn")


def hydrate_hits(spark, sf_dir):
    index = stored(spark, sf_dir)
    docs = index.hydrated(index.bm25(TERMS, k=20), ["lang", "source", "text"])
    passage = F.when(F.length("text") > 4000, F.concat(F.left("text", F.lit(4000)), F.lit("\n[...truncated]"))).otherwise(F.col("text"))
    return docs.join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left").select("doc_id", "score", "lang", "source", "quality", passage.alias("passage"))


def search_merge(spark, sf_dir):
    """Two result legs merged by key: greatest count, any flag, the first venue and year that a leg has, all finders; filtered after the fusion."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars", "lang", "source")
    year = F.lit(1950) + F.col("n_chars") % 75
    a = docs.where("lang = 'en'").orderBy(F.desc("n_chars"), "doc_id").limit(40).select("doc_id", F.col("n_chars").alias("citations"), F.lit(False).alias("oa"), F.lit("a").alias("by"), F.when(F.col("doc_id") % 2 == 0, F.col("source")).alias("venue"), F.lit(None).cast("long").alias("year"))
    b = docs.join(table(spark, sf_dir, "labels").where("quality = 1").select("doc_id"), "doc_id").orderBy(F.desc("n_chars"), "doc_id").limit(40).select("doc_id", (F.col("n_chars") + 1).alias("citations"), F.lit(True).alias("oa"), F.lit("b").alias("by"), F.upper("source").alias("venue"), year.alias("year"))
    legs = [x.withColumnRenamed("citations", "score") for x in (a, b)]
    fused = R.rrf(*[R.ranked(x, "doc_id") for x in legs])
    first = lambda c: F.min_by(c, F.when(F.col(c).isNotNull(), F.col("by"))).alias(c)
    merged = a.unionByName(b).groupBy("doc_id").agg(F.max("citations").alias("citations"), F.bool_or("oa").alias("oa"), F.array_join(F.array_sort(F.collect_list("by")), ",").alias("found_by"), first("venue"), first("year"))
    return fused.join(merged, "doc_id").where("citations >= 5000").select("doc_id", "score", "citations", "oa", "found_by", "venue", "year").orderBy(F.desc("score"), "doc_id").limit(20)


def rerank_overlap(spark, sf_dir):
    """A stand-in for a reranker: for every passage as a question, the share of its terms in each of the pool's texts."""
    index = stored(spark, sf_dir)
    rows = index.hydrated(index.bm25(TERMS, k=20), ["text"]).select("doc_id", T.terms(F.col("text")).alias("t"))
    q = table(spark, sf_dir, "benchmark").select("item_id", F.array_distinct(T.terms(F.col("text"))).alias("q")).where("size(q) > 0")
    both = q.crossJoin(F.broadcast(rows))  # a pool of 20 for each question
    return both.select("item_id", "doc_id", F.round(F.size(F.array_intersect("q", "t")) / F.size("q").cast("double"), 6).alias("score"))


_T = ", ".join(f"'{t}'" for t in TERMS)
_BM = """
tk as (select doc_id, regexp_extract_all(lower(coalesce(text, '')), '[a-z0-9]+') as t from documents),
dl as (select doc_id, len(t)::double as dl from tk),
co as (select count(*)::double as n, avg(dl) as avgdl from dl),
po as (select doc_id, term, count(*)::double as tf from (select doc_id, unnest(t) as term from tk) where term in ({T}) group by all),
df as (select term, count(*)::double as df from po group by 1),
bm as (select doc_id, round(sum(ln(1e0 + (n - df + 5e-1) / (df + 5e-1)) * tf * 2.2e0 / (tf + 1.2e0 * (2.5e-1 + 7.5e-1 * dl / avgdl))), 6) as score
  from po join df using (term) join dl using (doc_id), co {W} group by 1)
""".replace("{T}", _T)
BM = _BM.replace("{W}", "")
_DE = """
qv as (select embedding as q from embeddings order by vec_id limit 1),
de as (select vec_id, label, list_cosine_similarity(embedding::double[], q::double[]) as raw from embeddings, qv)
"""
_FUSE = f"""with {BM}, {_DE},
l1 as (select doc_id, row_number() over (order by score desc, doc_id) as rank from (select * from bm order by score desc, doc_id limit 50)),
l2 as (select vec_id as doc_id, row_number() over (order by score desc, vec_id) as rank from (select vec_id, round(raw, 6) as score from de order by 2 desc, 1 limit 50)),
fu as (select doc_id, round(sum(1e0 / (6e1 + rank)), 6) as score, count(*) as legs from (select * from l1 union all select * from l2) group by 1)
"""
ORACLES = {
    "bm25_topk": f"with {BM} select doc_id, score from bm order by score desc, doc_id limit 10",
    "bm25_topk_faceted": f"with {_BM.replace('{W}', chr(39).join(['where doc_id in (select doc_id from documents where lang = ', 'en', ')']))} select doc_id, score from bm order by score desc, doc_id limit 10",
    "dense_topk_cosine": f"with {_DE} select vec_id, label, round(raw, 6) as score from de order by 3 desc, 1 limit 10",
    "dense_topk_faceted": f"with {_DE} select vec_id, label, round(raw, 6) as score from de where label = 3 order by 3 desc, 1 limit 10",
    "soft_boost_topk": f"with {_DE} select vec_id, label, round(raw + case when label = 3 then 3e-2 else 0e0 end, 6) as score from de order by 3 desc, 1 limit 10",
    "rrf_hybrid": f"{_FUSE} select doc_id, score, legs from fu order by score desc, doc_id limit 20",
    "rrf_cap_per_group": f"{_FUSE} select doc_id, source, score, row_number() over (partition by source order by score desc, doc_id) as rn from fu join documents using (doc_id) qualify rn <= 2",
    "hydrate_hits": f"with {BM}, h as (select * from bm order by score desc, doc_id limit 20) select doc_id, score, lang, source, quality, case when length(text) > 4000 then concat(left(text, 4000), chr(10), '[...truncated]') else text end as passage from h join documents using (doc_id) left join labels using (doc_id)",
    "search_merge": """with a as (select doc_id, n_chars as c, false as oa, 'a' as k, case when doc_id % 2 = 0 then source end as venue, null::bigint as year from documents where lang = 'en' order by n_chars desc, doc_id limit 40),
b as (select doc_id, n_chars + 1 as c, true as oa, 'b' as k, upper(source) as venue, 1950 + n_chars % 75 as year from documents join labels using (doc_id) where quality = 1 order by n_chars desc, doc_id limit 40),
u as (select *, row_number() over (partition by k order by c desc, doc_id) as r from (select * from a union all select * from b)),
m as (select doc_id, round(sum(1e0 / (6e1 + r)), 6) as score, max(c) as citations, bool_or(oa) as oa, string_agg(k, ',' order by k) as found_by, arg_min(venue, k) filter (venue is not null) as venue, arg_min(year, k) filter (year is not null) as year from u group by 1)
select doc_id, score, citations, oa, found_by, venue, year from m where citations >= 5000 order by score desc, doc_id limit 20""",
    "rerank_overlap": f"with {BM}, h as (select * from bm order by score desc, doc_id limit 20), q as (select item_id, list_distinct(regexp_extract_all(lower(text), '[a-z0-9]+')) as q from benchmark) select item_id, doc_id, round(len(list_intersect(q, regexp_extract_all(lower(text), '[a-z0-9]+'))) / len(q)::double, 6) as score from h join documents using (doc_id), q where len(q) > 0",
}
QUERIES = {n: globals()[n] for n in [*ORACLES, "dense_index_topk"]}
