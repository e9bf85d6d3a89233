"""BM25 and dense retrieval, reciprocal rank fusion, caps and hydration."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.functions import text as T

K1, B, RRF = 1.2, 0.75, 60.0


def bm25(docs: DataFrame, query_terms: list[str], keep: Column | None = None, k: int = 50) -> DataFrame:
    """The k best documents for any of the terms. Counts and lengths are of the whole corpus; `keep` restricts the hits only.

    Two passes over the texts: one sums the corpus's counts, a row in all; the other scores each document by itself, so nothing of the size of the corpus is shuffled.
    """
    words = [str(w) for w in dict.fromkeys(query_terms)]
    held = T.terms(F.col("text"))
    tf = lambda w: F.size(F.filter("t", lambda x: x == w)).cast("double")
    split = docs.select("doc_id", (F.lit(True) if keep is None else F.coalesce(keep, F.lit(False))).alias("_keep"), held.alias("t"))
    sized = split.select("doc_id", "_keep", F.size("t").cast("double").alias("dl"), *[tf(w).alias(f"tf{i}") for i, w in enumerate(words)])
    corpus = sized.agg(F.count("*").cast("double").alias("n"), F.avg("dl").alias("avgdl"), *[F.count_if(F.col(f"tf{i}") > 0).cast("double").alias(f"df{i}") for i in range(len(words))])
    hit = F.greatest(*[F.col(f"tf{i}") for i in range(len(words))], F.lit(0.0)) > 0
    x = sized.where(F.col("_keep") & hit).crossJoin(F.broadcast(corpus))  # one row of totals
    parts = []
    for i in range(len(words)):
        idf = F.log(1.0 + (F.col("n") - F.col(f"df{i}") + 0.5) / (F.col(f"df{i}") + 0.5))
        parts.append(idf * F.col(f"tf{i}") * (K1 + 1.0) / (F.col(f"tf{i}") + K1 * (1.0 - B + B * F.col("dl") / F.col("avgdl"))))
    return x.select("doc_id", F.round(sum(parts, F.lit(0.0)), 6).alias("score")).orderBy(F.desc("score"), "doc_id").limit(k)


def cosine(vector: Column, query: list[float]) -> Column:
    q = F.array(*[F.lit(float(x)) for x in query])
    dot = F.aggregate(F.zip_with(vector, q, lambda a, b: a.cast("double") * b), F.lit(0.0), lambda s, x: s + x)
    norm = F.sqrt(F.aggregate(vector, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    return F.when(norm > 0, dot / (norm * F.lit(sum(x * x for x in query) ** 0.5))).otherwise(0.0)


def dense(vectors: DataFrame, query: list[float], keep: Column | None = None, k: int = 50, boost: Column | None = None) -> DataFrame:
    """The k nearest by cosine; the facet filter applies before the ranking."""
    rows = vectors if keep is None else vectors.where(keep)
    score = cosine(F.col("embedding"), query)
    return rows.select("vec_id", "label", F.round(score if boost is None else score + boost, 6).alias("score")).orderBy(F.desc("score"), "vec_id").limit(k)


def ranked(hits: DataFrame, key: str) -> DataFrame:
    """Ranks of a leg of fixed size."""
    return hits.select(F.col(key).alias("doc_id"), F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.desc("score"), key)).alias("rank"))


def rrf(*legs: DataFrame) -> DataFrame:
    out = legs[0]
    for leg in legs[1:]:
        out = out.unionByName(leg)
    return out.groupBy("doc_id").agg(F.round(F.sum(1.0 / (RRF + F.col("rank"))), 6).alias("score"), F.count("*").alias("legs"))


def cap(hits: DataFrame, group: str, most: int) -> DataFrame:
    """The first `most` of each group by score."""
    w = Window.partitionBy(group).orderBy(F.desc("score"), "doc_id")
    return hits.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= most)
