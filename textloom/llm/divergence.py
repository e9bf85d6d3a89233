"""How far the sources of a language differ in their terms, exactly, for every pair of sources.

Two sources differ by a sum over all kept terms, but most terms occur in few sources. So every pair starts from the value that terms in neither
give, each source adds what its own terms change against a source without them (from the histogram of its counts), and only terms of both
need a correction of their own. These come from a frequent-pattern tree: the row of a term is its sources with their counts in source
order, equal rows count once with their multiplicity, and rows that begin alike share a path. A correction is worked out
once for each node and ancestor, times the rows that pass through the node. A task sorts its rows and builds its own tree, a batch at a time; sums of
all trees add up, so nothing is ever held whole.
"""

from __future__ import annotations

from collections import Counter
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import Scratch, by_bytes, documents, slices

LEAST_DOCS = 10
TOP = 10
HELD_TERMS = 300_000  # counters that a task holds before it hands them on
CELLS = 1 << 20  # of the rows of a tree that are worked on at once
WORDS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))


def term_counts(docs: DataFrame, most: int = HELD_TERMS) -> DataFrame:
    """(lang, source, term, n, docs): occurrences, and documents with it, of the terms of (lang, source, text) rows; a key has one row a task or a few.

    Terms are runs of ASCII letters and of all other characters beyond ASCII, A-Z lower-cased: bytes outside them become spaces.
    """

    def handed(held):
        for (lang, source), (n, d) in held.items():
            terms = list(n)
            same = [pa.repeat(pa.scalar(x, pa.string()), len(terms)) for x in (lang, source)]
            counts = [pa.array([c[t] for t in terms], pa.int64()) for c in (n, d)]
            yield pa.RecordBatch.from_arrays([*same, pa.array(terms, pa.binary()), *counts], names=["lang", "source", "term", "n", "docs"])

    def run(batches):
        held, size = {}, 0
        for batch in slices(batches, 2048):
            langs, sources = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            blobs = batch.column(2).to_pylist()
            for i, j in by_bytes(blobs):
                groups = {}
                for k in range(i, j):
                    groups.setdefault((langs[k], sources[k]), []).append(blobs[k].translate(WORDS).split())
                for group, lists in groups.items():
                    n, d = held.setdefault(group, (Counter(), Counter()))
                    before = len(n)
                    n.update(chain.from_iterable(lists))
                    d.update(chain.from_iterable(map(set, lists)))
                    size += len(n) - before
                if size > most:
                    yield from handed(held)
                    held, size = {}, 0
        yield from handed(held)

    return docs.mapInArrow(run, "lang string, source string, term binary, n long, docs long").withColumn("term", F.col("term").cast("string"))


def long_division(n: str, by: str) -> str:
    """SQL of floor(10^9 n / by), three digits a step: no product passes 64 bits while `by` stays below 9 * 10^15."""
    rest, out = n, f"({n}) div ({by})"
    for _ in range(3):
        rest = f"(({rest}) % ({by})) * 1000"
        out = f"({out}) * 1000 + ({rest}) div ({by})"
    return out


def _apart(p, q):
    d = p - q
    return d * d // (p + q)


def tree_sums(k: np.ndarray, p: np.ndarray, zero: np.ndarray, limits: np.ndarray):
    """(k of the ancestor, k of the node, sum) of the corrections of rows that are sorted, given end to end with their limits.

    An item is a source k, its share p there and the share `zero` that it gives to terms without an occurrence.
    """
    sizes = np.diff(limits)
    rows, width = len(sizes), int(sizes.max(initial=0))
    place = np.minimum(limits[:-1, None] + np.arange(width), max(len(k) - 1, 0))
    valid = np.arange(width) < sizes[:, None]
    kk, pp, zz = k[place], p[place], zero[place]
    same = np.zeros((rows, width), bool)
    same[1:] = valid[1:] & valid[:-1] & (kk[1:] == kk[:-1]) & (pp[1:] == pp[:-1])
    shared = np.logical_and.accumulate(same, axis=1)
    for depth in range(1, width):
        starts = np.flatnonzero(~shared[:, depth])
        through = np.diff(np.append(starts, rows))  # rows that pass through the node that begins here
        node = valid[starts, depth]
        r, m = starts[node], through[node]
        if not len(r):
            continue
        pn, zn, pa_, za = pp[r, depth, None], zz[r, depth, None], pp[r, :depth], zz[r, :depth]
        value = (_apart(pa_, pn) - _apart(pa_, zn) - _apart(za, pn) + _apart(za, zn)) * m[:, None]
        yield kk[r, :depth].ravel(), np.repeat(kk[r, depth], depth), value.ravel()


def _summed(parts):
    """Sums of equal pairs."""
    low, high, value = (np.concatenate([x[i] for x in parts]) for i in range(3))
    order = np.lexsort((high, low))
    low, high, value = low[order], high[order], value[order]
    first = np.flatnonzero(np.concatenate(([True], (low[1:] != low[:-1]) | (high[1:] != high[:-1]))))
    return low[first], high[first], np.add.reduceat(value, first)


def corrections(rows: DataFrame, cells: int = CELLS) -> DataFrame:
    """(lang, low, high, value) of (lang, row) frames, a row being the sorted items (k, p, zero) of a term: sums over terms of both sources."""

    def run(batches):
        for batch in batches:
            langs, lists = batch.column(0), batch.column(1)
            if not batch.num_rows:
                continue
            items, limits = lists.flatten(), np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False)))).astype(np.int64)
            k, p, zero = (c.to_numpy(zero_copy_only=False).astype(np.int64) for c in items.flatten())
            names = langs.to_pylist()
            edge = [0, *[i for i in range(1, len(names)) if names[i] != names[i - 1]], len(names)]
            for a, b in zip(edge[:-1], edge[1:]):
                width, parts = int(np.diff(limits[a : b + 1]).max(initial=0)), []
                step = max(1, cells // max(width * width // 2, 1))
                for i in range(a, b, step):
                    at = limits[i : min(b, i + step) + 1]
                    parts += list(tree_sums(k[at[0] : at[-1]], p[at[0] : at[-1]], zero[at[0] : at[-1]], at - at[0]))
                    if sum(len(x[0]) for x in parts) > cells:
                        parts = [_summed(parts)]
                if parts:
                    low, high, value = _summed(parts)
                    yield pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(names[a], pa.string()), len(low)), pa.array(low), pa.array(high), pa.array(value)], names=["lang", "low", "high", "value"])

    sums = rows.mapInArrow(run, "lang string, low long, high long, value long")
    return sums.groupBy("lang", "low", "high").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP, held_terms: int = HELD_TERMS, cells: int = CELLS) -> DataFrame:
    """lang, source, part, item, value, rank of every (lang, source) group.

    Part `pair`: the other sources of the language by their distance, all ranks; part `term`: the kept terms that are more frequent in
    the source than in the language by their distance from it, ranks to `top`. Null text, lang and source are ''. Each row
    is a document, also if ids repeat or are null. A language without kept terms has distances of 0 and no terms; an empty
    frame gives an empty result; other columns are left behind.
    """
    scratch = Scratch(docs.sparkSession, "divergence")
    rows = docs.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source")], F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    names = rows.select("lang", "source").distinct()
    names = scratch.table(names.withColumn("k", F.row_number().over(Window.partitionBy("lang").orderBy("source")).cast("long")), "names")
    # One shuffle by (lang, term) serves both counts.
    by_term = term_counts(rows, held_terms).repartition("lang", "term").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    by_term = by_term.groupBy("lang", "term").agg(F.collect_list(F.struct("source", "n")).alias("items"), F.sum("n").alias("n_lang"), F.sum("docs").alias("docs")).where(F.col("docs") >= least_docs)
    counts = by_term.withColumn("row", F.monotonically_increasing_id()).select("lang", "term", "n_lang", "row", F.inline("items"))
    counts = scratch.table(counts, "counts")
    of_lang = counts.groupBy("lang").agg(F.count_distinct("row").alias("kept"), F.sum("n").alias("all_lang"))
    groups = names.join(counts.groupBy("lang", "source").agg(F.sum("n").alias("all")), ["lang", "source"], "left").join(of_lang, "lang", "left")
    groups = groups.select("lang", "source", "k", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("all", "kept", "all_lang")])
    groups = groups.withColumn("zero", F.when(F.col("kept") > 0, F.expr("1 + " + long_division("2", "all + 2 * kept"))).otherwise(1))
    groups = scratch.table(groups.withColumn("sources", F.max("k").over(Window.partitionBy("lang"))), "groups")
    items = counts.join(groups, ["lang", "source"]).withColumn("p", F.expr("1 + " + long_division("n + 2", "all + 2 * kept")))
    tops = items.withColumn("q", F.expr("1 + " + long_division("n_lang + 2", "all_lang + 2 * kept"))).where("p > q")
    tops = tops.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), F.expr("((p - q) * (p - q)) div (p + q)").alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    tops = tops.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return _pairs(items, groups, order, cells).unionByName(tops)


def _pairs(items: DataFrame, groups: DataFrame, order, cells: int) -> DataFrame:
    """Part `pair`: as many rows as the result has, each with the histograms of its two sources."""
    paths = items.groupBy("row").agg(F.first("lang").alias("lang"), F.sort_array(F.collect_list(F.struct("k", "p", "zero"))).alias("path"))
    both = corrections(paths.sortWithinPartitions("lang", "path").select("lang", "path"), cells)
    shares = items.groupBy("lang", "k", "p").agg(F.count("*").alias("m")).groupBy("lang", "k").agg(F.collect_list(F.struct("p", "m")).alias("shares"))
    own = groups.join(shares, ["lang", "k"], "left")
    pairs = groups.select("lang", F.col("k").alias("low"), F.explode_outer(F.expr("case when k < sources then sequence(k + 1, sources) end")).alias("high")).where("high is not null")
    for end in ("low", "high"):
        pairs = pairs.join(own.select("lang", F.col("k").alias(end), *[F.col(c).alias(f"{c}_{end}") for c in ("source", "zero", "shares")], *(["kept"] if end == "low" else [])), ["lang", end])
    pairs = pairs.join(both, ["lang", "low", "high"], "left")
    apart = "((x.p - zero_{0}) * (x.p - zero_{0})) div (x.p + zero_{0})"
    base = "((zero_low - zero_high) * (zero_low - zero_high)) div (zero_low + zero_high)"
    alone = [f"coalesce(aggregate(shares_{a}, 0L, (s, x) -> s + x.m * ({apart.format(b)} - {base})), 0L)" for a, b in (("low", "high"), ("high", "low"))]
    pairs = pairs.withColumn("value", F.expr(f"case when kept = 0 then 0L else kept * ({base}) + {alone[0]} + {alone[1]} + coalesce(value, 0L) end"))
    ends = F.explode(F.array(*[F.struct(F.col(f"source_{a}").alias("source"), F.col(f"source_{b}").alias("item")) for a, b in (("low", "high"), ("high", "low"))])).alias("e")
    pairs = pairs.select("lang", "value", ends).select("lang", "e.source", F.lit("pair").alias("part"), "e.item", "value")
    return pairs.withColumn("rank", F.row_number().over(order))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op13: all pairs of sources of each language, and the terms that mark a source."""
    return audit(documents(spark, sf_dir).select("lang", "source", "text"))


ORACLE = r"""
with d as (select row_number() over () as i, coalesce(text, '') as text, coalesce(lang, '') as lang, coalesce(source, '') as source from documents),
w as (select i, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term from d),
k as (select lang, term, count(*) as n from w group by all having count(distinct i) >= 10),
v as (select lang, count(*) as v, sum(n)::bigint as n from k group by lang),
c as (select lang, source, term, count(*) as n from w semi join k using (lang, term) group by all),
g as (select d.lang, d.source, coalesce(any_value(t.n), 0) as n, coalesce(any_value(v.v), 0) as v from d left join (select lang, source, sum(n)::bigint as n from c group by all) t using (lang, source) left join v on v.lang = d.lang group by all),
p as (select g.lang, g.source, k.term, coalesce(c.n, 0) as c, 1 + ((1000000000::hugeint * (coalesce(c.n, 0) + 2)) // (g.n + 2 * g.v)) as p,
  1 + ((1000000000::hugeint * (k.n + 2)) // (v.n + 2 * v.v)) as q from g join k on k.lang = g.lang join v on v.lang = g.lang left join c on c.lang = g.lang and c.source = g.source and c.term = k.term),
s as (select a.lang, a.source, b.source as item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p))::bigint as value from p a join p b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
pair as (select a.lang, a.source, 'pair' as part, b.source as item, coalesce(s.value, 0) as value from g a join g b on a.lang = b.lang and a.source <> b.source left join s on s.lang = a.lang and s.source = a.source and s.item = b.source),
term as (select lang, source, 'term' as part, term as item, (((p - q) * (p - q)) // (p + q))::bigint as value from p where c > 0 and p > q),
r as (select *, row_number() over (partition by lang, source, part order by value desc, item)::int as rank from (from pair union all from term))
select lang, source, part, item, value, rank from r where part = 'pair' or rank <= 10
"""
