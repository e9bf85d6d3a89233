"""Mixing sources to target weights by hierarchical budgets.

Weights go down a tree of domains, languages and sources: a node's budget is
split over its children by weight. A child that holds fewer tokens than its
share gets all it holds; what is left goes to its siblings by weight, and only
what a whole family can't hold goes to the families of its ancestors. A leaf
then takes its budget as a prefix of seeded epochs: whole passes over its
documents, and of the last pass the documents that come first by a hash of
seed, epoch and doc_id.

The tree has a row a leaf. The prefix of a leaf with a large share of all documents
is cut in hash ranges: their token totals are summed first, and running sums stay
inside one range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import Scratch, documents, join_same

LEVELS = ["domain", "lang", "source"]
SEED = 20260101
SHARE = 0.8  # of all tokens, the production budget
EPOCHS = 1.0
RANGE_ROWS = 1_000  # documents a hash range, about
#: Weights of children among their siblings; those not named have 1.
WEIGHTS = {"lang": {"en": 3.0, "de": 1.5}, "domain": {"d0": 2.0}}


def domain_of(source: Column) -> Column:
    """Sources have no domain of their own here; they fall into four by name."""
    return F.concat(F.lit("d"), F.pmod(F.crc32(F.coalesce(source, F.lit("")).cast("binary")), F.lit(4)).cast("string"))


def tokens_of(text: Column) -> Column:
    """Words between single spaces or line ends; a null or empty text has none."""
    return F.when(F.coalesce(F.length(text), F.lit(0)) == 0, F.lit(0)).otherwise(F.length(text) - F.length(F.translate(text, " \n", "")) + 1).cast("long")


def weight_of(level: str, weights: dict) -> Column:
    known = weights.get(level, {})
    out = F.lit(1.0)
    for name in sorted(known):
        out = F.when(F.col(level) == name, F.lit(float(known[name]))).otherwise(out)
    return out


def budgets(leaves: DataFrame, total: Column, weights: dict, epochs: float = EPOCHS, levels: list[str] | None = None) -> DataFrame:
    """leaves (levels, available) with `budget`, the tokens each leaf may give; `total` is an expression over `_all`, the tokens there are."""
    levels = levels or LEVELS
    room = {n: levels[: n + 1] for n in range(len(levels))}
    out = leaves.withColumn("_cap", F.col("available") * F.lit(float(epochs)))
    out = out.withColumn("_budget", total)
    for n, level in enumerate(levels):
        parent, own = levels[:n], room[n]
        nodes = out.groupBy(*own).agg(F.sum("_cap").alias("_c"), F.first("_budget").alias("_b")).withColumn("_w", weight_of(level, weights))
        # Children by capacity for their weight; those that come before some point are filled, the others share the rest by weight.
        nodes = nodes.withColumn("_r", F.col("_c") / F.col("_w"))
        w = (Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))).orderBy("_r", F.col(level).asc_nulls_first())
        full = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        rest = w.rowsBetween(Window.currentRow, Window.unboundedFollowing)
        nodes = nodes.withColumn("_before", F.sum("_c").over(full) - F.col("_c")).withColumn("_weights", F.sum("_w").over(rest))
        fair = (F.col("_b") - F.col("_before")) / F.col("_weights")
        nodes = nodes.withColumn("_filled", F.col("_r") <= fair)
        # Past the first child that isn't filled the quotient only falls, so the family's level is the greatest of these.
        first = F.max(F.when(~F.col("_filled"), fair)).over(Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0)))
        nodes = nodes.withColumn("_share", F.when(F.col("_filled"), F.col("_c")).otherwise(F.least(F.col("_c"), F.greatest(F.lit(0.0), first * F.col("_w")))))
        out = join_same(out.drop("_budget"), nodes.select(*own, F.col("_share").alias("_budget")), own)
    return out.withColumn("budget", F.floor(F.col("_budget") + 1e-6).cast("long")).drop("_budget", "_cap")


def mix(rows: DataFrame, scratch: Scratch, share: float = SHARE, weights: dict | None = None, epochs: float = EPOCHS, seed: int = SEED) -> DataFrame:
    """rows (doc_id, domain, lang, source, tokens) with `copies`: how often each document is taken, 0 for not.

    A document of no tokens is never taken. Null levels are a branch of their own. Repeated rows are placed next to each other and taken each by itself.
    An empty frame gives an empty result.
    """
    weights = WEIGHTS if weights is None else weights
    rows = scratch.table(rows.select("doc_id", *LEVELS, "tokens"), "rows")
    leaves = rows.groupBy(*LEVELS).agg(F.sum("tokens").alias("available"), F.count("*").alias("n"))
    leaves = scratch.table(leaves.withColumn("_all", F.sum("available").over(Window.partitionBy(F.lit(0)))), "leaves")
    plan = budgets(leaves, F.col("_all") * F.lit(float(share)), weights, epochs)
    plan = plan.withColumn("_passes", F.floor(F.col("budget") / F.greatest(F.col("available"), F.lit(1)))).withColumn("_left", F.col("budget") - F.col("_passes") * F.col("available"))
    plan = scratch.table(plan.select(*LEVELS, "budget", "_passes", "_left", F.greatest(F.lit(1), F.ceil(F.col("n") / RANGE_ROWS)).alias("_ranges")), "plan")
    placed = join_same(rows, plan, LEVELS)
    place = F.xxhash64(F.lit(seed), F.col("_passes"), F.coalesce("doc_id", F.lit(-1)))
    placed = placed.withColumn("_place", place).withColumn("_range", F.shiftright((F.shiftright("_place", 32) + (1 << 31)) * F.col("_ranges"), 32))  # 32 bits of the place, so that the product fits a long up to 2^31 ranges
    totals = placed.groupBy(*LEVELS, "_range").agg(F.sum("tokens").alias("_t"))
    before = Window.partitionBy(*LEVELS).orderBy("_range").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = totals.withColumn("_before", F.sum("_t").over(before) - F.col("_t"))
    inside = Window.partitionBy(*LEVELS, "_range").orderBy("_place", "doc_id", "tokens").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = placed.withColumn("_upto", F.sum("tokens").over(inside))
    both = join_same(placed, totals.drop("_t"), [*LEVELS, "_range"])
    taken = F.col("_passes") + F.when(F.col("_before") + F.col("_upto") <= F.col("_left"), 1).otherwise(0)
    return both.select("doc_id", *LEVELS, "tokens", F.when(F.col("tokens") > 0, taken).otherwise(0).cast("long").alias("copies"))


def leveled(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", domain_of(F.col("source")).alias("domain"), "lang", "source", tokens_of(F.col("text")).alias("tokens"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op3: how often each document is taken for the production mixture."""
    return mix(leveled(documents(spark, sf_dir)), Scratch(spark, "mixing"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents taken, with their own columns; one of no tokens is left out. Rows that share a doc_id, or have none, are taken if one of them is, those with tokens."""
    taken = mix(leveled(docs), Scratch(spark, "mixing")).where("copies > 0").select(F.col("doc_id").alias("_taken")).distinct()
    return docs.where(tokens_of(F.col("text")) > 0).join(taken, F.col("doc_id").eqNullSafe(F.col("_taken")), "left_semi").select(*docs.columns)
