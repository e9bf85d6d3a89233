"""Gates between an old and a new form of documents: how the lines that differ are explained."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Lines that show an asset by its long and by its short name, and their caption.
LONG = r"^!\[.*\]\(10\.[0-9]+:[^)]*-(fig|tab|eq)[0-9]+\)$"
SHORT = r"^!\[.*\]\((fig|tab|eq)[0-9]+\)$"
CAPTION = r"^!\[(.*)\]\(.*\)$"
TABLE = r"^(\||\*\*Table)|-tab[0-9]+\.html\)"


def gate_diff(old: DataFrame, new: DataFrame, allow_revert: bool = False) -> DataFrame:
    """(doc_id, whitespace, renamed, rest, pass) of the documents that both have (doc_id, text).

    Lines are compared as multisets. Of those that only one side has, pairs that differ by white space around them are set off first, then assets that
    show the same caption and number by a long and a short name. What is left is identical (nothing differed), explained (all was set off), ref-layout (assets
    only, and no caption is lost), splice-revert (a table for its asset; only if allowed) or unexpected, which alone fails. Documents may be long: lines are
    counted in groups, not held together.
    """
    lines = lambda x, n: x.select("doc_id", F.explode(F.split("text", "\n")).alias("line")).groupBy("doc_id", "line").agg(F.count("*").alias(n))
    both = lines(old, "o").join(lines(new, "n"), ["doc_id", "line"], "full").fillna(0, ["o", "n"])
    trimmed = both.groupBy("doc_id", F.btrim("line").alias("line")).agg(F.sum(F.greatest(F.col("o") - F.col("n"), F.lit(0))).alias("gone"), F.sum(F.greatest(F.col("n") - F.col("o"), F.lit(0))).alias("come"))
    pairs = F.least("gone", "come")
    x = trimmed.select(
        "doc_id", "line", pairs.alias("ws"), (F.col("gone") - pairs).alias("gone"), (F.col("come") - pairs).alias("come"), F.regexp_extract("line", CAPTION, 1).alias("cap"),
        F.regexp_extract("line", r"(fig|tab|eq)[0-9]+\)$", 0).alias("short"), F.col("line").rlike(LONG).alias("long_ref"), F.col("line").rlike(SHORT).alias("short_ref"),
    )
    renamed = x.where("long_ref or short_ref").groupBy("doc_id", "cap", "short").agg(F.least(F.sum(F.when(F.col("long_ref"), F.col("gone")).otherwise(0)), F.sum(F.when(F.col("short_ref"), F.col("come")).otherwise(0))).alias("ren")).where("ren > 0")
    x = x.join(renamed, ["doc_id", "cap", "short"], "left").fillna(0, ["ren"])
    x = x.withColumn("gone", F.col("gone") - F.when(F.col("long_ref"), F.col("ren")).otherwise(0)).withColumn("come", F.col("come") - F.when(F.col("short_ref"), F.col("ren")).otherwise(0))
    solid, ref = F.col("line") != "", F.col("long_ref") | F.col("short_ref")
    left = (F.col("gone") > 0) | (F.col("come") > 0)
    g = x.groupBy("doc_id").agg(
        F.sum("ws").alias("whitespace"), F.sum(F.when(F.col("long_ref"), F.col("ren")).otherwise(0)).alias("renamed"), F.sum("gone").alias("gone"), F.sum("come").alias("come"),
        F.count_if(solid & (F.col("gone") > 0)).alias("solid_gone"), F.count_if(solid & (F.col("come") > 0)).alias("solid_come"), F.count_if(solid & left & ~ref).alias("other"),
        F.collect_set(F.when((F.col("gone") > 0) & (F.col("cap") != ""), F.col("cap"))).alias("caps_gone"), F.collect_set(F.when((F.col("come") > 0) & ref, F.col("cap"))).alias("caps_come"),
        F.count_if((F.col("come") > 0) & solid & ~(F.col("short_ref") & F.col("short").startswith("tab"))).alias("not_tables"), F.count_if((F.col("gone") > 0) & F.col("line").rlike(TABLE)).alias("tables"),
    )
    rest = (
        F.when(F.col("whitespace") + F.col("renamed") + F.col("gone") + F.col("come") == 0, "identical")
        .when((F.col("solid_gone") > 0) & (F.col("solid_come") > 0) & (F.col("other") == 0) & (F.size(F.array_except("caps_gone", "caps_come")) == 0), "ref-layout")
        .when(F.lit(allow_revert) & (F.col("come") > 0) & (F.col("not_tables") == 0) & (F.col("tables") > 0), "splice-revert")
        .when(F.col("gone") + F.col("come") > 0, "unexpected").otherwise("explained")
    )
    return g.select("doc_id", "whitespace", "renamed", rest.alias("rest")).withColumn("pass", F.col("rest") != "unexpected")
