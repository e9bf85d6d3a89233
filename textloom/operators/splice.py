"""Bodies of numbered tables or equations put back where their tokens stand in a text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def splice(texts: DataFrame, groups: DataFrame, token: str = "tab") -> DataFrame:
    """(doc_id, text, spliced): each @@<token>N@@ becomes the body of group N of its document.

    texts has doc_id and text, groups has doc_id, number and body (one row for a number; of more, the least body counts).
    Where not one number fits and there are as many groups as tokens, they go by position. Otherwise a token without a
    body stays as it is. A null text stays null.
    """
    pattern = f"@@{token}([0-9]{{1,9}})@@"
    bodies = groups.where("doc_id is not null and number is not null and body is not null").groupBy("doc_id", "number").agg(F.min("body").alias("body"))
    bodies = bodies.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct(F.col("number").cast("long").alias("number"), "body"))).alias("_g"))
    bodies = bodies.select("doc_id", F.col("_g.body").alias("_b"), F.map_from_arrays("_g.number", "_g.body").alias("_m"))
    found = lambda g: F.regexp_extract_all("text", F.lit(pattern), F.lit(g))
    x = texts.select("doc_id", "text", F.transform(found(1), lambda n: n.cast("long")).alias("_n"), found(0).alias("_t")).join(bodies, "doc_id", "left")
    # Arrays are zipped: an array that is looked up in a lambda may be worked out again for each element.
    by_place = ~F.exists("_n", lambda n: F.map_contains_key("_m", n)) & (F.size("_n") == F.size("_b"))
    chosen = F.when(by_place, F.col("_b")).otherwise(F.transform("_n", lambda n: F.try_element_at("_m", n)))
    put = F.transform(F.arrays_zip(chosen.alias("b"), F.col("_t").alias("t")), lambda z: F.coalesce(z["b"], z["t"]))
    x = x.select("doc_id", "text", "_t", put.alias("_put"), F.split("text", pattern).alias("_parts"))
    whole = F.array_join(F.transform(F.arrays_zip(F.col("_parts").alias("p"), F.col("_put").alias("b")), lambda z: F.concat(z["p"], F.coalesce(z["b"], F.lit("")))), "")
    done = F.size(F.filter(F.arrays_zip(F.col("_put").alias("a"), F.col("_t").alias("b")), lambda z: z["a"] != z["b"]))
    return x.select("doc_id", F.when(F.size("_t") == 0, F.col("text")).otherwise(whole).alias("text"), F.when(F.col("text").isNull(), 0).otherwise(done).cast("long").alias("spliced"))
