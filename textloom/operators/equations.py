"""Equations read from pictures put back where their tokens stand, once all of a text are read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def equation_splice(texts: DataFrame, read: DataFrame) -> DataFrame:
    """(doc_id, text, spliced, kept): each @@eqN@@ becomes $tex$, or $$tex$$ where it stands alone on its line.

    read has doc_id, number, state (ok or failed) and tex. A text is left as it is until each of its tokens has a state; then tokens of a failed
    picture stay, and the others are replaced. Of several rows for a number the least tex counts, and one that failed makes it failed.
    """
    states = read.where("number is not null").groupBy("doc_id", F.col("number").cast("long").alias("number")).agg(F.bool_or(F.col("state") != "ok").alias("failed"), F.min("tex").alias("tex"))
    states = states.groupBy("doc_id").agg(F.map_from_entries(F.collect_list(F.struct("number", F.struct("failed", "tex")))).alias("_m"))
    pattern = "@@eq([0-9]{1,9})@@"
    parts = F.split("text", pattern)
    numbers = F.transform(F.regexp_extract_all("text", F.lit(pattern), F.lit(1)), lambda n: n.cast("long"))
    tokens = F.regexp_extract_all("text", F.lit(pattern), F.lit(0))
    x = texts.join(states, "doc_id", "left").select("doc_id", "text", parts.alias("_p"), F.slice(parts, 2, 1 << 30).alias("_after"), numbers.alias("_n"), tokens.alias("_t"), F.transform(numbers, lambda n: F.try_element_at("_m", n)).alias("_s"))
    ready = F.coalesce((F.size("_n") > 0) & ~F.exists("_s", lambda s: s.isNull()), F.lit(False))
    zipped = F.arrays_zip(F.col("_p").alias("p"), F.col("_after").alias("a"), F.col("_t").alias("t"), F.col("_s").alias("s"))
    begins = lambda z, i: z["p"].rlike(r"\n[ \t]*$") | ((i == 0) & z["p"].rlike(r"^[ \t]*$"))
    ends = lambda z, i: z["a"].rlike(r"^[ \t]*\n") | ((i == F.size("_t") - 1) & z["a"].rlike(r"^[ \t]*$"))
    mark = lambda z, i: F.when(begins(z, i) & ends(z, i), "$$").otherwise("$")
    put = lambda z, i: F.when(z["t"].isNull(), "").when(z["s"]["failed"], z["t"]).otherwise(F.concat(mark(z, i), z["s"]["tex"], mark(z, i)))
    whole = F.array_join(F.transform(zipped, lambda z, i: F.concat(F.coalesce(z["p"], F.lit("")), put(z, i))), "")
    failed = F.size(F.filter("_s", lambda s: s["failed"]))
    return x.select("doc_id", F.when(ready, whole).otherwise(F.col("text")).alias("text"), F.when(ready, F.size("_n") - failed).otherwise(0).cast("long").alias("spliced"), F.when(ready, failed).otherwise(0).cast("long").alias("kept"))
