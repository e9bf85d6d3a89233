"""License scan by diagonal voting.

Every rolling k-gram of a document's words is joined by hash to the places of
the k-grams in the templates; a hit votes for the diagonal (document place
less template place), and votes are counted per diagonal. A base phrase holds where one diagonal has all its places. For notices,
neighbouring diagonals are merged (a few words were added, left out or changed): a span is
a window of diagonals, and windows overlap by half, so an occurrence that drifts no further than half of one lies whole in some
window. A window is as wide as the notice is long at most, so notices that follow each other don't run together. A span is verified by its words in order: of
each template place the hit nearest the span's strongest diagonal counts if it stands after those of the places before it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import Scratch, documents, join_same

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # whatever stands between words
K = 3
DRIFT = 3  # words that an occurrence may have more or fewer than its template
COVER = 0.7  # share of a template's k-grams that a span needs

#: The base phrases and their labels.
BASE = [
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
]
#: Notices that add labels of the method's own; they may be met with small changes.
NOTICES = [
    ("this work is licensed under the gnu general public license version 3", "gpl-3"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", "gpl"),
    ("gnu lesser general public license", "lgpl"),
    ("gnu affero general public license", "agpl"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "mit-grant"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "bsd"),
    ("licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license", "apache-2-notice"),
    ("this work is licensed under a creative commons attribution 4 0 international license", "cc-by-4"),
    ("mozilla public license version 2 0", "mpl-2"),
    ("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl-2"),
    ("all rights reserved", "all-rights-reserved"),
    ("this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license", "lgpl"),
    ("you should have received a copy of the gnu affero general public license along with this program", "agpl"),
    ("the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability", "mit-grant"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "isc"),
    ("this software is provided by the copyright holders and contributors as is and any express or implied warranties", "bsd"),
    ("neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products", "bsd-3"),
    ("unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis", "apache-2-notice"),
    ("this program and the accompanying materials are made available under the terms of the eclipse public license", "epl"),
    ("this software is provided as is without any express or implied warranty in no event will the authors be held liable", "zlib"),
    ("boost software license version 1 0", "bsl-1"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
    ("creative commons attribution sharealike", "cc-by-sa"),
    ("creative commons attribution noncommercial", "cc-by-nc"),
    ("creative commons attribution noderivatives", "cc-by-nd"),
    ("to the extent possible under law the author has waived all copyright and related or neighboring rights to this work", "cc0"),
    ("this font software is licensed under the sil open font license version 1 1", "ofl-1"),
    ("do what the fuck you want to public license", "wtfpl"),
]


def template_grams(spark: SparkSession, base=None, notices=None, k: int = K, drift: int = DRIFT) -> DataFrame:
    """(gram, g0..gk-1, template, place, grams, half, label, base): a row a k-gram of the templates, whose number is fixed by them. half: half the width of a notice's windows."""
    rows = []
    for t, (phrase, label, is_base) in enumerate([(p, x, True) for p, x in (BASE if base is None else base)] + [(p, x, False) for p, x in (NOTICES if notices is None else notices)]):
        words = phrase.split()
        if len(words) < k:
            raise ValueError(f"a template has fewer than {k} words: {phrase}")
        n = len(words) - k + 1
        half = max(1, 2 * min(drift, (len(words) - 1) // 2))
        rows += [(*words[i : i + k], t, i, n, half, label, is_base) for i in range(n)]
    schema = ", ".join(f"g{j} string" for j in range(k)) + ", template int, place int, grams int, half int, label string, base boolean"
    return spark.createDataFrame(rows, schema).withColumn("gram", F.xxhash64(*[f"g{j}" for j in range(k)]))


def words_of(text):
    """The words of a text with A-Z lower-cased. lower() agrees with that on ASCII but for two letters that it turns into ASCII; texts with these take the slower way."""
    body = F.coalesce(text, F.lit(""))
    odd = body.contains("\u212a") | body.contains("\u0130")
    return F.array_remove(F.split(F.when(odd, F.translate(body, UPPER, LOWER)).otherwise(F.lower(body)), BREAK), "")


KEY = ["doc_id", "digest"]  # of a row: its doc_id, null or not, and a hash of its text


def scan(docs: DataFrame, text: str = "text", base=None, notices=None, k: int = K, drift: int = DRIFT, cover: float = COVER) -> tuple[DataFrame, DataFrame]:
    """Documents and verified spans.

    Documents: doc_id, digest, n_words and copies, a row for each different (doc_id, text); copies counts the rows that repeat it. Spans: doc_id, digest, template, label,
    base, first_word, last_word (of the start places), hits and score; a base
    template's span is one exact place. A text that is null, empty or shorter than k words has no span. A null doc_id is a
    value like others. An empty frame gives empty results.
    """
    split = docs.select("doc_id", F.xxhash64(F.coalesce(text, F.lit(""))).alias("digest"), words_of(F.col(text)).alias("w"))
    shifted = F.arrays_zip(*[F.slice("w", j + 1, F.greatest(F.size("w") - (k - 1), F.lit(0))).alias(f"w{j}") for j in range(k)])
    head = F.array(F.struct(*[F.lit(None).cast("string").alias(f"w{j}") for j in range(k)]))  # one row more of each document, for its counts
    grams = split.select(*KEY, F.size("w").alias("n_words"), F.posexplode(F.concat(head, shifted)).alias("at", "g"))
    grams = grams.select(*KEY, "n_words", (F.col("at") - 1).alias("at"), *[F.col(f"g.w{j}").alias(f"w{j}") for j in range(k)]).withColumn("gram", F.xxhash64(*[f"w{j}" for j in range(k)]))
    templates = template_grams(docs.sparkSession, base, notices, k, drift)
    wanted = [r.gram for r in templates.select("gram").distinct().collect()]  # some hundred numbers, fixed by the templates
    same = F.lit(True)
    for j in range(k):
        same = same & (F.col(f"w{j}") == F.col(f"g{j}"))  # equal hashes of different words don't count
    votes = (
        grams.where((F.col("at") < 0) | F.col("gram").isin(wanted))
        .join(F.broadcast(templates), "gram", "left")  # fixed size
        .where((F.col("at") < 0) | same)
        .groupBy(*KEY, "template", "label", "base", "grams", "half", (F.col("at") - F.col("place")).alias("diagonal"))
        .agg(F.max("n_words").cast("long").alias("n_words"), F.count("*").alias("copies"), F.array_sort(F.collect_set("place")).alias("places"))
    )
    votes = Scratch(docs.sparkSession, "licenses").table(votes, "votes")
    every = votes.where("template is null").select(*KEY, "n_words", "copies")
    return every, _spans(votes.where("template is not null"), cover)


def _spans(votes: DataFrame, cover: float) -> DataFrame:
    named = [*KEY, "template", "label", "base"]
    exact = votes.where(F.col("base") & (F.size("places") == F.col("grams"))).select(*named, F.col("diagonal").alias("first_word"), F.col("diagonal").alias("last_word"), F.size("places").alias("hits"), F.lit(1.0).alias("score"))
    window = F.floor(F.col("diagonal") / F.col("half"))
    spans = (
        votes.where("not base")
        .withColumn("window", F.explode(F.array(window - 1, window)))
        .groupBy(*named, "grams", "window")
        .agg(F.max_by("diagonal", F.struct(F.size("places"), -F.col("diagonal"))).alias("main"), F.collect_list(F.struct("diagonal", "places")).alias("lines"))
        .where(F.size(F.array_distinct(F.flatten("lines.places"))) >= F.col("grams") * F.lit(cover))
    )
    # At most a window's diagonals by the template's places: a small array.
    tries = F.flatten(F.transform("lines", lambda x: F.transform(x["places"], lambda p: F.struct(p.alias("place"), F.abs(x["diagonal"] - F.col("main")).alias("off"), (x["diagonal"] + p).alias("at")))))
    start = F.struct(F.lit(0).alias("hits"), F.lit(-1).alias("place"), F.lit(-1).alias("at"), F.lit(-1).alias("first"))
    step = lambda s, x: F.when((x["place"] > s["place"]) & (x["at"] > s["at"]), F.struct((s["hits"] + 1).alias("hits"), x["place"].alias("place"), x["at"].alias("at"), F.when(s["hits"] == 0, x["at"]).otherwise(s["first"]).alias("first"))).otherwise(s)
    near = spans.select(*named, "grams", F.aggregate(F.array_sort(tries), start, step).alias("s")).where(F.col("s.hits") >= F.col("grams") * F.lit(cover))
    return exact.unionByName(near.select(*named, F.col("s.first").alias("first_word"), F.col("s.at").alias("last_word"), F.col("s.hits").alias("hits"), (F.col("s.hits") / F.col("grams")).alias("score")))


def report(docs: DataFrame, base=None, notices=None) -> DataFrame:
    """Per document its words, base places and labels, and the labels that the method adds.

    score is the best cover of any template in the document, 0 if none holds. Every row of documents has a row, repeated ones and those without a doc_id too.
    """
    every, spans = scan(docs, base=base, notices=notices)
    found = spans.groupBy(*KEY).agg(
        F.count_if("base").alias("n_base"),
        F.min(F.when(F.col("base"), F.col("first_word"))).cast("long").alias("first_word"),
        F.max(F.when(F.col("base"), F.col("last_word"))).cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("base"), F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"),
        F.max("score").alias("score"),
    )
    rows = join_same(every, found, KEY, "left").withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return rows.select(
        "doc_id",
        "n_words",
        F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).cast("double").alias("score"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op2: the report of every document."""
    return report(documents(spark, sf_dir).select("doc_id", "text"))
