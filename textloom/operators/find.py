"""Phrases found in pages, with snippets; where a phrase is nowhere, pages that hold all of its words as parts, the tightest first.

Pages are stored once with an index of their pieces, the runs between spaces: what stands inside a piece is found by the grams of the vocabulary, which is
far smaller than the pages. So a question reads the pieces that hold its rarest parts, their postings and the pages of few folders.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textloom.functions import text as T
from textloom.sources.folders import dealt, shared_folder, source_state, written

MOST, AROUND, AROUND_WORDS = 8, 160, 80
PROBES = 3  # of a question's rarest parts, which a page must hold before it is read


def tokens_of(q: Column) -> Column:
    return F.array_distinct(F.filter(F.split(q, "[^a-z0-9]+"), lambda w: F.length(w) > 1))


def grams_of(piece: Column) -> Column:
    """Distinct runs of one, two and three characters."""
    return F.array_distinct(F.concat(*[F.regexp_extract_all(piece, F.lit(f"(?s)(?=({'.' * n}))"), F.lit(1)) for n in (1, 2, 3)]))


SCHEMAS = {
    "pages": "doc_id long, page string, bucket int", "postings": "piece string, block long, ids array<long>", "vocabulary": "piece string, n long", "grams": "gram string, piece string", "counts": "gram string, n long",
}


class PageIndex:
    """`pages` in folders by a hash of the id, `postings` (piece, ids in blocks of a range of ids), `vocabulary` (piece, n) and `grams` (gram, piece)."""

    def __init__(self, spark: SparkSession, path: str, buckets: int):
        self.path, self.buckets = path, buckets
        self.pages, self.postings, self.vocabulary, self.grams, self.counts = (spark.read.schema(s).parquet(f"{path}/{n}") for n, s in SCHEMAS.items())

    @classmethod
    def build(cls, pages: DataFrame, path: str, buckets: int = 16, span: int = 4096) -> PageIndex:
        """From (doc_id, text) rows with unique ids; a page is its text with words broken at line ends joined and white space collapsed. Null texts and ids are left out."""
        spark = pages.sparkSession
        bucket = F.pmod(F.xxhash64("doc_id"), F.lit(buckets)).cast("int")
        rows = pages.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), T.page_text(F.col("text")).alias("page"), bucket.alias("bucket")).where("page is not null")
        rows.repartition("bucket").write.partitionBy("bucket").parquet(f"{path}/pages")
        pieces = spark.read.schema(SCHEMAS["pages"]).parquet(f"{path}/pages").select("doc_id", F.explode(F.array_distinct(F.split(F.lower("page"), " "))).alias("piece")).where("piece <> ''")
        blocks = pieces.groupBy("piece", F.floor(F.col("doc_id") / span).alias("block")).agg(F.collect_list("doc_id").alias("ids"))
        blocks = written(blocks, f"{path}/postings")
        vocabulary = written(blocks.groupBy("piece").agg(F.sum(F.size("ids")).alias("n")), f"{path}/vocabulary")
        grams = written(vocabulary.select(F.explode(grams_of(F.col("piece"))).alias("gram"), "piece"), f"{path}/grams")
        written(grams.groupBy("gram").agg(F.count("*").alias("n")), f"{path}/counts")
        return cls(spark, path, buckets)

    def holding(self, probes: DataFrame) -> DataFrame:
        """(probe, piece, n) of the vocabulary's pieces that hold a probe inside; probes are looked up by their rarest gram of three characters (of all where they are shorter)."""
        size = F.least(F.length("probe"), F.lit(3))
        asked = probes.select("probe").distinct().select("probe", F.explode(F.filter(grams_of(F.col("probe")), lambda g: F.length(g) == size)).alias("gram"))
        rarest = asked.join(self.counts, "gram", "left").groupBy("probe").agg(F.min_by("gram", F.struct(F.coalesce("n", F.lit(0)), "gram")).alias("gram"))
        return self.grams.join(rarest, "gram").where(F.col("piece").contains(F.col("probe"))).select("probe", "piece").join(self.vocabulary, "piece")

    def _candidates(self, asked: DataFrame, pieces: DataFrame) -> DataFrame:
        """(item_id, doc_id) of pages with all of the PROBES rarest probes of each (item_id, probe); a probe is held by any of its (probe, piece, n)."""
        total = pieces.groupBy("probe").agg(F.sum("n").alias("n"))
        ranked = asked.join(total, "probe", "left").withColumn("_r", F.row_number().over(Window.partitionBy("item_id").orderBy(F.coalesce("n", F.lit(0)), "probe")))
        best = ranked.where(F.col("_r") <= PROBES).withColumn("need", F.count("*").over(Window.partitionBy("item_id"))).select("item_id", "probe", "need")
        found = best.join(pieces.select("probe", "piece"), "probe").join(self.postings, "piece").select("item_id", "need", "probe", F.explode("ids").alias("doc_id"))
        return found.groupBy("item_id", "doc_id", "need").agg(F.count_distinct("probe").alias("have")).where("have = need").select("item_id", "doc_id")

    def read(self, pairs: DataFrame, items: DataFrame) -> DataFrame:
        """Pages of (item_id, doc_id) pairs beside their questions; pages of other folders are not read."""
        pairs = written(pairs)
        folders = [r.b for r in pairs.select(F.pmod(F.xxhash64("doc_id"), F.lit(self.buckets)).cast("int").alias("b")).distinct().collect()]  # `buckets` of them at most
        return pairs.join(items, "item_id").join(self.pages.where(F.col("bucket").isin(folders)).select("doc_id", "page", F.lower("page").alias("low")), "doc_id")

    def find(self, queries: DataFrame) -> DataFrame:
        """(item_id, mode, rank, doc_id, place, snippet) of (item_id, text) questions: at most MOST hits of each.

        mode is phrase where the whole question stands in a page (hits don't overlap, in order of page and place), else words: pages that hold
        each of its words of two characters and more somewhere, if only inside of others, by the span from the first one's first place to the last one's last end.
        Case doesn't count. A question of white space alone finds nothing.
        """
        items = queries.select("item_id", F.lower(T.page_text(F.col("text"))).alias("q")).where("length(q) > 0")
        parts = items.select("item_id", F.split("q", " ").alias("p"))
        inner = parts.where("size(p) >= 3").select("item_id", F.explode(F.array_distinct(F.expr("slice(p, 2, size(p) - 2)"))).alias("probe"))
        ends = parts.where("size(p) < 3").select("item_id", F.explode(F.array_distinct("p")).alias("probe"))
        known = self.vocabulary.join(inner.select(F.col("probe").alias("piece")).distinct(), "piece", "left_semi").select(F.col("piece").alias("probe"), "piece", "n")
        candidates = self._candidates(inner, known).unionByName(self._candidates(ends, self.holding(ends)))
        whole = self._phrases(candidates, items)
        whole = written(whole)
        rest = items.join(whole.select("item_id").distinct(), "item_id", "left_anti").withColumn("w", tokens_of(F.col("q"))).where("size(w) > 0")
        words = rest.select("item_id", F.explode("w").alias("probe"))
        loose = self.read(self._candidates(words, written(self.holding(words))), rest).where(F.forall("w", lambda t: F.contains(F.col("low"), t)))
        first = F.array_min(F.transform("w", lambda t: F.position(t, F.col("low")))) - 1
        back = F.reverse("low")
        last = F.array_max(F.transform("w", lambda t: F.length("low") - F.position(F.reverse(t), F.col("back")) + 1))
        loose = loose.withColumn("back", back).select("item_id", "doc_id", "page", first.alias("place"), last.alias("end"))
        loose = loose.withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy(F.col("end") - F.col("place"), "doc_id"))).where(F.col("rank") <= MOST)
        return whole.unionByName(loose.select("item_id", F.lit("words").alias("mode"), "rank", "doc_id", F.col("place").cast("long").alias("place"), snippet(F.col("place"), F.col("end"), AROUND_WORDS).alias("snippet")))

    def _phrases(self, candidates: DataFrame, items: DataFrame) -> DataFrame:
        hits = self.read(candidates, items).where(F.contains(F.col("low"), F.col("q"))).withColumn("parts", F.split(F.replace("low", F.col("q"), F.lit("\u0001")), "\u0001")).withColumn("size", F.length("q"))
        # Where each part ends: running lengths of the parts and of the phrases between them.
        ends = F.aggregate("parts", F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")), lambda s, p: F.struct((s["at"] + F.length(p) + F.col("size")).alias("at"), F.when(F.size(s["out"]) < MOST, F.array_append(s["out"], s["at"] + F.length(p))).otherwise(s["out"]).alias("out")))
        some = hits.select("item_id", "doc_id", "page", "size", F.explode(F.slice(ends["out"], F.lit(1), F.least(F.size("parts") - 1, F.lit(MOST)))).alias("place"))
        some = some.withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy("doc_id", "place"))).where(F.col("rank") <= MOST)
        return some.select("item_id", F.lit("phrase").alias("mode"), "rank", "doc_id", F.col("place").cast("long").alias("place"), snippet(F.col("place"), F.col("place") + F.col("size"), AROUND).alias("snippet"))


def snippet(place: Column, end: Column, around: int) -> Column:
    begin = F.greatest(place - around, F.lit(0))
    return F.btrim(F.substring(F.col("page"), begin + 1, end + around - begin))


_BUILT: dict[tuple, PageIndex] = {}


def index_of(spark: SparkSession, source: str) -> PageIndex:
    """The index of a Parquet table's texts, built once in a session for each state of its files."""
    known = source_state(spark, source)
    if known not in _BUILT:
        _BUILT[known] = PageIndex.build(dealt(spark, source).select("doc_id", "text"), shared_folder(spark))
    return _BUILT[known]
