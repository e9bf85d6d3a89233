"""Quality rules: rule statistics of whole texts and an isolation forest over them.

The statistics of all documents are worked out once and stored. Every labelled document that passes the base rules counts:
one half of them (by a hash of doc_id) grows the forest, each tree on all of that half. A tree is grown a level at a time, from
the number of rows in each node and the bounds of their statistics, which Spark aggregates; so only numbers of a fixed count
come to the driver. A node splits a statistic at random; which one is drawn by how widely it spreads in the node against its
spread among good rows, as most statistics say nothing of an anomaly. A document's score is 2^(-mean path length / expected
path length), on a grid: few random splits isolate an anomaly. The threshold is calibrated on the whole other half, which no
tree has seen: the one with the best balanced accuracy that loses at most MAX_LOSS of its good rows. Without labels of both
classes in both halves only the base rules decide.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import Scratch, arrow_schema, by_bytes, documents, free_prefix, slices
from .words import mix, windows, word_hashes

TREES = 64
DEPTH = 8  # levels of splits of a tree; a leaf of many rows adds their expected path
GRID = 1 << 16  # steps of a score
DIGITS = 9  # binary digits of the statistics from which their usual spread is taken
MAX_LOSS = 0.002
TAIL = 0.001  # good rows beyond a statistic's usual spread, on either side
FOCUS = 3  # power of a statistic's relative spread when one is drawn
WINDOW = 5
SYMBOLS = "#*$%&|<>"
_SPACES = "\t\n\x0b\x0c\r "
_UPPER = bytes(range(65, 91))
_NUMERALS = bytes(range(48, 58))
_MARKS = b"!?.,;:"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
FEATURES = ["mean_word", "symbols", "dup_lines", "repeated", "distinct", "upper", "digits", "marks", "longest_run"]


def text_counts(texts: list[str], blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The five base counts (n x 5, whole numbers) and the features of the forest (n x 9) of some documents."""
    h, limits = word_hashes(blobs, lower=False)
    n = len(texts)
    first, n_words = limits[:-1], np.diff(limits)
    owner = np.repeat(np.arange(n), n_words)
    salt = mix(np.arange(1, n + 1).astype(np.uint64))
    repeat = np.zeros(n, np.int64)
    w = windows(h, WINDOW)
    if len(w):
        inside = owner[: len(w)] == owner[WINDOW - 1 :]
        at = np.flatnonzero(inside)
        if len(at):
            _, which, times = np.unique(w[at] + salt[owner[at]], return_inverse=True, return_counts=True)
            again = at[times[which] > 1]
            cover = np.zeros(len(h) + 1, np.int64)
            np.add.at(cover, again, 1)
            np.add.at(cover, again + WINDOW, -1)
            repeat = np.bincount(owner, weights=np.cumsum(cover[:-1]) > 0, minlength=n).astype(np.int64)
    distinct = np.bincount(owner[np.unique(h + salt[owner], return_index=True)[1]], minlength=n) if len(h) else np.zeros(n)
    same = np.bincount(owner[1:], weights=(h[1:] == h[:-1]) & (owner[1:] == owner[:-1]), minlength=n) if len(h) > 1 else np.zeros(n)
    counts, features = np.zeros((n, 5), np.int64), np.zeros((n, len(FEATURES)))
    for i, (text, blob) in enumerate(zip(texts, blobs)):
        lines = [x for x in text.split("\n") if x.strip(_SPACES)]
        chars = len(text) - sum(text.count(c) for c in _SPACES)
        symbols = sum(text.count(c) for c in SYMBOLS)
        counts[i] = n_words[i], chars, symbols, len(lines) - len(set(lines)), repeat[i]
        size, words = max(1, chars), max(1, n_words[i])
        upper, digits, marks = (len(blob) - len(blob.translate(None, x)) for x in (_UPPER, _NUMERALS, _MARKS))
        features[i] = chars / words, symbols / size, counts[i, 3] / max(1, len(lines)), repeat[i] / words, distinct[i] / words**0.9, upper / size, digits / size, marks / size, same[i] / words
    return counts, features


def rough_counts(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of a statistic, its values at DIGITS binary digits, and how many rows have each."""
    part, power = np.frexp(rows)
    rough = np.ldexp(np.round(part * 2.0**DIGITS), power - DIGITS) + 0.0
    found = [np.unique(column, return_counts=True) for column in rough.T]
    return np.repeat(np.arange(len(found)), [len(v) for v, _ in found]), np.concatenate([v for v, _ in found]), np.concatenate([n for _, n in found])


def usual_spread(feature: np.ndarray, value: np.ndarray, times: np.ndarray) -> np.ndarray:
    """The spread of each statistic of counted values without a TAIL on either side."""
    out = np.full(int(feature.max()) + 1, 1e-3)
    for f in range(len(out)):
        own = feature == f
        order = np.argsort(value[own])
        v, upto = value[own][order], np.cumsum(times[own][order])
        place = np.array([TAIL, 1 - TAIL]) * (upto[-1] - 1)
        below, above = (v[np.searchsorted(upto, x, side="right")] for x in (np.floor(place), np.ceil(place)))
        low, high = below + (place % 1) * (above - below)
        out[f] = max(out[f], high - low)
    return out


class IsolationForest:
    """Random axis-parallel splits of labelled rows; `score` is near 1 for rows that few splits isolate."""

    def __init__(self, rows: np.ndarray, good: np.ndarray, **how):
        self._grow(usual_spread(*rough_counts(rows[good])), lambda forest, level: forest.bounds(rows, level), **how)

    @classmethod
    def over(cls, usual: np.ndarray, bounds, **how) -> IsolationForest:
        """A forest from bounds(forest, level), which says of each node of a level what `bounds` does."""
        own = cls.__new__(cls)
        own._grow(usual, bounds, **how)
        return own

    def _grow(self, usual: np.ndarray, bounds, trees: int = TREES, depth: int = DEPTH, focus: int = FOCUS, seed: int = 7) -> None:
        rng, size = np.random.default_rng(seed), 2 ** (depth + 1) - 1
        self.depth, self.feature = depth, np.full((trees, size), -1, np.int16)
        self.cut, self.path = np.zeros((trees, size)), np.zeros((trees, size))
        for level in range(depth + 1):
            at = slice(2**level - 1, 2 ** (level + 1) - 1)
            n, low, high = bounds(self, level)
            upto = np.cumsum((np.where(n[..., None] > 1, high - low, 0.0) / usual) ** focus, -1)
            split = (upto[..., -1] > 0) & (level < depth)
            which, where = rng.random((2, trees, 2**level))
            f = np.minimum((upto <= which[..., None] * upto[..., -1:]).sum(-1), len(usual) - 1)
            low, high = (np.where(split, np.take_along_axis(x, f[..., None], -1)[..., 0], 0.0) for x in (low, high))
            self.path[:, at] = np.where(split, 0.0, level + self.expected(n))
            self.feature[:, at], self.cut[:, at] = np.where(split, f, -1), low + where * (high - low)
            if not level:
                self.norm = max(1e-9, float(self.expected(n[0, 0])))

    @staticmethod
    def expected(n):
        n = np.asarray(n, float)
        return np.where(n < 2, 0.0, np.where(n == 2, 1.0, 2 * (np.log(np.maximum(n - 1, 1)) + 0.5772156649) - 2 * (n - 1) / np.maximum(n, 1)))

    def nodes(self, rows: np.ndarray, levels: int) -> np.ndarray:
        """Where each row is in each tree after some levels of splits."""
        trees, node = np.arange(len(self.feature))[None, :], np.zeros((len(rows), len(self.feature)), np.int64)
        for _ in range(levels):
            f = self.feature[trees, node]
            value = np.take_along_axis(rows, np.maximum(f, 0).astype(np.int64), 1)
            node = np.where(f < 0, node, 2 * node + 1 + (value > self.cut[trees, node]))
        return node

    def bounds(self, rows: np.ndarray, level: int, some: int = 1024) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each tree's nodes of a level: how many rows are there, and the least and greatest of each statistic (infinite without rows)."""
        shape, first = (len(self.feature), 2**level), 2**level - 1
        n, low, high = np.zeros(shape, np.int64), np.full((*shape, rows.shape[1]), np.inf), np.full((*shape, rows.shape[1]), -np.inf)
        number, least, most = n.ravel(), low.reshape(-1, rows.shape[1]), high.reshape(-1, rows.shape[1])
        for a in range(0, len(rows), some):
            part = rows[a : a + some]
            node = self.nodes(part, level)
            row, tree = np.nonzero(node >= first)
            cell = tree * shape[1] + node[row, tree] - first
            order = np.argsort(cell, kind="stable")
            if not len(order):
                continue
            row, cell = row[order], cell[order]
            starts = np.flatnonzero(np.diff(cell, prepend=-1))
            cells = cell[starts]
            number[cells] += np.diff(starts, append=len(cell))
            for f in range(rows.shape[1]):
                value = part[row, f]
                least[cells, f] = np.minimum(least[cells, f], np.minimum.reduceat(value, starts))
                most[cells, f] = np.maximum(most[cells, f], np.maximum.reduceat(value, starts))
        return n, low, high

    def score(self, rows: np.ndarray) -> np.ndarray:
        trees = np.arange(len(self.feature))[None, :]
        return np.round(GRID * 2.0 ** (-self.path[trees, self.nodes(rows, self.depth)].mean(1) / self.norm)) / GRID


def base_failed(counts: np.ndarray) -> np.ndarray:
    return (counts[:, 0] < 10) | (100 * counts[:, 4] > 20 * counts[:, 0])


def measure(docs: DataFrame) -> DataFrame:
    """doc_id, the five counts and the features of every row of (doc_id, text); a null text counts as an empty one."""
    out = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType)] + [T.StructField(c, T.LongType()) for c in COUNTS] + [T.StructField(f, T.DoubleType()) for f in FEATURES])

    def run(batches):
        schema = arrow_schema(out)
        for batch in slices(batches):
            texts = [x or "" for x in batch.column(1).to_pylist()]
            blobs = [x.encode() for x in texts]
            for a, b in by_bytes(blobs):
                counts, features = text_counts(texts[a:b], blobs[a:b])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), *map(pa.array, counts.T), *map(pa.array, features.T)], schema=schema)

    return docs.select("doc_id", "text").mapInArrow(run, out)


def _numbers(batch: pa.RecordBatch, names: list[str]) -> np.ndarray:
    return np.column_stack([batch.column(batch.schema.names.index(c)).to_numpy(zero_copy_only=False) for c in names])


def labelled_rows(measured: DataFrame, labels: DataFrame) -> DataFrame:
    """(quality, half, features) of every labelled document that passes the base rules; half is 0 or 1 by a hash of doc_id.

    A document with both labels is bad; of rows that repeat a document the least features that pass are read.
    """
    once = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"))
    passed = measured.where((F.col("n_words") >= 10) & (100 * F.col("n_repeat_words") <= 20 * F.col("n_words")))
    least = passed.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min(F.struct(*FEATURES)).alias("least"))
    return least.join(once, "doc_id").select("quality", (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2).cast("int").alias("half"), "least.*")


def calibrate(score: np.ndarray, good: np.ndarray, bad: np.ndarray, max_loss: float = MAX_LOSS) -> float:
    """The least threshold (scores above it are anomalous) with the best balanced accuracy under the allowed loss, of scores and how many good and bad rows have each."""
    order = np.argsort(score)
    score, good, bad = score[order], good[order], bad[order]
    lost, caught = (1 - np.cumsum(x) / x.sum() for x in (good, bad))
    gain = np.where(lost <= max_loss, caught - lost, -np.inf)
    return float(score[np.argmax(gain)])


def train(rows: np.ndarray, quality: np.ndarray, half: np.ndarray):
    """(forest, threshold) from features of rows that pass the base rules: trees grow on one half, the threshold is set on the other, which no tree has seen."""
    good, grown = quality == 1, half == 0
    if not all((a & b).any() for a in (good, ~good) for b in (grown, ~grown)):
        return None
    forest = IsolationForest(rows[grown], good[grown])
    score, place = np.unique(forest.score(rows[~grown]), return_inverse=True)
    return forest, calibrate(score, *(np.bincount(place[x[~grown]], minlength=len(score)) for x in (good, ~good)))


def fit_measured(measured: DataFrame, labels: DataFrame):
    """What `train` gives of all labelled rows, by Spark: each level's bounds and each score's counts are aggregated, and come to the driver as numbers of a fixed count."""
    spark = measured.sparkSession
    scratch = Scratch(spark, "quality-labels")
    rows = scratch.table(labelled_rows(measured, labels), "rows")
    if rows.select("quality", "half").distinct().count() < 4:
        scratch.drop("rows")
        return None
    grown = rows.where("half = 0").select(*FEATURES)
    k = len(FEATURES)

    def rough(batches):
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rough_counts(_numbers(batch, FEATURES)), [pa.int32(), pa.float64(), pa.int64()])], names=["feature", "value", "times"])

    some = rows.where("half = 0 and quality = 1").select(*FEATURES).mapInArrow(rough, "feature int, value double, times long")
    usual = usual_spread(*(c.to_numpy() for c in some.groupBy("feature", "value").agg(F.sum("times").alias("times")).toArrow().columns))

    def bounds(forest, level):
        shared, wide = spark.sparkContext.broadcast(forest), 2**level
        names = [f"low{i}" for i in range(k)] + [f"high{i}" for i in range(k)]

        def run(batches):
            forest, total = shared.value, None
            for batch in batches:
                if batch.num_rows:
                    n, low, high = forest.bounds(_numbers(batch, FEATURES), level)
                    total = (n, low, high) if total is None else (total[0] + n, np.minimum(total[1], low), np.maximum(total[2], high))
            if total is not None:
                n, low, high = total[0].ravel(), total[1].reshape(-1, k), total[2].reshape(-1, k)
                at = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(n[at]), *map(pa.array, low[at].T), *map(pa.array, high[at].T)], names=["cell", "n", *names])

        cells = grown.mapInArrow(run, ", ".join(["cell int", "n long", *(f"{c} double" for c in names)]))
        got = cells.groupBy("cell").agg(F.sum("n").alias("n"), *(F.min(c).alias(c) for c in names[:k]), *(F.max(c).alias(c) for c in names[k:])).toArrow()
        at, all_cells = got.column("cell").to_numpy(), TREES * wide
        n, low, high = np.zeros(all_cells, np.int64), np.full((all_cells, k), np.inf), np.full((all_cells, k), -np.inf)
        n[at] = got.column("n").to_numpy()
        low[at], high[at] = (np.column_stack([got.column(c).to_numpy() for c in part]) for part in (names[:k], names[k:]))
        shared.unpersist()
        return n.reshape(TREES, wide), low.reshape(TREES, wide, k), high.reshape(TREES, wide, k)

    forest = IsolationForest.over(usual, bounds)
    shared = spark.sparkContext.broadcast(forest)

    def scored(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(shared.value.score(_numbers(batch, FEATURES)), pa.float64()), batch.column(0)], names=["score", "quality"])

    seen = rows.where("half = 1").select("quality", *FEATURES).mapInArrow(scored, "score double, quality int")
    seen = seen.groupBy("score").agg(F.count_if(F.col("quality") == 1).alias("good"), F.count_if(F.col("quality") == 0).alias("bad")).toArrow()  # as many rows as the grid has steps, at most
    scratch.drop("rows")
    return forest, calibrate(*(c.to_numpy() for c in seen.columns))


def fit(docs: DataFrame, labels: DataFrame):
    """The model of all labelled documents, or None (then only the base rules decide) if a half of them lacks a class."""
    scratch = Scratch(docs.sparkSession, "quality-documents")
    model = fit_measured(scratch.table(measure(docs), "measured"), labels)
    scratch.drop("measured")
    return model


def verdicts(counts: np.ndarray, features: np.ndarray, model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """anomaly, base_failed and kept of measured rows."""
    failed = base_failed(counts)
    anomaly = model[0].score(features) if model else np.zeros(len(counts))
    return anomaly, failed, ~failed & ~(anomaly > model[1] if model else failed)


def judge_measured(measured: DataFrame, model) -> DataFrame:
    """doc_id, the five counts, anomaly, base_failed and kept of what `measure` gave."""
    out = T.StructType([f for f in measured.schema.fields if f.name not in FEATURES] + [T.StructField("anomaly", T.DoubleType()), T.StructField("base_failed", T.BooleanType()), T.StructField("kept", T.BooleanType())])
    shared = measured.sparkSession.sparkContext.broadcast(model)  # a forest of fixed size

    def run(batches):
        schema = arrow_schema(out)
        for batch in slices(batches, 2048):
            got = verdicts(_numbers(batch, COUNTS), _numbers(batch, FEATURES), shared.value)
            yield pa.RecordBatch.from_arrays([*batch.columns[: 1 + len(COUNTS)], *map(pa.array, got)], schema=schema)

    return measured.mapInArrow(run, out)


def judge(docs: DataFrame, model, text: str = "text", prefix: str = "") -> DataFrame:
    """docs with the five counts, anomaly (0 to 1), base_failed and kept. A null text counts as one without words, which fails the base.

    Repeated rows and rows without a doc_id are judged each. Columns of docs with these names are replaced; `prefix` goes before them. An empty frame gives an empty result.
    """
    added = T.StructType(
        [T.StructField(prefix + c, T.LongType()) for c in COUNTS]
        + [T.StructField(f"{prefix}anomaly", T.DoubleType()), T.StructField(f"{prefix}base_failed", T.BooleanType()), T.StructField(f"{prefix}kept", T.BooleanType())]
    )
    held = [f for f in docs.schema.fields if f.name not in added.fieldNames() or f.name == text]
    out = T.StructType(held + [f for f in added.fields if f.name != text])
    docs = docs.select(*[F.col(f"`{f.name}`") for f in held])
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a forest of fixed size

    def run(batches):
        schema = arrow_schema(out)
        model = shared.value
        for batch in slices(batches):
            texts = [x or "" for x in batch.column(batch.schema.names.index(text)).to_pylist()]
            blobs = [x.encode() for x in texts]
            for a, b in by_bytes(blobs):
                counts, features = text_counts(texts[a:b], blobs[a:b])
                own = batch.slice(a, b - a)
                columns = [*own.columns, *map(pa.array, counts.T), *map(pa.array, verdicts(counts, features, model))]
                yield pa.RecordBatch.from_arrays([c.cast(t) for c, t in zip(columns, schema.types)], schema=schema)

    return docs.mapInArrow(run, out)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op8: the base counts of every whole text, base_failed and the forest's verdict; texts are read once."""
    measured = Scratch(spark, "quality").table(measure(documents(spark, sf_dir)), "measured")
    model = fit_measured(measured, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return judge_measured(measured, model).select("doc_id", *COUNTS, "base_failed", "kept", "anomaly")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep, with their own columns; each of repeated rows is judged by its own text."""
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    prefix = free_prefix(docs)
    return judge(docs, model, prefix=prefix).where(F.col(f"{prefix}kept")).select(*docs.columns)
