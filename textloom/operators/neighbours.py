"""Near neighbours by cosine through an inverted file: vectors lie in cells around centroids, a question reads the cells nearest to it and ranks what is there exactly.

Centroids and the number of cells to read are fitted on a bounded sample (`SAMPLE` vectors, `TRIALS` questions of it, whose true neighbours among all rows are found by a scan);
every row is in the index. Vectors that differ little from chance need most cells; what was fitted is in `fitted`.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textloom.sources.folders import written

SAMPLE, TRIALS, TARGET = 20_000, 200, 0.95
DEPTHS = (1, 4, 16, 64)  # times k: neighbours for which the number of cells is fitted; beyond the last all cells are read
MOST_CELLS = 1024
PIECE, BLOCK = 4096, 256  # rows of a cell and questions that meet in one group


def matrix(column) -> np.ndarray:
    """Rows of length 1 of an Arrow column of lists; a null list and one of zeros are rows of zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    rows = [np.asarray(v if v is not None else [], np.float64) for v in column.to_numpy(zero_copy_only=False)]
    width = max(map(len, rows), default=0)
    out = np.zeros((len(rows), width))
    for i, r in enumerate(rows):
        if len(r):
            norm = float(np.sqrt(r @ r))
            out[i, : len(r)] = r / norm if norm else 0.0
    return out


def dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products of the rows of both; columns that one side lacks are zeros."""
    width = min(a.shape[1], b.shape[1])
    return a[:, :width] @ b[:, :width].T


def centroids_of(x: np.ndarray, cells: int, rounds: int = 12, seed: int = 7) -> np.ndarray:
    """Spherical k-means of a sample; a centroid that loses all its rows takes a row of the sample."""
    rng = np.random.default_rng(seed)
    c = x[rng.permutation(len(x))[:cells]].copy()
    for _ in range(rounds):
        cell = (x @ c.T).argmax(1)
        total = np.zeros_like(c)
        np.add.at(total, cell, x)
        norm = np.sqrt((total**2).sum(1))
        total[norm == 0] = x[rng.integers(0, len(x), int((norm == 0).sum()))]
        c = total / np.maximum(np.sqrt((total**2).sum(1)), 1e-12)[:, None]
    return c


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best of each row of scores, the lesser id first among equals (to six places)."""
    order = np.lexsort((np.broadcast_to(ids, scores.shape), -np.round(scores, 6)), axis=1)
    return order[:, :k]


class VectorIndex:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.fitted = json.loads(spark.read.text(f"{path}/fitted").first()[0])
        self.centroids = np.array(self.fitted["centroids"])
        self.probes = {int(d): p for d, p in self.fitted["probes"].items()}  # by depth
        self.rows = spark.read.schema(self.fitted["schema"]).parquet(f"{path}/rows")

    @classmethod
    def build(cls, vectors: DataFrame, path: str, key: str, vector: str, facets: list[str] = (), k: int = 10, target: float = TARGET, cells: int | None = None) -> VectorIndex:
        """Writes the index of (key, vector, facets) rows with unique integer keys. Rows without a key are left out; null vectors and vectors of zeros have cosine 0 to all and lie in a cell that every question reads."""
        spark = vectors.sparkSession
        x = vectors.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<float>").alias("v"), *facets)
        n = x.count()
        sample = x.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("id", "v").toArrow()
        known = matrix(sample.column("v"))
        solid = known[(known**2).sum(1) > 0] if known.size else known
        cells = min(cells or max(1, int(n**0.5)), MOST_CELLS, max(1, len(solid)))
        centroids = centroids_of(solid, cells) if len(solid) else np.zeros((1, 1))
        schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in x.schema), "cell int"])

        def assign(batches):
            for b in batches:
                m = matrix(b.column("v"))
                cell = np.where((m**2).sum(1) > 0, dots(m, centroids).argmax(1), -1)
                yield b.append_column("cell", pa.array(cell.astype(np.int32)))

        dealt = x.mapInArrow(assign, schema).repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), "cell", "id")
        dealt.sortWithinPartitions("cell", "id").write.partitionBy("cell").parquet(f"{path}/rows")
        rows = spark.read.schema(schema).parquet(f"{path}/rows")
        trials = sample.slice(0, TRIALS)
        need, place = cls._ranks(rows, trials, centroids, k * DEPTHS[-1])
        # For each depth the least number of cells that holds the wanted share of so many true neighbours.
        least = lambda held: next((p for p in range(1, cells + 1) if held.size == 0 or (held < p).mean() >= target), cells)
        fitted = {"centroids": centroids.tolist(), "probes": {k * d: least(need[place <= k * d]) for d in DEPTHS}, "cells": cells, "rows": n, "schema": schema}
        spark.createDataFrame([(json.dumps(fitted),)], "value string").coalesce(1).write.text(f"{path}/fitted")
        return cls(spark, path)

    @staticmethod
    def _ranks(rows: DataFrame, trials: pa.Table, centroids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """For each of the k true neighbours of each trial question: how many cells are nearer to the question than the neighbour's, and the neighbour's place from 1."""
        q = matrix(trials.column("v"))
        if not q.size:
            return np.zeros(0), np.zeros(0)

        def best(batches):
            for b in batches:
                m, ids = matrix(b.column("v")), b.column("id").to_numpy()
                if len(ids):
                    s = dots(q, m)
                    at = _best(s, ids, k)
                    yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(len(q)), at.shape[1])), pa.array(ids[at.ravel()]), pa.array(np.take_along_axis(s, at, 1).ravel()), pa.array(b.column("cell").to_numpy()[at.ravel()].astype(np.int32))], names=["q", "id", "s", "cell"])

        found = rows.select("id", "v", "cell").mapInArrow(best, "q long, id long, s double, cell int")
        top = found.withColumn("_r", F.row_number().over(Window.partitionBy("q").orderBy(F.desc(F.round("s", 6)), "id"))).where(F.col("_r") <= k).select("q", "cell", "_r").toPandas()  # k a trial
        rank = np.argsort(np.argsort(-dots(q, centroids), axis=1, kind="stable"), axis=1)
        cell = top["cell"].to_numpy()
        return np.where(cell < 0, -1, rank[top["q"].to_numpy(), np.maximum(cell, 0)]), top["_r"].to_numpy()

    def search(self, questions: DataFrame, key: str, vector: str, k: int = 10, keep: Column | None = None, probes: int | None = None) -> DataFrame:
        """(question, id, rank, score) of the k nearest rows of each (key, vector) question; `keep` restricts the rows before they are ranked. The k nearest of a
        tenth of all rows are about the 10 k nearest of all, so a restricted question reads as many cells as were fitted for that depth.

        Questions and rows meet by cell, in groups of at most about BLOCK questions and PIECE rows, so neither a large cell nor many questions for one fall to one task; each group
        hands on the k best of each of its questions.
        """
        chosen = self.rows if keep is None else self.rows.where(keep)
        depth = k if keep is None else k * self.fitted["rows"] / max(chosen.count(), 1)  # reads the facets only
        fitted = next((self.probes[d] for d in sorted(self.probes) if d >= depth), self.fitted["cells"])
        centroids, most = self.centroids, min(probes or fitted, len(self.centroids))
        rows = chosen.select("id", "v", "cell")
        asked = questions.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("question"), F.col(vector).cast("array<float>").alias("v"))

        def near(batches):
            for b in batches:
                m = matrix(b.column("v"))
                s = dots(m, centroids)
                cell = np.hstack([np.full((len(s), 1), -1), np.argsort(-s, axis=1, kind="stable")[:, :most]])
                at = np.repeat(np.arange(b.num_rows), cell.shape[1])
                yield pa.RecordBatch.from_arrays([b.column("question").take(at), b.column("v").take(at), pa.array(cell.ravel().astype(np.int32))], names=["question", "v", "cell"])

        probed = written(asked.mapInArrow(near, "question long, v array<float>, cell int"))
        sizes = rows.groupBy("cell").agg(F.ceil(F.count("*") / PIECE).cast("int").alias("pieces")).join(probed.groupBy("cell").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")), "cell")
        sizes = F.broadcast(sizes)  # a row a cell, at most MOST_CELLS + 1
        left = rows.join(sizes, "cell").select("cell", F.pmod(F.xxhash64("id"), F.col("pieces")).cast("int").alias("piece"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "id", "v")
        right = probed.join(sizes, "cell").select("cell", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("piece"), F.pmod(F.xxhash64("question"), F.col("blocks")).cast("int").alias("block"), "question", "v")

        def ranked(rows: pa.Table, asked: pa.Table) -> pa.Table:
            m, q, ids = matrix(rows.column("v")), matrix(asked.column("v")), rows.column("id").to_numpy()
            s = dots(q, m)
            at = _best(s, ids, k)
            return pa.table({"question": pa.array(np.repeat(asked.column("question").to_numpy(), at.shape[1]), pa.int64()), "id": pa.array(ids[at.ravel()], pa.int64()), "score": pa.array(np.take_along_axis(s, at, 1).ravel(), pa.float64())})

        keys = ["cell", "piece", "block"]
        found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(ranked, "question long, id long, score double").withColumn("score", F.round("score", 6))
        best = found.withColumn("rank", F.row_number().over(Window.partitionBy("question").orderBy(F.desc("score"), "id"))).where(F.col("rank") <= k)
        return best.select("question", "id", "rank", "score")
