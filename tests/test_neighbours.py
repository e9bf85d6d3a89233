"""The inverted file against brute force: recall, exactness with all cells, facets, odd vectors."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from textloom.operators import neighbours as N


def brute(ids, x, qids, q, k, mask=None):
    unit = lambda m: m / np.maximum(np.sqrt((m**2).sum(1)), 1e-12)[:, None]
    s = np.round(unit(q) @ unit(x).T, 6)
    if mask is not None:
        s[:, ~mask] = -9
    return {int(i): [int(ids[j]) for j in np.lexsort((ids, -row))[:k] if row[j] > -9] for i, row in zip(qids, s)}


def got_of(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.question, r.rank)):
        out.setdefault(r.question, []).append(r.id)
    return out


def recall(got, want):
    return sum(len(set(got.get(i, [])) & set(w)) for i, w in want.items()) / sum(map(len, want.values()))


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_recall_on_the_given_vectors(spark, tmp_path, sf):
    """Ids divisible by 50 against all rows: 0.9 and more of the true ten nearest."""
    df = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet")
    held = N.VectorIndex.build(df, str(tmp_path / "i"), "vec_id", "embedding", ["label"])
    rows = df.select("vec_id", "embedding", "label").toPandas()
    ids, x, label = rows.vec_id.to_numpy(), np.stack(rows.embedding.to_numpy()).astype(np.float32).astype(float), rows.label.to_numpy()
    ask, mine = df.where("vec_id % 50 = 0"), ids % 50 == 0
    assert recall(got_of(held.search(ask, "vec_id", "embedding")), brute(ids, x, ids[mine], x[mine], 10)) >= 0.9
    assert recall(got_of(held.search(ask, "vec_id", "embedding", keep=F.col("label") == 3)), brute(ids, x, ids[mine], x[mine], 10, label == 3)) >= 0.9
    assert held.rows.count() == len(rows)


def test_clusters_need_few_cells(spark, tmp_path, monkeypatch):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(20, 16)) * 5
    x = (centres[np.arange(3000) % 20] + rng.normal(size=(3000, 16)) * 0.3).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, v array<float>").repartition(4)
    held = N.VectorIndex.build(df, str(tmp_path / "i"), "id", "v")
    assert held.probes[10] * 3 <= held.fitted["cells"]
    monkeypatch.setattr(N, "PIECE", 16)  # many pieces and blocks of a cell
    monkeypatch.setattr(N, "BLOCK", 4)
    ask = df.where("id % 50 = 0")
    want = brute(np.arange(3000), x.astype(float), np.arange(0, 3000, 50), x[::50].astype(float), 10)
    assert recall(got_of(held.search(ask, "id", "v")), want) >= 0.9
    assert got_of(held.search(ask, "id", "v", probes=10_000)) == want  # all cells: exact


def test_odd_vectors(spark, tmp_path):
    rows = [(1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, None), (4, [-1.0, 0.0]), (None, [1.0, 0.0]), (5, [2.0, 0.0])]
    df = spark.createDataFrame(rows, "id long, v array<float>")
    held = N.VectorIndex.build(df, str(tmp_path / "i"), "id", "v")
    got = got_of(held.search(df, "id", "v", 5, probes=99))
    assert got[1] == [1, 5, 2, 3, 4] and got[2] == [1, 2, 3, 4, 5] == got[3]
    empty = N.VectorIndex.build(df.limit(0), str(tmp_path / "e"), "id", "v")
    assert empty.search(df, "id", "v").count() == 0 and held.search(df.limit(0), "id", "v").count() == 0
