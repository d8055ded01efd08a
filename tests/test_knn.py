"""The k-NN join over Voronoi cells against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cardspark.operators import knn
from cardspark.operators.knn import KnnJoin, exact_knn


def brute(ids, pts, k):
    d = ((pts[:, None, :] - pts[None, :, :]) ** 2).sum(-1)
    np.fill_diagonal(d, np.inf)
    out = {}
    for q, row in enumerate(d):
        order = sorted((i for i in range(len(ids)) if i != q), key=lambda i: (row[i], ids[i]))
        out[ids[q]] = [ids[i] for i in order[:k]]
    return out


def found(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["qid"], {})[r["j"]] = r["nid"]
    return {q: [js[j] for j in range(len(js))] for q, js in out.items()}


@pytest.mark.parametrize("pivots,block_rows,chunk", [(None, 20_000, 1024), (5, 9, 4), (1, 7, 100), (30, 4, 3)])
@pytest.mark.parametrize("shape", ["normal", "clusters", "grid"])
def test_equal_to_brute_force(spark, pivots, block_rows, chunk, shape, monkeypatch):
    monkeypatch.setattr(knn, "CHUNK_ROWS", chunk)
    rng = np.random.default_rng(3)
    pts = {"normal": rng.normal(size=(80, 3)),
           "clusters": rng.normal(size=(80, 3)) + 1000 * rng.integers(0, 4, size=(80, 1)),
           "grid": rng.integers(0, 4, size=(80, 3)).astype(float)}[shape]  # many ties, equal rows
    ids = [1000 + (37 * i) % 80 for i in range(80)]
    df = spark.createDataFrame([(i, p.tolist()) for i, p in zip(ids, pts)], "rid long, x array<double>")
    assert found(exact_knn(df, 4, pivots, block_rows)) == brute(ids, pts, 4)


@pytest.mark.parametrize("n", [0, 1, 2, 4])
def test_few_rows(spark, n):
    pts = np.arange(2.0 * n).reshape(n, 2)
    df = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(pts)], "rid long, x array<double>")
    assert found(exact_knn(df, 5)) == {q: v for q, v in brute(list(range(n)), pts, 5).items() if v}


def test_few_copies_of_a_row(spark):
    """On the failed transactions' features a row meets few cells besides its own."""
    from cardspark.plans.features import build_features, time_split
    from cardspark.plans.star import _wh
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array
    frame, names = build_features(_wh(spark, "/root/testdata/sf0.001").ml_frame())
    x = VectorAssembler(inputCols=names, outputCol="v").transform(frame).filter("label = 1") \
        .select(F.col("transaction_id").cast("long").alias("rid"), vector_to_array("v").alias("x"))
    rows = x.collect()
    j = KnnJoin(x, 5)
    assert j.reached.count() < 5 * len(rows)
    pts = np.array([r["x"] for r in rows])
    got, want = found(j.neighbours()), brute([r["rid"] for r in rows], pts, 5)
    at = {r["rid"]: np.array(r["x"]) for r in rows}
    for q in want:  # equal distances, up to rounding
        far = [[float(((at[q] - at[i]) ** 2).sum()) for i in side[q]] for side in (got, want)]
        assert np.allclose(far[0], far[1], rtol=1e-9, atol=1e-6)
