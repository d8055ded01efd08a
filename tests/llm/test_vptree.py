import numpy as np
import pytest
from pyspark.sql import functions as F

from cardspark.llm.vptree import VPTree, distances, nearest, usable

SCHEMA = "vec_id long, embedding array<float>, score string, rank string, shard int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x", "y", 1) for i, v in rows], SCHEMA)


def brute(rows, queries, k=5):
    ok = []
    for i, v in rows:
        if i is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        v = np.array(v, np.float32).astype(np.float64)
        if v.any():
            ok.append((i, v))
    out = {}
    for q, v in ok:
        if q in queries:
            s = sorted({(-float(v @ w / np.linalg.norm(v) / np.linalg.norm(w)).__round__(12), i)
                        for i, w in ok if i != q and len(w) == len(v)})
            out[q] = s[:k]
    return out


def run(spark, rows, queries, **kw):
    p = usable(frame(spark, rows))
    got = {}
    for r in nearest(p, p.filter(F.col("vec_id").isin(list(queries))), **kw).orderBy(
            "query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((-round(r["score"], 12), r["vec_id"]))
        assert r["rank"] == len(got[r["query_id"]])
    return got


def test_exact_against_brute_force(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(rng.normal(size=(700, 12)))]
    queries = set(range(0, 700, 50))
    assert run(spark, rows, queries, shard_rows=150) == brute(rows, queries)


def test_ties_copies_and_unusable(spark):
    v = [1.0, 2.0, 3.0]
    rows = [(i, v) for i in range(40)] + [(i, v) for i in range(3)]  # a hot vector, repeated rows
    rows += [(100, None), (101, [0.0, 0.0, 0.0]), (102, [1.0, None, 2.0]),
             (103, [float("nan"), 1.0, 1.0]), (104, [float("inf"), 1.0, 1.0]), (None, v),
             (105, [1.0, 2.0]), (106, [3.0, 2.0, 1.0]), (107, [])]
    queries = {0, 2, 39, 100, 101, 102, 105, 106}
    want = brute(rows, queries)
    got = run(spark, rows, queries, shard_rows=16)
    assert got == {q: s for q, s in want.items() if s}
    assert [i for _, i in got[2]] == [0, 1, 3, 4, 5]


def test_factor_trades_recall_for_work():
    rng = np.random.default_rng(2)
    unit = rng.normal(size=(4000, 8))
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    q = unit[::40]
    truth = np.argsort(distances(q, unit), axis=1)[:, :5]
    found, work = [], []
    for factor in (1.0, 0.7, 0.3):
        t = VPTree(unit, leaf=32)
        _, rows = t.search(q, 5, factor)
        found.append(np.mean([len(set(a) & set(b)) / 5 for a, b in zip(rows, truth)]))
        work.append(t.compared)
    assert found[0] == 1.0
    assert found[0] >= found[1] >= found[2]
    assert work[0] > work[1] > work[2]
    assert work[0] < 0.9 * len(q) * len(unit)


@pytest.mark.parametrize("same", [1, 300])
def test_tree_of_equal_points(same):
    unit = np.tile([[0.6, 0.8]], (same, 1))
    d, rows = VPTree(unit, leaf=16).search(unit[:1], 3)
    assert (rows[0] >= 0).sum() == min(3, same)
    assert np.allclose(d[0][rows[0] >= 0], 0)


def test_empty(spark):
    p = usable(frame(spark, []))
    assert nearest(p, p).count() == 0
    one = usable(frame(spark, [(50, [1.0, 2.0])]))
    assert nearest(one, one).count() == 0


@pytest.mark.parametrize("shard_rows", [4096, 7])
def test_many_vectors_at_one_cosine(spark, shard_rows):
    rng = np.random.default_rng(4)
    # multiples of one direction, not of equal last bits; and one-hot vectors
    rows = [(961 + (17 * i) % 40, [float(x) for x in (0.1 + 0.37 * i) * np.array([1.0, 2.0, 3.0, 0.5])])
            for i in range(40)]
    rows += [(i, [float(j == i % 4) for j in range(4)]) for i in range(0, 60)]
    rows += [(200 + i, [float(x) for x in v]) for i, v in enumerate(rng.normal(size=(30, 4)))]
    queries = {0, 1, 961, 980, 1000, 200}
    got = run(spark, rows, queries, shard_rows=shard_rows)
    want = brute(rows, queries)
    assert {q: [i for _, i in s] for q, s in got.items()} == {q: [i for _, i in s] for q, s in want.items()}
    assert [i for _, i in got[1000]] == [961, 962, 963, 964, 965]
    assert [i for _, i in got[0]] == [4, 8, 12, 16, 20]


def test_recall_below_factor_one(spark):
    """What the relaxed search loses, on the test table."""
    p = usable(spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet"))
    q = p.filter("vec_id % 50 = 0")
    exact = {(r["query_id"], r["vec_id"]) for r in nearest(p, q).collect()}
    part = {(r["query_id"], r["vec_id"]) for r in nearest(p, q, factor=0.9).collect()}
    assert len(exact & part) >= 0.9 * len(exact)
