"""SCD-2 properties and metric functions on hand-checkable tables."""

import datetime as dt

import pytest

import numpy as np

from cardspark.operators.scd import asof_lookup, scd2_feed, scd2_merge
from cardspark.plans import metrics as M

HIGH = dt.datetime(9999, 12, 31)
T0 = dt.datetime(2020, 1, 1)
T1 = dt.datetime(2021, 1, 1)

DIM_SCHEMA = ("K long, BK int, A string, B int, RowIsCurrent string, RowStartDate timestamp_ntz, "
              "RowEndDate timestamp_ntz, RowChangeReason string, InsertAuditKey int, "
              "UpdateAuditKey int")


def _dim(spark):
    rows = [(-1, -1, "Unknown", -1, "Y", dt.datetime(1899, 12, 31), HIGH, "N/A", -1, -1),
            (1, 10, "x", 1, "Y", T0, HIGH, "New", 1, 1),
            (2, 20, "y", 2, "Y", T0, HIGH, "New", 1, 1),
            (3, 30, "z", 3, "Y", T0, HIGH, "New", 1, 1)]
    return spark.createDataFrame(rows, DIM_SCHEMA)


def _merge(spark, dim, snap):
    inc = spark.createDataFrame(snap, "BK int, A string, B int")
    return scd2_merge(dim, inc, "BK", "K", ["A"], ["B"], T1, 2)


def test_scd2_versions_and_properties(spark):
    # BK 10: type-1 change only; 20: type-2 change; 30: missing; 40: new
    out = _merge(spark, _dim(spark), [(10, "x2", 1), (20, "y", 5), (40, "w", 4)])
    rows = {(r["K"]): r for r in out.collect()}
    assert rows[1]["A"] == "x2" and rows[1]["RowIsCurrent"] == "Y"
    assert rows[2]["RowIsCurrent"] == "N" and rows[2]["RowEndDate"] == T1
    new = [r for r in rows.values() if r["BK"] == 20 and r["RowIsCurrent"] == "Y"][0]
    assert new["B"] == 5 and new["RowStartDate"] == T1 and new["RowChangeReason"] == "Changed: B"
    assert rows[3]["RowIsCurrent"] == "Y" and rows[3]["B"] == 3
    n40 = [r for r in rows.values() if r["BK"] == 40][0]
    assert n40["RowChangeReason"] == "New" and n40["K"] == 5 and new["K"] == 4
    assert rows[-1]["A"] == "Unknown"
    cur = out.filter("K > 0 AND RowIsCurrent = 'Y'").groupBy("BK").count()
    assert cur.filter("count > 1").count() == 0
    # validity ranges of a key do not overlap and leave no gap
    v = sorted((r["RowStartDate"], r["RowEndDate"]) for r in rows.values() if r["BK"] == 20)
    assert v[0][1] == v[1][0]


def test_scd2_same_snapshot_twice_adds_nothing(spark):
    snap = [(10, "x2", 1), (20, "y", 5), (40, "w", 4)]
    once = _merge(spark, _dim(spark), snap).checkpoint()
    twice = _merge(spark, once, snap)
    assert twice.count() == once.count()
    assert twice.filter("RowIsCurrent = 'Y'").count() == once.filter("RowIsCurrent = 'Y'").count()


def _by_replay(dim, feed):
    """Brute force: per key the moments in order, each with the attributes then."""
    out = {}
    for bk in {r["BK"] for r in dim if r["K"] > 0} | {f[0] for f in feed}:
        old = {r["RowStartDate"]: r for r in dim if r["K"] > 0 and r["BK"] == bk}
        said = {}
        for f in sorted((f for f in feed if f[0] == bk), key=lambda f: f[2]):
            said[f[1]] = f
        last = max(said.values(), key=lambda f: (f[1], f[2]), default=None)
        rows, before = [], None
        for at in sorted({*old, *said}):
            b = said[at][4] if at in said else old[at]["B"]
            if at in old or before is None or b != before[0]:
                rows.append([at, b, last[3] if last else old[at]["A"], old[at]["K"] if at in old else None])
            before = (b,)
        out[bk] = [(*r, rows[i + 1][0] if i + 1 < len(rows) else HIGH) for i, r in enumerate(rows)]
    return out


@pytest.mark.parametrize("seed", range(4))
def test_scd2_feed_equals_replay(spark, seed):
    import random
    rng = random.Random(seed)
    base = _merge(spark, _dim(spark), [(10, "x2", 1), (20, "y", 5), (40, "w", 4)]).checkpoint()
    day = lambda: T0 + dt.timedelta(days=rng.randrange(-200, 800, 50))
    feed = [(rng.choice([10, 20, 40, 50, 60]), rng.choice([day(), T0, T1]), i, rng.choice("ab"),
             rng.randrange(3)) for i in range(25)]
    frame = spark.createDataFrame(feed, "BK int, EffectiveAt timestamp_ntz, Seq int, A string, B int")
    out = scd2_feed(base, frame, "BK", "K", ["A"], ["B"], 3).collect()
    dim = base.collect()
    want = _by_replay(dim, feed)
    got = {}
    for r in out:
        if r["K"] > 0:
            got.setdefault(r["BK"], []).append(r)
    assert set(got) == set(want)
    known = {r["K"] for r in dim}
    for bk, rows in got.items():
        rows.sort(key=lambda r: r["RowStartDate"])
        assert [(r["RowStartDate"], r["B"], r["A"], r["K"] if r["K"] in known else None, r["RowEndDate"])
                for r in rows] == want[bk]
        # no gap, no overlap, one current version
        assert all(a["RowEndDate"] == b["RowStartDate"] for a, b in zip(rows, rows[1:]))
        assert [r["RowIsCurrent"] for r in rows] == ["N"] * (len(rows) - 1) + ["Y"]
    keys = [r["K"] for r in out]
    assert len(keys) == len(set(keys)) and sorted(keys)[-1] == len(keys) - 1  # dense, -1 aside
    unknown = [r for r in out if r["K"] == -1]
    assert unknown == [r for r in dim if r["K"] == -1]
    again = scd2_feed(base, frame.limit(0), "BK", "K", ["A"], ["B"], 3).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, dim))


def test_asof_lookup_picks_version(spark):
    dim = _merge(spark, _dim(spark), [(20, "y", 5)])
    facts = spark.createDataFrame([(20, dt.datetime(2020, 6, 1)), (20, dt.datetime(2021, 6, 1)),
                                   (99, dt.datetime(2021, 6, 1))], "BK int, ts timestamp_ntz")
    got = sorted((r["BK"], r["ts"], r["K"])
                 for r in asof_lookup(facts, "BK", "ts", dim, "BK", "K").collect())
    assert [k for _, _, k in got] == [2, 4, -1]


@pytest.mark.parametrize("versions", [10_000, 3])
def test_asof_lookup_of_a_key_with_many_versions(spark, versions):
    """One key holds nearly all versions and facts, over several partitions; some
    of its moments and the keys around it have no version."""
    from pyspark.sql import functions as F
    day = dt.datetime(2000, 1, 1)
    step = dt.timedelta(hours=60_000 // versions)
    rows = [(k + 1, 7, day + k * step, day + (k + 1) * step) for k in range(versions) if k % 10 != 3]
    rows += [(90_001, 5, day, day + 9 * step), (90_002, 9, day + step, dt.datetime(9999, 12, 31)),
             (-1, 7, day, dt.datetime(9999, 12, 31))]
    dim = spark.createDataFrame(rows, "K long, BK int, RowStartDate timestamp_ntz, RowEndDate timestamp_ntz")
    rng = __import__("random").Random(8)
    facts = [(i, rng.choice([7] * 30 + [5, 9, 4, None]),
              rng.choice([None, day - step, day + rng.randrange(versions) * step,
                          day + dt.timedelta(hours=rng.randrange(-500, 70_000))])) for i in range(6000)]
    facts += [(10_000 + i, 7, day + step / 2) for i in range(500)]  # one moment
    f = spark.createDataFrame(facts, "id long, BK int, ts timestamp_ntz")
    out = asof_lookup(f, "BK", "ts", dim, "BK", "K")
    got = {r["id"]: r["K"] for r in out.collect()}
    import bisect
    of = {}
    for k, bk, start, end in rows:
        if k > 0:
            of.setdefault(bk, []).append((start, end, k))
    for i, bk, ts in facts:
        mine = sorted(of.get(bk, []))
        at = bisect.bisect_right(mine, (ts, dt.datetime.max, 0)) - 1 if ts else -1
        want = mine[at][2] if at >= 0 and ts < mine[at][1] else -1
        assert got[i] == want, (i, bk, ts)
    assert len(got) == len(facts)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
    assert out.select(F.col("K")).count() == len(facts)


def test_asof_lookup_of_nothing(spark):
    dim = _merge(spark, _dim(spark), [(20, "y", 5)])
    facts = spark.createDataFrame([], "BK int, ts timestamp_ntz")
    assert asof_lookup(facts, "BK", "ts", dim, "BK", "K").count() == 0
    facts = spark.createDataFrame([(20, dt.datetime(2020, 6, 1))], "BK int, ts timestamp_ntz")
    assert [r["K"] for r in asof_lookup(facts, "BK", "ts", dim.limit(0), "BK", "K").collect()] == [-1]


# an 8-row score table with ties
LABELS = [1, 0, 1, 0, 0, 1, 0, 0]
SCORES = [0.9, 0.9, 0.7, 0.6, 0.6, 0.3, 0.3, 0.1]


def _scored(spark):
    return spark.createDataFrame([(i, l, s) for i, (l, s) in enumerate(zip(LABELS, SCORES))],
                                 "id long, label int, score double")


def _brute():
    y, s = np.array(LABELS), np.array(SCORES)
    P = y.sum()
    thr = np.unique(s)[::-1]
    ap, prev_r, f1s = 0.0, 0.0, []
    for t in thr:
        pred = s >= t
        tp = (pred & (y == 1)).sum()
        p, r = tp / pred.sum(), tp / P
        ap += (r - prev_r) * p
        prev_r = r
        f1s.append((2 * p * r / (p + r + 1e-12), -t))
    pos, neg = s[y == 1], s[y == 0]
    auc = np.mean([(a > b) + 0.5 * (a == b) for a in pos for b in neg])
    best = -max(f1s)[1]
    return ap, auc, best


def test_metrics_match_brute_force(spark):
    ap, auc, best = _brute()
    curve = M.score_curve(_scored(spark))
    assert abs(M.average_precision(curve).first()[0] - ap) < 1e-9
    assert abs(M.roc_auc(curve).first()[0] - auc) < 1e-12
    assert M.best_f1(curve).first()["threshold"] == best


def test_recall_at_k_ties_by_id(spark):
    r = {row["k_pct"]: row for row in M.recall_at_k(_scored(spark), [10, 20, 50]).collect()}
    # n = 8: k = 1 (id 0, label 1), 1, 4 (ids 0, 1, 2, 3 -> 2 positives of 3)
    assert r[10]["caught"] == 1 and r[20]["k"] == 1 and r[50]["caught"] == 2
    assert abs(r[50]["recall"] - 2 / 3) < 1e-12


def test_confusion_at_threshold(spark):
    thr = spark.createDataFrame([(0.7,)], "threshold double")
    c = M.confusion_at(_scored(spark), thr).first()
    assert (c["tn"], c["fp"], c["fn"], c["tp"]) == (4, 1, 1, 2)
    assert abs(c["f1"] - 4 / 6) < 1e-12


def test_recall_at_k_matches_sorting_with_heavy_ties(spark):
    rng = np.random.default_rng(7)
    n = 3000
    ids = rng.permutation(n)
    labels = (rng.random(n) < 0.1).astype(int)
    scores = rng.integers(0, 6, n) / 5.0  # six distinct scores: large tie groups
    df = spark.createDataFrame([(int(i), int(lb), float(s)) for i, lb, s in zip(ids, labels, scores)],
                               "id long, label int, score double")
    pcts = [1, 5, 10, 20, 33, 50, 100]
    got = {r["k_pct"]: (r["k"], r["caught"]) for r in M.recall_at_k(df, pcts).collect()}
    order = np.lexsort((ids, -scores))  # score descending, then id ascending
    for p in pcts:
        k = max(int(np.floor(n * p / 100)), 1)
        assert got[p] == (k, int(labels[order[:k]].sum())), p
