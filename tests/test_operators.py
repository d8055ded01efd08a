"""Distributed helpers against brute force."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cardspark.operators.keys import global_position, surrogate_keys
from cardspark.operators.prefix import exact_medians, exact_quantiles, running_totals


def _frame(spark, n=5000, parts=7, seed=1):
    rnd = random.Random(seed)
    rows = [(i, rnd.randint(0, 50), rnd.random(), rnd.choice(["a", "b", "c"])) for i in range(n)]
    return spark.createDataFrame(rows, "id long, k int, v double, g string").repartition(parts)


def test_global_position_matches_row_number(spark):
    df = _frame(spark)
    got = global_position(df, ["k", "id"], "pos").select("id", "pos")
    want = df.select("id", F.row_number().over(Window.orderBy("k", "id")).alias("pos"))
    assert sorted(got.collect()) == sorted(want.collect())


def test_surrogate_keys_dense_and_offset(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",)], "bk string")
    got = {r["bk"]: r["key"] for r in surrogate_keys(df, ["bk"], "key", start=11).collect()}
    assert got == {"a": 11, "b": 12, "c": 13}


def test_running_totals_match_cumsum(spark):
    df = _frame(spark)
    got = running_totals(df, ["k", "id"], ["v"]).select("id", "cum_v").toPandas()
    pdf = df.toPandas().sort_values(["k", "id"])
    pdf["want"] = pdf["v"].cumsum()
    m = pdf.merge(got, on="id")
    assert np.allclose(m["want"], m["cum_v"])


def test_exact_medians_like_pandas(spark):
    pdf = pd.DataFrame({"a": [1.0, 2.0, 2.0, 7.0, None], "b": [5.0, 1.0, 3.0, 4.0, 10.0]})
    df = spark.createDataFrame(pdf)
    got = {r["column_name"]: r["median"] for r in exact_medians(df, ["a", "b"]).collect()}
    assert got == {"a": pdf["a"].median(), "b": pdf["b"].median()}


def test_exact_quantiles_like_pandas(spark):
    df = _frame(spark, n=999)
    q = exact_quantiles(df, "v", "g", [0.25, 0.5, 0.75]).toPandas().set_index("g")
    pdf = df.toPandas()
    for g, sub in pdf.groupby("g"):
        for i, p in enumerate([0.25, 0.5, 0.75]):
            assert abs(q.loc[g, f"q_{i}"] - sub["v"].quantile(p)) < 1e-12


@pytest.mark.parametrize("shape", ["normal", "ties", "skewed", "sorted"])
def test_quantiles_from_brackets(spark, shape, monkeypatch):
    """Narrow brackets over many rows, most of them outside."""
    from cardspark.operators import prefix
    monkeypatch.setattr(prefix, "WHOLE_ROWS", 50)
    rng = np.random.default_rng(7)
    n = 40_000
    v = {"normal": rng.normal(size=n), "ties": rng.integers(0, 5, n).astype(float),
         "skewed": np.where(rng.random(n) < 0.7, 0.0, rng.exponential(size=n) * 1e6),
         "sorted": np.arange(n, dtype=float)}[shape]
    pdf = pd.DataFrame({"v": v, "g": rng.choice(3, n, p=[0.9, 0.0995, 0.0005])})
    probs = [0.0, 0.001, 0.25, 0.5, 0.9, 0.999, 1.0]
    q = exact_quantiles(spark.createDataFrame(pdf).repartition(7), "v", "g", probs).toPandas().set_index("g")
    for g, sub in pdf.groupby("g"):
        assert q.loc[g, "n"] == len(sub)
        for i, p in enumerate(probs):
            assert abs(q.loc[g, f"q_{i}"] - sub["v"].quantile(p)) <= 1e-9 * max(1, abs(sub["v"].quantile(p)))


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), (3.0, 2)], "v double, g int")
    assert [tuple(r) for r in exact_quantiles(df, "v", "g", [0.5]).collect()] == [(2, 3.0, 1)]
    assert exact_medians(df.limit(0), ["v"]).count() == 0


def test_running_totals_distributed_path(spark):
    df = _frame(spark, n=3000, parts=5)
    got = running_totals(df, ["k", "id"], ["v"], small_rows=0).select("id", "cum_v").toPandas()
    pdf = df.toPandas().sort_values(["k", "id"])
    pdf["want"] = pdf["v"].cumsum()
    m = pdf.merge(got, on="id")
    assert np.allclose(m["want"], m["cum_v"])


def test_surrogate_keys_distributed_path(spark):
    df = _frame(spark, n=3000, parts=5).select("id", "k")
    got = surrogate_keys(df, ["k", "id"], "key", start=5, small_rows=0).select("id", "key")
    want = df.select("id", (F.row_number().over(Window.orderBy("k", "id")) + 4).alias("key"))
    assert sorted(got.collect()) == sorted(want.collect())


def test_time_features_keep_rows_without_a_date(spark):
    import datetime as dt

    from cardspark.plans.star import time_features
    rows = [(1, dt.datetime(2020, 1, 1, 3), 7), (2, dt.datetime(2020, 1, 1, 9), 7),
            (3, None, 7), (4, None, 7), (5, dt.datetime(2020, 1, 2, 1), 8)]
    df = spark.createDataFrame(rows, "id long, date timestamp_ntz, card_id int")
    got = {r["transaction_id"]: (r["txn_per_card_day"], r["is_night"])
           for r in time_features(df).collect()}
    # a missing date is its own (card, day) group, as in a window; night is 0
    assert got == {1: (2, 1), 2: (2, 0), 3: (2, 0), 4: (2, 0), 5: (1, 1)}


def test_run_concurrently_returns_each_result_and_raises(spark):
    import pytest

    from cardspark.session import run_concurrently
    out = run_concurrently({i: (lambda i=i: spark.range(i * 10).count()) for i in range(4)})
    assert out == {0: 0, 1: 10, 2: 20, 3: 30}

    def fails():
        raise ValueError("boom")
    with pytest.raises(ValueError):
        run_concurrently({"ok": lambda: spark.range(5).count(), "bad": fails})


def test_expected_values_are_arguments(spark):
    from cardspark.plans.verify import verify_report
    from cardspark.plans.warehouse import DEFAULT_CTX, Warehouse
    wh = Warehouse.get(spark, "/root/testdata/sf0.001", DEFAULT_CTX)
    got = {r["check_id"]: r for r in verify_report(wh, {"V07": 5, "V13": 0}).collect()}
    assert got["V07"]["status"] == "FAIL" and float(got["V07"]["expected"]) == 5
    assert got["V08"]["status"] == "PASS"
    with pytest.raises(ValueError):
        verify_report(wh, {"V99": 1})
