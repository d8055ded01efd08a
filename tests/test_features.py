"""The feature matrix (M4-M8) against a brute-force pandas build of the same
rules on the smallest scale factor: median fill, row-share frequency
encoding, top states with the rest 'Other', one column per category level
(no level dropped), cleaned names in (column, level) order."""

import numpy as np
import pandas as pd

from cardspark.plans.features import (ALL_NUMERIC, CATEGORICAL_COLS, FREQ_ENCODE_COLS,
                                      STATE_TOP_N, TIME_CATEGORICAL_COLS, build_features,
                                      clean_name)
from cardspark.plans.warehouse import DEFAULT_CTX, Warehouse

SF = "/root/testdata/sf0.001"


def _text(s: pd.Series, dtype: str) -> pd.Series:
    """Category text: True/False for flags, digits for numbers, 'None' if missing."""
    def one(v):
        if v is None or (isinstance(v, float) and np.isnan(v)):
            return "None"
        if dtype == "boolean":
            return "True" if v else "False"
        if dtype in ("double", "float", "int", "smallint", "bigint", "tinyint"):
            return str(int(v))
        return str(v)
    return s.map(one)


def _brute_force(pdf: pd.DataFrame, dtypes: dict):
    out = {"transaction_id": pdf["transaction_id"].to_numpy()}
    for c in ALL_NUMERIC:
        x = pdf[c].astype("float64")
        out[c] = x.fillna(x.median()).to_numpy()
    for c in FREQ_ENCODE_COLS:
        key = pdf[c].astype(str)
        out[f"{c}_freq"] = key.map(key.value_counts() / len(key)).to_numpy()
    text = {c: _text(pdf[c], dtypes[c]) for c in CATEGORICAL_COLS + TIME_CATEGORICAL_COLS}
    state = _text(pdf["state"], dtypes["state"])
    counts = state.value_counts()
    ranked = sorted(counts.items(), key=lambda kv: (-kv[1], kv[0]))
    top = {s for s, _ in ranked[:STATE_TOP_N]}
    text["state_grp"] = state.where(state.isin(top), "Other")
    names = list(ALL_NUMERIC) + [f"{c}_freq" for c in FREQ_ENCODE_COLS]
    for c in CATEGORICAL_COLS + TIME_CATEGORICAL_COLS + ["state_grp"]:
        for level in sorted(text[c].unique()):
            name = clean_name(f"{c}_{level}")
            out[name] = (text[c] == level).astype("float64").to_numpy()
            names.append(name)
    return pd.DataFrame(out), names


def test_feature_matrix_matches_brute_force(spark):
    flat = Warehouse.get(spark, SF, DEFAULT_CTX).ml_frame()
    frame, names = build_features(flat)
    got = frame.toPandas().sort_values("transaction_id").reset_index(drop=True)

    pdf = flat.toPandas()
    want, want_names = _brute_force(pdf, dict(flat.dtypes))
    want = want.sort_values("transaction_id").reset_index(drop=True)

    assert names == want_names
    assert len(got) == len(want) == flat.count()
    assert (got["transaction_id"].to_numpy() == want["transaction_id"].to_numpy()).all()
    for c in names:
        np.testing.assert_allclose(got[c].to_numpy(dtype="float64"),
                                   want[c].to_numpy(dtype="float64"), rtol=1e-12, atol=1e-12,
                                   err_msg=c)


def test_missing_merchant_is_a_category(spark):
    from cardspark.plans.features import frequencies
    d = spark.createDataFrame([(None, "a"), (None, None), (7, "a")],
                              "merchant_id int, mcc_description string")
    got = {(r["column_name"], r["value"]): r["freq"] for r in frequencies(d).collect()}
    assert got[("merchant_id", "None")] == 2 / 3 and got[("mcc_description", "None")] == 1 / 3
    assert None not in {v for _, v in got}


def test_features_fitted_on_the_training_rows(spark):
    from cardspark.plans.features import SPLIT_CUTOFF, _flat, build_features, time_split
    flat = _flat(spark, "/root/testdata/sf0.001")
    train, _ = time_split(flat, 19960101)
    frame, names = build_features(flat, fit=train)
    assert frame.count() == flat.count() and SPLIT_CUTOFF
    # the training rows' features do not change when the test rows go
    alone, same = build_features(train)
    assert names == same
    a = sorted(map(tuple, frame.filter("date_key < 19960101").collect()))
    b = sorted(map(tuple, alone.collect()))
    assert a == b
    assert frame.filter("merchant_id_freq IS NULL OR mcc_description_freq IS NULL").count() == 0


def test_assembled_features_are_the_matrix_as_vectors(spark):
    from pyspark.ml.feature import VectorAssembler
    from cardspark.plans.features import _flat, assembled_features, time_split
    flat = _flat(spark, SF)
    # levels that the fitted rows lack have no column
    for fit in (None, time_split(flat, 19960101)[0].filter("card_brand <> 'Visa'")):
        frame, names = build_features(flat, fit=fit)
        want = VectorAssembler(inputCols=names, outputCol="features").transform(frame)
        got, same = assembled_features(flat, fit=fit)
        assert same == names
        assert got.schema["features"].metadata == want.schema["features"].metadata
        key = lambda r: r["transaction_id"]
        assert sorted(got.collect(), key=key) == sorted(want.select(got.columns).collect(), key=key)


def test_a_level_is_looked_up_once_a_column(spark):
    """The plan of the feature rows grows with the columns, not with columns times levels."""
    from cardspark.plans.features import ALL_CATEGORICAL, feature_rows
    shown = spark.conf.get("spark.sql.debug.maxToStringFields")
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    try:
        plan = feature_rows(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set("spark.sql.debug.maxToStringFields", shown)
    assert plan.count("array_position(") == len(ALL_CATEGORICAL) and plan.count("CASE WHEN") < 60
