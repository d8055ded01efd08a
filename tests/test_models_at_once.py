"""Models that a query compares are fitted at once, and are those fitted in turn."""

import threading
from types import SimpleNamespace

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from cardspark.plans import models
from cardspark.plans.models import ModelRun
from cardspark.session import run_concurrently

WAIT = 60


def test_every_model_of_the_table_is_at_work_at_once(spark):
    met = threading.Barrier(len(models.EVAL_NAMES))

    def metrics(name):
        met.wait(WAIT)  # broken if one has to end before the next begins
        return spark.createDataFrame([(models.EVAL_NAMES[name], 0.5, 0.25)],
                                     "model string, average_precision double, roc_auc double")
    rows = models.model_table(SimpleNamespace(metrics=metrics)).collect()
    assert [r["model"] for r in rows] == list(models.EVAL_NAMES.values())
    assert all((r["average_precision"], r["roc_auc"]) == (0.5, 0.25) for r in rows)


def test_models_to_save_are_fitted_at_once():
    met = threading.Barrier(len(models.FITTED))
    saved = {}

    class Saved(Exception):
        pass

    def fitted(name):
        met.wait(WAIT)

        def save(path):
            saved[name] = path
            if len(saved) == len(models.FITTED):
                raise Saved
        return SimpleNamespace(write=lambda: SimpleNamespace(save=save))
    with pytest.raises(Saved):
        models.save_run(SimpleNamespace(spark=None, fitted=fitted), "out")
    assert saved == {n: f"out/{n}" for n in models.FITTED}


def test_trees_grown_at_once_are_those_grown_in_turn(spark):
    rows = spark.range(0, 3000, 1, 3).select(
        F.pmod(F.xxhash64("id"), F.lit(97)).cast("double").alias("a"),
        F.pmod(F.xxhash64("id", F.lit(1)), F.lit(2)).cast("double").alias("b"),
        (F.pmod(F.xxhash64("id"), F.lit(97)) + F.pmod(F.xxhash64("id", F.lit(2)), F.lit(40)) > 90)
        .cast("double").alias("label"), (1 + F.col("id") % 3).cast("double").alias("w"))
    data = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(rows)
    run = ModelRun.__new__(ModelRun)
    run.n_trees = 3

    def grow(weight):
        model = run._gbt(weight).fit(data)
        return model.toDebugString.split("\n", 1)[1]  # the first line is the model's id
    turn = {w: grow(w) for w in (True, False)}
    assert "If (feature" in turn[True] and turn[True] != turn[False]
    assert run_concurrently({w: (lambda w=w: grow(w)) for w in (True, False)}) == turn
