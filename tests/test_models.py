"""Models at the smallest scale: the run trains, the metrics table has one
row per model, saved models reload and score identically, and the chosen one
is judged on every test row."""

import tempfile

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import functions as F

from cardspark.plans import metrics as M
from cardspark.plans import models
from cardspark.plans.features import FORBIDDEN
from cardspark.plans.models import (ModelRun, best_model, evaluate, load_scores, model_table,
                                    save_run)

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def run(spark):
    return ModelRun.get(spark, SF, n_trees=3)


def test_models_train_save_and_reload(spark, run):
    assert not (set(run.names) & FORBIDDEN)
    assert run.n_pos > 0 and run.n_neg > run.n_pos
    table = {r["model"]: r for r in model_table(run).collect()}
    assert set(table) == {"random(stratified)", "logreg(balanced)", "gbt(weighted)", "smote+gbt"}
    for r in table.values():
        assert 0.0 <= r["average_precision"] <= 1.0 and 0.0 <= r["roc_auc"] <= 1.0
    out = tempfile.mkdtemp(prefix="models-", dir="/tmp") + "/run"
    best = save_run(run, out)
    lr = PipelineModel.load(f"{out}/logreg")
    gbt = GBTClassificationModel.load(f"{out}/gbt")
    a = sorted(r["probability"][1] for r in lr.transform(run.test).select("probability").collect())
    b = sorted(r["probability"][1] for r in run.logreg().transform(run.test)
               .select("probability").collect())
    assert a == b
    assert gbt.getNumTrees == run.gbt().getNumTrees == 3
    assert spark.read.json(f"{out}/train_metrics").count() == 4
    assert spark.read.json(f"{out}/features").count() == len(run.names)
    assert best == best_model(run)

    # scores of the loaded model equal those of the run
    loaded = load_scores(spark, out, run.test)
    same = loaded.join(run.scores(best).select("transaction_id", F.col("score").alias("s")),
                       "transaction_id").filter("score = s").count()
    assert same == run.test.count()
    result = {r["metric"]: r["value"] for r in evaluate(loaded).collect()}
    assert sum(result[k] for k in ("tn", "fp", "fn", "tp")) == run.test.count()
    assert {"average_precision", "roc_auc", "threshold", "recall_at_1", "recall_at_20"} <= set(result)
    assert result["average_precision"] == table[models.EVAL_NAMES[best]]["average_precision"]
    with pytest.raises(Exception):
        save_run(run, out)  # nothing is overwritten


def test_a_later_session_loads_what_was_fitted(spark, run, monkeypatch):
    def refuse(*a, **k):
        raise AssertionError("fitted again")
    monkeypatch.setattr(models.GBTClassifier, "fit", refuse)
    monkeypatch.setattr(models.Pipeline, "fit", refuse)
    monkeypatch.setattr(models, "smote", refuse)
    again = ModelRun(spark, SF, n_trees=3)  # no memory of the first run but the folder
    assert again.store.root == run.store.root
    for name in models.FITTED:
        a, b = ([tuple(r) for r in x.scores(name).orderBy("transaction_id").collect()]
                for x in (run, again))
        assert a == b
    other = models.ModelStore(spark, SF, {"trees": 4})
    assert other.root != run.store.root and other._done("gbt") is None


def test_contributions_of_the_sample(spark, run, monkeypatch):
    from cardspark.plans.contributions import contributions, node_table
    monkeypatch.setattr(models, "_run", lambda spark, sf_dir: run)
    rows = models.importance_contributions(spark, SF).collect()
    assert {r["feature"] for r in rows} <= set(run.names) and rows[0]["mean_contribution"] > 0
    sample = run.test.orderBy(*models._sample_order()).limit(models.SAMPLE_ROWS)
    path = run.store.entry("gbt", lambda p: 1 / 0)
    each = contributions(node_table(spark, path), sample, ["transaction_id"])
    margin = run.gbt().transform(sample).select(
        "transaction_id", models.vector_to_array("rawPrediction")[1].alias("margin"))
    off = each.join(margin, "transaction_id").select(F.max(F.abs(
        F.col("bias") + F.expr("aggregate(contributions, 0D, (a, c) -> a + c)") - F.col("margin"))))
    assert off.first()[0] < 1e-9


def test_permutation_importance(spark, run, monkeypatch):
    monkeypatch.setattr(models, "_run", lambda spark, sf_dir: run)
    rows = models.importance_permutation(spark, SF, top=4).collect()
    assert len(rows) == 4 and {r["feature"] for r in rows} <= set(run.names)
    assert all(-1 <= r["importance"] <= 1 for r in rows)


def test_metrics_without_positives(spark):
    d = spark.createDataFrame([(1, 0, 0.5), (2, 0, 0.1)], "id long, label int, score double")
    curve = M.score_curve(d)
    assert M.average_precision(curve).first()[0] == 0.0
    assert M.roc_auc(curve).first()[0] is None
    assert M.best_f1(curve).first()["recall"] == 0.0


def test_roc_auc_beyond_a_long(spark):
    curve = spark.createDataFrame(
        [(0.9, 3 * 10 ** 9, 0, 3 * 10 ** 9, 0), (0.1, 10 ** 9, 9 * 10 ** 9, 4 * 10 ** 9, 9 * 10 ** 9)],
        "score double, pos long, neg long, tp long, fp long").selectExpr(
        "*", "4000000000L AS P", "9000000000L AS N")
    assert abs(M.roc_auc(curve).first()[0] - (0.75 + 0.25 / 2)) < 1e-12
