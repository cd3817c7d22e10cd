"""Boosting inside a task: the same trees as the library's where nothing is drawn, and bounds."""

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors

from checks import model_queries
from ledgerloom.plans import gradient, risk


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(3)
    x = rng.integers(0, 9, (300, 4)).astype(float)
    x[:, 3] = 1.0
    y = ((x[:, 0] * x[:, 1] + rng.normal(0, 6, 300)) > 18).astype(float)
    data = [(i, float(y[i]), float(1 + i % 3), Vectors.dense(x[i])) for i in range(300)]
    return spark.createDataFrame(data, ["consumer_id", "label", "class_weight", "features"]).repartition(5)


def probabilities(model, df):
    out = model.transform(df).select("consumer_id", vector_to_array("probability")[1].alias("p"))
    return np.array([r["p"] for r in out.orderBy("consumer_id").collect()])


@pytest.mark.parametrize("weighted", [False, True])
def test_same_trees_as_the_library_without_draws(rows, weighted):
    model = risk.boosted(6, 0.3, 3, weighted=weighted).setSubsamplingRate(1.0).setFeatureSubsetStrategy("all")
    got = gradient.Boosting(model).fit(rows)
    assert isinstance(got, gradient.BoostedTrees) and len(got.trees) == 6
    assert np.allclose(probabilities(got, rows), probabilities(model.fit(rows), rows), atol=1e-9)


def test_draws_do_not_depend_on_partitions(rows):
    model = gradient.Boosting(risk.boosted(8, 0.3, 4))
    first = probabilities(model.fit(rows), rows)
    assert np.array_equal(first, probabilities(model.fit(rows.repartition(2)), rows))
    y = np.array([r["label"] for r in rows.orderBy("consumer_id").collect()])
    assert gradient.area(np.where(y == 1, 1, -1), first) > 0.9


def test_more_rows_are_left_to_the_library(rows, monkeypatch):
    monkeypatch.setattr(gradient, "LOCAL_CELLS", 300 * 4 - 1)
    assert type(gradient.Boosting(risk.boosted(2, 0.3, 2)).fit(rows)).__name__ == "GBTClassificationModel"


def test_sides_hold_enough_rows_and_areas_are_exact(rows):
    held = gradient.Boosting(risk.boosted(1, 1.0, 6)).rows(rows)
    settings = gradient.Settings(1, 1.0, 6, 40, 1.0, 1.0, 1)
    feature, cut, left, value = gradient.boost(held.bins, held.y, held.weight, settings)[0]
    leaf = gradient._walk(feature, cut, left, held.bins.T)
    assert np.unique(leaf, return_counts=True)[1].min() >= 40 and len(feature) > 3
    assert np.allclose(value[leaf], [held.y[leaf == i].mean() for i in leaf])
    assert gradient.area(np.array([1, -1, 1, -1]), np.array([3.0, 1.0, 1.0, 0.0])) == pytest.approx(3.5 / 4)
    assert gradient.area(np.array([1, 1]), np.array([0.0, 1.0])) == 0.5


def test_comparison_boosts_inside_tasks(rows):
    chosen = risk.candidates(300)
    assert all(isinstance(chosen[n].estimator, gradient.Boosting) for n in ("gradient_boosting", "weighted_boosting", "undersampled_boosting"))
    few = {n: risk.candidates(300, rounds=4)[n] for n in ("gradient_boosting", "weighted_boosting")}
    out = risk.compare(risk.PreparedData(rows, rows, ["a", "b", "c", "d"], rows), few)
    assert {r["model"] for r in out.table.filter("roc_auc > 0.8").collect()} >= set(few)


def test_the_search_tries_all_settings_and_refits_the_best(spark, rows, monkeypatch):
    out = risk.tune_boosting(rows, n_trials=6, rounds=(3, 6))
    assert len(out.validationMetrics) == len(out.trials) == 6 and len({t["maxDepth"] for t in out.trials}) > 1
    best = out.trials[int(np.argmax(out.validationMetrics))]
    assert len(out.bestModel.trees) == best["maxIter"] and max(out.validationMetrics) > 0.8
    monkeypatch.setattr(gradient, "LOCAL_CELLS", 1)
    assert len(risk.tune_boosting(rows, n_trials=2, rounds=(2,)).validationMetrics) == 2


def test_the_query_searches_the_whole_space(monkeypatch, rows):
    asked = []
    monkeypatch.setattr(gradient, "validation_areas", lambda spark, held, wanted, share, seed: asked.extend(wanted) or [0.5] * len(wanted))
    monkeypatch.setattr(gradient.Boosting, "fit_rows", lambda *args: gradient.BoostedTrees([np.zeros(0)] * 4, []))
    monkeypatch.setattr(model_queries, "risk_data", lambda *args: risk.PreparedData(rows, rows, ["a", "b", "c", "d"], rows))
    model_queries.tuned_gbt(None, None)
    assert len(asked) == 100 and {s.rounds for s in asked} == set(range(50, 500, 50))
    assert {s.depth for s in asked} == set(range(3, 11)) and len({s.tried for s in asked}) == 100
