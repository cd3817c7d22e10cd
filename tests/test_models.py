"""Model jobs: shapes, ranges and invariants (fits of other libraries cannot be matched)."""

import math
import threading

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from checks import model_queries
from ledgerloom.plans import memo, risk


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(0)
    rows = []
    for i in range(400):
        y = float(rng.random() < 0.15)
        rows.append((i, y, float(rng.normal(y * 2, 1)), float(rng.normal(0, 3)), float(rng.normal(-y, 1)), 1.0))
    return spark.createDataFrame(
        rows, "consumer_id long, dq_target double, credit_score double, noise double, other double, constant double"
    )


FEATURES = ["credit_score", "noise", "other", "constant"]


@pytest.fixture(scope="module")
def data(spark, table):
    return risk.prepare(table, FEATURES)


def test_prepared_rows_are_balanced_and_scaled(data):
    counts = {r["label"]: r["count"] for r in data.train.groupBy("label").count().collect()}
    assert abs(counts[0.0] - counts[1.0]) <= 0.1 * counts[0.0]
    v = np.array([r[0] for r in data.train.select(vector_to_array("features")).collect()])
    assert np.allclose(v.mean(axis=0), 0, atol=1e-9)
    assert np.allclose(v.std(axis=0)[:3], 1)
    assert np.all(v[:, 3] == 0)
    assert data.test.count() > 0


def test_comparison_ranks_models_and_ensembles(data):
    chosen = risk.candidates(data.train.count(), rounds=3, trees=5, max_iter=30)
    out = risk.compare(data, {k: chosen[k] for k in ("logistic_regression", "balanced_forest", "linear_margin")})
    rows = out.table.collect()
    assert {r["model"] for r in rows} == {
        "logistic_regression", "balanced_forest", "linear_margin", "ensemble_weighted", "ensemble_max"
    }
    areas = [r["roc_auc"] for r in rows]
    assert areas == sorted(areas, reverse=True)
    assert areas[0] > 0.8
    again = risk.ensemble_probability(out.models, out.weights, data.test).select("consumer_id", "ensemble_probability")
    joined = again.withColumnRenamed("ensemble_probability", "p").join(out.predictions, "consumer_id")
    assert joined.filter(F.abs(F.col("p") - F.col("ensemble_probability")) > 1e-9).count() == 0


def test_tree_importances(data, table):
    model = risk.forest(5, 5).fit(data.train)
    top = risk.importances(model, FEATURES, table, "dq_target", 2).collect()
    assert top[0]["feature"] == "credit_score" and top[0]["correlation"] > 0


def test_whole_scoring_job(spark, table):
    open_rows = table.filter("consumer_id < 30").withColumn("dq_target", F.lit(None).cast("double"))
    ids = open_rows.select("consumer_id", "dq_target").unionByName(
        spark.sql("select 9999L consumer_id, cast(null as double) dq_target")
    )
    rows = risk.score_all(table.filter("consumer_id >= 30"), open_rows, ids, FEATURES, max_iter=30).collect()
    assert [r["consumer_id"] for r in rows] == [*range(30), 9999]
    assert all(1 <= r["credit_score"] <= 999 for r in rows[:-1])
    assert rows[-1]["credit_score"] is None
    assert all(r["non_credit_top_1_feature"] != "credit_score" for r in rows)


def test_both_scoring_models_are_fitted_side_by_side(table, monkeypatch):
    """Two fits that wait for each other; the credit score is only in the first."""
    met, widths, fit = threading.Barrier(2, timeout=60), [], risk.LogisticRegression.fit

    def waiting(self, rows):
        met.wait()
        widths.append(rows.first()["features"].size)
        return fit(self, rows)

    monkeypatch.setattr(risk.LogisticRegression, "fit", waiting)
    open_rows = table.filter("consumer_id < 5").withColumn("dq_target", F.lit(None).cast("double"))
    rows = risk.score_all(table.filter("consumer_id >= 30"), open_rows, open_rows.select("consumer_id", "dq_target"), FEATURES, max_iter=5).collect()
    assert len(rows) == 5 and sorted(widths) == [3, 4]
    assert all(r["non_credit_top_1_feature"] != "credit_score" for r in rows)


def test_memo_model_round_trip(spark, tmp_path):
    words = {"FOOD": "burger pizza coffee", "RENT": "landlord lease flat", "PAY": "salary payroll bonus"}
    rows = [
        (i, f"{words[c].split()[i % 3]} {words[c].split()[(i + 1) % 3]} {i}", c, 1.0, "2024-01-01")
        for i, c in enumerate(list(words) * 40)
    ]
    df = spark.createDataFrame(rows, "id long, memo string, category string, amount double, d string").selectExpr(
        "*", "cast(d as date) posted_date"
    )
    train, test = memo.split(memo.prepared_memos(df))
    model = memo.train(train, memo.logistic(20), memo.fit_tfidf(train, min_df=2))
    out = model.predict(test)
    assert out.filter("category <> predicted").count() == 0
    probabilities = out.first()["class_probabilities"]
    assert sorted(probabilities) == ["FOOD", "PAY", "RENT"] and sum(probabilities.values()) == pytest.approx(1)
    path = str(tmp_path / "model")
    model.save(path)
    again = memo.MemoModel.load(path).predict(test)
    assert again.select("id", "predicted").exceptAll(out.select("id", "predicted")).count() == 0
    pairs = memo.train(train, memo.bayes(), memo.bigram_features(buckets=1 << 12))
    report = {r["label"]: r for r in pairs.report(test).collect()}
    assert report["accuracy"]["recall"] == 1.0


def test_models_are_fitted_side_by_side(spark, monkeypatch):
    """Two fits that wait for each other."""
    met = threading.Barrier(2, timeout=60)
    rows = [(i, float(i % 2), Vectors.dense([float(i % 5), float(i % 3)])) for i in range(40)]
    df = spark.createDataFrame(rows, ["consumer_id", "label", "features"])
    fit = risk.LogisticRegression.fit

    def waiting(self, *args):
        met.wait()
        return fit(self, *args)

    monkeypatch.setattr(risk.LogisticRegression, "fit", waiting)
    chosen = {name: risk.Candidate(risk.logistic(40, n, weighted=False)) for name, n in (("short", 2), ("long", 20))}
    done = risk.compare(risk.PreparedData(df, df, ["a", "b"], df), chosen)
    assert list(done.models) == ["short", "long"]
    assert done.models["long"].getMaxIter() == 20
    assert {r.model for r in done.table.collect()} == {"short", "long", "ensemble_weighted", "ensemble_max"}


def test_tfidf_vocabulary_is_counted_by_term(spark):
    """Frequent terms first, equally frequent ones by name, whatever the partitions; counts and idf by hand."""
    rows = [(i, " ".join([f"t{j:02d}" for j in range(40, 0, -1)] + ["often", "often"] * (i < 5))) for i in range(8)] + [(8, "x")]
    memos = spark.createDataFrame(rows, "id long, memo string").repartition(5)
    _, counted, scale, _ = memo.fit_tfidf(memos, max_terms=6, min_df=3, max_df=0.95).stages
    assert counted.vocabulary == ["often", "t01", "t02", "t03", "t04", "t05"]
    assert np.allclose(scale.getScalingVec(), [math.log(10 / 6) + 1] + [math.log(10 / 9) + 1] * 5, atol=1e-12)
    model = memo.fit_tfidf(memos, max_terms=6, min_df=3, max_df=0.6)
    assert model.stages[1].vocabulary == ["often"]
    out = {r["id"]: r["counts"] for r in model.transform(memos).collect()}
    assert out[0][0] == 2.0 and out[7].numNonzeros() == 0


def test_boosted_memos_are_fitted_with_all_rounds_and_terms(spark, monkeypatch):
    asked = []
    monkeypatch.setattr(model_queries, "memo_report", lambda spark, sf_dir, classifier, max_terms=2000: asked.append((classifier, max_terms)))
    model_queries.memo_boosted(spark, None)
    (model, terms), = asked
    tree = model.getClassifier()
    assert (tree.getMaxIter(), tree.getMaxDepth(), terms) == (100, 6, 2000)
    assert model.getParallelism() > 1  # classes side by side
