import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import evaluate, neighbors, scoring


def brute_force(ids, matrix, k):
    out = {}
    for i, x in zip(ids, matrix):
        d = np.sqrt(((matrix - x) ** 2).sum(axis=1))
        others = sorted((dist, j) for dist, j in zip(d, ids) if j != i)
        out[i] = [j for _, j in others[:k]]
    return out


@pytest.mark.parametrize("shape", ["clusters", "uniform", "copies", "one_hot_group"])
def test_nearest_is_exact(spark, shape):
    rng = np.random.default_rng(5)
    if shape == "clusters":
        matrix = np.concatenate([rng.normal(c, 0.1, (60, 4)) for c in (0, 5, 50, -20)])
    elif shape == "uniform":
        matrix = rng.uniform(-1, 1, (200, 6))
    elif shape == "one_hot_group":
        matrix = np.concatenate([np.zeros((150, 3)), rng.normal(0, 1, (60, 3))])
    else:
        matrix = np.repeat(rng.integers(0, 3, (20, 2)).astype(float), 10, axis=0)
    ids = list(range(len(matrix)))
    df = spark.createDataFrame([(i, [float(v) for v in x]) for i, x in zip(ids, matrix)], "id long, v array<double>")
    rows = neighbors.nearest(df, 3, block_rows=16).collect()
    got = {}
    for r in sorted(rows, key=lambda r: (r["id"], r["rank"])):
        got.setdefault(r["id"], []).append(r["neighbor_id"])
    assert got == brute_force(ids, matrix, 3)


def test_nearest_with_few_points(spark):
    df = spark.createDataFrame([(1, [0.0]), (2, [1.0])], "id long, v array<double>")
    assert {(r["id"], r["neighbor_id"]) for r in neighbors.nearest(df, 5).collect()} == {(1, 2), (2, 1)}
    assert neighbors.nearest(df.filter("id > 5"), 5).count() == 0


def test_smote_balances_and_stays_on_the_segments(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(v) for v in rng.normal(0, 1, 3)], int(i < 12)) for i in range(53)]
    df = spark.createDataFrame(rows, "id long, v array<double>, y int")
    new = neighbors.smote_rows(df, k=4).collect()
    assert len(new) == 41 - 12
    points = {i: np.array(v) for i, v, _ in rows}
    for r in new:
        line = points[r["base_id"]] + r["step"] * (points[r["neighbor_id"]] - points[r["base_id"]])
        assert r["base_id"] < 12 and r["neighbor_id"] < 12
        assert np.allclose(r["v"], line)
    both = neighbors.oversample(df, k=4)
    assert {r["y"]: r["count"] for r in both.groupBy("y").count().collect()} == {0: 41, 1: 41}
    assert both.select("id").distinct().count() == 82


def test_tomek_links_are_mutual_and_mixed(spark):
    df = spark.createDataFrame(
        [(1, [0.0], 0), (2, [0.1], 1), (3, [5.0], 0), (4, [5.1], 0), (5, [9.0], 1)], "id long, v array<double>, y int"
    )
    assert [(r["id"], r["neighbor_id"]) for r in neighbors.tomek_links(df).collect()] == [(1, 2)]
    assert sorted(r["id"] for r in neighbors.drop_tomek(df).collect()) == [3, 4, 5]


def scores(spark, rows):
    return spark.createDataFrame(rows, "label int, score double")


def test_auc_counts_ties_half(spark):
    df = scores(spark, [(1, 0.9), (1, 0.5), (0, 0.5), (0, 0.1)])
    assert evaluate.roc_auc(df, "label", "score").first()["auc"] == pytest.approx(3.5 / 4)
    flipped = df.withColumn("score", 1 - F.col("score"))
    assert evaluate.roc_auc(flipped, "label", "score").first()["auc"] == pytest.approx(0.5 / 4)
    assert evaluate.roc_auc(df.filter("label = 1"), "label", "score").first()["auc"] is None


def test_auc_matches_all_pairs(spark):
    rng = np.random.default_rng(9)
    rows = [(int(rng.random() < 0.3), float(np.round(rng.normal(), 2))) for _ in range(500)]
    pos = [s for y, s in rows if y]
    neg = [s for y, s in rows if not y]
    expected = np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg])
    assert evaluate.roc_auc(scores(spark, rows), "label", "score").first()["auc"] == pytest.approx(expected)


def test_roc_curve_ends_at_one(spark):
    rows = evaluate.roc_curve(scores(spark, [(1, 0.9), (0, 0.5), (1, 0.4)]), "label", "score").orderBy("threshold").collect()
    assert [(r["threshold"], r["fpr"], r["tpr"]) for r in rows] == [(0.4, 1.0, 1.0), (0.5, 1.0, 0.5), (0.9, 0.0, 0.5)]


def test_classification_report(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b"), ("c", "b")], "label string, prediction string")
    rows = {r["label"]: r for r in evaluate.classification_report(df).collect()}
    assert (rows["a"]["precision"], rows["a"]["recall"], rows["a"]["support"]) == (1.0, 0.5, 2)
    assert (rows["b"]["precision"], rows["c"]["precision"]) == (pytest.approx(1 / 3), 0.0)
    assert rows["accuracy"]["precision"] == 0.5
    assert rows["weighted avg"]["recall"] == 0.5
    matrix = {r["label"]: r for r in evaluate.confusion_matrix(df, ["a", "b", "c"]).collect()}
    assert (matrix["a"]["predicted_b"], matrix["c"]["predicted_c"]) == (1, 0)
    assert {r["label"]: r["accuracy"] for r in evaluate.per_class_accuracy(df).collect()}["b"] == 0.5


def test_risk_score_bounds_and_order(spark):
    df = spark.createDataFrame([(p / 50,) for p in range(51)], "p double")
    got = [r[0] for r in df.orderBy("p").select(scoring.risk_score(F.col("p"))).collect()]
    assert got[0] == 999 and got[-1] == 1
    assert got == sorted(got, reverse=True)


def test_rounding_is_half_to_even(spark):
    df = spark.createDataFrame([(2.5,), (3.5,)], "x double")
    assert [r[0] for r in df.select(F.bround("x")).collect()] == [2.0, 4.0]


def test_ensembles(spark):
    df = spark.createDataFrame([(0.2, 0.7), (0.4, 0.1)], "a double, b double")
    assert [r["ensemble_prediction"] for r in scoring.ensemble_max(df, ["a", "b"]).collect()] == [1, 0]
    out = scoring.ensemble_weighted(df, {"a": 3.0, "b": 1.0}).collect()
    assert out[0]["ensemble_probability"] == pytest.approx(0.325)


def test_reason_codes_signed_and_absolute(spark):
    df = spark.createDataFrame([(1.0, -5.0, 2.0, 0.0)], "a double, b double, c double, d double")
    parts = {c: F.col(c) for c in "abcd"}
    signed = scoring.reason_codes(df, parts).first()
    assert [signed[f"top_{i}_feature"] for i in (1, 2, 3)] == ["c", "a", "d"]
    absolute = scoring.reason_codes(df, parts, by="abs").first()
    assert [absolute[f"top_{i}_feature"] for i in (1, 2, 3)] == ["b", "c", "a"]
    assert absolute["top_1_score"] == -5.0


def test_final_scores_keep_unscored_consumers(spark):
    ids = spark.createDataFrame([(1,), (2,)], "consumer_id long")
    scored = spark.createDataFrame(
        [(1, 700, "a", "b", "c")], "consumer_id long, score int, top_1_feature string, top_2_feature string, top_3_feature string"
    )
    rows = scoring.final_scores(ids, scored, scored).collect()
    assert [(r["consumer_id"], r["credit_score"], r["non_credit_top_1_feature"]) for r in rows] == [(1, 700, "a"), (2, None, None)]


def test_tomek_links_search_once(spark):
    """The search is done before the links are read from both ends; no plan after it holds it or joins by whole vectors."""
    rows = [(i, [float(i * i % 7), float(i)], int(i % 3 == 0)) for i in range(30)]
    df = spark.createDataFrame(rows, "id long, v array<double>, y int")
    plan = neighbors.drop_tomek(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "CoGroup" not in plan and "Join Inner, (v" not in plan


def test_nearest_lists_copies_of_any_number(spark):
    """Groups of fewer and of more copies than neighbours are found in two ways; both agree with brute force."""
    points = [(i, [0.0, 1.0]) for i in range(2)] + [(i, [0.0, -0.0]) for i in range(2, 9)] + [(9, [0.0, 0.0]), (10, [5.0, 5.0])]
    df = spark.createDataFrame(points, "id long, v array<double>")
    found = {}
    for r in neighbors.nearest(df, 3).collect():
        found.setdefault(r["id"], {})[r["rank"]] = (r["distance"], r["neighbor_id"])
    for i, v in points:
        others = sorted((sum((a - b) ** 2 for a, b in zip(v, w)) ** 0.5, j) for j, w in points if j != i)
        assert found[i] == dict(enumerate(others[:3], 1))
