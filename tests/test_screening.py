"""Single-feature models fitted together against separate fits."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.plans import screening


def separate(x, y, l2=1.0, balanced=True):
    """Newton steps on the centred feature alone."""
    keep = ~np.isnan(x)
    share = {c: len(y) / (2 * (y == c).sum()) for c in (0, 1)}
    weight = np.array([share[c] if balanced else 1.0 for c in y])[keep]
    x, y = x[keep], y[keep]
    design = np.stack([np.ones(len(x)), x - x.mean()], 1)
    beta, penalty = np.zeros(2), np.diag([0.0, l2])
    for _ in range(100):
        p = 1 / (1 + np.exp(-design @ beta))
        gradient = design.T @ (weight * (p - y)) + penalty @ beta
        beta = beta - np.linalg.solve(design.T @ (design * (weight * p * (1 - p))[:, None]) + penalty, gradient)
    return beta


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(4)
    y = (rng.random(400) < 0.3).astype(int)
    x = np.stack([rng.normal(y, 1), 1000 * rng.normal(0, 1, 400) - 500 * y + 1e5, rng.normal(0, 1e-2, 400), y * 4 + rng.normal(0, 0.5, 400)], 1)
    x[::13, 0] = np.nan
    return y, x


@pytest.fixture(scope="module")
def frame(spark, rows):
    data = [(int(c), *[None if np.isnan(z) else float(z) for z in v], 7.0, None, "x") for c, v in zip(*rows)]
    data += [(None, 1.0, 1.0, 1.0, 1.0, 7.0, None, "x"), (0, float("nan"), 1e5, 0.0, 0.0, 7.0, None, "x")]
    schema = "label int, a double, b double, c double, `d.e` double, f double, g double, v string"
    return spark.createDataFrame(data, schema).repartition(3)


@pytest.mark.parametrize("balanced", [True, False])
def test_models_equal_separate_fits(frame, rows, balanced):
    y, x = np.append(rows[0], 0), np.vstack([rows[1], [np.nan, 1e5, 0.0, 0.0]])
    models = screening.fit_singles(frame, ["a", "b", "c", "d.e"], "label", balanced=balanced)
    for i, model in enumerate(models):
        intercept, slope = separate(x[:, i], y, balanced=balanced)
        assert (model.intercept, model.slope / model.std) == pytest.approx((intercept, slope), abs=1e-6)
        assert model.rows == (~np.isnan(x[:, i])).sum()


def test_constant_and_empty_features(frame):
    constant, empty = screening.fit_singles(frame, ["f", "g"], "label", balanced=False)
    share = frame.filter("label is not null").agg(F.avg("label")).first()[0]
    assert constant.slope == 0.0 and constant.intercept == pytest.approx(np.log(share / (1 - share)))
    assert (empty.rows, empty.intercept, empty.slope) == (0, 0.0, 0.0)


def test_one_class_no_rows_no_features(frame):
    for some in (frame.filter("label = 1"), frame.limit(0)):
        (model,) = screening.fit_singles(some, ["a"], "label")
        assert (model.intercept, model.slope) == (0.0, 0.0)
    assert screening.fit_singles(frame, [], "label") == []


def test_screen_ranks_the_features(frame):
    table = [r.asDict() for r in screening.screen(frame, frame, ["a", "b", "c", "d.e", "f", "g"], "label").collect()]
    order = [r["feature"] for r in table]
    assert order[:2] == ["d.e", "a"] and table[0]["logistic_auc"] > 0.99
    by_name = {r["feature"]: r["logistic_auc"] for r in table}
    assert by_name["f"] == 0.5 and by_name["g"] is None and by_name["b"] > 0.55
