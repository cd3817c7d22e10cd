"""Every feature tried alone: the logistic models of all features are fitted together, one aggregate per Newton step.

A row is exploded into (feature, value) pairs, which are summed per feature to gradient, curvature and loss on the map
side, so that a step shuffles five numbers per feature and task, and the number of passes does not depend on the number
of features. The driver holds two coefficients per feature.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators import evaluate
from ledgerloom.session import discard, staged


@dataclass(frozen=True)
class SingleModel:
    """P(1) = 1 / (1 + exp(-(intercept + slope * (x - mean) / std))). ``std`` is 1 for a constant feature."""

    feature: str
    rows: int
    mean: float
    std: float
    intercept: float
    slope: float
    loss: float

    def probability(self, x: Column) -> Column:
        return 1.0 / (1.0 + F.exp(-(self.intercept + self.slope * (x - self.mean) / self.std)))


def _pairs(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """``(y, v array)`` of the rows with a label; values that are null or not a number become null."""
    value = lambda f: F.nanvl(F.col(f"`{f}`").cast("double"), F.lit(None).cast("double"))
    return df.filter(F.col(label).isNotNull()).select(F.col(label).cast("int").alias("y"), F.array(*[value(f) for f in features]).alias("v"))


def fit_singles(
    df: DataFrame, features: Sequence[str], label: str, l2: float = 1.0, balanced: bool = True, max_iter: int = 1000, tolerance: float = 1e-9,
) -> list[SingleModel]:
    """One logistic model per feature; ``l2`` / 2 times the squared slope of the feature as it is adds to the summed loss.

    With ``balanced`` the rows weigh rows / (2 * rows of the class), counted over all rows with a label. A feature's null
    values (or NaN) are left out of its model; a feature without values, and any feature if there are less than two
    classes, gets slope and intercept 0; a constant one gets an intercept only. A step that does not lower a feature's
    loss is halved, so that the fit cannot run away. Ends when no coefficient moves by more than ``tolerance``.
    """
    features = list(features)
    if not features:
        return []
    held = staged(_pairs(df, features, label), "screening")
    sizes = {r["y"]: r["n"] for r in held.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    whole = sum(sizes.values())
    exploded = held.select("y", F.posexplode("v").alias("f", "x")).filter("x is not null")
    n, mean, std = np.zeros(len(features), np.int64), np.zeros(len(features)), np.ones(len(features))
    for r in exploded.groupBy("f").agg(F.count("x").alias("n"), F.avg("x").alias("m"), F.stddev_pop("x").alias("s")).collect():
        n[r["f"]], mean[r["f"]], std[r["f"]] = r["n"], r["m"], r["s"]
    constant = ~(std > 1e-12 * np.abs(mean))
    std = np.where(constant, 1.0, std)
    penalty = l2 / std**2
    at, best = np.zeros((len(features), 2)), np.zeros((len(features), 2))
    loss = np.full(len(features), np.inf)
    weight = F.when(F.col("y") == 1, whole / max(1, 2 * sizes.get(1, 0))).otherwise(whole / max(1, 2 * sizes.get(0, 0))) if balanced else F.lit(1.0)
    moving = np.flatnonzero(n > 0) if len(sizes) > 1 else np.zeros(0, np.int64)
    for _ in range(max_iter):
        if not len(moving):
            break
        numbers = lambda values: F.get(F.array(*[F.lit(float(x)) for x in values]), F.col("f"))
        x = (F.col("x") - numbers(mean)) / numbers(std)
        wanted = F.col("f").isin(moving.tolist())
        rows = exploded.filter(wanted).select("f", "y", x.alias("x"), weight.alias("c"), numbers(at[:, 0]).alias("b"), numbers(at[:, 1]).alias("w"))
        rows = rows.withColumn("m", F.col("b") + F.col("w") * F.col("x")).withColumn("p", 1.0 / (1.0 + F.exp(-F.col("m"))))
        first, second = F.col("c") * (F.col("p") - F.col("y")), F.col("c") * F.col("p") * (1 - F.col("p"))
        # log(1 + exp(m)) - y m, without overflow
        lost = F.greatest("m", F.lit(0.0)) + F.log1p(F.exp(-F.abs("m"))) - F.col("y") * F.col("m")
        sums = rows.groupBy("f").agg(
            F.sum(first).alias("g0"), F.sum(first * F.col("x")).alias("g1"), F.sum(second).alias("h00"),
            F.sum(second * F.col("x")).alias("h01"), F.sum(second * F.col("x") ** 2).alias("h11"), F.sum(F.col("c") * lost).alias("loss"),
        )
        following = []
        for r in sums.collect():
            i = r["f"]
            now = r["loss"] + penalty[i] / 2 * at[i, 1] ** 2
            if now > loss[i] + 1e-12 * abs(loss[i]):
                step = (at[i] - best[i]) / 2
            else:
                best[i], loss[i] = at[i], now
                g1, h11 = r["g1"] + penalty[i] * at[i, 1], r["h11"] + penalty[i]
                det = r["h00"] * h11 - r["h01"] ** 2
                if constant[i]:
                    step = np.array([-r["g0"] / r["h00"], 0.0]) if r["h00"] > 0 else np.zeros(2)
                else:
                    step = -np.array([h11 * r["g0"] - r["h01"] * g1, r["h00"] * g1 - r["h01"] * r["g0"]]) / det if det > 0 else np.zeros(2)
            if np.abs(step).max() > tolerance:
                at[i] = best[i] + step
                following.append(i)
        moving = np.array(sorted(following), np.int64)
    discard(held)
    mean_loss = [float(loss[i] / n[i]) if np.isfinite(loss[i]) else float("nan") for i in range(len(features))]
    return [SingleModel(f, int(n[i]), float(mean[i]), float(std[i]), *map(float, best[i]), mean_loss[i]) for i, f in enumerate(features)]


def screen(train: DataFrame, test: DataFrame, features: Sequence[str], label: str, **settings: float) -> DataFrame:
    """Area under the ROC curve on ``test`` of every feature's own model, best first; null where ``test`` has one class.
    The scores of all features share one stacked pass."""
    spark = train.sparkSession
    models = fit_singles(train, features, label, **settings)
    scores = F.array(*[F.struct(F.lit(m.feature).alias("feature"), m.probability(F.col("v")[i]).alias("p")) for i, m in enumerate(models)])
    long = _pairs(test, features, label).select("y", F.inline(scores))
    area = evaluate.roc_auc(long, "y", "p", ["feature"]).select("feature", F.col("auc").alias("logistic_auc"))
    schema = "feature string, rows long, intercept double, slope double, loss double"
    lines = spark.createDataFrame([(m.feature, m.rows, m.intercept, m.slope, m.loss) for m in models], schema)
    return lines.join(area, "feature", "left").orderBy(F.desc_nulls_last("logistic_auc"), "feature")
