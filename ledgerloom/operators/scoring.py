"""Ensembles, the 1-999 score, reason codes and the final score table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.columns import one_row
from ledgerloom.operators.profile import histogram

KEY = "consumer_id"


def risk_score(probability: Column) -> Column:
    """1 (certain default) to 999 (certain payment), rounding half to even."""
    first = F.bround(F.lit(1.0) + probability * 998.0)
    return F.bround(F.lit(1.0) + (F.lit(999.0) - first)).cast("int")


def ensemble_max(df: DataFrame, probabilities: Sequence[str], cut: float = 0.5) -> DataFrame:
    """Largest member probability, and the class at the cut."""
    top = F.greatest(*[F.col(p) for p in probabilities]) if len(probabilities) > 1 else F.col(probabilities[0])
    return df.withColumn("ensemble_probability", top).withColumn("ensemble_prediction", (top > cut).cast("int"))


def ensemble_weighted(df: DataFrame, weights: Mapping[str, float], cut: float = 0.5) -> DataFrame:
    """Mean of the member probabilities weighted by, for example, their areas."""
    total = sum(weights.values())
    mean = sum((F.col(p) * F.lit(w / total) for p, w in weights.items()), F.lit(0.0))
    return df.withColumn("ensemble_probability", mean).withColumn("ensemble_prediction", (mean > cut).cast("int"))


def linear_contributions(
    coefficients: Mapping[str, float], means: Mapping[str, Column | float], stds: Mapping[str, Column | float]
) -> dict[str, Column]:
    """Additive contribution of each feature in a linear model: coefficient * standardised value.

    Positive raises the risk. A constant feature contributes 0.
    """

    def as_column(x: Column | float) -> Column:
        return x if isinstance(x, Column) else F.lit(float(x))

    return {
        f: F.coalesce(
            F.try_divide(F.col(f"`{f}`").cast("double") - as_column(means[f]), as_column(stds[f])) * F.lit(float(c)),
            F.lit(0.0),
        )
        for f, c in coefficients.items()
    }


def with_moments(
    df: DataFrame, features: Sequence[str], fitted_on: DataFrame | None = None
) -> tuple[DataFrame, dict[str, Column], dict[str, Column]]:
    """The table with the features' means and population standard deviations attached as one struct
    (``_moments``, from ``fitted_on`` if given), and the columns that read them."""
    parts = []
    for i, f in enumerate(features):
        value = F.col(f"`{f}`").cast("double")
        parts += [F.avg(value).alias(f"m{i}"), F.stddev_pop(value).alias(f"s{i}")]
    stats = one_row(df if fitted_on is None else fitted_on, *parts)
    return (
        df.withColumn("_moments", stats),
        {f: F.col(f"_moments.m{i}") for i, f in enumerate(features)},
        {f: F.col(f"_moments.s{i}") for i, f in enumerate(features)},
    )


def reason_codes(df: DataFrame, contributions: Mapping[str, Column], top: int = 3, by: str = "signed") -> DataFrame:
    """The ``top`` features with the largest contribution per row, and their values.

    ``by="signed"`` ranks by the contribution, ``"abs"`` by its size; ties by feature name.
    """
    entries = F.array(
        *[
            F.struct(
                (-(F.abs(c) if by == "abs" else c)).alias("rank"), F.lit(f).alias("feature"), c.alias("value")
            )
            for f, c in contributions.items()
        ]
    )
    best = df.withColumn("_best", F.slice(F.array_sort(entries), 1, top))
    for i in range(top):
        entry = F.get(F.col("_best"), F.lit(i))
        best = best.withColumn(f"top_{i + 1}_feature", entry.getField("feature")).withColumn(
            f"top_{i + 1}_score", entry.getField("value")
        )
    return best.drop("_best")


def global_contributions(df: DataFrame, contributions: Mapping[str, Column], top: int = 5) -> DataFrame:
    """Features by mean absolute contribution."""
    wide = df.agg(*[F.avg(F.abs(c)).alias(f) for f, c in contributions.items()])
    long = wide.unpivot([], [F.col(f"`{f}`") for f in contributions], "feature", "mean_abs_contribution")
    return long.orderBy(F.desc("mean_abs_contribution"), "feature").limit(top)


def reason_code_frequency(scored: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """How often each feature is among the reason codes."""
    columns = list(columns or ("top_1_feature", "top_2_feature", "top_3_feature"))
    long = scored.select(F.explode(F.array(*columns)).alias("feature")).filter(F.col("feature").isNotNull())
    return long.groupBy("feature").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "feature")


def score_histogram(scored: DataFrame, score: str = "score", bins: int = 10) -> DataFrame:
    return histogram(scored, score, bins, low=F.lit(1.0), high=F.lit(999.0))


def count_below(scored: DataFrame, cut: int, score: str = "score") -> DataFrame:
    return scored.agg(F.count_if(F.col(score) < cut).alias("n_below"))


def final_scores(consumers: DataFrame, with_credit: DataFrame, without_credit: DataFrame) -> DataFrame:
    """Both score sets for every consumer to be scored (null where one was not scored), sorted by id."""

    def named(scored: DataFrame, prefix: str) -> DataFrame:
        return scored.select(
            KEY,
            F.col("score").alias(f"{prefix}_score"),
            *[F.col(f"top_{i}_feature").alias(f"{prefix}_top_{i}_feature") for i in (1, 2, 3)],
        )

    ids = consumers.select(KEY)
    left = ids.join(named(with_credit, "credit"), KEY, "full_outer")
    right = ids.join(named(without_credit, "non_credit"), KEY, "full_outer")
    return left.join(right, KEY).orderBy(KEY)
