"""A margin classifier with a Gaussian kernel: random Fourier features, a linear margin on them, calibrated probabilities.

The inner product of sqrt(2 / D) cos(w x + b) over D random directions w and phases b approaches exp(-gamma |x - x'|^2)
(error about 1 / sqrt(D)), so that a linear model on D numbers stands for the kernel, whatever the number of rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml.classification import LinearSVC, LinearSVCModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators import sampling
from ledgerloom.plans import screening
from ledgerloom.session import cut_lineage


def _numbers(values: np.ndarray) -> Column:
    return F.array(*[F.lit(float(x)) for x in values])


@dataclass(frozen=True)
class FourierMap:
    """``directions[D, features]`` and ``phases[D]``."""

    directions: np.ndarray
    phases: np.ndarray

    @classmethod
    def draw(cls, width: int, gamma: float, size: int, seed: int) -> FourierMap:
        rng = np.random.default_rng(seed)
        return cls(rng.normal(0.0, np.sqrt(2.0 * gamma), (size, width)), rng.uniform(0.0, 2 * np.pi, size))

    def apply(self, values: Column) -> Column:
        """``array<double>`` of the features of an ``array<double>``, computed in the JVM."""
        rows = F.array(*[F.struct(_numbers(w).alias("w"), F.lit(float(b)).alias("b")) for w, b in zip(self.directions, self.phases, strict=True)])
        product = lambda row: F.aggregate(F.zip_with(row["w"], values, lambda w, x: w * x), row["b"], lambda done, x: done + x)
        return F.transform(rows, lambda row: float(np.sqrt(2.0 / len(self.phases))) * F.cos(product(row)))


@dataclass(frozen=True)
class KernelMargin:
    map: FourierMap
    model: LinearSVCModel
    calibration: screening.SingleModel

    def score(self, df: DataFrame, vector: str = "features") -> DataFrame:
        """Add ``margin`` and ``probability``, which grows with the margin."""
        mapped = df.withColumn("_z", self.map.apply(vector_to_array(vector)))
        total = F.zip_with("_z", _numbers(self.model.coefficients.toArray()), lambda z, c: z * c)
        scored = mapped.withColumn("margin", F.aggregate(total, F.lit(float(self.model.intercept)), lambda done, x: done + x))
        return scored.withColumn("probability", self.calibration.probability(F.col("margin"))).drop("_z")


def fit_kernel_margin(
    train: DataFrame, label: str, key: str, vector: str = "features", size: int = 512, gamma: float | None = None, cost: float = 1.0,
    max_iter: int = 100, seed: int = 42,
) -> KernelMargin:
    """Fit on ``train(key, label, vector)``. ``gamma`` is one over the number of features, as for scaled features, if not given.

    The sigmoid is fitted on the margins that a model of four fifths of the keys gives the other fifth; the margin itself
    on all rows. Rows with a null label are left out; both classes must be there.
    """
    rows = train.filter(F.col(label).isNotNull()).select(key, F.col(label).cast("double").alias("label"), F.col(vector).alias("_v"))
    first = rows.select(F.size(vector_to_array("_v")).alias("n")).first()
    if first is None:
        raise ValueError("no rows with a label")
    fourier = FourierMap.draw(first["n"], gamma or 1.0 / first["n"], size, seed)
    mapped = cut_lineage(rows.withColumn("features", array_to_vector(fourier.apply(vector_to_array("_v")))))
    sides = sampling.split_side(mapped, key)

    def fitted(part: DataFrame) -> LinearSVCModel:
        strength = 1.0 / (cost * max(1, part.count()))
        return LinearSVC(maxIter=max_iter, regParam=strength, standardization=False).fit(part.select("label", "features"))

    held = fitted(sides.filter("side = 'train'")).transform(sides.filter("side = 'test'"))
    margins = held.select("label", vector_to_array("rawPrediction")[1].alias("margin"))
    (calibration,) = screening.fit_singles(margins, ["margin"], "label", l2=0.0, balanced=False, max_iter=50)
    return KernelMargin(fourier, fitted(mapped), calibration)
