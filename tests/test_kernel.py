"""The kernel margin model on data that no line separates."""

import numpy as np
import pytest
from pyspark.ml.classification import LinearSVC
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from ledgerloom.plans import kernel


@pytest.fixture(scope="module")
def ring(spark):
    rng = np.random.default_rng(2)
    angle, y = rng.uniform(0, 2 * np.pi, 500), (rng.random(500) < 0.5).astype(int)
    radius = np.where(y == 1, 0.7, 2.0) + rng.normal(0, 0.25, 500)
    data = [(i, int(c), [float(r * np.cos(a)), float(r * np.sin(a))], "x") for i, (c, r, a) in enumerate(zip(y, radius, angle))]
    df = spark.createDataFrame([*data, (900, None, [0.0, 0.0], "x")], "id long, label int, v array<double>, margin string").repartition(3)
    return df.drop("margin").withColumn("features", array_to_vector("v"))


def test_features_approach_the_kernel(spark):
    fourier = kernel.FourierMap.draw(3, 0.5, 4000, 1)
    points = np.random.default_rng(0).normal(0, 1, (6, 3))
    df = spark.createDataFrame([(i, [float(x) for x in p]) for i, p in enumerate(points)], "i int, v array<double>")
    z = np.array([r.z for r in df.select("i", fourier.apply(F.col("v")).alias("z")).orderBy("i").collect()])
    want = np.exp(-0.5 * ((points[:, None] - points[None]) ** 2).sum(axis=2))
    assert np.abs(z @ z.T - want).max() < 0.06
    assert np.allclose(z, np.sqrt(2 / 4000) * np.cos(points @ fourier.directions.T + fourier.phases))


def test_a_ring_is_separated_where_a_line_fails(ring):
    model = kernel.fit_kernel_margin(ring, "label", "id", size=60, max_iter=12)
    rows = model.score(ring).select("id", "label", "margin", "probability").collect()
    known = [r for r in rows if r.label is not None]
    assert len(rows) == 501 and np.mean([(r.margin > 0) == r.label for r in known]) > 0.95
    line = LinearSVC(maxIter=12).fit(ring.filter("label is not null")).transform(ring.filter("label is not null"))
    assert line.agg(F.avg((F.col("prediction") == F.col("label")).cast("int"))).first()[0] < 0.7
    ordered = sorted(rows, key=lambda r: r.margin)
    assert all(0 <= a.probability <= b.probability <= 1 for a, b in zip(ordered, ordered[1:]))
    assert np.mean([(r.probability - r.label) ** 2 for r in known]) < 0.06


def test_no_labelled_rows_are_refused(ring):
    with pytest.raises(ValueError, match="no rows"):
        kernel.fit_kernel_margin(ring.limit(0), "label", "id")
