import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import bins, profile, sampling


def values(spark, numbers, target=None):
    rows = [(float(x), float(target[i]) if target else float(i % 2)) for i, x in enumerate(numbers)]
    return spark.createDataFrame(rows, "x double, t double")


def test_equal_width_bins(spark):
    out = bins.target_rate_equal_width(values(spark, [0, 1, 5, 10]), "x", "t", 2).collect()
    assert [(r["bin"], r["n"]) for r in out] == [(1, 3), (2, 1)]


def test_quantile_bins_merge_equal_edges(spark):
    out = bins.target_rate_equal_freq(values(spark, [0, 0, 0, 1, 5, 10]), "x", "t", 3).collect()
    assert [r["n"] for r in out] == [4, 2]


def test_trimmed_bins_drop_outliers(spark):
    out = bins.target_rate_trimmed(values(spark, [-1e6, *range(200), 1e6]), "x", "t", 4).collect()
    assert sum(r["n"] for r in out) < 202


def test_grid_fills_empty_cells_with_one(spark):
    df = spark.createDataFrame([(0.0, 0.0, 0.0), (10.0, 10.0, 0.0)], "a double, b double, t double")
    rows = bins.target_rate_grid(df, "a", "b", "t", 2).collect()
    assert [tuple(r) for r in rows] == [(1, 0.0, 1.0), (2, 1.0, 0.0)]


def test_bands_are_half_open(spark):
    out = bins.target_rate_by_band(values(spark, [300, 324, 325, 350], [1, 0, 1, 1]), "x", "t").collect()
    assert [(r["band_start"], r["n"], r["n_target"]) for r in out] == [(300, 2, 1), (325, 1, 1), (350, 1, 1)]


def test_histogram_closes_the_last_bin(spark):
    rows = profile.histogram(values(spark, [0, 1, 2, 3, 4]), "x", 4).orderBy("bin").collect()
    assert [r["n"] for r in rows] == [1, 1, 1, 2]
    assert sum(r["density"] for r in rows) == pytest.approx(1.0)


def test_column_profile(spark):
    df = spark.sql("select * from values (1, 'a'), (2, null), (2, null) t(x, y)")
    rows = {r["column_name"]: tuple(r)[1:] for r in profile.column_profile(df).collect()}
    assert rows == {"x": ("int", 3, 0, 2), "y": ("string", 3, 2, 2)}


def test_impute_median_handles_infinities(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (float("inf"),), (float("nan"),), (None,)], "x double")
    assert sorted(r["x"] for r in profile.impute_median(df, ["x"]).collect()) == [1.0, 2.0, 2.0, 2.0, 3.0]


def test_drop_null_columns(spark):
    df = spark.sql("select * from values (1, null, 3), (1, 2, 3) t(a, b, c)")
    assert profile.drop_null_columns(df).columns == ["a", "c"]


def test_ks_statistic(spark):
    df = spark.createDataFrame([(1.0, "a"), (2.0, "a"), (2.0, "b"), (3.0, "b")], "x double, s string")
    assert profile.ks_two_sample(df, "x", "s", "a", "b").first()["statistic"] == pytest.approx(0.5)


def test_trims_and_tails(spark):
    df = values(spark, range(101)).withColumn("category", F.lit("A"))
    assert profile.trim_global_quantile(df, "x", 0.95).count() == 95
    assert profile.trim_global_quantile(df, "x", 0.95, "upto").count() == 96
    assert profile.trim_global_quantile(df, "x", 0.95, "above").count() == 5
    assert profile.tail_by_category(df, "category", "x", 0.98).count() == 2


def test_top_memo_breaks_ties_by_text(spark):
    df = spark.createDataFrame([("A", "y"), ("A", "x"), ("B", "z")], "category string, memo string")
    assert {tuple(r) for r in profile.top_memo_per_category(df).collect()} == {("A", "x", 1), ("B", "z", 1)}


def test_splits_do_not_depend_on_partitioning(spark):
    df = spark.range(500).withColumnRenamed("id", "key").withColumn("label", F.col("key") % 3)
    one = sampling.split_stratified(df, "label", "key")
    two = sampling.split_stratified(df.repartition(11), "label", "key")
    assert one.exceptAll(two).count() == 0
    for r in one.groupBy("label").agg(F.count_if(F.col("side") == "train").alias("t"), F.count("*").alias("n")).collect():
        assert r["t"] == r["n"] * 80 // 100


def test_take_by_hash_extremes(spark):
    df = spark.range(300).withColumnRenamed("id", "key").withColumn("label", F.when(F.col("key") < 290, 0).otherwise(1))
    assert sampling.take_by_hash(df, "label", "key", F.lit(0)).filter("taken").count() == 0
    assert sampling.take_by_hash(df, "label", "key", F.lit(1000)).filter("taken").count() == 300
    under = sampling.undersample(df, "label", "key").groupBy("label").count().collect()
    assert {r["label"]: r["count"] for r in under} == {0: 10, 1: 10}


def test_class_weights(spark):
    df = spark.createDataFrame([(0,), (0,), (0,), (1,)], "y int")
    assert {r["y"]: r["weight"] for r in sampling.class_weights(df, "y").collect()} == {
        0: pytest.approx(4 / 6),
        1: pytest.approx(2.0),
    }
    assert sampling.positive_weight(df, "y").first()[0] == 3.0
    assert sampling.positive_weight(df, "y", "rows").first()[0] == 4.0
