"""The skew-safe paths give the same rows as plain windows and built-in percentiles."""

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerloom.functions.columns import net_amount, value_range
from ledgerloom.operators import quantiles, scan


def skewed_ledger(spark, n=3000):
    """One consumer holds most rows, and one of its days holds a third of them."""
    row = F.col("id")
    return spark.range(n).select(
        row.alias("txn_id"),
        F.when(row % 10 < 8, 1).otherwise(row % 7 + 2).cast("long").alias("consumer_id"),
        ((row * 7919) % 1000 / 4).cast("decimal(18,2)").alias("amount"),
        F.when(row % 2 == 0, "CREDIT").otherwise("DEBIT").alias("credit_or_debit"),
        F.expr("date_add(date'2024-01-01', cast(CASE WHEN id % 3 = 0 THEN 10 ELSE id % 40 END AS int))").alias(
            "posted_date"
        ),
    )


def plain(df):
    w = Window.partitionBy("consumer_id").orderBy("posted_date", "txn_id").rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("expected", F.sum("signed").over(w))


@pytest.mark.parametrize("max_rows", [1_000_000, 100, 7])
def test_prefix_sums_match_a_plain_window(spark, max_rows):
    df = skewed_ledger(spark).withColumn("signed", net_amount())
    mine = scan.ledger_prefix_sums(df, ["consumer_id"], "posted_date", "txn_id", ["signed"], max_rows)
    both = mine.join(plain(df).select("txn_id", "expected"), "txn_id")
    assert both.count() == df.count()
    assert both.filter(F.col("signed_upto") != F.col("expected")).count() == 0


@pytest.mark.parametrize("outlier", [0, 10**15])
def test_hot_day_is_cut_into_bounded_ranges(spark, outlier):
    df = skewed_ledger(spark, 10_000).withColumn("posted_date", F.to_date(F.lit("2024-01-01")))
    df = df.withColumn("txn_id", F.when(F.col("txn_id") == 5, F.col("txn_id") + outlier).otherwise(F.col("txn_id")))
    cut = scan.cut_ranges(df, ["consumer_id"], ["posted_date", "txn_id"], 100)
    assert cut.groupBy(scan.RANGE).count().agg(F.max("count")).first()[0] <= 300
    assert cut.count() == df.count()


def test_text_ids_are_ordered_by_themselves(spark):
    df = spark.createDataFrame([(str(i), 1, "2024-01-01", i) for i in (3, 1, 5, 2, 4)], "txn_id string, consumer_id int, posted_date string, v long")
    out = scan.ledger_prefix_sums(df, ["consumer_id"], "posted_date", "txn_id", ["v"], 2)
    assert [r["v_upto"] for r in out.orderBy("txn_id").collect()] == [1, 3, 6, 10, 15]


def test_null_heavy_group_has_exact_quantiles(spark):
    df = spark.range(100_000).select(F.lit(1).alias("k"), F.when(F.col("id") < 5, F.col("id")).cast("double").alias("v"))
    got = quantiles.group_stats(df, ["k"], "v", [0.5, 1.0], [F.count(F.lit(1)).alias("n")], max_group_rows=100).first()
    assert (got["n"], got["quantiles"]) == (100_000, [2.0, 4.0])


def test_text_tie_break_has_a_fixed_order(spark):
    df = skewed_ledger(spark).withColumn("txn_id", F.concat(F.lit("t"), F.col("txn_id"))).withColumn(
        "signed", net_amount()
    )
    runs = [
        {
            r["txn_id"]: r["signed_upto"]
            for r in scan.ledger_prefix_sums(d, ["consumer_id"], "posted_date", "txn_id", ["signed"], m).collect()
        }
        for d, m in ((df, 1_000_000), (df.repartition(7), 50))
    ]
    assert runs[0] == runs[1]


def test_per_key_attributes_reach_every_row(spark):
    df = skewed_ledger(spark).withColumn("signed", net_amount())
    names = df.select("consumer_id").distinct().withColumn("name", F.concat(F.lit("c"), F.col("consumer_id")))
    out = scan.ledger_prefix_sums(df, ["consumer_id"], "posted_date", "txn_id", ["signed"], 100, per_key=names)
    assert out.filter(F.col("name") == F.concat(F.lit("c"), F.col("consumer_id"))).count() == df.count()


def test_rows_without_key_or_day_are_dropped(spark):
    df = spark.sql(
        "select * from values (1L, 1L, date'2024-01-01', 1), (2L, null, date'2024-01-01', 1), (3L, 1L, null, 1)"
        " as t(txn_id, consumer_id, posted_date, v)"
    )
    assert scan.ledger_prefix_sums(df, ["consumer_id"], "posted_date", "txn_id", ["v"]).count() == 1


PROBES = [0.0, 0.01, 0.25, 0.5, 0.75, 0.98, 1.0]


@pytest.mark.parametrize("max_rows", [1_000_000, 50])
def test_group_quantiles_match_numpy(spark, max_rows):
    rng = np.random.default_rng(3)
    rows = [("a", float(x)) for x in rng.lognormal(3, 2, 700)] + [("b", float(x)) for x in -rng.lognormal(1, 1, 90)]
    rows += [("c", 5.0)] * 200 + [("d", float(x)) for x in rng.normal(0, 1, 301)] + [("e", 1.5), ("f", None)]
    df = spark.createDataFrame(rows, "g string, x double")
    got = {
        r["g"]: r["quantiles"]
        for r in quantiles.group_stats(df, ["g"], "x", PROBES, [F.count("x").alias("n")], max_group_rows=max_rows).collect()
    }
    for g in "abcde":
        values = [x for k, x in rows if k == g]
        assert np.allclose(got[g], np.quantile(values, PROBES), rtol=1e-12)


@pytest.mark.parametrize("max_rows", [1_000_000, 20])
def test_column_quantiles_ignore_null_and_nan(spark, max_rows):
    values = [3.0, -1.0, 0.0, 7.5, 7.5, 1e9, -1e-9] * 9
    df = spark.createDataFrame([(v,) for v in values] + [(None,), (float("nan"),)], "x double")
    got = quantiles.column_quantiles(df, "x", PROBES, max_group_rows=max_rows).first()[0]
    assert np.allclose(got, np.quantile(values, PROBES))


def test_value_range_keeps_the_order(spark):
    rng = np.random.default_rng(1)
    values = np.concatenate([rng.normal(0, 1, 300), rng.lognormal(0, 20, 300), -rng.lognormal(0, 20, 300), [0.0]])
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    pairs = sorted((r["x"], r["r"]) for r in df.select("x", value_range("x").alias("r")).collect())
    buckets = [b for _, b in pairs]
    assert buckets == sorted(buckets)
