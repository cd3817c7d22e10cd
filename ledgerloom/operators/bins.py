"""Target rates by bins of a feature."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.columns import equal_width_bin, one_row
from ledgerloom.operators.quantiles import column_quantiles


def _rates(df: DataFrame, bin_number: Column, target: str) -> DataFrame:
    return (
        df.withColumn("bin", bin_number)
        .filter(F.col("bin").isNotNull())
        .groupBy("bin")
        .agg(F.count(F.lit(1)).alias("n"), F.avg(target).alias("target_rate"))
        .orderBy("bin")
    )


def target_rate_by_band(df: DataFrame, feature: str, target: str, width: int = 25) -> DataFrame:
    """Share of rows with target 1 in half-open bands that start at the smallest value."""
    low = one_row(df, F.min(feature).alias("low")).getField("low")
    band = F.floor((F.col(feature) - low) / width).cast("int")
    return (
        df.filter(F.col(feature).isNotNull())
        .groupBy(band.alias("band"), (low + band * width).alias("band_start"))
        .agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(target) == 1).alias("n_target"))
        .withColumn("target_rate", F.col("n_target") / F.col("n"))
        .orderBy("band")
    )


def target_rate_equal_width(df: DataFrame, feature: str, target: str, bins: int = 10) -> DataFrame:
    """Mean target in right-closed bins of equal width over the feature's range; empty bins are left out."""
    value = F.col(feature).cast("double")
    bounded = df.withColumn("_b", one_row(df, F.min(value).alias("low"), F.max(value).alias("high")))
    return _rates(bounded, equal_width_bin(value, F.col("_b.low"), F.col("_b.high"), bins), target)


def target_rate_equal_freq(df: DataFrame, feature: str, target: str, bins: int = 10) -> DataFrame:
    """Mean target in right-closed bins between quantiles; equal edges are merged."""
    edges = column_quantiles(df, feature, [i / bins for i in range(bins + 1)]).scalar()
    value = F.round(F.col(feature).cast("double"), 9)
    edge = [F.round(F.col("_edges")[i], 9) for i in range(bins + 1)]
    below = sum(
        (((e < value) & (F.lit(True) if i == 0 else e != edge[i - 1])).cast("int") for i, e in enumerate(edge)),
        F.lit(0),
    )
    return _rates(df.withColumn("_edges", edges), F.when(value.isNotNull(), F.greatest(F.lit(1), below)), target)


def target_rate_trimmed(df: DataFrame, feature: str, target: str, bins: int = 10) -> DataFrame:
    """Equal-width bins between the 1st and 99th percentile; values outside are dropped."""
    edges = column_quantiles(df, feature, [0.01, 0.99]).scalar()
    number = F.col(feature).cast("double")
    return _rates(df.withColumn("_q", edges), equal_width_bin(number, F.col("_q")[0], F.col("_q")[1], bins), target)


def target_rate_grid(df: DataFrame, rows: str, columns: str, target: str, bins: int = 5) -> DataFrame:
    """Mean target by bins of two features; combinations without a rate count as 1.0."""
    row, column = F.col(rows).cast("double"), F.col(columns).cast("double")
    bounds = one_row(
        df, F.min(row).alias("rl"), F.max(row).alias("rh"), F.min(column).alias("cl"), F.max(column).alias("ch")
    )
    binned = (
        df.withColumn("_b", bounds)
        .withColumn("row_bin", equal_width_bin(row, F.col("_b.rl"), F.col("_b.rh"), bins))
        .withColumn("_c", equal_width_bin(column, F.col("_b.cl"), F.col("_b.ch"), bins))
    )
    numbers = list(range(1, bins + 1))
    grid = (
        binned.filter(F.col("row_bin").isNotNull() & F.col("_c").isNotNull())
        .groupBy("row_bin")
        .pivot("_c", numbers)
        .agg(F.avg(target))
    )
    names = {str(i): f"column_bin_{i}" for i in numbers}
    return grid.withColumnsRenamed(names).fillna(1.0, list(names.values())).orderBy("row_bin")
