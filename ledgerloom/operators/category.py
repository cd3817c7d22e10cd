"""Per consumer and category: distribution of amounts and month-over-month change."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.columns import sample_skewness, whole_months
from ledgerloom.operators.quantiles import MAX_GROUP_ROWS, group_stats

KEY = "consumer_id"
ADVANCED = ("median", "count", "skewness", "iqr", "coef_variation")


def category_stats(categorised: DataFrame, max_group_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """Median, count, bias-corrected skewness, interquartile range and coefficient of variation."""
    amount = F.col("amount").cast("double")
    stats = group_stats(
        categorised,
        [KEY, "category"],
        "amount",
        [0.25, 0.5, 0.75],
        [
            F.count("amount").alias("count"),
            F.coalesce(sample_skewness(amount), F.lit(0.0)).alias("skewness"),
            F.avg(amount).alias("_mean"),
            F.stddev_samp(amount).alias("_std"),
        ],
        max_group_rows=max_group_rows,
    )
    q = F.col("quantiles")
    return stats.select(
        KEY,
        "category",
        q[1].alias("median"),
        "count",
        "skewness",
        (q[2] - q[0]).alias("iqr"),
        F.coalesce(F.try_divide("_std", "_mean"), F.lit(0.0)).alias("coef_variation"),
    )


def _widen(long: DataFrame, categories: Sequence[str], stats: Sequence[str]) -> DataFrame:
    """One ``<category>_<stat>`` column per pair, 0 where a consumer has no such category."""
    wide = long.groupBy(KEY).agg(
        *[
            F.max(F.when(F.col("category") == c, F.col(s).cast("double"))).alias(f"{c}_{s}")
            for c in categories
            for s in stats
        ]
    )
    return wide.fillna(0.0)


def category_stats_wide(
    categorised: DataFrame, categories: Sequence[str], max_group_rows: int = MAX_GROUP_ROWS
) -> DataFrame:
    return _widen(category_stats(categorised, max_group_rows), categories, ADVANCED)


def monthly_amounts(categorised: DataFrame) -> DataFrame:
    """Amount per consumer, category and month; a consumer without category on a row keeps the month."""
    return (
        categorised.filter(F.col(KEY).isNotNull() & F.col("posted_date").isNotNull())
        .groupBy(KEY, "category", F.trunc("posted_date", "MM").alias("month"))
        .agg(F.sum("amount").alias("amount"))
    )


def month_category_grid(categorised: DataFrame, categories: Sequence[str]) -> DataFrame:
    """Every month from a consumer's first to last, for every category, with the amount or 0."""
    spans = (
        categorised.filter(F.col(KEY).isNotNull())
        .groupBy(KEY)
        .agg(
            F.trunc(F.min("posted_date"), "MM").alias("_first"), F.trunc(F.max("posted_date"), "MM").alias("_last")
        )
    )
    months = spans.select(KEY, F.explode(F.sequence("_first", "_last", F.expr("interval 1 month"))).alias("month"))
    grid = months.select(KEY, "month", F.explode(F.array(*[F.lit(c) for c in categories])).alias("category"))
    return grid.join(monthly_amounts(categorised), [KEY, "category", "month"], "left").select(
        KEY, "category", "month", F.coalesce("amount", F.lit(0).cast("decimal(28,2)")).alias("amount")
    )


def monthly_change_stats(categorised: DataFrame) -> DataFrame:
    """Mean and standard deviation of the month-over-month change of a category's amount.

    The change is taken over every month of the consumer's history, months without the category
    counting as 0 and the first month's change as 0. Only months with an amount are touched: an amount
    changes the series when it appears and, if the next month is empty, when it goes. So the dense
    consumer x month x category grid is never built. Categories a consumer never used are left out
    (their change is 0 throughout).
    """
    lifetime = Window.partitionBy(KEY)
    monthly = monthly_amounts(categorised).select(
        KEY,
        "category",
        "month",
        "amount",
        F.min("month").over(lifetime).alias("_first"),
        F.max("month").over(lifetime).alias("_last"),
    )
    series = Window.partitionBy(KEY, "category").orderBy("month")
    seen = monthly.filter(F.col("category").isNotNull()).select(
        "*",
        F.lag("month").over(series).alias("_previous"),
        F.lag("amount").over(series).alias("_previous_amount"),
        F.lead("month").over(series).alias("_next"),
    )
    amount = F.col("amount")
    zero = F.lit(0).cast("decimal(28,2)")
    rise = (
        F.when(F.col("_previous").isNull() & (F.col("month") == F.col("_first")), zero)
        .when(whole_months(F.col("_previous"), F.col("month")) == 1, amount - F.col("_previous_amount"))
        .otherwise(amount)
    )
    empties = F.coalesce(whole_months(F.col("month"), F.col("_next")) > 1, F.col("month") < F.col("_last"))
    fall = F.when(empties, -amount).otherwise(zero)
    steps = seen.select(
        KEY,
        "category",
        rise.cast("double").alias("_rise"),
        fall.cast("double").alias("_fall"),
        (rise + fall).alias("_step"),
        (whole_months(F.col("_first"), F.col("_last")) + 1).cast("double").alias("_n"),
    )
    total = F.sum("_step").cast("double")
    squares = F.sum(F.col("_rise") * F.col("_rise") + F.col("_fall") * F.col("_fall"))
    n = F.max("_n")
    return steps.groupBy(KEY, "category").agg(
        (total / n).alias("mean"),
        F.coalesce(
            F.when(n > 1, F.sqrt(F.greatest(F.lit(0.0), squares - total * total / n) / (n - 1))), F.lit(0.0)
        ).alias("std"),
    )


def monthly_change_wide(categorised: DataFrame, categories: Sequence[str]) -> DataFrame:
    return _widen(monthly_change_stats(categorised), categories, ("mean", "std"))
