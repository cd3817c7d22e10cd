"""Column profiles, cleaning of feature tables, frequencies, calendars, histograms and trimming."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.columns import hash_number, one_row
from ledgerloom.operators.quantiles import column_quantiles, group_stats
from ledgerloom.operators.scan import value_prefix_sums
from ledgerloom.session import checked_broadcast


def column_profile(df: DataFrame) -> DataFrame:
    """Type, rows, nulls and distinct values (null counts as one) of every column, in one stacked pass."""
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    text = df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])
    long = text.unpivot([], [F.col(f"`{c}`") for c in df.columns], "column_name", "value")
    per_value = long.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    dtype = F.create_map(*[F.lit(x) for pair in types.items() for x in pair])[F.col("column_name")]
    return per_value.groupBy("column_name").agg(
        F.sum("n").alias("n_rows"),
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("n_nulls"),
        F.count(F.lit(1)).alias("n_distinct"),
    ).select("column_name", dtype.alias("data_type"), "n_rows", "n_nulls", "n_distinct")


def coerce(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast columns; a value that does not fit becomes null."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items()})


def finite(column: Column) -> Column:
    """NaN and infinities become null."""
    number = column.cast("double")
    return F.when(~F.isnan(number) & (F.abs(number) != F.lit(float("inf"))), number)


def column_medians(df: DataFrame, columns: Sequence[str]) -> Column:
    """Exact medians of several columns as one scalar struct; the columns are stacked into one pass."""
    long = df.select(*[finite(F.col(f"`{c}`")).alias(c) for c in columns]).unpivot(
        [], [F.col(f"`{c}`") for c in columns], "column_name", "value"
    )
    medians = group_stats(long, ["column_name"], "value", [0.5])
    return one_row(
        medians,
        *[
            F.max(F.when(F.col("column_name") == c, F.col("quantiles")[0])).alias(f"m{i}")
            for i, c in enumerate(columns)
        ],
    )


def impute_median(df: DataFrame, columns: Sequence[str], fitted_on: DataFrame | None = None) -> DataFrame:
    """Infinite and missing values become the column median."""
    medians = column_medians(fitted_on if fitted_on is not None else df, columns)
    return (
        df.withColumn("_medians", medians)
        .withColumns({c: F.coalesce(finite(F.col(f"`{c}`")), F.col(f"_medians.m{i}")) for i, c in enumerate(columns)})
        .drop("_medians")
    )


def drop_null_rows(df: DataFrame) -> DataFrame:
    return df.na.drop()


def drop_null_columns(df: DataFrame) -> DataFrame:
    """Drop every column that holds a null. The result's columns depend on the data, so this runs one
    aggregation at once; only its single row of counts reaches the driver."""
    counts = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns]).first()
    return df.select(*[F.col(f"`{c}`") for c in df.columns if counts[c] == 0])


def value_frequency(df: DataFrame, column: str) -> DataFrame:
    """Rows per value and their share; nulls are left out of both."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    total = one_row(df, F.count(column).alias("n")).getField("n")
    return counts.withColumn("share", F.col("n") / total).orderBy(F.desc("n"), column)


def class_balance(df: DataFrame, target: str = "dq_target") -> DataFrame:
    return df.filter(F.col(target).isNotNull()).groupBy(target).agg(F.count(F.lit(1)).alias("n"))


def category_totals(df: DataFrame) -> DataFrame:
    return (
        df.groupBy("category")
        .agg(F.sum("amount").alias("total_amount"))
        .orderBy(F.desc("total_amount"), "category")
    )


def side_category_drift(df: DataFrame, side: str = "side", category: str = "category") -> DataFrame:
    """Category shares (x 100) of the two sides of a split, 0 where a side lacks the category."""
    is_train, is_test = F.col(side) == "train", F.col(side) == "test"
    known = df.filter(F.col(category).isNotNull())
    totals = one_row(known, F.count_if(is_train).alias("train"), F.count_if(is_test).alias("test"))
    return known.groupBy(category).agg(
        F.coalesce(F.try_divide(F.count_if(is_train) * 100.0, totals.getField("train")), F.lit(0.0)).alias(
            "train_percent"
        ),
        F.coalesce(F.try_divide(F.count_if(is_test) * 100.0, totals.getField("test")), F.lit(0.0)).alias(
            "test_percent"
        ),
    )


def ks_two_sample(df: DataFrame, value: str, side: str, first: str, second: str) -> DataFrame:
    """Largest gap between the empirical distributions of a value on two sides, and the side sizes."""
    number = F.col(value).cast("double")
    counted = (
        df.filter(number.isNotNull() & F.col(side).isin(first, second))
        .groupBy(number.alias("_v"))
        .agg(
            F.count_if(F.col(side) == first).alias("_a"),
            F.count_if(F.col(side) == second).alias("_b"),
        )
    )
    along = value_prefix_sums(counted, [], "_v", ["_a", "_b"])
    gap = F.abs(
        F.try_divide(F.col("_a_upto").cast("double"), F.col("_a_all"))
        - F.try_divide(F.col("_b_upto").cast("double"), F.col("_b_all"))
    )
    return along.agg(F.max(gap).alias("statistic"), F.sum("_a").alias("n_first"), F.sum("_b").alias("n_second"))


def ks_p_value(compared: DataFrame, terms: int = 100) -> DataFrame:
    """``p_value`` beside what ``ks_two_sample`` gives: the chance of a gap at least as large between two samples of one
    distribution, by its limit for large samples, 2 * sum of (-1)^(k-1) exp(-2 k^2 x^2). Null if a side has no values."""
    n = F.col("n_first").cast("double") * F.col("n_second") / (F.col("n_first") + F.col("n_second"))
    # Below 0.2 the sum is 1 to twelve digits, but needs more terms the smaller x is.
    x = F.sqrt(F.when((F.col("n_first") > 0) & (F.col("n_second") > 0), n)) * F.col("statistic")
    sign = lambda k: F.when(k % 2 == 1, 2.0).otherwise(-2.0)
    series = F.aggregate(F.sequence(F.lit(1), F.lit(terms)), F.lit(0.0), lambda s, k: s + sign(k) * F.exp(k * k * -2.0 * x * x))
    p = F.when(x < 0.2, 1.0).when(x.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), series)))
    return compared.withColumn("p_value", p)


def category_by_month(df: DataFrame) -> DataFrame:
    return df.groupBy(F.trunc("posted_date", "MM").alias("month"), "category").agg(
        F.count(F.lit(1)).alias("n_transactions"), F.avg("amount").cast("double").alias("mean_amount")
    )


def amount_by_month_name(df: DataFrame) -> DataFrame:
    return (
        df.groupBy(F.month("posted_date").alias("month_number"), F.date_format("posted_date", "MMMM").alias("month_name"))
        .agg(F.avg("amount").cast("double").alias("mean_amount"), F.sum("amount").alias("total_amount"))
        .orderBy("month_number")
    )


def count_by_weekday(df: DataFrame) -> DataFrame:
    """Monday first."""
    return (
        df.groupBy(F.weekday("posted_date").alias("weekday_number"), F.date_format("posted_date", "EEEE").alias("weekday"))
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy("weekday_number")
    )


def amount_by_day(df: DataFrame) -> DataFrame:
    return (
        df.groupBy(F.day("posted_date").alias("day"))
        .agg(F.avg("amount").cast("double").alias("mean_amount"))
        .orderBy("day")
    )


def date_slice(df: DataFrame, first: str, last: str, date: str = "posted_date") -> DataFrame:
    return df.filter(F.col(date).between(F.lit(first).cast("date"), F.lit(last).cast("date")))


def histogram(
    df: DataFrame, value: Column | str, bins: int, keys: Sequence[str] = (), low: Column | None = None,
    high: Column | None = None,
) -> DataFrame:
    """Counts and density in equal bins between the column's (or the given) bounds; empty bins are left out.

    Bins are closed on the left, the last one on both sides; density is per key.
    """
    value = F.col(value) if isinstance(value, str) else value
    numbers = df.select(*keys, value.cast("double").alias("_v")).filter(F.col("_v").isNotNull())
    if low is None or high is None:
        bounds = one_row(numbers, F.min("_v").alias("low"), F.max("_v").alias("high"))
    else:
        bounds = F.struct(low.alias("low"), high.alias("high"))
    bounded = numbers.withColumn("_bounds", bounds)
    low, high = F.col("_bounds.low"), F.col("_bounds.high")
    width = (high - low) / F.lit(float(bins))
    place = F.least(F.lit(bins - 1), F.floor(F.coalesce(F.try_divide(F.col("_v") - low, width), F.lit(0.0))))
    counted = (
        bounded.filter((F.col("_v") >= low) & (F.col("_v") <= high))
        .groupBy(*keys, place.cast("int").alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"), F.first("_bounds").alias("_bounds"))
    )
    # At most ``bins`` rows per key are left for this window.
    total = F.sum("n").over(Window.partitionBy(*keys))
    return counted.select(
        *keys,
        "bin",
        (low + F.col("bin") * width).alias("low_edge"),
        "n",
        F.try_divide(F.col("n").cast("double"), total * width).alias("density"),
    )


def date_histogram(df: DataFrame, bins: int, date: str = "posted_date", keys: Sequence[str] = ()) -> DataFrame:
    """``histogram`` over days since 1970-01-01."""
    return histogram(df, F.unix_date(F.col(date)), bins, keys)


def box_stats(df: DataFrame, value: str = "amount") -> DataFrame:
    """Quartiles, whisker ends (furthest values within 1.5 interquartile ranges) and number of outliers."""
    quartiles = column_quantiles(df, value, [0.25, 0.5, 0.75]).scalar()
    q1, q2, q3 = (F.col("_q")[i] for i in range(3))
    number = F.col(value).cast("double")
    low, high = q1 - (q3 - q1) * 1.5, q3 + (q3 - q1) * 1.5
    inside = (number >= low) & (number <= high)
    return df.withColumn("_q", quartiles).agg(
        F.max(q1).alias("q1"),
        F.max(q2).alias("median"),
        F.max(q3).alias("q3"),
        F.min(F.when(inside, number)).alias("whisker_low"),
        F.max(F.when(inside, number)).alias("whisker_high"),
        F.count_if(~inside).alias("n_outliers"),
    )


def trim_global_quantile(df: DataFrame, value: str = "amount", q: float = 0.99, keep: str = "below") -> DataFrame:
    """Rows below (``below``), at or below (``upto``) or above (``above``) a quantile of the column."""
    edge = column_quantiles(df, value, [q]).scalar()[0]
    number = F.col(value).cast("double")
    return df.filter({"below": number < edge, "upto": number <= edge, "above": number > edge}[keep])


def tail_by_category(df: DataFrame, category: str = "category", value: str = "amount", q: float = 0.98) -> DataFrame:
    """Rows above their category's quantile. The table of edges (one line per category) is computed at
    once, to see whether it is small enough to broadcast."""
    edges = group_stats(df, [category], value, [q]).select(category, F.col("quantiles")[0].alias("_edge"))
    return df.join(checked_broadcast(edges), category).filter(F.col(value).cast("double") > F.col("_edge")).drop("_edge")


def top_memo_per_category(df: DataFrame, category: str = "category", memo: str = "memo") -> DataFrame:
    """The most frequent memo of each category (ties: first in sort order), found by aggregation only."""
    counts = df.groupBy(category, memo).agg(F.count(F.lit(1)).alias("n"))
    # min over (-n, memo) picks the highest count, then the first memo, with map-side combining.
    best = F.min(F.struct((-F.col("n")).alias("rank"), F.col(memo).alias("memo")))
    return counts.groupBy(category).agg(best.alias("_best")).select(
        category, F.col("_best.memo").alias("top_memo"), (-F.col("_best.rank")).alias("n")
    )


def head_per_category(df: DataFrame, order: Sequence[str], n: int = 15, category: str = "category") -> DataFrame:
    """First ``n`` rows of each category in the given order; Spark limits each group before the shuffle."""
    place = F.row_number().over(Window.partitionBy(category).orderBy(*order))
    return df.withColumn("row_no", place).filter(F.col("row_no") <= n)


def sample_consumers(df: DataFrame, n: int, key: str = "consumer_id") -> DataFrame:
    """``n`` consumers in hash order: a random but repeatable choice."""
    return df.select(key).filter(F.col(key).isNotNull()).distinct().orderBy(hash_number(key), key).limit(n)


def nonzero_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with a value other than 0, per column."""
    wide = df.agg(*[F.count_if(F.col(f"`{c}`") != 0).alias(c) for c in columns])
    return wide.unpivot([], [F.col(f"`{c}`") for c in columns], "column_name", "n_nonzero")


def target_correlation(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """Correlation of each column with the target, over rows where both are known; null for a constant."""
    goal = F.col(target).cast("double")

    def correlation(value: Column) -> Column:
        # ``corr`` raises on a constant column in ANSI mode, so the quotient is written out.
        x, y = F.when(goal.isNotNull(), value), F.when(value.isNotNull(), goal)
        return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))

    wide = df.agg(*[correlation(F.col(f"`{c}`").cast("double")).alias(c) for c in columns])
    return wide.unpivot([], [F.col(f"`{c}`") for c in columns], "feature", "correlation")


