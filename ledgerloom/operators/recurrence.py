"""Recurring payments and regular income, found from the gaps between days.

Rows are first combined per consumer, category and day. The windows then see at most one row per
calendar day of a group, however many rows the group has; rows of the same day are gaps of 0 days.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.columns import is_credit, sum_if

KEY = "consumer_id"
GROUP = [KEY, "category"]

# The cadences in days.
WEEK, TWO_WEEKS, MONTH = 7, 14, 30


def daily_gaps(transactions: DataFrame) -> DataFrame:
    """Rows and credit per consumer, category and day, with the days since the group's previous day."""
    daily = (
        transactions.filter(F.col(KEY).isNotNull() & F.col("posted_date").isNotNull())
        .groupBy(*GROUP, "posted_date")
        .agg(F.count(F.lit(1)).alias("n_rows"), sum_if(is_credit(), "amount").alias("credit"))
    )
    previous = F.lag("posted_date").over(Window.partitionBy(*GROUP).orderBy("posted_date"))
    return daily.withColumn("gap", F.datediff("posted_date", previous))


def _regular_gap(gap: Column, tolerance: int) -> Column:
    fits = F.lit(False)
    for cadence in (WEEK, TWO_WEEKS, MONTH):
        fits = fits | gap.between(cadence - tolerance, cadence + tolerance)
    return fits


def _group_regularity(transactions: DataFrame, tolerance: int) -> DataFrame:
    gaps = daily_gaps(transactions)
    same_day = F.sum(F.col("n_rows") - 1)
    zero_fits = any(c - tolerance <= 0 for c in (WEEK, TWO_WEEKS, MONTH))
    same_day_ok = F.lit(True) if zero_fits else same_day == 0
    all_fit = F.bool_and(F.coalesce(_regular_gap(F.col("gap"), tolerance), F.lit(True)))
    return gaps.groupBy(*GROUP).agg(
        (F.sum("n_rows") - 1).alias("n_gaps"),
        ((F.sum("n_rows") > 2) & all_fit & same_day_ok).alias("is_regular"),
        F.sum("credit").alias("credit"),
        F.min("posted_date").alias("first_date"),
        F.max("posted_date").alias("last_date"),
    )


def regular_groups(transactions: DataFrame, tolerance: int = 5) -> DataFrame:
    """Consumer x category groups with at least two gaps, all of them near 7, 14 or 30 days."""
    return (
        _group_regularity(transactions, tolerance)
        .filter(F.col("category").isNotNull())
        .select(*GROUP, "n_gaps", "is_regular")
    )


def income_per_day(
    transactions: DataFrame, features: DataFrame | None = None, tolerance: int = 5, how: str = "left"
) -> DataFrame:
    """Credits of the regular groups per day of the consumer's history.

    With ``features`` the result is joined to it; ``how="left"`` gives consumers without regular
    income 0, ``how="inner"`` drops them. A history of 0 days has no rate and counts as 0.
    """
    groups = _group_regularity(transactions, tolerance)
    regular = F.col("is_regular") & F.col("category").isNotNull()
    days = F.datediff(F.max("last_date"), F.min("first_date"))
    per_consumer = (
        groups.groupBy(KEY)
        .agg(
            sum_if(regular, "credit").alias("income"),
            F.bool_or(regular & (F.col("credit") != 0)).alias("_has_income"),
            days.alias("days"),
        )
        .withColumn(
            "income_per_day",
            F.coalesce(F.try_divide(F.col("income").cast("double"), F.col("days").cast("double")), F.lit(0.0)),
        )
    )
    if how == "inner":
        per_consumer = per_consumer.filter("_has_income")
    if features is None:
        return per_consumer.drop("_has_income")
    joined = features.join(per_consumer.select(KEY, "income_per_day"), KEY, how)
    return joined.fillna(0.0, ["income_per_day"])


def _recurring_gap(gap: Column, monthly: int, weekly: int, biweekly: int) -> Column:
    return (
        (F.abs(gap - MONTH) <= monthly) | (F.abs(gap - WEEK) <= weekly) | (F.abs(gap - TWO_WEEKS) <= biweekly)
    )


def recurring_groups(
    transactions: DataFrame, monthly_tolerance: int = 7, weekly_tolerance: int = 3, biweekly_tolerance: int = 3
) -> DataFrame:
    """Whether any gap of a group is near a month, a week or two weeks, and the group's rows."""
    def near(gap: Column) -> Column:
        return _recurring_gap(gap, monthly_tolerance, weekly_tolerance, biweekly_tolerance)

    same_day = F.max(F.col("n_rows")) > 1
    return (
        daily_gaps(transactions)
        .filter(F.col("category").isNotNull())
        .groupBy(*GROUP)
        .agg(
            (
                F.coalesce(F.bool_or(near(F.col("gap"))), F.lit(False)) | (same_day & near(F.lit(0)))
            ).alias("is_recurring"),
            F.sum("n_rows").alias("n_transactions"),
        )
    )


def recurring_flags(transactions: DataFrame, **tolerances: int) -> DataFrame:
    """Rows with the flag of their whole group. A hot group is split by adaptive skew-join handling."""
    flags = recurring_groups(transactions, **tolerances).drop("n_transactions")
    return transactions.join(flags, GROUP, "left").fillna(False, ["is_recurring"])


def recurring_summary(transactions: DataFrame, **tolerances: int) -> DataFrame:
    """Row count of each recurring group."""
    return recurring_groups(transactions, **tolerances).filter("is_recurring").drop("is_recurring")


def recurrence_tolerance(
    transactions: DataFrame, tie: str = "txn_id", amount_tolerance: float = 0.2, day_tolerance: int = 7
) -> DataFrame:
    """Flag rows near the consumer's mean amount, and rows soon after the previous one.

    The first row has no previous row, so its date flag is false. The previous day is looked up per
    consumer and day; inside a day only the first row (lowest tie-break) looks back further than 0 days.
    """
    rows = transactions.filter(F.col(KEY).isNotNull() & F.col("posted_date").isNotNull())
    by_day = Window.partitionBy(KEY).orderBy("posted_date")
    life = Window.partitionBy(KEY)
    days = (
        rows.groupBy(KEY, "posted_date")
        .agg(F.min(tie).alias("_first"), F.sum("amount").alias("_sum"), F.count("amount").alias("_n"))
        .select(
            KEY,
            "posted_date",
            "_first",
            F.datediff("posted_date", F.lag("posted_date").over(by_day)).alias("_gap"),
            F.try_divide(F.sum("_sum").over(life).cast("double"), F.sum("_n").over(life)).alias("_mean"),
        )
    )
    amount = F.col("amount").cast("double")
    gap = F.when(F.col(tie) == F.col("_first"), F.col("_gap")).otherwise(F.lit(0))
    near = F.try_divide(F.abs(amount - F.col("_mean")), amount) <= amount_tolerance
    return rows.join(days, [KEY, "posted_date"]).select(
        *rows.columns,
        F.coalesce(near, F.lit(False)).alias("amount_tolerance"),
        F.coalesce(F.abs(gap) <= day_tolerance, F.lit(False)).alias("date_tolerance"),
    )
