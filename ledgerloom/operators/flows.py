"""Cash-flow aggregates per consumer and category.

All of them are one ``groupBy`` with conditional aggregates, so each row is read once and combined
on the map side before the shuffle; a consumer with very many rows shuffles no more than others.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.columns import (
    is_credit,
    is_debit,
    net_amount,
    not_in_keep_nulls,
    one_row,
    sum_if,
    week_end_sunday,
)
from ledgerloom.operators.quantiles import group_stats
from ledgerloom.sources.schemas import EXCLUDED_CATEGORIES, INCOME_CATEGORIES, INCOME_RECODE

KEY = "consumer_id"


def with_category(
    transactions: DataFrame, category_map: DataFrame, excluded: Sequence[str] = EXCLUDED_CATEGORIES
) -> DataFrame:
    """Attach the category name and drop the excluded categories; unmapped rows stay with a null name.

    The map is a vocabulary table; its size is left to the optimizer, which broadcasts it when small.
    """
    return transactions.join(category_map, "category_id", "left").filter(not_in_keep_nulls("category", excluded))


def consumer_totals(transactions: DataFrame) -> DataFrame:
    """Count, mean and sum of the amount per consumer."""
    return transactions.groupBy(KEY).agg(
        F.count("amount").alias("n_transactions"),
        F.avg("amount").cast("double").alias("mean_amount"),
        F.sum("amount").alias("total_amount"),
    )


def mean_of_consumer_totals(transactions: DataFrame) -> DataFrame:
    """Mean over consumers of their count and of their mean amount."""
    return consumer_totals(transactions).agg(
        F.avg("n_transactions").alias("mean_n_transactions"),
        F.avg("mean_amount").alias("mean_of_mean_amount"),
    )


def total_transactions(features: DataFrame, categorised: DataFrame) -> DataFrame:
    """Add ``transactions``: rows with a category, 0 for consumers without any."""
    counts = categorised.filter(F.col(KEY).isNotNull()).groupBy(KEY).agg(F.count("category").alias("transactions"))
    return features.join(counts, KEY, "left").fillna(0, ["transactions"])


def credit_debit_totals(transactions: DataFrame) -> DataFrame:
    return transactions.filter(is_credit() | is_debit()).groupBy(KEY).agg(
        sum_if(is_credit(), "amount").alias("total_credit"),
        sum_if(is_debit(), "amount").alias("total_debit"),
    )


def credit_share(transactions: DataFrame) -> DataFrame:
    """Credit / (credit + debit) for consumers that have both."""
    totals = transactions.groupBy(KEY).agg(
        F.sum(F.when(is_credit(), F.col("amount"))).alias("credit_amount"),
        F.sum(F.when(is_debit(), F.col("amount"))).alias("debit_amount"),
    )
    credit, debit = F.col("credit_amount").cast("double"), F.col("debit_amount").cast("double")
    return totals.withColumn("credit_share", F.try_divide(credit, credit + debit)).na.drop()


def spend_windows(
    transactions: DataFrame,
    windows: Sequence[int] = (0, 350, 700, 1050, 1401),
    categories: Sequence[str | int] = (),
    category: str = "category",
) -> DataFrame:
    """Credit, debit, net, amount in the last n days before the ledger's last date, amount per category."""
    last = one_row(transactions, F.max("posted_date").alias("last")).getField("last")
    rows = transactions.withColumn("days_since", F.datediff(last, F.col("posted_date")))
    parts = [
        sum_if(is_credit(), "amount").alias("total_credit"),
        sum_if(is_debit(), "amount").alias("total_debit"),
        F.sum(net_amount()).alias("net_transaction_balance"),
    ]
    parts += [sum_if(F.col("days_since") <= d, "amount").alias(f"spending_last_{d}_days") for d in windows]
    parts += [sum_if(F.col(category) == c, "amount").alias(f"category_{c}_spending") for c in categories]
    return rows.groupBy(KEY).agg(*parts)


def avg_period_outflow(transactions: DataFrame) -> DataFrame:
    """Debit sum per distinct month and per distinct year with debits.

    Months are combined first, so the distinct count needs no list of dates per consumer.
    """
    monthly = (
        transactions.filter(is_debit())
        .groupBy(KEY, F.trunc("posted_date", "MM").alias("_month"))
        .agg(F.sum("amount").alias("_amount"))
    )
    yearly = monthly.groupBy(KEY, F.year("_month").alias("_year")).agg(
        F.sum("_amount").alias("_amount"), F.count("_month").alias("_months")
    )
    total = F.sum("_amount").cast("double")
    return yearly.groupBy(KEY).agg(
        (total / F.greatest(F.lit(1), F.sum("_months"))).alias("avg_monthly_outflow"),
        (total / F.greatest(F.lit(1), F.count("_year"))).alias("avg_yearly_outflow"),
    )


def consumer_category_totals(transactions: DataFrame) -> DataFrame:
    rows = transactions.filter(F.col(KEY).isNotNull() & F.col("category").isNotNull())
    return rows.groupBy(KEY, "category").agg(
        F.count(F.lit(1)).alias("total_transactions"),
        sum_if(is_credit(), "amount").alias("total_credit_amount"),
        sum_if(is_debit(), "amount").alias("total_debit_amount"),
        F.sum("amount").alias("total_transaction_amount"),
    )


def direction_category_pivot(transactions: DataFrame, categories: Sequence[str]) -> DataFrame:
    """Amount per direction and category, one column each; 0 where there is none."""
    sides = (("credit", is_credit()), ("debit", is_debit()))
    return transactions.groupBy(KEY).agg(
        *[
            sum_if(side & (F.col("category") == c), "amount").alias(f"category_{c}_{name}_spending")
            for c in categories
            for name, side in sides
        ]
    )


def flow_pivots(categorised: DataFrame, categories: Sequence[str]) -> DataFrame:
    """Occurrences and sums per category for outflows and inflows.

    As in the source tables only consumers with a categorised outflow are kept, and a consumer
    without any inflow has null inflow columns.
    """
    known = F.col("category").isNotNull()
    parts: list[Column] = [
        F.count_if(is_debit() & known).alias("_outflows"),
        F.count_if(is_credit() & known).alias("_inflows"),
    ]
    for name, side in (("outflow", is_debit()), ("inflow", is_credit())):
        for c in categories:
            parts.append(F.count_if(side & (F.col("category") == c)).alias(f"{name}_occurrences_{c}"))
            parts.append(sum_if(side & (F.col("category") == c), "amount").alias(f"{name}_sums_{c}"))
    wide = categorised.groupBy(KEY).agg(*parts).filter(F.col("_outflows") > 0)
    cells = [
        F.when(F.col("_inflows") > 0, F.col(c)).alias(c) if c.startswith("inflow_") else F.col(c)
        for c in wide.columns
        if not c.startswith("_")
    ]
    return wide.select(*cells)


def category_percent(
    consumers: DataFrame, transactions: DataFrame, categories: Sequence[str], category: str = "category"
) -> DataFrame:
    """Share (x 100) of each category in a consumer's credits, debits and all rows, with the totals.

    A side without any amount is null, as is a consumer without transactions.
    """
    rows = transactions.filter(F.col(category).isNotNull())
    everything = F.lit(True)
    parts = []
    for name, side in (("credit", is_credit()), ("debit", is_debit()), ("trxn", everything)):
        total = F.sum(F.when(side, F.col("amount"))).cast("double")
        for c in categories:
            part = sum_if(side & (F.col(category) == c), "amount").cast("double")
            share = F.when(total.isNotNull(), F.try_divide(part, total) * 100)
            parts.append(share.alias(f"{name}_percentage_{c}"))
        parts.append(total.alias(f"{name}_percentage_total"))
    return consumers.select(KEY).join(rows.groupBy(KEY).agg(*parts), KEY, "left")


PERIOD_LABEL = {
    "1D": lambda: F.col("posted_date"),
    "1W": lambda: week_end_sunday("posted_date"),
    "1M": lambda: F.last_day("posted_date"),
}


def period_balances(transactions: DataFrame, period: str) -> DataFrame:
    """Net flow per consumer and day (1D), week ending Sunday (1W) or month end (1M), and its running sum.

    Rows are combined per day first, so the window sees at most one row per calendar day.
    """
    binned = (
        transactions.filter(F.col(KEY).isNotNull() & F.col("posted_date").isNotNull())
        .groupBy(KEY, PERIOD_LABEL[period]().alias("period"))
        .agg(F.sum(net_amount()).alias("net_flow"))
    )
    upto = Window.partitionBy(KEY).orderBy("period").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return binned.withColumn("running_total", F.sum("net_flow").over(upto))


def running_total_stats(transactions: DataFrame, periods: Sequence[str] = ("1M", "1W", "1D")) -> DataFrame:
    """Mean, median and variance of the running total per period length.

    The periods are stacked, so one window and one aggregation serve all of them. A consumer has at
    most one row per calendar day here, which bounds the buffer of the exact median.
    """
    daily = (
        transactions.filter(F.col(KEY).isNotNull() & F.col("posted_date").isNotNull())
        .groupBy(KEY, "posted_date")
        .agg(F.sum(net_amount()).alias("_net"))
    )
    labels = F.array(
        *[F.struct(F.lit(p).alias("frame"), PERIOD_LABEL[p]().alias("period")) for p in periods]
    )
    stacked = daily.select(KEY, "_net", F.explode(labels).alias("_p")).select(KEY, "_net", "_p.frame", "_p.period")
    binned = stacked.groupBy(KEY, "frame", "period").agg(F.sum("_net").alias("net_flow"))
    upto = Window.partitionBy(KEY, "frame").orderBy("period").rowsBetween(Window.unboundedPreceding, 0)
    running = binned.withColumn("_running", F.sum("net_flow").over(upto).cast("double"))
    parts = []
    for p in periods:
        value = F.when(F.col("frame") == p, F.col("_running"))
        parts += [
            F.avg(value).alias(f"{p}_mean"),
            F.median(value).alias(f"{p}_median"),
            F.var_samp(value).alias(f"{p}_var"),
        ]
    return running.groupBy(KEY).agg(*parts)


def days_open(transactions: DataFrame) -> DataFrame:
    """Days between a consumer's first and last transaction."""
    return transactions.groupBy(KEY).agg(
        F.datediff(F.max("posted_date"), F.min("posted_date")).alias("total_days")
    )


def keep_and_recode(
    flows: DataFrame,
    categories: Sequence[str] = INCOME_CATEGORIES,
    recode: Mapping[str, str] | None = None,
) -> DataFrame:
    """Rows of the given categories, with some category names folded into others."""
    recode = INCOME_RECODE if recode is None else recode
    kept = flows.filter(F.col("category").isin(*categories))
    return kept.replace(dict(recode), subset=["category"]) if recode else kept


def income_shares(income: DataFrame) -> DataFrame:
    """Share of each category in a consumer's income, in percent with two decimals (long form)."""
    sums = income.groupBy(KEY, "category").agg(F.sum("amount").alias("amount"))
    # One row per category is left for each consumer, so this window is small.
    total = F.sum("amount").over(Window.partitionBy(KEY))
    share = F.try_divide(F.col("amount").cast("decimal(28,2)") * 100, total.cast("decimal(28,2)"))
    return sums.withColumn("total_income", total).withColumn(
        "percentage", F.round(share.cast("decimal(20,8)"), 2).cast("double")
    )


def income_breakdown(income: DataFrame, categories: Sequence[str]) -> DataFrame:
    """Income shares with one column per category, 0 where a consumer has none."""
    return (
        income_shares(income).groupBy(KEY).pivot("category", list(categories)).agg(F.first("percentage")).fillna(0.0)
    )


def income_breakdown_summary(income: DataFrame, categories: Sequence[str]) -> DataFrame:
    """Mean and standard deviation of the income shares over consumers, largest mean first."""
    wide = income_breakdown(income, categories)
    long = wide.unpivot([KEY], [F.col(f"`{c}`") for c in categories], "category", "percentage")
    return (
        long.groupBy("category")
        .agg(
            F.round(F.avg("percentage"), 2).alias("average_percentage"),
            F.round(F.stddev_samp("percentage"), 2).alias("standard_deviation"),
        )
        .orderBy(F.desc("average_percentage"), "category")
    )


def category_mean_of_totals(flows: DataFrame) -> DataFrame:
    """Mean over consumers of a category's total and row count."""
    per_consumer = flows.groupBy(KEY, "category").agg(
        F.sum("amount").alias("total_amount"), F.count("posted_date").alias("total_transactions")
    )
    return per_consumer.groupBy("category").agg(
        F.avg(F.col("total_amount").cast("double")).alias("mean_total_amount"),
        F.avg("total_transactions").alias("mean_total_transactions"),
    )


def activity_rates(flows: DataFrame, days_per_unit: int = 365) -> DataFrame:
    """Rows and amount per unit of account age, where age = span in days + 1."""
    base = flows.groupBy(KEY).agg(
        F.min("posted_date").alias("min_date"),
        F.max("posted_date").alias("max_date"),
        F.count("posted_date").alias("total_transactions"),
        F.sum("amount").alias("total_amount"),
    )
    age = (F.datediff("max_date", "min_date") + 1) / F.lit(float(days_per_unit))
    return (
        base.withColumn("account_age", age)
        .withColumn("transactions_per_unit", F.col("total_transactions") / F.col("account_age"))
        .withColumn("amount_per_unit", F.col("total_amount").cast("double") / F.col("account_age"))
    )


def income_sources(income: DataFrame) -> DataFrame:
    """Sum, mean and count per category, largest sum first."""
    return (
        income.groupBy("category")
        .agg(
            F.sum("amount").alias("total_amount"),
            F.avg("amount").cast("double").alias("mean_amount"),
            F.count("amount").alias("n_transactions"),
        )
        .orderBy(F.desc("total_amount"), "category")
    )


def inflow_by_category(income: DataFrame) -> DataFrame:
    return income.groupBy(KEY, "category").agg(
        F.sum("amount").alias("total_inflow"), F.count("memo").alias("transaction_count")
    )


def inflow_summary(income: DataFrame) -> DataFrame:
    """Consumer totals rolled up from the consumer x category totals."""
    return (
        inflow_by_category(income)
        .groupBy(KEY)
        .agg(F.sum("total_inflow").alias("total_inflow"), F.sum("transaction_count").alias("transaction_count"))
    )


def top_income_source(income: DataFrame) -> DataFrame:
    """Categories of average rank 1 by total inflow; two categories tied for the top rank 1.5 and drop out.

    The window runs over one row per category and consumer.
    """
    by_category = inflow_by_category(income)
    order = Window.partitionBy(KEY).orderBy(F.desc("total_inflow"))
    ties = F.count(F.lit(1)).over(Window.partitionBy(KEY, "total_inflow"))
    ranked = by_category.withColumn("rank", F.rank().over(order) + (ties - 1) / 2.0)
    return ranked.filter(F.col("rank") == 1.0)


def category_direction_mix(transactions: DataFrame, category_map: DataFrame) -> DataFrame:
    """Share of debits per category, and whether a category is only debit, only credit or mixed."""
    counts = transactions.groupBy("category_id").agg(
        F.count_if(is_debit()).alias("total_debit"), F.count("credit_or_debit").alias("total")
    )
    share = F.try_divide(F.col("total_debit").cast("double"), F.col("total").cast("double"))
    return (
        category_map.join(counts, "category_id", "left")
        .withColumn("percent_debit", share)
        .withColumn(
            "direction_class",
            F.when(share == 1.0, "debit_only").when(share == 0.0, "credit_only").otherwise("mixed"),
        )
    )


def spending_balance_ratio(transactions: DataFrame, accounts: DataFrame) -> DataFrame:
    """sum(amount) / (sum(balance) + 1) for consumers with transactions and accounts.

    Both sides are one row per consumer before the join.
    """
    spent = transactions.groupBy(KEY).agg(F.sum("amount").alias("amount"))
    held = accounts.groupBy(KEY).agg(F.sum("balance").alias("balance"))
    ratio = F.try_divide(F.col("amount").cast("double"), F.col("balance").cast("double") + 1)
    return spent.join(held, KEY).withColumn("spending_balance_ratio", ratio)


def describe(df: DataFrame, value: str = "amount", keys: Sequence[str] = ()) -> DataFrame:
    """count, mean, std, min, quartiles, max; over the table or per group (exact quantiles)."""
    number = F.col(value).cast("double")
    aggregates = [
        F.count(number).alias("count"),
        F.avg(number).alias("mean"),
        F.stddev_samp(number).alias("std"),
        F.min(number).alias("min"),
        F.max(number).alias("max"),
    ]
    groups = list(keys) or ["_all"]
    source = df if keys else df.withColumn("_all", F.lit(0))
    stats = group_stats(source, groups, value, [0.25, 0.5, 0.75], aggregates)
    return stats.select(
        *keys,
        "count",
        "mean",
        "std",
        "min",
        F.col("quantiles")[0].alias("p25"),
        F.col("quantiles")[1].alias("p50"),
        F.col("quantiles")[2].alias("p75"),
        "max",
    )
