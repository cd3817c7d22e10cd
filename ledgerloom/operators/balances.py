"""Account balances, running balances and balances rebuilt around a known one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.columns import net_amount, one_row, sum_if
from ledgerloom.operators.scan import MAX_SEGMENT_ROWS, ledger_prefix_sums
from ledgerloom.sources.schemas import BORROWING_TYPES

KEY = "consumer_id"


def account_type_onehot(
    accounts: DataFrame, features: DataFrame, types: Sequence[str], how: str = "normal", target: str = "dq_target"
) -> DataFrame:
    """Number of accounts per type as ``account_type_<type>``.

    ``how="normal"`` keeps every consumer and fills nulls with 0 except in the target column; any
    other value keeps only consumers with an account.
    """
    counts = _type_counts(accounts, types, "account_type_")
    if how != "normal":
        return features.join(counts, KEY)
    joined = features.join(counts, KEY, "left")
    return joined.fillna(0, [c for c in joined.columns if c not in (target, KEY)])


def account_type_counts(accounts: DataFrame, features: DataFrame, types: Sequence[str]) -> DataFrame:
    """The same counts as ``num_accounts_<type>``; every null becomes 0, the target's too."""
    joined = features.join(_type_counts(accounts, types, "num_accounts_"), KEY, "left")
    return joined.fillna(0, [c for c in joined.columns if c != KEY])


def _type_counts(accounts: DataFrame, types: Sequence[str], prefix: str) -> DataFrame:
    return (
        accounts.filter(F.col(KEY).isNotNull())
        .groupBy(KEY)
        .agg(*[F.count_if(F.col("account_type") == t).alias(f"{prefix}{t}") for t in types])
    )


def _adjusted(borrowing: Sequence[str]):
    return F.when(F.col("account_type").isin(*borrowing), -F.col("balance")).otherwise(F.col("balance"))


def adjusted_balance_by_type(
    accounts: DataFrame, types: Sequence[str], borrowing: Sequence[str] = BORROWING_TYPES
) -> DataFrame:
    """Balance per account type, owed money negative, 0 where there is no account."""
    return accounts.groupBy(KEY).agg(
        *[sum_if(F.col("account_type") == t, _adjusted(borrowing)).alias(t) for t in types]
    )


def adjusted_balance_total(accounts: DataFrame, borrowing: Sequence[str] = BORROWING_TYPES) -> DataFrame:
    return accounts.groupBy(KEY).agg(
        F.sum(_adjusted(borrowing)).alias("total_balance"),
        F.min("balance_date").alias("earliest_balance_date"),
    )


def consumer_balance(accounts: DataFrame) -> DataFrame:
    return accounts.groupBy(KEY).agg(F.sum("balance").alias("balance"))


def account_balance_stats(accounts: DataFrame) -> DataFrame:
    """Negative count, mean, maximum and minimum of a consumer's account balances."""
    return accounts.groupBy(KEY).agg(
        F.count_if(F.col("balance") < 0).alias("negative_balance_count"),
        F.avg("balance").cast("double").alias("average_balance"),
        F.max("balance").alias("max_balance"),
        F.min("balance").alias("min_balance"),
    )


def ordered_lists(
    rows: DataFrame,
    day: str,
    tie: str,
    value: str,
    out: str,
    chunk: int = 100_000,
    max_rows: int = MAX_SEGMENT_ROWS,
) -> DataFrame:
    """All values of a consumer in (day, tie-break) order, a row per (consumer, ``chunk_no``).

    Chunk c holds the values at places c * ``chunk`` up to (c + 1) * ``chunk``: the key and the layout are the same for
    consumers of any size, and no array grows with the data.
    """
    numbered = ledger_prefix_sums(
        rows.select(KEY, day, tie, F.col(value).alias("_value"), F.lit(1).cast("bigint").alias("_one")),
        [KEY],
        day,
        tie,
        ["_one"],
        max_rows,
    )
    place = F.col("_one_upto") - 1
    entries = numbered.select(
        KEY, (F.floor(place / chunk)).cast("bigint").alias("chunk_no"), F.struct("_one_upto", "_value").alias("_entry")
    )
    lists = entries.groupBy(KEY, "chunk_no").agg(F.array_sort(F.collect_list("_entry")).alias("_entries"))
    return lists.select(KEY, "chunk_no", F.col("_entries._value").alias(out))


def account_negative_ratio(accounts: DataFrame) -> DataFrame:
    """Negative balances per day of account history (span + 1)."""
    negative = F.count_if(F.col("balance") < 0)
    span = F.datediff(F.max("balance_date"), F.min("balance_date"))
    return accounts.groupBy(KEY).agg(
        negative.alias("negative_balance_days"),
        span.alias("days_account_open"),
        (negative / (span + 1)).alias("negative_balance_ratio"),
    )


def _days_since_last(accounts: DataFrame) -> DataFrame:
    last = one_row(accounts, F.max("balance_date").alias("last")).getField("last")
    return accounts.withColumn("days_since", F.datediff(last, F.col("balance_date")))


def account_age(accounts: DataFrame) -> DataFrame:
    """Days from a consumer's oldest balance to the last balance date of the table."""
    return _days_since_last(accounts).groupBy(KEY).agg(F.max("days_since").alias("account_age_days"))


def balance_windows(
    accounts: DataFrame, windows: Sequence[int] = (30, 90, 180, 365), thresholds: Sequence[int] = (25, 50, 100)
) -> DataFrame:
    """Mean balance and number of low balances in the last n days, and the number of negative balances."""
    recent = {d: F.col("days_since") <= d for d in windows}
    parts = [F.avg(F.when(recent[d], F.col("balance"))).cast("double").alias(f"avg_balance_{d}d") for d in windows]
    parts += [
        F.count_if(recent[d] & (F.col("balance") < t)).alias(f"below_{t}_{d}d") for t in thresholds for d in windows
    ]
    parts.append(F.count_if(F.col("balance") < 0).alias("days_negative_balance"))
    return _days_since_last(accounts).groupBy(KEY).agg(*parts)


def running_balance(
    transactions: DataFrame, tie: str = "txn_id", day: str = "posted_date", max_rows: int = MAX_SEGMENT_ROWS
) -> DataFrame:
    """Add ``calculated_balance``: the consumer's net flow from zero up to each transaction."""
    signed = transactions.withColumn("_signed", net_amount())
    return (
        ledger_prefix_sums(signed, [KEY], day, tie, ["_signed"], max_rows)
        .withColumnRenamed("_signed_upto", "calculated_balance")
        .drop("_signed")
    )


def negative_balance_rates(with_balance: DataFrame) -> DataFrame:
    """How often the running balance is below zero: count, share of rows, and per day of history."""
    negative = F.count_if(F.col("calculated_balance") < 0)
    span = F.datediff(F.max("posted_date"), F.min("posted_date"))
    return with_balance.groupBy(KEY).agg(
        negative.alias("negative_count"),
        F.count(F.lit(1)).alias("total_transactions"),
        span.alias("account_duration_days"),
        (negative / F.count(F.lit(1))).alias("negative_balance_ratio"),
        (negative / (span + 1)).alias("negative_balance_per_day"),
    )


def below_threshold_ratios(with_balance: DataFrame, thresholds: Sequence[int] = (25, 50, 100)) -> DataFrame:
    """Share of rows whose running balance is more than a threshold below zero."""
    return with_balance.groupBy(KEY).agg(
        *[
            (F.count_if(F.col("calculated_balance") < -t) / F.count(F.lit(1))).alias(f"below_{t}_ratio")
            for t in thresholds
        ]
    )


def balance_lists(with_balance: DataFrame, tie: str = "txn_id", chunk: int = 100_000) -> DataFrame:
    """A consumer's running balances in time order (in chunks, see ``ordered_lists``)."""
    return ordered_lists(with_balance, "posted_date", tie, "calculated_balance", "all_balances", chunk)


def anchored_balance(
    transactions: DataFrame, accounts: DataFrame, tie: str = "txn_id", max_rows: int = MAX_SEGMENT_ROWS
) -> DataFrame:
    """Balance at each transaction, rebuilt around the known balance on the consumer's first balance date.

    From that date on the balance is the known one plus all flows since; before it, the known one with
    the flows in between taken back, the row's own flow included. Both follow from the running balance
    plus one number per consumer, so a single scan serves both directions.
    """
    anchors = (
        accounts.filter(F.col(KEY).isNotNull())
        .groupBy(KEY)
        .agg(F.min("balance_date").alias("anchor_date"), F.sum("balance").alias("anchor_balance"))
    )
    signed = transactions.withColumn("_signed", net_amount())
    # Daily sums keep this join at one row per consumer and day.
    daily = signed.groupBy(KEY, "posted_date").agg(F.sum("_signed").alias("_flow"))
    shifts = (
        daily.join(anchors, KEY)
        .groupBy(KEY, "anchor_date", "anchor_balance")
        .agg(sum_if(F.col("posted_date") < F.col("anchor_date"), "_flow").alias("_flow_before"))
    )
    scanned = ledger_prefix_sums(signed, [KEY], "posted_date", tie, ["_signed"], max_rows, per_key=shifts)
    before = F.col("posted_date") < F.col("anchor_date")
    shifted = F.col("anchor_balance") - F.col("_flow_before") + F.col("_signed_upto")
    return (
        scanned.withColumn("running_balance", F.when(before, shifted - F.col("_signed")).otherwise(shifted))
        .drop("_signed", "_signed_upto", "_flow_before")
    )


def negative_txn_share(anchored: DataFrame) -> DataFrame:
    """Span, row count and share of rows with a negative rebuilt balance per consumer."""
    negative = F.count_if(F.col("running_balance") < 0)
    return anchored.groupBy(KEY).agg(
        (F.datediff(F.max("posted_date"), F.min("posted_date")) + 1).alias("days"),
        F.count("posted_date").alias("transaction_count"),
        negative.alias("negative_trans_count"),
        (negative / F.count("posted_date")).alias("percent_neg_trans_count"),
    )


def zscore(df: DataFrame, columns: Sequence[str], prefix: str = "std_") -> DataFrame:
    """Add (x - mean) / sample standard deviation of each column; null for a constant column."""
    parts = []
    for i, c in enumerate(columns):
        value = F.col(f"`{c}`").cast("double")
        parts += [F.avg(value).alias(f"m{i}"), F.stddev_samp(value).alias(f"s{i}")]
    scaled = {
        f"{prefix}{c}": F.try_divide(F.col(f"`{c}`").cast("double") - F.col(f"_stats.m{i}"), F.col(f"_stats.s{i}"))
        for i, c in enumerate(columns)
    }
    return df.withColumn("_stats", one_row(df, *parts)).withColumns(scaled).drop("_stats")
