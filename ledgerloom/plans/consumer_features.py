"""The wide per-consumer feature table for training and scoring."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators import balances, category, flows
from ledgerloom.operators.quantiles import MAX_GROUP_ROWS

KEY = "consumer_id"


def consumer_features(
    consumers: DataFrame,
    accounts: DataFrame,
    categorised: DataFrame,
    categories: Sequence[str],
    account_types: Sequence[str],
    labelled: bool = True,
    min_transactions: int | None = 1,
    target: str = "dq_target",
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Account counts, transaction count, amount statistics and monthly change per category, balance.

    ``labelled=True`` keeps consumers with a known target and at least one account (training);
    ``False`` keeps those without a target, with or without accounts (scoring). Consumers with at most
    ``min_transactions`` categorised rows are dropped. The account and transaction parts are aggregated
    to one row per consumer first, so the joins at the end only see aggregates.
    """
    known = F.col(target).isNotNull() if labelled else F.col(target).isNull()
    wanted = consumers.filter(known)
    features = balances.account_type_onehot(
        accounts, wanted, account_types, "existing" if labelled else "normal", target
    )
    features = flows.total_transactions(features, categorised)
    if min_transactions is not None:
        features = features.filter(F.col("transactions") > min_transactions)
    stats = category.category_stats_wide(categorised, categories, max_group_rows)
    change = category.monthly_change_wide(categorised, categories)
    held = balances.consumer_balance(accounts).withColumn("balance", F.col("balance").cast("double"))
    wide = (
        features.join(stats, KEY, "left").join(change.join(held, KEY, "left"), KEY, "left")
    )
    return wide.fillna(0, [c for c in wide.columns if c not in (KEY, target)])
