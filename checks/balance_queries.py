"""Balances, categories, recurrence and the flagship feature table."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import bindings as b
from checks.bindings import Registry, big, dbl, rnd, text, with_views
from checks.flow_queries import CTXN_VIEWS, ctxn
from ledgerloom.operators import balances, category, flows, recurrence
from ledgerloom.plans.consumer_features import consumer_features as build_features

registry = Registry()
query = registry.add

RUNNING = """running AS (
  SELECT *, sum(CASE WHEN credit_or_debit = 'CREDIT' THEN amount ELSE -amount END)
    OVER (PARTITION BY consumer_id ORDER BY posted_date, txn_id ROWS UNBOUNDED PRECEDING) AS bal FROM txn)"""


def running(spark, sf_dir):
    return balances.running_balance(b.txn(spark, sf_dir))


@query(
    "running_balance",
    with_views(b.TXN, RUNNING, body="SELECT txn_id, consumer_id, CAST(bal AS DOUBLE) AS calculated_balance FROM running"),
)
def running_balance(spark, sf_dir):
    return running(spark, sf_dir).select("txn_id", "consumer_id", dbl("calculated_balance"))


@query(
    "negative_balance_rates",
    with_views(
        b.TXN,
        RUNNING,
        body="""SELECT consumer_id, count(*) FILTER (WHERE bal < 0) AS negative_count, count(*) AS total_transactions,
  max(posted_date) - min(posted_date) AS account_duration_days,
  round(count(*) FILTER (WHERE bal < 0) / count(*), 6) AS negative_balance_ratio,
  round(count(*) FILTER (WHERE bal < 0) / (max(posted_date) - min(posted_date) + 1), 6) AS negative_balance_per_day
FROM running GROUP BY 1""",
    ),
)
def negative_balance_rates(spark, sf_dir):
    return balances.negative_balance_rates(running(spark, sf_dir)).select(
        "consumer_id", "negative_count", "total_transactions", big("account_duration_days"),
        rnd("negative_balance_ratio"), rnd("negative_balance_per_day"),
    )


@query(
    "below_threshold_ratios",
    with_views(
        b.TXN,
        RUNNING,
        body="SELECT consumer_id, "
        + ", ".join(f"round(count(*) FILTER (WHERE bal < -{t}) / count(*), 6) AS below_{t}_ratio" for t in (25, 50, 100))
        + " FROM running GROUP BY 1",
    ),
)
def below_threshold_ratios(spark, sf_dir):
    out = balances.below_threshold_ratios(running(spark, sf_dir))
    return out.select("consumer_id", *[rnd(c) for c in out.columns[1:]])


@query(
    "balance_lists",
    with_views(
        b.TXN,
        RUNNING,
        body="""SELECT consumer_id, CAST(0 AS BIGINT) AS chunk_no,
  string_agg(CAST(bal AS VARCHAR), ',' ORDER BY posted_date, txn_id) AS all_balances FROM running GROUP BY 1""",
    ),
)
def balance_lists(spark, sf_dir):
    return balances.balance_lists(running(spark, sf_dir)).withColumn(
        "all_balances", F.array_join(F.col("all_balances").cast("array<string>"), ",")
    )


ANCHORED = """anchors AS (
  SELECT consumer_id, min(balance_date) AS anchor_date, sum(balance) AS anchor_balance FROM account GROUP BY 1),
sides AS (
  SELECT t.*, anchor_date, anchor_balance, posted_date < anchor_date AS before,
    CASE WHEN credit_or_debit = 'CREDIT' THEN amount ELSE -amount END AS signed FROM txn t JOIN anchors USING (consumer_id)),
anchored AS (
  SELECT *, anchor_balance + CASE WHEN before
    THEN sum(-signed) OVER (PARTITION BY consumer_id, before ORDER BY posted_date, txn_id
                            ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
    ELSE sum(signed) OVER (PARTITION BY consumer_id, before ORDER BY posted_date, txn_id ROWS UNBOUNDED PRECEDING)
    END AS running_balance FROM sides)"""


def anchored(spark, sf_dir):
    return balances.anchored_balance(b.txn(spark, sf_dir), b.account(spark, sf_dir))


@query(
    "anchored_balance",
    with_views(
        b.TXN,
        b.ACCOUNT,
        ANCHORED,
        body="""SELECT txn_id, consumer_id, CAST(anchor_date AS VARCHAR) AS anchor_date,
  CAST(anchor_balance AS DOUBLE) AS anchor_balance, CAST(running_balance AS DOUBLE) AS running_balance FROM anchored""",
    ),
)
def anchored_balance(spark, sf_dir):
    return anchored(spark, sf_dir).select(
        "txn_id", "consumer_id", text("anchor_date"), dbl("anchor_balance"), dbl("running_balance")
    )


SHARE_SQL = """SELECT consumer_id, max(posted_date) - min(posted_date) + 1 AS days, count(posted_date) AS transaction_count,
  count(*) FILTER (WHERE running_balance < 0) AS negative_trans_count,
  count(*) FILTER (WHERE running_balance < 0) / count(posted_date) AS percent_neg_trans_count
FROM anchored GROUP BY 1"""


@query(
    "negative_txn_share",
    with_views(
        b.TXN,
        b.ACCOUNT,
        ANCHORED,
        body=f"SELECT * REPLACE (round(percent_neg_trans_count, 6) AS percent_neg_trans_count) FROM ({SHARE_SQL})",
    ),
)
def negative_txn_share(spark, sf_dir):
    return balances.negative_txn_share(anchored(spark, sf_dir)).select(
        "consumer_id", big("days"), "transaction_count", "negative_trans_count", rnd("percent_neg_trans_count")
    )


@query(
    "describe_by_target",
    with_views(
        b.TXN,
        b.ACCOUNT,
        b.CONSUMER,
        ANCHORED,
        body=f"""SELECT dq_target, count(v) AS "count", round(avg(v), 7) AS mean, round(stddev_samp(v), 6) AS std, round(min(v), 6) AS min,
  round(quantile_cont(v, 0.25), 6) AS p25, round(quantile_cont(v, 0.5), 6) AS p50, round(quantile_cont(v, 0.75), 6) AS p75,
  round(max(v), 6) AS max
FROM (SELECT dq_target, percent_neg_trans_count AS v FROM ({SHARE_SQL}) JOIN consumer USING (consumer_id)
  WHERE dq_target IS NOT NULL) GROUP BY 1""",
    ),
)
def describe_by_target(spark, sf_dir):
    share = balances.negative_txn_share(anchored(spark, sf_dir)).join(b.consumer(spark, sf_dir), "consumer_id")
    out = flows.describe(share, "percent_neg_trans_count", ["dq_target"])
    return out.select(
        "dq_target", "count", rnd("mean", digits=7), rnd("std"), rnd("min"), rnd("p25"), rnd("p50"), rnd("p75"), rnd("max")
    )


@query(
    "account_onehot",
    with_views(
        b.ACCOUNT,
        b.CONSUMER,
        body="SELECT c.*, "
        + ", ".join(f'coalesce("account_type_{t}", 0) AS "account_type_{t}"' for t in b.ACCOUNT_TYPES)
        + " FROM consumer c LEFT JOIN (SELECT consumer_id, "
        + ", ".join(f"count(*) FILTER (WHERE account_type = '{t}') AS \"account_type_{t}\"" for t in b.ACCOUNT_TYPES)
        + " FROM account GROUP BY 1) USING (consumer_id)",
    ),
)
def account_onehot(spark, sf_dir):
    return balances.account_type_onehot(b.account(spark, sf_dir), b.consumer(spark, sf_dir), b.ACCOUNT_TYPES)


@query(
    "account_type_counts",
    with_views(
        b.ACCOUNT,
        b.CONSUMER,
        body="SELECT c.consumer_id, credit_score, coalesce(dq_target, 0) AS dq_target, "
        + ", ".join(f'coalesce("num_accounts_{t}", 0) AS "num_accounts_{t}"' for t in b.ACCOUNT_TYPES)
        + " FROM consumer c LEFT JOIN (SELECT consumer_id, "
        + ", ".join(f"count(*) FILTER (WHERE account_type = '{t}') AS \"num_accounts_{t}\"" for t in b.ACCOUNT_TYPES)
        + " FROM account GROUP BY 1) a ON a.consumer_id = c.consumer_id",
    ),
)
def account_type_counts(spark, sf_dir):
    return balances.account_type_counts(b.account(spark, sf_dir), b.consumer(spark, sf_dir), b.ACCOUNT_TYPES)


ADJUSTED = "CASE WHEN account_type IN ('LOW', 'NOT SPECIFIED') THEN -balance ELSE balance END"


@query(
    "adjusted_balance_by_type",
    with_views(
        b.ACCOUNT,
        body="SELECT consumer_id, "
        + ", ".join(
            f"CAST(coalesce(sum({ADJUSTED}) FILTER (WHERE account_type = '{t}'), 0) AS DOUBLE) AS \"{t}\""
            for t in b.ACCOUNT_TYPES
        )
        + " FROM account GROUP BY 1",
    ),
)
def adjusted_balance_by_type(spark, sf_dir):
    out = balances.adjusted_balance_by_type(b.account(spark, sf_dir), b.ACCOUNT_TYPES, b.BORROWING)
    return out.select("consumer_id", *[dbl(c) for c in out.columns[1:]])


@query(
    "adjusted_balance_total",
    with_views(
        b.ACCOUNT,
        body=f"""SELECT consumer_id, CAST(sum({ADJUSTED}) AS DOUBLE) AS total_balance,
  CAST(min(balance_date) AS VARCHAR) AS earliest_balance_date FROM account GROUP BY 1""",
    ),
)
def adjusted_balance_total(spark, sf_dir):
    return balances.adjusted_balance_total(b.account(spark, sf_dir), b.BORROWING).select(
        "consumer_id", dbl("total_balance"), text("earliest_balance_date")
    )


@query(
    "consumer_balance",
    with_views(b.ACCOUNT, body="SELECT consumer_id, CAST(sum(balance) AS DOUBLE) AS balance FROM account GROUP BY 1"),
)
def consumer_balance(spark, sf_dir):
    return balances.consumer_balance(b.account(spark, sf_dir)).select("consumer_id", dbl("balance"))


@query(
    "account_balance_stats",
    with_views(
        b.ACCOUNT,
        body="""SELECT consumer_id, count(*) FILTER (WHERE balance < 0) AS negative_balance_count,
  round(CAST(sum(balance) AS DOUBLE) / count(balance), 6) AS average_balance, CAST(max(balance) AS DOUBLE) AS max_balance,
  CAST(min(balance) AS DOUBLE) AS min_balance FROM account GROUP BY 1""",
    ),
)
def account_balance_stats(spark, sf_dir):
    return balances.account_balance_stats(b.account(spark, sf_dir)).select(
        "consumer_id", "negative_balance_count", rnd("average_balance"), dbl("max_balance"), dbl("min_balance")
    )


@query(
    "account_balance_lists",
    with_views(
        b.ACCOUNT,
        body="""SELECT consumer_id, CAST(0 AS BIGINT) AS chunk_no,
  string_agg(CAST(balance AS VARCHAR), ',' ORDER BY balance_date, account_type) AS all_balances
FROM account GROUP BY 1""",
    ),
)
def account_balance_lists(spark, sf_dir):
    accounts = b.account(spark, sf_dir)
    return balances.ordered_lists(accounts, "balance_date", "account_type", "balance", "all_balances").withColumn(
        "all_balances", F.array_join(F.col("all_balances").cast("array<string>"), ",")
    )


@query(
    "account_negative_ratio",
    with_views(
        b.ACCOUNT,
        body="""SELECT consumer_id, count(*) FILTER (WHERE balance < 0) AS negative_balance_days,
  max(balance_date) - min(balance_date) AS days_account_open,
  round(count(*) FILTER (WHERE balance < 0) / (max(balance_date) - min(balance_date) + 1), 6) AS negative_balance_ratio
FROM account GROUP BY 1""",
    ),
)
def account_negative_ratio(spark, sf_dir):
    return balances.account_negative_ratio(b.account(spark, sf_dir)).select(
        "consumer_id", "negative_balance_days", big("days_account_open"), rnd("negative_balance_ratio")
    )


@query(
    "account_age",
    with_views(
        b.ACCOUNT,
        body="""SELECT consumer_id, max((SELECT max(balance_date) FROM account) - balance_date) AS account_age_days
FROM account GROUP BY 1""",
    ),
)
def account_age(spark, sf_dir):
    return balances.account_age(b.account(spark, sf_dir)).select("consumer_id", big("account_age_days"))


@query(
    "balance_windows",
    with_views(
        b.ACCOUNT,
        "aged AS (SELECT *, (SELECT max(balance_date) FROM account) - balance_date AS age FROM account)",
        body="SELECT consumer_id, "
        + ", ".join(
            f"round(CAST(sum(balance) FILTER (WHERE age <= {d}) AS DOUBLE) / count(*) FILTER (WHERE age <= {d}), 6) AS avg_balance_{d}d"
            for d in (30, 90, 180, 365)
        )
        + ", "
        + ", ".join(
            f"count(*) FILTER (WHERE age <= {d} AND balance < {t}) AS below_{t}_{d}d"
            for t in (25, 50, 100)
            for d in (30, 90, 180, 365)
        )
        + ", count(*) FILTER (WHERE balance < 0) AS days_negative_balance FROM aged GROUP BY 1",
    ),
)
def balance_windows(spark, sf_dir):
    out = balances.balance_windows(b.account(spark, sf_dir))
    return out.select("consumer_id", *[rnd(c) if c.startswith("avg") else big(c) for c in out.columns[1:]])


@query(
    "zscore_balance",
    with_views(
        b.ACCOUNT,
        b.CONSUMER,
        "cb AS (SELECT consumer_id, credit_score, CAST(x AS DOUBLE) AS balance FROM consumer"
        " FULL JOIN (SELECT consumer_id, sum(balance) AS x FROM account GROUP BY 1) USING (consumer_id))",
        body="""SELECT consumer_id,
  round((credit_score - (SELECT avg(credit_score) FROM cb)) / (SELECT stddev_samp(credit_score) FROM cb), 6) AS std_credit_score,
  round((balance - (SELECT avg(balance) FROM cb)) / (SELECT stddev_samp(balance) FROM cb), 6) AS std_balance FROM cb""",
    ),
)
def zscore_balance(spark, sf_dir):
    joined = b.consumer(spark, sf_dir).join(
        balances.consumer_balance(b.account(spark, sf_dir)), "consumer_id", "full_outer"
    )
    return balances.zscore(joined, ["credit_score", "balance"]).select(
        "consumer_id", rnd("std_credit_score"), rnd("std_balance")
    )


@query(
    "zscore_wide",
    with_views(
        b.ACCOUNT,
        "wide AS (SELECT consumer_id, "
        + ", ".join(
            f"CAST(coalesce(sum({ADJUSTED}) FILTER (WHERE account_type = '{t}'), 0) AS DOUBLE) AS \"{t}\""
            for t in b.ACCOUNT_TYPES
        )
        + " FROM account GROUP BY 1)",
        body="SELECT consumer_id, "
        + ", ".join(
            f'round(("{t}" - (SELECT avg("{t}") FROM wide)) / (SELECT stddev_samp("{t}") FROM wide), 6) AS "std_{t}"'
            for t in b.ACCOUNT_TYPES
        )
        + " FROM wide",
    ),
)
def zscore_wide(spark, sf_dir):
    wide = balances.adjusted_balance_by_type(b.account(spark, sf_dir), b.ACCOUNT_TYPES, b.BORROWING)
    out = balances.zscore(wide, b.ACCOUNT_TYPES)
    return out.select("consumer_id", *[rnd(f"std_{t}") for t in b.ACCOUNT_TYPES])


STATS_SQL = """SELECT consumer_id, category, round(median(v), 6) AS median, count(v) AS "count",
  round(coalesce(CASE WHEN count(v) > 2 THEN skewness(v) END, 0), 6) AS skewness,
  round(quantile_cont(v, 0.75) - quantile_cont(v, 0.25), 6) AS iqr,
  round(coalesce(stddev_samp(v) / nullif(avg(v), 0), 0), 6) AS coef_variation
FROM (SELECT consumer_id, category, CAST(amount AS DOUBLE) AS v FROM {source}) WHERE category IS NOT NULL GROUP BY 1, 2"""


@query("category_stats", with_views(b.LTXN, body=STATS_SQL.format(source="ltxn")))
def category_stats(spark, sf_dir):
    return category.category_stats(b.ltxn(spark, sf_dir)).select(
        "consumer_id", "category", rnd("median"), "count", rnd("skewness"), rnd("iqr"), rnd("coef_variation")
    )


def _wide_sql(long_sql: str, stats: tuple[str, ...]) -> str:
    cells = ", ".join(
        f"CAST(coalesce(max(\"{s}\") FILTER (WHERE category = '{c}'), 0) AS DOUBLE) AS \"{c}_{s}\""
        for c in b.CATEGORIES
        for s in stats
    )
    return f"SELECT consumer_id, {cells} FROM ({long_sql}) GROUP BY 1"


@query(
    "category_stats_wide",
    with_views(*CTXN_VIEWS, body=_wide_sql(STATS_SQL.format(source="ctxn"), category.ADVANCED)),
)
def category_stats_wide(spark, sf_dir):
    out = category.category_stats_wide(ctxn(spark, sf_dir), b.CATEGORIES)
    return out.select("consumer_id", *[rnd(c) for c in out.columns[1:]])


GRID = """spans AS (
  SELECT consumer_id, date_trunc('month', min(posted_date)) AS lo, date_trunc('month', max(posted_date)) AS hi FROM ctxn GROUP BY 1),
months AS (SELECT consumer_id, CAST(unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS DATE) AS month FROM spans),
cats AS (SELECT DISTINCT category FROM ctxn WHERE category IS NOT NULL),
grid AS (
  SELECT m.consumer_id, m.month, c.category, coalesce(s.a, 0) AS amount FROM months m CROSS JOIN cats c
  LEFT JOIN (SELECT consumer_id, category, CAST(date_trunc('month', posted_date) AS DATE) AS month, sum(amount) AS a
             FROM ctxn GROUP BY 1, 2, 3) s
  ON s.consumer_id = m.consumer_id AND s.category = c.category AND s.month = m.month)"""


@query(
    "month_category_grid",
    with_views(
        *CTXN_VIEWS,
        GRID,
        body="SELECT consumer_id, category, CAST(month AS VARCHAR) AS month, CAST(amount AS DOUBLE) AS amount FROM grid",
    ),
)
def month_category_grid(spark, sf_dir):
    return category.month_category_grid(ctxn(spark, sf_dir), b.CATEGORIES).select(
        "consumer_id", "category", text("month"), dbl("amount")
    )


CHANGE = """changes AS (
  SELECT consumer_id, category, CAST(sum(d) AS DOUBLE) / count(*) AS mean,
    coalesce(stddev_samp(CAST(d AS DOUBLE)), 0) AS std FROM (
    SELECT consumer_id, category, coalesce(amount - lag(amount) OVER (
      PARTITION BY consumer_id, category ORDER BY month), 0) AS d FROM grid) GROUP BY 1, 2)"""


@query(
    "monthly_change_stats",
    with_views(
        *CTXN_VIEWS,
        GRID,
        CHANGE,
        body="""SELECT consumer_id, category, round(mean, 5) AS mean, round(std, 5) AS std FROM changes
WHERE (consumer_id, category) IN (SELECT consumer_id, category FROM ctxn)""",
    ),
)
def monthly_change_stats(spark, sf_dir):
    return category.monthly_change_stats(ctxn(spark, sf_dir)).select(
        "consumer_id", "category", rnd("mean", digits=5), rnd("std", digits=5)
    )


def _features_sql() -> str:
    """The feature table from the dense grid and one sub-query per part."""
    types = ", ".join(f"count(*) FILTER (WHERE account_type = '{t}') AS \"account_type_{t}\"" for t in b.ACCOUNT_TYPES)
    change = _wide_sql("SELECT * FROM changes", ("mean", "std"))
    stats = _wide_sql(STATS_SQL.format(source="ctxn"), category.ADVANCED)
    filled = [f"{c}_{s}" for c in b.CATEGORIES for s in category.ADVANCED]
    changed = [f"{c}_{s}" for c in b.CATEGORIES for s in ("mean", "std")]
    return (
        "SELECT c.consumer_id, c.credit_score, c.dq_target, "
        + ", ".join(f'"account_type_{t}"' for t in b.ACCOUNT_TYPES)
        + ", coalesce(t.n, 0) AS transactions, "
        + ", ".join(f'coalesce(s."{c}", 0) AS "{c}"' for c in filled)
        + ", "
        + ", ".join(f'round(coalesce(g."{c}", 0), 5) AS "{c}"' for c in changed)
        + ", CAST(CASE WHEN g.consumer_id IS NULL THEN 0 ELSE coalesce(x.v, 0) END AS DOUBLE) AS balance FROM consumer c"
        + f" JOIN (SELECT consumer_id, {types} FROM account GROUP BY 1) a USING (consumer_id)"
        + " LEFT JOIN (SELECT consumer_id, count(category) AS n FROM ctxn GROUP BY 1) t USING (consumer_id)"
        + f" LEFT JOIN ({stats}) s USING (consumer_id) LEFT JOIN ({change}) g USING (consumer_id)"
        + " LEFT JOIN (SELECT consumer_id, sum(balance) AS v FROM account GROUP BY 1) x USING (consumer_id)"
        + " WHERE c.dq_target IS NOT NULL AND coalesce(t.n, 0) > 1"
    )


@query("consumer_features", with_views(*CTXN_VIEWS, b.ACCOUNT, b.CONSUMER, GRID, CHANGE, body=_features_sql()))
def consumer_features(spark, sf_dir):
    out = build_features(
        b.consumer(spark, sf_dir),
        b.account(spark, sf_dir),
        ctxn(spark, sf_dir),
        categories=b.CATEGORIES,
        account_types=b.ACCOUNT_TYPES,
        labelled=True,
        min_transactions=1,
    )
    changed = {f"{c}_{s}" for c in b.CATEGORIES for s in ("mean", "std")}
    stats = {f"{c}_{s}" for c in b.CATEGORIES for s in category.ADVANCED}
    return out.select(
        *[
            rnd(c, digits=5) if c in changed else rnd(c) if c in stats else dbl(c) if c == "balance" else F.col(f"`{c}`")
            for c in out.columns
        ]
    )


GAPS = """gaps AS (
  SELECT *, posted_date - lag(posted_date) OVER (PARTITION BY consumer_id, category ORDER BY posted_date, txn_id) AS gap
  FROM {source} WHERE category IS NOT NULL)"""
REGULAR = """regular AS (
  SELECT consumer_id, category, count(gap) AS n_gaps, count(gap) >= 2 AND coalesce(bool_and(
    gap BETWEEN 2 AND 12 OR gap BETWEEN 9 AND 19 OR gap BETWEEN 25 AND 35), true) AS is_regular
  FROM gaps GROUP BY 1, 2)"""


@query(
    "regular_groups",
    with_views(
        b.EVTXN,
        b.EVTXN_3D,
        GAPS.format(source="evtxn_3d"),
        REGULAR,
        body="SELECT consumer_id, category, n_gaps, is_regular FROM regular",
    ),
)
def regular_groups(spark, sf_dir):
    return recurrence.regular_groups(b.evtxn_3d(spark, sf_dir))


@query(
    "regular_groups_dense",
    with_views(
        b.EVTXN, GAPS.format(source="evtxn"), REGULAR, body="SELECT consumer_id, category, n_gaps, is_regular FROM regular"
    ),
)
def regular_groups_dense(spark, sf_dir):
    return recurrence.regular_groups(b.evtxn(spark, sf_dir))


@query(
    "income_per_day",
    with_views(
        b.EVTXN,
        b.EVTXN_3D,
        GAPS.format(source="evtxn_3d"),
        REGULAR,
        body="""SELECT consumer_id, CAST(coalesce(sum(amount) FILTER (WHERE is_regular AND credit_or_debit = 'CREDIT'), 0) AS DOUBLE) AS income,
  max(posted_date) - min(posted_date) AS days,
  round(coalesce(CAST(coalesce(sum(amount) FILTER (WHERE is_regular AND credit_or_debit = 'CREDIT'), 0) AS DOUBLE)
    / nullif(max(posted_date) - min(posted_date), 0), 0), 6) AS income_per_day
FROM evtxn_3d JOIN regular USING (consumer_id, category) GROUP BY 1""",
    ),
)
def income_per_day(spark, sf_dir):
    return recurrence.income_per_day(b.evtxn_3d(spark, sf_dir)).select(
        "consumer_id", dbl("income"), big("days"), rnd("income_per_day")
    )


RECURRING = """recurring AS (
  SELECT consumer_id, category, coalesce(bool_or(abs(gap - 30) <= 7 OR abs(gap - 7) <= 3 OR abs(gap - 14) <= 3), false) AS is_recurring,
    count(*) AS n FROM gaps GROUP BY 1, 2)"""


@query(
    "recurring_flags",
    with_views(
        *CTXN_VIEWS,
        GAPS.format(source="ctxn"),
        RECURRING,
        body="""SELECT txn_id, t.consumer_id, t.category, coalesce(is_recurring, false) AS is_recurring FROM ctxn t
LEFT JOIN recurring r ON r.consumer_id = t.consumer_id AND r.category = t.category""",
    ),
)
def recurring_flags(spark, sf_dir):
    return recurrence.recurring_flags(ctxn(spark, sf_dir)).select("txn_id", "consumer_id", "category", "is_recurring")


@query(
    "recurring_summary",
    with_views(
        *CTXN_VIEWS,
        GAPS.format(source="ctxn"),
        RECURRING,
        body="SELECT consumer_id, category, n AS n_transactions FROM recurring WHERE is_recurring",
    ),
)
def recurring_summary(spark, sf_dir):
    return recurrence.recurring_summary(ctxn(spark, sf_dir))


@query(
    "recurrence_tolerance",
    with_views(
        b.TXN,
        body="""SELECT txn_id, consumer_id, coalesce(abs(CAST(amount AS DOUBLE) - m) / nullif(CAST(amount AS DOUBLE), 0) <= 0.2, false) AS amount_tolerance,
  coalesce(abs(gap) <= 7, false) AS date_tolerance FROM (
    SELECT *, CAST(sum(amount) OVER (PARTITION BY consumer_id) AS DOUBLE) / count(amount) OVER (PARTITION BY consumer_id) AS m,
      posted_date - lag(posted_date) OVER (PARTITION BY consumer_id ORDER BY posted_date, txn_id) AS gap FROM txn)""",
    ),
)
def recurrence_tolerance(spark, sf_dir):
    return recurrence.recurrence_tolerance(b.txn(spark, sf_dir)).select(
        "txn_id", "consumer_id", "amount_tolerance", "date_tolerance"
    )
