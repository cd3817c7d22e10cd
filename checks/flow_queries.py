"""Sources, joins and cash-flow queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import bindings as b
from checks.bindings import Registry, big, dbl, rnd, text, with_views
from ledgerloom.operators import flows
from ledgerloom.session import new_path
from ledgerloom.sources import schemas, tables

registry = Registry()
query = registry.add


def ctxn(spark, sf_dir):
    return flows.with_category(b.txn(spark, sf_dir), b.catmap(spark, sf_dir), b.EXCLUDED)


def income(spark, sf_dir):
    return flows.keep_and_recode(b.evtxn(spark, sf_dir), b.INCOME_KEEP, b.INCOME_RECODE)


CTXN_VIEWS = (b.TXN, b.CATMAP, b.CTXN)
INCOME_VIEWS = (b.EVTXN, b.INCOME)


@query(
    "csv_roundtrip",
    with_views(
        b.TXN,
        b.CATMAP,
        body="""SELECT t.txn_id, CAST(t.consumer_id AS VARCHAR) AS consumer_id, t.category_id,
  CAST(t.amount AS DOUBLE) AS amount, t.credit_or_debit, CAST(t.posted_date AS VARCHAR) AS posted_date, c.category
FROM (SELECT * REPLACE (CAST(txn_id AS VARCHAR) AS txn_id) FROM txn) t LEFT JOIN catmap c ON t.category_id = c.category_id""",
    ),
)
def csv_roundtrip(spark, sf_dir):
    ledger, names = new_path(spark, "ledger-csv"), new_path(spark, "catmap-csv")
    tables.write_csv(tables.conform(b.txn(spark, sf_dir), schemas.TRANSACTION), ledger)
    tables.write_csv(b.catmap(spark, sf_dir), names)
    back = tables.read_csv(spark, ledger, schemas.TRANSACTION)
    cats = tables.read_csv(spark, names, schemas.CATEGORY_MAP)
    return flows.with_category(back, cats, ["-"]).select(
        "txn_id", "consumer_id", "category_id", dbl("amount"), "credit_or_debit", text("posted_date"), "category"
    )


LINE_SQL = "'__label__' || replace(category, ' ', '_') || ' ' || regexp_replace(memo, '[\\r\\n]+', ' ', 'g')"


@query("labelled_text_lines", with_views(b.MEMO, body=f"SELECT {LINE_SQL} AS value FROM memo"))
def labelled_text_lines(spark, sf_dir):
    path = new_path(spark, "labelled-lines")
    tables.write_labelled_lines(b.memo(spark, sf_dir), path)
    return spark.read.text(path)


@query(
    "labelled_text_parse",
    with_views(
        b.MEMO,
        body="""SELECT category, regexp_replace(memo, '[\\r\\n]+', ' ', 'g') AS memo FROM memo""",
    ),
)
def labelled_text_parse(spark, sf_dir):
    path = new_path(spark, "labelled-lines")
    tables.write_labelled_lines(b.memo(spark, sf_dir), path)
    return tables.read_labelled_lines(spark, path)


@query(
    "signed_amounts",
    with_views(
        b.TXN,
        body="""SELECT txn_id, credit_or_debit,
  CAST(CASE WHEN credit_or_debit = 'DEBIT' THEN amount ELSE -amount END AS DOUBLE) AS amount FROM txn""",
    ),
)
def signed_amounts(spark, sf_dir):
    return tables.spend_signed(b.txn(spark, sf_dir)).select("txn_id", "credit_or_debit", dbl("amount"))


@query(
    "txn_with_category",
    with_views(
        *CTXN_VIEWS,
        body="""SELECT txn_id, consumer_id, category_id, category, CAST(amount AS DOUBLE) AS amount, credit_or_debit,
  CAST(posted_date AS VARCHAR) AS posted_date FROM ctxn""",
    ),
)
def txn_with_category(spark, sf_dir):
    return ctxn(spark, sf_dir).select(
        "txn_id", "consumer_id", "category_id", "category", dbl("amount"), "credit_or_debit", text("posted_date")
    )


@query(
    "consumer_totals",
    with_views(
        b.LTXN,
        body="""SELECT consumer_id, count(amount) AS n_transactions, round(avg(amount), 6) AS mean_amount,
  CAST(sum(amount) AS DOUBLE) AS total_amount FROM ltxn GROUP BY 1""",
    ),
)
def consumer_totals(spark, sf_dir):
    return flows.consumer_totals(b.ltxn(spark, sf_dir)).select(
        "consumer_id", "n_transactions", rnd(F.col("total_amount").cast("double") / F.col("n_transactions"), "mean_amount"),
        dbl("total_amount"),
    )


@query(
    "mean_of_consumer_totals",
    with_views(
        b.LTXN,
        body="""SELECT round(avg(n), 6) AS mean_n_transactions, round(avg(m), 4) AS mean_of_mean_amount
FROM (SELECT count(amount) AS n, avg(amount) AS m FROM ltxn GROUP BY consumer_id)""",
    ),
)
def mean_of_consumer_totals(spark, sf_dir):
    return flows.mean_of_consumer_totals(b.ltxn(spark, sf_dir)).select(
        rnd("mean_n_transactions"), rnd("mean_of_mean_amount", digits=4)
    )


@query(
    "total_transactions",
    with_views(
        *CTXN_VIEWS,
        b.CONSUMER,
        body="""SELECT c.consumer_id, c.credit_score, c.dq_target, coalesce(t.n, 0) AS transactions
FROM consumer c LEFT JOIN (SELECT consumer_id, count(category) AS n FROM ctxn GROUP BY 1) t USING (consumer_id)""",
    ),
)
def total_transactions(spark, sf_dir):
    return flows.total_transactions(b.consumer(spark, sf_dir), ctxn(spark, sf_dir))


@query(
    "credit_debit_totals",
    with_views(
        b.TXN,
        body="""SELECT consumer_id,
  CAST(coalesce(sum(amount) FILTER (WHERE credit_or_debit = 'CREDIT'), 0) AS DOUBLE) AS total_credit,
  CAST(coalesce(sum(amount) FILTER (WHERE credit_or_debit = 'DEBIT'), 0) AS DOUBLE) AS total_debit
FROM txn GROUP BY 1""",
    ),
)
def credit_debit_totals(spark, sf_dir):
    return flows.credit_debit_totals(b.txn(spark, sf_dir)).select(
        "consumer_id", dbl("total_credit"), dbl("total_debit")
    )


@query(
    "credit_share",
    with_views(
        b.TXN,
        body="""SELECT c.consumer_id, CAST(c.a AS DOUBLE) AS credit_amount, CAST(d.a AS DOUBLE) AS debit_amount,
  round(CAST(c.a AS DOUBLE) / (CAST(c.a AS DOUBLE) + CAST(d.a AS DOUBLE)), 6) AS credit_share
FROM (SELECT consumer_id, sum(amount) AS a FROM txn WHERE credit_or_debit = 'CREDIT' GROUP BY 1) c
JOIN (SELECT consumer_id, sum(amount) AS a FROM txn WHERE credit_or_debit = 'DEBIT' GROUP BY 1) d USING (consumer_id)""",
    ),
)
def credit_share(spark, sf_dir):
    return flows.credit_share(b.txn(spark, sf_dir)).select(
        "consumer_id", dbl("credit_amount"), dbl("debit_amount"), rnd("credit_share")
    )


SPEND_WINDOWS = (0, 350, 700, 1050, 1401)


@query(
    "spend_windows",
    with_views(
        b.TXN,
        body="SELECT consumer_id,"
        " CAST(coalesce(sum(amount) FILTER (WHERE credit_or_debit = 'CREDIT'), 0) AS DOUBLE) AS total_credit,"
        " CAST(coalesce(sum(amount) FILTER (WHERE credit_or_debit = 'DEBIT'), 0) AS DOUBLE) AS total_debit,"
        " CAST(sum(CASE WHEN credit_or_debit = 'CREDIT' THEN amount ELSE -amount END) AS DOUBLE) AS net_transaction_balance,"
        + ",".join(
            f" CAST(coalesce(sum(amount) FILTER (WHERE last_day - posted_date <= {d}), 0) AS DOUBLE) AS spending_last_{d}_days"
            for d in SPEND_WINDOWS
        )
        + ","
        + ",".join(
            f" CAST(coalesce(sum(amount) FILTER (WHERE category_id = {c}), 0) AS DOUBLE) AS category_{c}_spending"
            for c in range(1, 6)
        )
        + " FROM txn, (SELECT max(posted_date) AS last_day FROM txn) GROUP BY 1",
    ),
)
def spend_windows(spark, sf_dir):
    out = flows.spend_windows(b.txn(spark, sf_dir), SPEND_WINDOWS, range(1, 6), "category_id")
    return out.select("consumer_id", *[dbl(c) for c in out.columns[1:]])


@query(
    "avg_period_outflow",
    with_views(
        b.TXN,
        body="""SELECT consumer_id,
  round(CAST(sum(amount) AS DOUBLE) / count(DISTINCT date_trunc('month', posted_date)), 6) AS avg_monthly_outflow,
  round(CAST(sum(amount) AS DOUBLE) / count(DISTINCT date_trunc('year', posted_date)), 6) AS avg_yearly_outflow
FROM txn WHERE credit_or_debit = 'DEBIT' GROUP BY 1""",
    ),
)
def avg_period_outflow(spark, sf_dir):
    return flows.avg_period_outflow(b.txn(spark, sf_dir)).select(
        "consumer_id", rnd("avg_monthly_outflow"), rnd("avg_yearly_outflow")
    )


@query(
    "consumer_category_totals",
    with_views(
        b.LTXN,
        body="""SELECT consumer_id, category, count(*) AS total_transactions,
  CAST(coalesce(sum(amount) FILTER (WHERE credit_or_debit = 'CREDIT'), 0) AS DOUBLE) AS total_credit_amount,
  CAST(coalesce(sum(amount) FILTER (WHERE credit_or_debit = 'DEBIT'), 0) AS DOUBLE) AS total_debit_amount,
  CAST(sum(amount) AS DOUBLE) AS total_transaction_amount
FROM ltxn GROUP BY 1, 2""",
    ),
)
def consumer_category_totals(spark, sf_dir):
    return flows.consumer_category_totals(b.ltxn(spark, sf_dir)).select(
        "consumer_id", "category", "total_transactions", dbl("total_credit_amount"), dbl("total_debit_amount"),
        dbl("total_transaction_amount"),
    )


PART_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


@query(
    "direction_category_pivot",
    with_views(
        b.LTXN,
        body="SELECT consumer_id, "
        + ", ".join(
            f"CAST(coalesce(sum(amount) FILTER (WHERE category = '{c}' AND credit_or_debit = '{d.upper()}'), 0) AS DOUBLE)"
            f" AS category_{c}_{d}_spending"
            for c in PART_TYPES
            for d in ("credit", "debit")
        )
        + " FROM ltxn GROUP BY 1",
    ),
)
def direction_category_pivot(spark, sf_dir):
    out = flows.direction_category_pivot(b.ltxn(spark, sf_dir), PART_TYPES)
    return out.select("consumer_id", *[dbl(c) for c in out.columns[1:]])


def _flow_pivot_sql() -> str:
    out_cells, in_cells = [], []
    for c in b.CATEGORIES:
        out_cells += [
            f"count(*) FILTER (WHERE category = '{c}') AS outflow_occurrences_{c}",
            f"CAST(coalesce(sum(amount) FILTER (WHERE category = '{c}'), 0) AS DOUBLE) AS outflow_sums_{c}",
        ]
        in_cells += [
            f"CAST(count(*) FILTER (WHERE category = '{c}') AS DOUBLE) AS inflow_occurrences_{c}",
            f"CAST(coalesce(sum(amount) FILTER (WHERE category = '{c}'), 0) AS DOUBLE) AS inflow_sums_{c}",
        ]
    half = "SELECT consumer_id, {cells} FROM ctxn WHERE category IS NOT NULL AND credit_or_debit = '{side}' GROUP BY 1"
    return (
        "SELECT * FROM (" + half.format(cells=", ".join(out_cells), side="DEBIT") + ") o LEFT JOIN ("
        + half.format(cells=", ".join(in_cells), side="CREDIT") + ") i USING (consumer_id)"
    )


@query("flow_pivots", with_views(*CTXN_VIEWS, body=_flow_pivot_sql()))
def flow_pivots(spark, sf_dir):
    out = flows.flow_pivots(ctxn(spark, sf_dir), b.CATEGORIES)
    cells = [c for c in out.columns if c != "consumer_id"]
    return out.select("consumer_id", *[big(c) if c.startswith("outflow_occ") else dbl(c) for c in cells])


def _percent_sql() -> str:
    cells = []
    for name, cond in (("credit", "credit_or_debit = 'CREDIT'"), ("debit", "credit_or_debit = 'DEBIT'"), ("trxn", "true")):
        total = f"CAST(sum(amount) FILTER (WHERE {cond}) AS DOUBLE)"
        for c in range(1, 6):
            part = f"CAST(coalesce(sum(amount) FILTER (WHERE {cond} AND category_id = {c}), 0) AS DOUBLE)"
            cells.append(f"round({part} / {total} * 100, 6) AS {name}_percentage_{c}")
        cells.append(f"{total} AS {name}_percentage_total")
    return (
        "SELECT * FROM (SELECT consumer_id FROM consumer) c LEFT JOIN (SELECT consumer_id, "
        + ", ".join(cells) + " FROM txn GROUP BY 1) t USING (consumer_id)"
    )


@query("category_percent", with_views(b.TXN, b.CONSUMER, body=_percent_sql()))
def category_percent(spark, sf_dir):
    out = flows.category_percent(b.consumer(spark, sf_dir), b.txn(spark, sf_dir), range(1, 6), "category_id")
    return out.select("consumer_id", *[dbl(c) if c.endswith("total") else rnd(c) for c in out.columns[1:]])


@query(
    "running_total_stats",
    with_views(
        b.TXN,
        body="SELECT * FROM "
        + " JOIN ".join(
            f"""(SELECT consumer_id, round(avg(r), 6) AS "{p}_mean", round(median(r), 6) AS "{p}_median",
  round(var_samp(r), -2) AS "{p}_var" FROM (
    SELECT consumer_id, CAST(sum(a) OVER (PARTITION BY consumer_id ORDER BY d) AS DOUBLE) AS r FROM (
      SELECT consumer_id, {expr} AS d, sum(CASE WHEN credit_or_debit = 'CREDIT' THEN amount ELSE -amount END) AS a
      FROM txn GROUP BY 1, 2)) GROUP BY 1) t{p}"""
            + ("" if p == "1M" else " USING (consumer_id)")
            for p, expr in (
                ("1M", "last_day(posted_date)"),
                ("1W", "CAST(date_trunc('week', posted_date) AS DATE) + 6"),
                ("1D", "posted_date"),
            )
        ),
    ),
)
def running_total_stats(spark, sf_dir):
    out = flows.running_total_stats(b.txn(spark, sf_dir))
    return out.select("consumer_id", *[rnd(c, digits=-2 if c.endswith("var") else 6) for c in out.columns[1:]])


@query(
    "period_balances",
    with_views(
        b.TXN,
        body="""SELECT consumer_id, CAST(d AS VARCHAR) AS period, CAST(a AS DOUBLE) AS net_flow,
  CAST(sum(a) OVER (PARTITION BY consumer_id ORDER BY d) AS DOUBLE) AS running_total FROM (
    SELECT consumer_id, CAST(date_trunc('week', posted_date) AS DATE) + 6 AS d,
      sum(CASE WHEN credit_or_debit = 'CREDIT' THEN amount ELSE -amount END) AS a FROM txn GROUP BY 1, 2)""",
    ),
)
def period_balances(spark, sf_dir):
    return flows.period_balances(b.txn(spark, sf_dir), "1W").select(
        "consumer_id", text("period"), dbl("net_flow"), dbl("running_total")
    )


@query(
    "days_open",
    with_views(b.TXN, body="SELECT consumer_id, max(posted_date) - min(posted_date) AS total_days FROM txn GROUP BY 1"),
)
def days_open(spark, sf_dir):
    return flows.days_open(b.txn(spark, sf_dir)).select("consumer_id", big("total_days"))


SHARES_SQL = """SELECT consumer_id, category, CAST(a AS DOUBLE) AS amount, CAST(t AS DOUBLE) AS total_income,
  CAST(round(CAST(a * 100 / NULLIF(CAST(t AS DOUBLE), 0) AS DECIMAL(20,8)), 2) AS DOUBLE) AS percentage FROM (
  SELECT consumer_id, category, sum(amount) AS a, sum(sum(amount)) OVER (PARTITION BY consumer_id) AS t
  FROM income GROUP BY 1, 2)"""


@query(
    "income_shares", with_views(*INCOME_VIEWS, body=SHARES_SQL)
)
def income_shares(spark, sf_dir):
    return flows.income_shares(income(spark, sf_dir)).select(
        "consumer_id", "category", dbl("amount"), dbl("total_income"), "percentage"
    )


@query(
    "income_breakdown",
    with_views(
        *INCOME_VIEWS,
        body=f"""SELECT consumer_id, coalesce(max(percentage) FILTER (WHERE category = 'click'), 0) AS click,
  coalesce(max(percentage) FILTER (WHERE category = 'purchase'), 0) AS purchase FROM ({SHARES_SQL}) GROUP BY 1""",
    ),
)
def income_breakdown(spark, sf_dir):
    return flows.income_breakdown(income(spark, sf_dir), ["click", "purchase"])


@query(
    "income_breakdown_summary",
    with_views(
        *INCOME_VIEWS,
        body=f"""SELECT category, round(avg(p), 2) AS average_percentage, round(stddev_samp(p), 2) AS standard_deviation
FROM (SELECT u.consumer_id, k.category, coalesce(s.percentage, 0) AS p
  FROM (SELECT DISTINCT consumer_id FROM income) u, (SELECT DISTINCT category FROM income) k
  LEFT JOIN ({SHARES_SQL}) s ON s.consumer_id = u.consumer_id AND s.category = k.category) GROUP BY 1""",
    ),
)
def income_breakdown_summary(spark, sf_dir):
    return flows.income_breakdown_summary(income(spark, sf_dir), ["click", "purchase"])


@query(
    "category_mean_of_totals",
    with_views(
        *INCOME_VIEWS,
        body="""SELECT category, round(avg(CAST(a AS DOUBLE)), 6) AS mean_total_amount, round(avg(n), 6) AS mean_total_transactions
FROM (SELECT consumer_id, category, sum(amount) AS a, count(posted_date) AS n FROM income GROUP BY 1, 2) GROUP BY 1""",
    ),
)
def category_mean_of_totals(spark, sf_dir):
    return flows.category_mean_of_totals(income(spark, sf_dir)).select(
        "category", rnd("mean_total_amount"), rnd("mean_total_transactions")
    )


@query(
    "activity_rates",
    with_views(
        b.TXN,
        body="""SELECT consumer_id, CAST(lo AS VARCHAR) AS min_date, CAST(hi AS VARCHAR) AS max_date, n AS total_transactions,
  CAST(a AS DOUBLE) AS total_amount, round((hi - lo + 1) / 365.0, 6) AS account_age,
  round(n / ((hi - lo + 1) / 365.0), 6) AS transactions_per_unit,
  round(CAST(a AS DOUBLE) / ((hi - lo + 1) / CAST(365.0 AS DOUBLE)), 4) AS amount_per_unit
FROM (SELECT consumer_id, min(posted_date) AS lo, max(posted_date) AS hi, count(posted_date) AS n, sum(amount) AS a
  FROM txn GROUP BY 1)""",
    ),
)
def activity_rates(spark, sf_dir):
    return flows.activity_rates(b.txn(spark, sf_dir)).select(
        "consumer_id", text("min_date"), text("max_date"), "total_transactions", dbl("total_amount"),
        rnd("account_age"), rnd("transactions_per_unit"), rnd("amount_per_unit", digits=4),
    )


@query(
    "income_sources",
    with_views(
        *INCOME_VIEWS,
        body="""SELECT category, CAST(sum(amount) AS DOUBLE) AS total_amount,
  round(CAST(sum(amount) AS DOUBLE) / count(amount), 6) AS mean_amount, count(amount) AS n_transactions
FROM income GROUP BY 1""",
    ),
)
def income_sources(spark, sf_dir):
    return flows.income_sources(income(spark, sf_dir)).select(
        "category", dbl("total_amount"), rnd(F.col("total_amount").cast("double") / F.col("n_transactions"), "mean_amount"),
        "n_transactions",
    )


@query(
    "inflow_summary",
    with_views(
        *INCOME_VIEWS,
        body="""SELECT consumer_id, CAST(sum(amount) AS DOUBLE) AS total_inflow, count(memo) AS transaction_count
FROM income GROUP BY 1""",
    ),
)
def inflow_summary(spark, sf_dir):
    return flows.inflow_summary(income(spark, sf_dir)).select("consumer_id", dbl("total_inflow"), "transaction_count")


@query(
    "top_income_source",
    with_views(
        b.EVTXN,
        body="""SELECT consumer_id, category, CAST(a AS DOUBLE) AS total_inflow, n AS transaction_count, CAST(1.0 AS DOUBLE) AS rank
FROM (SELECT *, rank() OVER (PARTITION BY consumer_id ORDER BY a DESC) AS r,
        count(*) OVER (PARTITION BY consumer_id, a) AS ties
  FROM (SELECT consumer_id, category, sum(amount) AS a, count(memo) AS n FROM evtxn GROUP BY 1, 2))
WHERE r = 1 AND ties = 1""",
    ),
)
def top_income_source(spark, sf_dir):
    return flows.top_income_source(b.evtxn(spark, sf_dir)).select(
        "consumer_id", "category", dbl("total_inflow"), "transaction_count", dbl("rank")
    )


@query(
    "category_direction_mix",
    with_views(
        b.TXN,
        b.CATMAP,
        body="""SELECT c.category_id, c.category, t.d AS total_debit, t.n AS total, round(t.d / t.n, 6) AS percent_debit,
  CASE WHEN t.d = t.n THEN 'debit_only' WHEN t.d = 0 THEN 'credit_only' ELSE 'mixed' END AS direction_class
FROM catmap c LEFT JOIN (SELECT category_id, count(*) FILTER (WHERE credit_or_debit = 'DEBIT') AS d,
  count(credit_or_debit) AS n FROM txn GROUP BY 1) t ON c.category_id = t.category_id""",
    ),
)
def category_direction_mix(spark, sf_dir):
    return flows.category_direction_mix(b.txn(spark, sf_dir), b.catmap(spark, sf_dir)).withColumn(
        "percent_debit", F.round("percent_debit", 6)
    )


@query(
    "spending_balance_ratio",
    with_views(
        b.TXN,
        b.ACCOUNT,
        body="""SELECT consumer_id, CAST(t.a AS DOUBLE) AS amount, CAST(c.x AS DOUBLE) AS balance,
  round(CAST(t.a AS DOUBLE) / (CAST(c.x AS DOUBLE) + 1), 6) AS spending_balance_ratio
FROM (SELECT consumer_id, sum(amount) AS a FROM txn GROUP BY 1) t
JOIN (SELECT consumer_id, sum(balance) AS x FROM account GROUP BY 1) c USING (consumer_id)""",
    ),
)
def spending_balance_ratio(spark, sf_dir):
    return flows.spending_balance_ratio(b.txn(spark, sf_dir), b.account(spark, sf_dir)).select(
        "consumer_id", dbl("amount"), dbl("balance"), rnd("spending_balance_ratio")
    )


DESCRIBE_SQL = """count(v) AS "count", round(avg(v), 7) AS mean, round(stddev_samp(v), 6) AS std, min(v) AS min,
  round(quantile_cont(v, 0.25), 6) AS p25, round(quantile_cont(v, 0.5), 6) AS p50,
  round(quantile_cont(v, 0.75), 6) AS p75, max(v) AS max"""


def describe_columns(df):
    keys = [c for c in df.columns if c not in ("count", "mean", "std", "min", "p25", "p50", "p75", "max")]
    return df.select(
        *keys, "count", rnd("mean", digits=7), rnd("std"), "min", rnd("p25"), rnd("p50"), rnd("p75"), "max"
    )


@query(
    "describe_amounts",
    with_views(b.LTXN, body=f"SELECT {DESCRIBE_SQL} FROM (SELECT CAST(amount AS DOUBLE) AS v FROM ltxn)"),
)
def describe_amounts(spark, sf_dir):
    return describe_columns(flows.describe(b.ltxn(spark, sf_dir)))


@query(
    "describe_by_category",
    with_views(
        b.LTXN,
        body=f"""SELECT consumer_id, category, {DESCRIBE_SQL}
FROM (SELECT consumer_id, category, CAST(amount AS DOUBLE) AS v FROM ltxn) GROUP BY 1, 2""",
    ),
)
def describe_by_category(spark, sf_dir):
    return describe_columns(flows.describe(b.ltxn(spark, sf_dir), keys=["consumer_id", "category"]))
