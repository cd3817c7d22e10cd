"""Hand-worked cases for flows, balances, categories and recurrence."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions.columns import not_in_keep_nulls, sample_skewness, week_end_sunday
from ledgerloom.operators import balances, category, flows, recurrence
from ledgerloom.plans.consumer_features import consumer_features

FOUR = [
    (1, 1, "A", 10, "CREDIT", "2024-01-01"),
    (2, 1, "A", 4, "DEBIT", "2024-01-02"),
    (3, 1, "A", 8, "DEBIT", "2024-01-03"),
    (4, 1, "A", 1, "CREDIT", "2024-01-04"),
]


def accounts(spark, rows):
    return spark.createDataFrame(
        [(c, t, d, float(x)) for c, t, d, x in rows], "consumer_id long, account_type string, d string, b double"
    ).selectExpr("consumer_id", "account_type", "cast(d as date) balance_date", "cast(b as decimal(18,2)) balance")


def by(df, key, value):
    return {r[key]: r[value] for r in df.collect()}


def test_running_balance_and_rates(ledger):
    with_balance = balances.running_balance(ledger(FOUR[:3]))
    assert by(with_balance, "txn_id", "calculated_balance") == {1: 10, 2: 6, 3: -2}
    rates = balances.negative_balance_rates(with_balance).first()
    assert rates["negative_balance_ratio"] == pytest.approx(1 / 3)
    assert rates["negative_balance_per_day"] == pytest.approx(1 / 3)
    assert balances.below_threshold_ratios(with_balance, [1, 2]).first()[1:] == (pytest.approx(1 / 3), 0.0)


def test_same_day_rows_follow_the_transaction_id(ledger):
    rows = [(2, 1, "A", 5, "DEBIT", "2024-01-01"), (1, 1, "A", 3, "CREDIT", "2024-01-01")]
    assert by(balances.running_balance(ledger(rows)), "txn_id", "calculated_balance") == {1: 3, 2: -2}


@pytest.mark.parametrize("max_rows", [1_000_000, 2])
def test_anchored_balance(spark, ledger, max_rows):
    anchor = accounts(spark, [(1, "CHECKING", "2024-01-03", 60), (1, "SAVINGS", "2024-02-01", 40)])
    out = balances.anchored_balance(ledger(FOUR), anchor, max_rows=max_rows)
    assert by(out, "txn_id", "running_balance") == {1: 94, 2: 104, 3: 92, 4: 93}
    share = balances.negative_txn_share(out).first()
    assert (share["days"], share["transaction_count"], share["negative_trans_count"]) == (4, 4, 0)


@pytest.mark.parametrize("max_rows", [1_000_000, 2])
def test_anchored_balance_differs_from_the_running_one_by_a_constant(spark, sf_dir, max_rows):
    from checks import bindings as b

    txn, acct = b.txn(spark, sf_dir), b.account(spark, sf_dir)
    run = balances.running_balance(txn).select("txn_id", "calculated_balance")
    both = balances.anchored_balance(txn, acct, max_rows=max_rows).join(run, "txn_id")
    after = F.col("posted_date") >= F.col("anchor_date")
    signed = F.when(F.col("credit_or_debit") == "CREDIT", F.col("amount")).otherwise(-F.col("amount"))
    shift = F.col("running_balance") - F.when(after, F.col("calculated_balance")).otherwise(
        F.col("calculated_balance") - signed
    )
    spread = both.groupBy("consumer_id").agg(F.max(shift).alias("hi"), F.min(shift).alias("lo"))
    assert spread.filter("hi <> lo").count() == 0


def test_balance_lists_are_ordered_and_cut_into_chunks(ledger):
    with_balance = balances.running_balance(ledger(FOUR))
    rows = balances.balance_lists(with_balance, chunk=3).orderBy("chunk_no").collect()
    assert [[float(x) for x in r["all_balances"]] for r in rows] == [[10, 6, -2], [-1]]


def test_account_features(spark):
    acct = accounts(
        spark,
        [(1, "SAVINGS", "2024-01-01", 10), (1, "LOAN", "2024-01-31", 30), (1, "LOAN", "2024-01-11", -5), (2, "LOAN", "2024-01-31", 1)],
    )
    people = spark.sql("select * from values (1L, 700.0, 1.0), (2L, null, null), (3L, 650.0, 0.0) t(consumer_id, credit_score, dq_target)")
    types = ["SAVINGS", "LOAN"]
    normal = {r["consumer_id"]: r for r in balances.account_type_onehot(acct, people, types).collect()}
    assert (normal[1]["account_type_LOAN"], normal[3]["account_type_LOAN"]) == (2, 0)
    assert normal[2]["credit_score"] == 0 and normal[2]["dq_target"] is None
    assert balances.account_type_onehot(acct, people, types, "other").count() == 2
    assert by(balances.account_type_counts(acct, people, types), "consumer_id", "dq_target")[2] == 0
    assert by(balances.adjusted_balance_total(acct), "consumer_id", "total_balance")[1] == -15
    ratio = {r["consumer_id"]: r for r in balances.account_negative_ratio(acct).collect()}
    assert ratio[1]["negative_balance_ratio"] == pytest.approx(1 / 31)
    assert by(balances.account_age(acct), "consumer_id", "account_age_days") == {1: 30, 2: 0}
    windows = {r["consumer_id"]: r for r in balances.balance_windows(acct, [30], [25]).collect()}
    assert windows[1]["avg_balance_30d"] == pytest.approx(35 / 3)
    assert (windows[1]["below_25_30d"], windows[1]["days_negative_balance"]) == (2, 1)


def test_week_labels(spark):
    days = spark.sql("select cast(d as date) d from values ('2024-01-01'), ('2024-01-07'), ('2024-01-08') t(d)")
    labels = [str(r[0]) for r in days.select(week_end_sunday("d")).collect()]
    assert labels == ["2024-01-07", "2024-01-07", "2024-01-14"]


def test_period_balances_end_at_the_same_value(ledger):
    txn = ledger(FOUR + [(5, 1, "A", 3, "DEBIT", "2024-03-05")])
    ends = set()
    for period in ("1D", "1W", "1M"):
        rows = flows.period_balances(txn, period).orderBy("period").collect()
        ends.add(rows[-1]["running_total"])
    assert ends == {-4}
    months = [str(r["period"]) for r in flows.period_balances(txn, "1M").orderBy("period").collect()]
    assert months == ["2024-01-31", "2024-03-31"]


def test_null_category_survives_the_exclusion_list(spark):
    df = spark.sql("select * from values ('A'), (null), ('B') t(category)")
    assert sorted(str(r[0]) for r in df.filter(not_in_keep_nulls("category", ["A"])).collect()) == ["B", "None"]


def test_skewness_is_bias_corrected(spark):
    df = spark.sql("select * from values ('a',1.0D),('a',2.0D),('a',2.0D),('a',9.0D),('b',1.0D),('b',2.0D),('c',3.0D),('c',3.0D),('c',3.0D) t(g,x)")
    got = by(df.groupBy("g").agg(F.coalesce(sample_skewness("x"), F.lit(0.0)).alias("s")), "g", "s")
    assert got == {"a": pytest.approx(1.9001038154942962), "b": 0.0, "c": 0.0}


def test_category_stats(ledger):
    rows = [(i, 1, "A", a, "DEBIT", "2024-01-01") for i, a in enumerate([1, 2, 2, 9])]
    for limit in (1_000_000, 2):
        out = category.category_stats(ledger(rows), limit).first()
        assert (out["median"], out["count"], out["iqr"]) == (2.0, 4, 3.75 - 1.75)
        assert out["skewness"] == pytest.approx(1.9001038154942962)


def test_category_percent_sums_to_100(ledger, spark):
    txn = ledger(FOUR + [(5, 1, "B", 7, "DEBIT", "2024-01-01"), (6, 2, "B", 0, "CREDIT", "2024-01-01")])
    people = spark.createDataFrame([(1,), (2,), (3,)], "consumer_id long")
    rows = {r["consumer_id"]: r for r in flows.category_percent(people, txn, ["A", "B"]).collect()}
    for side in ("credit", "debit", "trxn"):
        assert rows[1][f"{side}_percentage_A"] + rows[1][f"{side}_percentage_B"] == pytest.approx(100)
    assert rows[2]["credit_percentage_A"] is None and rows[2]["debit_percentage_total"] is None
    assert rows[3]["trxn_percentage_A"] is None


def test_monthly_change_equals_the_dense_grid(ledger):
    txn = ledger(
        [
            (1, 1, "A", 5, "DEBIT", "2024-01-10"),
            (2, 1, "A", 7, "DEBIT", "2024-03-10"),
            (3, 1, "A", 9, "DEBIT", "2024-04-10"),
            (4, 1, "B", 2, "DEBIT", "2024-02-01"),
            (5, 1, None, 1, "DEBIT", "2024-06-01"),
            (6, 2, "A", 3, "DEBIT", "2024-06-01"),
        ]
    )
    got = {(r["consumer_id"], r["category"]): (r["mean"], r["std"]) for r in category.monthly_change_stats(txn).collect()}
    import numpy as np

    series = {(1, "A"): [5, 0, 7, 9, 0, 0], (1, "B"): [0, 2, 0, 0, 0, 0]}
    for key, values in series.items():
        steps = np.concatenate([[0], np.diff(values)])
        assert got[key] == (pytest.approx(steps.mean()), pytest.approx(steps.std(ddof=1)))
    assert got[2, "A"] == (0.0, 0.0)
    grid = category.month_category_grid(txn, ["A", "B"])
    assert grid.filter("consumer_id = 1").count() == 12
    assert grid.filter("consumer_id = 1 and category = 'A' and month = date'2024-02-01'").first()["amount"] == 0


def dated(gaps, start="2024-01-01", consumer=1, name="A", direction="CREDIT", first=1):
    day = dt.date.fromisoformat(start)
    rows = [(first, consumer, name, 10, direction, str(day))]
    for i, gap in enumerate(gaps, first + 1):
        day += dt.timedelta(days=gap)
        rows.append((i, consumer, name, 10, direction, str(day)))
    return rows


@pytest.mark.parametrize(
    ("gaps", "regular"), [([7, 14, 30], True), ([7, 20], False), ([7], False), ([7, 0, 7], False), ([2, 35], True)]
)
def test_regular_groups(ledger, gaps, regular):
    out = recurrence.regular_groups(ledger(dated(gaps))).first()
    assert (out["is_regular"], out["n_gaps"]) == (regular, len(gaps))


def test_income_per_day(ledger, spark):
    txn = ledger(dated([7, 7]) + dated([3], consumer=2, first=50) + dated([7, 7], name="B", direction="DEBIT", first=80))
    out = {r["consumer_id"]: r for r in recurrence.income_per_day(txn).collect()}
    assert out[1]["income_per_day"] == pytest.approx(30 / 14)
    assert out[2]["income_per_day"] == 0
    people = spark.createDataFrame([(1,), (2,), (3,)], "consumer_id long")
    assert recurrence.income_per_day(txn, people).count() == 3
    assert recurrence.income_per_day(txn, people, how="inner").count() == 1


def test_recurring_marks_the_whole_group(ledger):
    txn = ledger(dated([100, 28]) + dated([100, 50], name="B", first=20))
    flags = recurrence.recurring_flags(txn)
    assert flags.filter("category = 'A' and is_recurring").count() == 3
    assert flags.filter("category = 'B' and is_recurring").count() == 0
    assert recurrence.recurring_summary(txn).first()["n_transactions"] == 3


def test_recurrence_tolerance(ledger):
    rows = [(1, 1, "A", 10, "CREDIT", "2024-01-01"), (2, 1, "A", 10, "CREDIT", "2024-01-05"), (3, 1, "A", 40, "CREDIT", "2024-02-05"), (4, 1, "A", 20, "CREDIT", "2024-02-05")]
    out = recurrence.recurrence_tolerance(ledger(rows))
    assert by(out, "txn_id", "date_tolerance") == {1: False, 2: True, 3: False, 4: True}
    assert by(out, "txn_id", "amount_tolerance") == {1: False, 2: False, 3: False, 4: True}


def test_top_income_source_uses_average_ranks(ledger):
    txn = ledger([(1, 1, "A", 5, "CREDIT", "2024-01-01"), (2, 1, "B", 5, "CREDIT", "2024-01-01"), (3, 2, "A", 5, "CREDIT", "2024-01-01"), (4, 2, "B", 3, "CREDIT", "2024-01-01")])
    rows = flows.top_income_source(txn.withColumn("memo", F.lit("m"))).collect()
    assert [(r["consumer_id"], r["category"]) for r in rows] == [(2, "A")]


def test_no_division_by_zero(ledger, spark):
    txn = ledger([(1, 1, "A", 0, "CREDIT", "2024-01-01"), (2, 1, "A", 0, "DEBIT", "2024-01-01")])
    assert flows.credit_share(txn).count() == 0
    assert category.category_stats(txn).first()["coef_variation"] == 0
    out = flows.spending_balance_ratio(txn, accounts(spark, [(1, "X", "2024-01-01", -1)])).first()
    assert out["spending_balance_ratio"] is None


def test_consumer_features_for_training_and_scoring(spark, ledger):
    txn = ledger(FOUR + [(9, 2, "B", 1, "DEBIT", "2024-01-01"), (10, 2, "B", 1, "DEBIT", "2024-02-01"), (11, 3, "A", 1, "DEBIT", "2024-02-01")])
    people = spark.sql("select * from values (1L, 700D, 1D), (2L, 600D, null), (3L, 650D, 0D) t(consumer_id, credit_score, dq_target)")
    acct = accounts(spark, [(1, "LOAN", "2024-01-01", 5), (3, "LOAN", "2024-01-01", 5)])
    train = consumer_features(people, acct, txn, ["A", "B"], ["LOAN"])
    assert [r["consumer_id"] for r in train.collect()] == [1]
    score = consumer_features(people, acct, txn, ["A", "B"], ["LOAN"], labelled=False).collect()
    assert [(r["consumer_id"], r["account_type_LOAN"], r["B_count"], r["dq_target"]) for r in score] == [(2, 0, 2.0, None)]
