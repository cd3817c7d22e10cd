"""Declared schemas and standard column names of the ledger tables.

consumer     consumer_id, evaluation_date, credit_score, dq_target (null = to be scored)
account      consumer_id, account_id, account_type, balance_date, balance
transaction  txn_id, consumer_id, category_id, amount (unsigned), credit_or_debit, posted_date
category map category_id, category
flow         consumer_id, account_id, memo, amount, posted_date, category
"""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)

CONSUMER = T.StructType(
    [
        T.StructField("consumer_id", T.StringType()),
        T.StructField("evaluation_date", T.DateType()),
        T.StructField("credit_score", T.DoubleType()),
        T.StructField("dq_target", T.DoubleType()),
    ]
)
ACCOUNT = T.StructType(
    [
        T.StructField("consumer_id", T.StringType()),
        T.StructField("account_id", T.StringType()),
        T.StructField("account_type", T.StringType()),
        T.StructField("balance_date", T.DateType()),
        T.StructField("balance", MONEY),
    ]
)
TRANSACTION = T.StructType(
    [
        T.StructField("txn_id", T.StringType()),
        T.StructField("consumer_id", T.StringType()),
        T.StructField("category_id", T.IntegerType()),
        T.StructField("amount", MONEY),
        T.StructField("credit_or_debit", T.StringType()),
        T.StructField("posted_date", T.DateType()),
    ]
)
CATEGORY_MAP = T.StructType(
    [
        T.StructField("category_id", T.IntegerType()),
        T.StructField("category", T.StringType()),
    ]
)
FLOW = T.StructType(
    [
        T.StructField("consumer_id", T.LongType()),
        T.StructField("account_id", T.StringType()),
        T.StructField("memo", T.StringType()),
        T.StructField("amount", MONEY),
        T.StructField("posted_date", T.DateType()),
        T.StructField("category", T.StringType()),
    ]
)

# Account types that hold borrowed money.
BORROWING_TYPES = (
    "CREDIT CARD",
    "LOAN",
    "LINE OF CREDIT",
    "AUTO",
    "MORTGAGE",
    "STUDENT",
    "OVERDRAFT",
    "HOME EQUITY",
)

# Categories left out of the feature tables.
EXCLUDED_CATEGORIES = (
    "UNEMPLOYMENT_BENEFITS",
    "EDUCATION",
    "HOME_IMPROVEMENT",
    "HEALTHCARE_MEDICAL",
    "CHILD_DEPENDENTS",
    "PENSION",
)

# Categories that count as income, and the one that is folded into another.
INCOME_CATEGORIES = (
    "PAYCHECK",
    "EXTERNAL_TRANSFER",
    "INVESTMENT_INCOME",
    "DEPOSIT",
    "PAYCHECK_PLACEHOLDER",
    "INSURANCE",
    "OTHER_BENEFITS",
    "UNEMPLOYMENT_BENEFITS",
)
INCOME_RECODE = {"PAYCHECK_PLACEHOLDER": "PAYCHECK"}
