"""The test tables seen as ledger tables: the same views for Spark (functions) and SQL (CTE texts)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
CATEGORIES = ["URGENT", "HIGH", "MEDIUM"]
ACCOUNT_TYPES = ["URGENT", "HIGH", "MEDIUM", "NOT SPECIFIED", "LOW"]
BORROWING = ["LOW", "NOT SPECIFIED"]
EXCLUDED = ["NOT SPECIFIED"]
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]
INCOME_KEEP = ["purchase", "signup", "click"]
INCOME_RECODE = {"signup": "purchase"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def txn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("txn_id"),
        F.col("o_custkey").alias("consumer_id"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("category_id"),
        F.col("o_totalprice").cast(MONEY).alias("amount"),
        F.when(F.col("o_orderstatus") == "F", "CREDIT").otherwise("DEBIT").alias("credit_or_debit"),
        F.col("o_orderdate").cast("date").alias("posted_date"),
    )


TXN = """txn AS (
  SELECT o_orderkey AS txn_id, o_custkey AS consumer_id, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS category_id,
         CAST(o_totalprice AS DECIMAL(18,2)) AS amount,
         CASE WHEN o_orderstatus = 'F' THEN 'CREDIT' ELSE 'DEBIT' END AS credit_or_debit,
         CAST(o_orderdate AS DATE) AS posted_date
  FROM orders)"""


def catmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "orders")
        .select(
            F.substring("o_orderpriority", 1, 1).cast("int").alias("category_id"),
            F.expr("substr(o_orderpriority, 3)").alias("category"),
        )
        .distinct()
        .filter("category_id <> 5")
    )


CATMAP = """catmap AS (
  SELECT DISTINCT CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS category_id, substr(o_orderpriority, 3) AS category
  FROM orders WHERE substr(o_orderpriority, 1, 1) <> '5')"""


def account(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("o_totalprice").cast(MONEY)
    return (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_custkey").alias("consumer_id"), F.expr("substr(o_orderpriority, 3)").alias("account_type"))
        .agg(
            F.max(F.col("o_orderdate").cast("date")).alias("balance_date"),
            F.sum(F.when(F.col("o_orderstatus") == "P", -price).otherwise(price)).alias("balance"),
        )
    )


ACCOUNT = """account AS (
  SELECT o_custkey AS consumer_id, substr(o_orderpriority, 3) AS account_type,
         max(CAST(o_orderdate AS DATE)) AS balance_date,
         sum(CASE WHEN o_orderstatus = 'P' THEN -CAST(o_totalprice AS DECIMAL(18,2))
             ELSE CAST(o_totalprice AS DECIMAL(18,2)) END) AS balance
  FROM orders GROUP BY 1, 2)"""


def consumer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("consumer_id"),
        (F.lit(300) + (F.col("c_custkey") * 7919) % 551).cast("double").alias("credit_score"),
        F.when(F.col("c_custkey") % 10 == 9, F.lit(None))
        .when(F.col("c_acctbal") < 0, F.lit(1.0))
        .otherwise(F.lit(0.0))
        .cast("double")
        .alias("dq_target"),
    )


CONSUMER = """consumer AS (
  SELECT c_custkey AS consumer_id, CAST(300 + (c_custkey * 7919) % 551 AS DOUBLE) AS credit_score,
         CAST(CASE WHEN c_custkey % 10 = 9 THEN NULL WHEN c_acctbal < 0 THEN 1.0 ELSE 0.0 END AS DOUBLE) AS dq_target
  FROM customer)"""


def evtxn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("txn_id"),
        F.col("user_id").alias("consumer_id"),
        F.col("event_type").alias("category"),
        F.col("props").alias("memo"),
        F.col("value").cast(MONEY).alias("amount"),
        F.when(F.col("event_type").isin("purchase", "signup"), "CREDIT").otherwise("DEBIT").alias("credit_or_debit"),
        F.col("ts").cast("date").alias("posted_date"),
    )


EVTXN = """evtxn AS (
  SELECT event_id AS txn_id, user_id AS consumer_id, event_type AS category, props AS memo,
         CAST(value AS DECIMAL(18,2)) AS amount,
         CASE WHEN event_type IN ('purchase', 'signup') THEN 'CREDIT' ELSE 'DEBIT' END AS credit_or_debit,
         CAST(ts AS DATE) AS posted_date
  FROM events)"""


def evtxn_3d(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First event per user, type and slot of three days, dated by the slot: a cadence with regular gaps."""
    slot = F.expr("date_add(date'2024-01-01', cast(floor(datediff(posted_date, date'2024-01-01') / 3) * 3 as int))")
    first = F.min(F.struct("txn_id", "amount", "credit_or_debit")).alias("_first")
    return (
        evtxn(spark, sf_dir)
        .groupBy("consumer_id", "category", slot.alias("posted_date"))
        .agg(first)
        .select("consumer_id", "category", "posted_date", "_first.txn_id", "_first.amount", "_first.credit_or_debit")
    )


EVTXN_3D = """evtxn_3d AS (
  SELECT consumer_id, category, slot AS posted_date, txn_id, amount, credit_or_debit FROM (
    SELECT *, row_number() OVER (PARTITION BY consumer_id, category, slot ORDER BY txn_id) AS rn FROM (
      SELECT *, CAST(DATE '2024-01-01' + CAST(floor((posted_date - DATE '2024-01-01') / 3) * 3 AS INTEGER) AS DATE) AS slot
      FROM evtxn)) WHERE rn = 1)"""


def ltxn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as transactions: the largest table."""
    items = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    return (
        items.join(orders, items["l_orderkey"] == orders["o_orderkey"])
        .join(parts, items["l_partkey"] == parts["p_partkey"])
        .select(
            F.col("o_custkey").alias("consumer_id"),
            F.col("p_type").alias("category"),
            F.col("l_extendedprice").cast(MONEY).alias("amount"),
            F.when(F.col("l_returnflag") == "R", "CREDIT").otherwise("DEBIT").alias("credit_or_debit"),
            F.col("l_shipdate").cast("date").alias("posted_date"),
        )
    )


LTXN = """ltxn AS (
  SELECT o_custkey AS consumer_id, p_type AS category, CAST(l_extendedprice AS DECIMAL(18,2)) AS amount,
         CASE WHEN l_returnflag = 'R' THEN 'CREDIT' ELSE 'DEBIT' END AS credit_or_debit,
         CAST(l_shipdate AS DATE) AS posted_date
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)"""


def memo(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"),
        F.col("text").alias("memo"),
        F.col("lang").alias("category"),
        (F.col("n_chars") / F.lit(2.0)).cast(MONEY).alias("amount"),
        F.expr("date_add(date'2024-01-01', cast(doc_id % 365 as int))").alias("posted_date"),
    )


MEMO = """memo AS (
  SELECT doc_id AS id, text AS memo, lang AS category, CAST(n_chars / 2.0 AS DECIMAL(18,2)) AS amount,
         CAST(DATE '2024-01-01' + CAST(doc_id % 365 AS INTEGER) AS DATE) AS posted_date
  FROM documents)"""


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a toxicity label and two simple scores of their text."""
    labels = table(spark, sf_dir, "labels")
    docs = table(spark, sf_dir, "documents")
    return labels.join(docs, "doc_id").select(
        F.col("doc_id").alias("id"),
        F.col("toxic").alias("y"),
        F.col("quality"),
        F.col("n_chars").cast("double").alias("n_chars"),
        F.size(F.split("text", " ")).cast("double").alias("n_words"),
    )


LABELLED = """labelled AS (
  SELECT l.doc_id AS id, l.toxic AS y, l.quality AS quality, CAST(d.n_chars AS DOUBLE) AS n_chars,
         CAST(len(string_split(d.text, ' ')) AS DOUBLE) AS n_words
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"""


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"),
        F.col("embedding").cast("array<double>").alias("v"),
        (F.col("label") == 0).cast("int").alias("y"),
    )


POINTS = """points AS (
  SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS v, CASE WHEN label = 0 THEN 1 ELSE 0 END AS y
  FROM embeddings)"""

CTXN = """ctxn AS (
  SELECT t.*, c.category FROM txn t LEFT JOIN catmap c ON t.category_id = c.category_id
  WHERE c.category IS NULL OR c.category <> 'NOT SPECIFIED')"""

INCOME = """income AS (
  SELECT * REPLACE (CASE WHEN category = 'signup' THEN 'purchase' ELSE category END AS category)
  FROM evtxn WHERE category IN ('purchase', 'signup', 'click'))"""


def with_views(*views: str, body: str) -> str:
    return "WITH " + ",\n".join(views) + "\n" + body


class Registry:
    """Collects named queries and their SQL texts."""

    def __init__(self) -> None:
        self.queries: dict = {}
        self.sql: dict[str, str] = {}

    def add(self, name: str, sql: str | None = None):
        def register(function):
            if name in self.queries:
                raise ValueError(f"query {name} is registered twice")
            self.queries[name] = function
            if sql is not None:
                self.sql[name] = sql
            return function

        return register


def dbl(column: Column | str, name: str | None = None) -> Column:
    """As a double, under its own or a new name."""
    plain = F.col(f"`{column}`") if isinstance(column, str) else column
    return plain.cast("double").alias(name or column)


def rnd(column: Column | str, name: str | None = None, digits: int = 6) -> Column:
    """Rounded, so that the order of summation does not show."""
    plain = F.col(f"`{column}`") if isinstance(column, str) else column
    return F.round(plain.cast("double"), digits).alias(name or column)


def big(column: Column | str, name: str | None = None) -> Column:
    plain = F.col(f"`{column}`") if isinstance(column, str) else column
    return plain.cast("bigint").alias(name or column)


def text(column: Column | str, name: str | None = None) -> Column:
    plain = F.col(f"`{column}`") if isinstance(column, str) else column
    return plain.cast("string").alias(name or column)
