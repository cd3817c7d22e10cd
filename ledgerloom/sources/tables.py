"""Parquet, CSV and labelled-text readers and writers."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.sources import schemas

LABEL_PREFIX = "__label__"


def conform(df: DataFrame, schema: T.StructType, columns: dict[str, str] | None = None) -> DataFrame:
    """Rename (``columns``: source name -> standard name) and cast to a declared schema.

    A value that does not fit its type becomes null. Only the declared columns are kept, so the
    parquet scan reads no others.
    """
    found = {(columns or {}).get(name, name): name for name in df.columns}
    picked = []
    for field in schema.fields:
        if field.name in found:
            picked.append(F.col(f"`{found[field.name]}`").try_cast(field.dataType).alias(field.name))
        else:
            picked.append(F.lit(None).cast(field.dataType).alias(field.name))
    return df.select(*picked)


def read_parquet(
    spark: SparkSession, path: str, schema: T.StructType | None = None, columns: dict[str, str] | None = None
) -> DataFrame:
    df = spark.read.parquet(path)
    return conform(df, schema, columns) if schema is not None else df


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header and a declared schema, so there is no inference pass over the data."""
    return spark.read.schema(schema).option("header", True).csv(path)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def labelled_lines(df: DataFrame, text: str = "memo", label: str = "category") -> DataFrame:
    """One line per row: the prefixed label, a blank, the text."""
    return df.select(F.concat(F.lit(LABEL_PREFIX), F.col(label), F.lit(" "), F.col(text)).alias("value"))


def write_labelled_lines(df: DataFrame, path: str, text: str = "memo", label: str = "category") -> None:
    """Line breaks inside a text would split its line, so they are written as blanks."""
    one_line = df.withColumn(text, F.regexp_replace(F.col(text), r"[\r\n]+", " "))
    labelled_lines(one_line, text, label).write.text(path)


def parse_labelled_lines(lines: DataFrame, text: str = "memo", label: str = "category") -> DataFrame:
    """Split each line at its first blank and take the prefix off the label."""
    parts = F.split(F.col("value"), " ", 2)
    return lines.select(
        F.regexp_replace(parts.getItem(0), f"^{LABEL_PREFIX}", "").alias(label),
        F.coalesce(F.try_element_at(parts, F.lit(2)), F.lit("")).alias(text),
    )


def read_labelled_lines(spark: SparkSession, path: str, text: str = "memo", label: str = "category") -> DataFrame:
    return parse_labelled_lines(spark.read.text(path), text, label)


def spend_signed(transactions: DataFrame) -> DataFrame:
    """Amounts signed from the spender's view: a debit counts up, a credit counts down."""
    amount = F.col("amount")
    return transactions.withColumn("amount", F.when(F.col("credit_or_debit") == "DEBIT", amount).otherwise(-amount))


@dataclass(frozen=True)
class LedgerBundle:
    categories: DataFrame
    consumers: DataFrame
    accounts: DataFrame
    transactions: DataFrame


def load_bundle(
    spark: SparkSession,
    categories: str,
    consumers: str,
    accounts: str,
    transactions: str,
    columns: dict[str, str] | None = None,
    signed: bool = True,
) -> LedgerBundle:
    """The four tables of the risk job; ``signed`` signs the amounts as in ``spend_signed``."""
    ledger = read_parquet(spark, transactions, schemas.TRANSACTION, columns)
    return LedgerBundle(
        read_csv(spark, categories, schemas.CATEGORY_MAP),
        read_parquet(spark, consumers, schemas.CONSUMER, columns),
        read_parquet(spark, accounts, schemas.ACCOUNT, columns),
        spend_signed(ledger) if signed else ledger,
    )
