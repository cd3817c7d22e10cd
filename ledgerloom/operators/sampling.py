"""Splits, samples and class balancing that depend on key values only, never on partitioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.columns import hash_number, one_row
from ledgerloom.session import checked_broadcast


def hash_sample(df: DataFrame, key: str, percent: int) -> DataFrame:
    """Rows whose key hash falls in the first ``percent`` of 100 slots."""
    return df.filter(hash_number(key) % 100 < percent)


def split_side(df: DataFrame, key: str, train_percent: int = 80) -> DataFrame:
    """Add ``side`` (train / test) by the hash of a key: a row id, or a consumer id so that all rows of
    a consumer fall on the same side. No shuffle."""
    return df.withColumn("side", F.when(hash_number(key) % 100 < train_percent, "train").otherwise("test"))


def take_by_hash(df: DataFrame, group: str, key: str, quota: Column, flag: str = "taken") -> DataFrame:
    """Flag exactly ``quota`` rows of each group: those with the smallest key hash. ``key`` is unique.

    ``quota`` may use ``_n`` (rows of the group) and ``_least`` (rows of the smallest group). Instead of
    sorting whole groups, rows are counted in 65,536 hash buckets; only the one bucket per group in which
    the quota ends is sorted, to find the last row to take. That is computed at once (one line per
    group); the result itself is then a filter on the row's own hash, without a shuffle.
    """
    hashed = df.withColumn("_hash", hash_number(key)).withColumn("_bucket", F.expr("_hash div 65536"))
    buckets = hashed.groupBy(group, "_bucket").agg(F.count(F.lit(1)).alias("_c"))
    along = Window.partitionBy(group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sizes = df.groupBy(group).agg(F.count(F.lit(1)).alias("_n"))
    least = one_row(sizes, F.min("_n").alias("least")).getField("least")
    counted = buckets.select(
        group,
        "_bucket",
        "_c",
        F.sum("_c").over(along).alias("_upto"),
        F.sum("_c").over(Window.partitionBy(group)).alias("_n"),
    ).withColumn("_least", least)
    limited = counted.withColumn("_quota", F.least(quota.cast("bigint"), F.col("_n")))
    edge = F.struct("_bucket", (F.col("_quota") - F.col("_upto") + F.col("_c")).alias("rest"))
    cuts = (
        limited.filter(F.col("_upto") >= F.col("_quota"))
        .groupBy(group)
        .agg(F.min(edge).alias("_edge"))
        .select(group, F.col("_edge._bucket").alias("_bucket"), F.col("_edge.rest").alias("_rest"))
    )
    # The last row to take, per group: found among the rows of one bucket.
    place = F.row_number().over(Window.partitionBy(group).orderBy("_hash", key))
    last = (
        hashed.select(group, "_bucket", "_hash", key)
        .join(checked_broadcast(cuts), [group, "_bucket"])
        .withColumn("_place", place)
        .filter(F.col("_place") == F.col("_rest"))
        .select(group, F.col("_hash").alias("_last_hash"), F.col(key).alias("_last_key"))
    )
    own = hash_number(key)
    taken = (own < F.col("_last_hash")) | ((own == F.col("_last_hash")) & (F.col(key) <= F.col("_last_key")))
    marked = df.join(checked_broadcast(last), group, "left")
    return marked.select(*df.columns, F.coalesce(taken, F.lit(False)).alias(flag))


def split_stratified(df: DataFrame, label: str, key: str, train_percent: int = 80) -> DataFrame:
    """Add ``side`` so that every label has exactly floor(train_percent * n / 100) training rows."""
    quota = F.expr(f"_n * {int(train_percent)} div 100")
    taken = take_by_hash(df.filter(F.col(label).isNotNull()), label, key, quota)
    return taken.withColumn("side", F.when(F.col("taken"), "train").otherwise("test")).drop("taken")


def undersample(df: DataFrame, label: str, key: str) -> DataFrame:
    """Every class cut to the size of the smallest one."""
    taken = take_by_hash(df.filter(F.col(label).isNotNull()), label, key, F.col("_least"))
    return taken.filter("taken").drop("taken")


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weight of each class: rows / (classes * rows of the class)."""
    counts = df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    totals = one_row(counts, F.sum("n").alias("rows"), F.count(F.lit(1)).alias("classes"))
    return counts.withColumn(
        "weight", totals.getField("rows").cast("double") / (totals.getField("classes") * F.col("n"))
    )


def positive_weight(df: DataFrame, label: str, over: str = "negatives") -> DataFrame:
    """negatives / positives, or all rows / positives with ``over="rows"``."""
    positives = F.count_if(F.col(label) == 1)
    top = F.count_if(F.col(label) == 0) if over == "negatives" else F.count(label)
    return df.agg(F.try_divide(top.cast("double"), positives.cast("double")).alias("positive_weight"))


def with_class_weight(df: DataFrame, label: str, out: str = "class_weight") -> DataFrame:
    weights = class_weights(df, label).select(label, F.col("weight").alias(out))
    return df.join(checked_broadcast(weights), label)


def keep_keys(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows whose key is in the id table."""
    return df.join(ids.select(key), key, "left_semi")


def drop_keys(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not in the id table."""
    return df.join(ids.select(key), key, "left_anti")
