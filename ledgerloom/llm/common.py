"""Helpers shared by the corpus operators: staging in the shared folder, exact distributed prefix sums, components."""

from __future__ import annotations

import gc
import sys
import types
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.session import freed_shuffles, new_path

#: What counts as white space between words, as a character class.
SPACE = r"\x20\x09-\x0D"
WORD = rf"[^{SPACE}]+"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Written as Parquet below the shared folder and read again: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = new_path(spark, f"llm-{name}")
    with freed_shuffles(spark):
        df.write.option("compression", "zstd").parquet(path)
    gc.collect()
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_at = path
    return out


def discard(*frames: DataFrame) -> None:
    """Deletes what ``staged`` wrote for these frames, once nothing that is still to run reads it."""
    for frame in frames:
        spark = frame.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(frame._staged_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def paused_collection():
    """No search for cycles while millions of small objects without any are made."""
    on = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if on:
            gc.enable()


def worker_memory() -> dict:
    """A dictionary that lives as long as the Python worker, so that later tasks find what earlier ones have loaded."""
    return sys.modules.setdefault("_llm_worker_memory", types.ModuleType("_llm_worker_memory")).__dict__


class Recent(dict):
    """A memory of bounded size: when full it becomes the old one, whose entries come back when they are asked for.
    Entries in frequent use stay; the others go after a while, which costs time only."""

    def __init__(self, limit: int) -> None:
        super().__init__()
        self.limit, self.old = limit, {}

    def __missing__(self, key):
        value = self.old[key]
        self.add(key, value)
        return value

    def add(self, key, value) -> None:
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[key] = value

    def known(self, keys: set) -> tuple[dict, set]:
        """What is remembered of ``keys``, in a dictionary of its own that later entries do not push out of, and the
        keys of which nothing is."""
        found = {key: self[key] for key in keys if key in self}
        again = {key: self.old[key] for key in keys if key in self.old and key not in found}
        self.learn(again)
        found |= again
        return found, keys - found.keys()

    def learn(self, entries: dict) -> None:
        for key, value in entries.items():
            self.add(key, value)


def text_batches(column: pa.Array, size_limit: int) -> Iterator[list[str]]:
    """The texts of a column in order, about ``size_limit`` characters at a time; null is empty."""
    held, size = [], 0
    for text in column:
        held.append(text.as_py() or "")
        size += len(held[-1])
        if size >= size_limit:
            yield held
            held, size = [], 0
    if held:
        yield held


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def uniform(*parts: Column) -> Column:
    """A number in (0, 1) that depends on the parts alone (52 bits of their MD5)."""
    digits = F.substring(F.md5(F.concat_ws("|", *parts)), 1, 13)
    return (F.conv(digits, 16, 10).cast("bigint").cast("double") + 0.5) / F.lit(float(2**52))


def prefix_sums(
    df: DataFrame, values: list[str], order: list[str], group: list[str] | None = None, rows_per_range: int = 50_000
) -> DataFrame:
    """Adds ``before_<value>`` (sum over the earlier rows of the group) for each value, and ``before_rows``.

    The rows are cut into ranges of about equal size by group and order, so that a group with any share of the rows
    is spread over many tasks; sums of whole ranges are then added up over the ranges, of which there are about
    rows / rows_per_range. The result depends on the order alone, not on the cuts. Equal rows get different
    positions, any of them the first. ``df`` should be narrow; it is staged.
    """
    group = group or []
    spark = df.sparkSession
    base = staged(df, "narrow")
    rows = base.count()
    ranges = max(1, -(-rows // rows_per_range), min(int(spark.conf.get("spark.sql.shuffle.partitions")), rows // 1000))
    keys = [F.col(c).asc_nulls_last() for c in [*group, *order]]
    cut = staged(base.repartitionByRange(ranges, *keys).withColumn("_range", F.spark_partition_id()), "ranges")
    ones = F.lit(1).cast("long").alias("rows")
    totals = cut.select("_range", *group, *values, ones).groupBy("_range", *group)
    totals = totals.agg(*[F.sum(v).alias(f"_t_{v}") for v in [*values, "rows"]])
    past = Window.partitionBy(*[F.col(c) for c in group] or [F.lit(0)]).orderBy("_range")
    past = past.rowsBetween(Window.unboundedPreceding, -1)
    inner = Window.partitionBy("_range", *group).orderBy(*[F.col(c).asc_nulls_last() for c in order])
    inner = inner.rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        F.col("_range").alias("_r"),
        *[F.col(c).alias(f"_g{i}") for i, c in enumerate(group)],
        *[F.coalesce(F.sum(f"_t_{v}").over(past), F.lit(0)).alias(f"_o_{v}") for v in [*values, "rows"]],
    )
    within = cut.select(
        *df.columns,
        "_range",
        *[F.coalesce(F.sum(v).over(inner), F.lit(0)).alias(f"_i_{v}") for v in values],
        F.coalesce(F.count(F.lit(1)).over(inner), F.lit(0)).alias("_i_rows"),
    )
    on = F.col("_range") == F.col("_r")
    for i, c in enumerate(group):
        on = on & F.col(c).eqNullSafe(F.col(f"_g{i}"))
    return within.join(offsets, on).select(
        *df.columns, *[(F.col(f"_o_{v}") + F.col(f"_i_{v}")).alias(f"before_{v}") for v in [*values, "rows"]]
    )


def components(edges: DataFrame, max_rounds: int = 50) -> DataFrame:
    """Connected components of ``edges(a long, b long)``: rows ``(node, component)``, the least node as component.

    Alternates large-star and small-star steps until nothing changes. Each step is a partially aggregated minimum per
    node and a join on the node, which adaptive execution can split for nodes with very many edges; no list of
    neighbours is built. Loops and nulls are dropped, nodes without an edge do not appear.
    """
    now = staged(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges"
    )
    for _ in range(max_rounds):
        if now.isEmpty():
            break
        both = now.select("u", "v").union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = staged(large.filter("u <> v").distinct(), "large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")),
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v")
        after = staged(small.filter("u <> v").distinct(), "small")
        same = now.count() == after.count() and now.exceptAll(after).isEmpty()
        discard(large, now)
        now = after
        if same:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = now.select(F.col("v").alias("u"), "v").distinct()
    out = now.union(roots).select(F.col("u").alias("node"), F.col("v").alias("component"))
    out._staged_at = now._staged_at  # for ``discard``
    return out
