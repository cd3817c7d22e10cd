"""Exact quantiles (linear interpolation) that hold for groups of any size.

Rows are counted per key and value once; the counts are summed up along the values (``range_prefix_sums``), which gives
the rank of every value, whatever the size of its group, and the wanted ranks are picked in one aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.scan import range_prefix_sums

MAX_GROUP_ROWS = 1_000_000


def _positions(probabilities: Sequence[float]) -> list[Column]:
    return [(F.col("_n") - 1) * F.lit(float(p)) for p in probabilities]


def _interpolated(positions: Sequence[Column], out: str) -> Column:
    cells = [
        F.col(f"_lo{i}") + (h - F.floor(h)) * (F.col(f"_hi{i}") - F.col(f"_lo{i}")) for i, h in enumerate(positions)
    ]
    return F.array(*cells).alias(out)


def _picked(values: DataFrame, keys: list[str], probabilities: Sequence[float], out: str, max_rows: int) -> DataFrame:
    """Quantiles of ``_v`` per key; ``values(keys, _v)`` holds neither null nor NaN."""
    counted = values.groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_c"))
    ranked = range_prefix_sums(counted, keys, ["_v"], ["_c"], max_rows, total_suffix="_all")
    ranked = ranked.withColumnsRenamed({"_c_all": "_n", "_c_upto": "_upto"})

    def at(rank: Column) -> Column:
        return F.max(F.when((rank >= F.col("_upto") - F.col("_c")) & (rank < F.col("_upto")), F.col("_v")))

    picks = [F.max("_n").alias("_n")]
    for i, h in enumerate(_positions(probabilities)):
        picks += [at(F.floor(h)).alias(f"_lo{i}"), at(F.ceil(h)).alias(f"_hi{i}")]
    result = ranked.groupBy(*keys).agg(*picks).filter(F.col("_n").isNotNull())
    return result.select(*keys, _interpolated(_positions(probabilities), out))


def group_stats(
    df: DataFrame,
    keys: Sequence[str],
    value: Column | str,
    probabilities: Sequence[float],
    aggregates: Sequence[Column] = (),
    out: str = "quantiles",
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """``aggregates`` and an array of exact quantiles of ``value`` per key. Null keys are dropped.

    The source is read twice: for the aggregates and for the counts per value. Groups without a value have null
    quantiles. ``max_group_rows`` bounds the rows of a range that is sorted in one task.
    """
    keys = list(keys)
    value = F.col(value) if isinstance(value, str) else value
    for key in keys:
        df = df.filter(F.col(key).isNotNull())
    number = value.cast("double")
    values = df.select(*keys, number.alias("_v")).filter(F.col("_v").isNotNull() & ~F.isnan("_v"))
    picked = _picked(values, keys, probabilities, out, max_group_rows)
    groups = df.groupBy(*keys).agg(*aggregates) if aggregates else df.select(*keys).distinct()
    return groups.join(picked, keys, "left")


def column_quantiles(
    df: DataFrame,
    value: Column | str,
    probabilities: Sequence[float],
    out: str = "quantiles",
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """One row with the exact quantiles of a whole column (no row if the table is empty)."""
    value = F.col(value) if isinstance(value, str) else value
    values = df.select(value.cast("double").alias("_v")).filter(F.col("_v").isNotNull() & ~F.isnan("_v"))
    return _picked(values, [], probabilities, out, max_group_rows)
