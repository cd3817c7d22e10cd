"""Ordered cumulative sums that do not put a whole key into one task.

A window over ``partitionBy(consumer)`` sends every row of a consumer to one task, which fails when
one consumer holds a large share of the ledger. Here a key is cut into segments that follow the sort
order (its days, or ranges of a value). Segment totals are pre-aggregated and summed per key - a
small window, because a key has few segments - and the row-level window only runs inside a segment.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.columns import value_range
from ledgerloom.session import staged

PIECE, RANGE = "_piece", "_range"

# A (key, day) group above this many rows is cut further, by ranges of its tie-break.
MAX_SEGMENT_ROWS = 1_000_000


def prefix_sums(
    rows: DataFrame,
    keys: Sequence[str],
    segments: Sequence[str],
    order: Sequence[str],
    values: Sequence[str],
    suffix: str = "_upto",
    total_suffix: str | None = None,
) -> DataFrame:
    """Add ``<value><suffix>``: the sum of a value over all rows of the key up to and including the row.

    Rows are ordered by ``segments`` first and ``order`` inside a segment. ``total_suffix`` also adds
    the sum over the whole key, which the segment totals give for free.
    """
    keys, segments = list(keys), list(segments)
    totals = rows.groupBy(*keys, *segments).agg(*[F.sum(v).alias(v) for v in values])
    earlier = Window.partitionBy(*keys).orderBy(*segments).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *keys,
        *segments,
        *[F.coalesce(F.sum(v).over(earlier), F.lit(0)).alias(f"_{v}_before") for v in values],
        *([F.sum(v).over(Window.partitionBy(*keys)).alias(f"{v}{total_suffix}") for v in values] if total_suffix else []),
    )
    inside = (
        Window.partitionBy(*keys, *segments).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return rows.join(offsets, [*keys, *segments]).select(
        *rows.columns,
        *[(F.col(f"_{v}_before") + F.sum(v).over(inside)).alias(f"{v}{suffix}") for v in values],
        *([f"{v}{total_suffix}" for v in values] if total_suffix else []),
    )


def with_pieces(
    rows: DataFrame, groups: Sequence[str], position: Column, max_rows: int = MAX_SEGMENT_ROWS
) -> DataFrame:
    """Number the pieces of each group: 0 for a normal group, ranges of ``position`` for a large one.

    The table of large groups has at most (rows / max_rows) lines, which bounds the broadcast; adaptive
    execution drops the join when there are none.
    """
    groups = list(groups)
    count = F.floor(F.col("_n") / max_rows) + 1
    spread = F.col("_high").cast("double") - F.col("_low").cast("double")
    large = (
        rows.groupBy(*groups)
        .agg(F.count(F.lit(1)).alias("_n"), F.min(position).alias("_low"), F.max(position).alias("_high"))
        .filter(F.col("_n") > max_rows)
        .select(*groups, "_low", F.try_divide(spread, count).alias("_width"))
    )
    # A larger position never gives a smaller quotient, so the pieces follow the order of the rows.
    offset = position.cast("double") - F.col("_low").cast("double")
    piece = F.coalesce(F.floor(F.try_divide(offset, F.col("_width"))).cast("bigint"), F.lit(0).cast("bigint"))
    return rows.join(F.broadcast(large), groups, "left").select(*rows.columns, piece.alias(PIECE))


def with_value_segments(
    counted: DataFrame, keys: Sequence[str], value: str, max_rows: int = MAX_SEGMENT_ROWS
) -> DataFrame:
    """Segments along a double: its value range, and pieces of a range that holds many values."""
    ranged = counted.withColumn(RANGE, value_range(value))
    return with_pieces(ranged, [*keys, RANGE], F.col(value), max_rows)


def value_prefix_sums(
    counted: DataFrame, keys: Sequence[str], value: str, values: Sequence[str], max_rows: int = MAX_SEGMENT_ROWS
) -> DataFrame:
    """Cumulative (``_upto``) and whole (``_all``) sums along a double, one row per key and distinct value."""
    segments = with_value_segments(counted, keys, value, max_rows)
    return prefix_sums(segments, keys, [RANGE, PIECE], [value], values, total_suffix="_all").drop(RANGE, PIECE)


def cut_ranges(
    rows: DataFrame, keys: Sequence[str], order: Sequence[str], max_rows: int = MAX_SEGMENT_ROWS
) -> DataFrame:
    """``rows`` with the number of their range: ranges of about equal size, at most about ``max_rows``, along the keys and
    the order, whatever the values are. Staged, so that later readers see the same cuts."""
    source = staged(rows, "scan")
    ranges = source.count() // max_rows + int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sort = [F.col(c).asc_nulls_last() for c in [*keys, *order]]
    return staged(source.repartitionByRange(ranges, *sort).withColumn(RANGE, F.spark_partition_id()), "ranges")


def range_prefix_sums(
    rows: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    values: Sequence[str],
    max_rows: int = MAX_SEGMENT_ROWS,
    suffix: str = "_upto",
    total_suffix: str | None = None,
) -> DataFrame:
    """Cumulative sums (``<value><suffix>``) along ``order`` per key, for keys of any size.

    The rows are staged once, cut into ranges of about equal size by key and order, whatever the values are. Sums of
    whole ranges are added up per key; row-level windows run inside a range. The result depends on the order alone,
    not on the cuts. ``total_suffix`` also adds the sum over the whole key.
    """
    keys, order = list(keys), list(order)
    cut = cut_ranges(rows, keys, order, max_rows)
    totals = cut.groupBy(*keys, RANGE).agg(*[F.sum(v).alias(v) for v in values])
    along = Window.partitionBy(*keys or [F.lit(0)])
    earlier = along.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *keys,
        RANGE,
        *[F.coalesce(F.sum(v).over(earlier), F.lit(0)).alias(f"_{v}_before") for v in values],
        *([F.sum(v).over(along).alias(f"{v}{total_suffix}") for v in values] if total_suffix else []),
    )
    inside = Window.partitionBy(*keys, RANGE).orderBy(*[F.col(c).asc_nulls_last() for c in order])
    inside = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return cut.join(offsets, [*keys, RANGE]).select(
        *rows.columns,
        *[(F.col(f"_{v}_before") + F.sum(v).over(inside)).alias(f"{v}{suffix}") for v in values],
        *([f"{v}{total_suffix}" for v in values] if total_suffix else []),
    )


def ledger_prefix_sums(
    rows: DataFrame,
    keys: Sequence[str],
    day: str,
    tie: str,
    values: Sequence[str],
    max_rows: int = MAX_SEGMENT_ROWS,
    suffix: str = "_upto",
    per_key: DataFrame | None = None,
) -> DataFrame:
    """Cumulative sums per key in (day, tie-break) order, text ids included. Rows without key or day are dropped.

    ``per_key`` (one row per key) is inner-joined on the way.
    """
    keys = list(keys)
    for column in [*keys, day]:
        rows = rows.filter(F.col(column).isNotNull())
    if per_key is not None:
        rows = rows.join(per_key, keys)
    return range_prefix_sums(rows, keys, [day, tie], values, max_rows, suffix)
