"""Small column expressions: signs, dates, buckets, rounding, hashing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def net_amount(amount: str = "amount", direction: str = "credit_or_debit") -> Column:
    """Cash view: a credit adds, a debit takes away, anything else moves nothing."""
    value = F.col(amount)
    zero = F.lit(0).cast("decimal(18,2)")
    return F.when(F.col(direction) == "CREDIT", value).when(F.col(direction) == "DEBIT", -value).otherwise(zero)


def is_credit() -> Column:
    return F.col("credit_or_debit") == "CREDIT"


def is_debit() -> Column:
    return F.col("credit_or_debit") == "DEBIT"


def sum_if(condition: Column, value: Column | str) -> Column:
    """Conditional sum; 0 where no row meets the condition."""
    value = F.col(value) if isinstance(value, str) else value
    return F.coalesce(F.sum(F.when(condition, value)), F.lit(0))


def not_in_keep_nulls(column: Column | str, values: Sequence[str]) -> Column:
    """Exclusion list that keeps null values."""
    column = F.col(column) if isinstance(column, str) else column
    return ~F.coalesce(column.isin(*values), F.lit(False))


def week_end_sunday(date: Column | str) -> Column:
    """The Sunday that closes the week of a date (the date itself if it is a Sunday)."""
    return F.next_day(F.date_sub(date, 1), "SU")


def whole_months(start: Column, end: Column) -> Column:
    """Months from the first of one month to the first of another."""
    return ((F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start)).cast("int")


def sample_skewness(column: Column | str) -> Column:
    """Bias-corrected skewness; null below three values and for a constant."""
    n = F.count(column).cast("double")
    return F.when(F.count(column) > 2, F.skewness(column) * F.sqrt(n * (n - 1)) / (n - 2))


def one_row(df: DataFrame, *aggregates: Column) -> Column:
    """Several global aggregates as one scalar-subquery struct: no join and no collect."""
    return df.agg(F.struct(*aggregates)).scalar()


def hash_number(*columns: Column | str) -> Column:
    """A number in [0, 2^32) from the md5 of the key text: the same on every engine and partitioning."""
    text = F.concat_ws("|", *[F.col(c).cast("string") if isinstance(c, str) else c for c in columns])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def value_range(column: Column | str, per_octave: int = 1024) -> Column:
    """An order-preserving bucket number of a double, ``per_octave`` buckets for each power of two.

    Equal values share a bucket and a larger value never has a smaller bucket, so sorted work over
    a long list of values can be cut at bucket borders without looking at the data first.
    """
    value = F.col(column) if isinstance(column, str) else column
    depth = (F.floor(F.log2(F.abs(value)) * per_octave) + 1100 * per_octave).cast("bigint")
    return F.when(value > 0, depth).when(value < 0, -depth).otherwise(F.lit(0).cast("bigint"))


def equal_width_bin(value: Column, low: Column, high: Column, bins: int) -> Column:
    """Right-closed bins 1..n between two bounds, the lowest bound included; outside is null."""
    width = (high - low) / F.lit(float(bins))
    raw = F.ceil(F.try_divide(value - low, width)).cast("int")
    inside = (value >= low) & (value <= high)
    return F.when(inside, F.greatest(F.lit(1), F.least(F.lit(bins), F.coalesce(raw, F.lit(1)))))
