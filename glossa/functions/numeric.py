"""Numeric column helpers shared by all operators (JVM-side expressions only)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_even(c: str | Column, places: int = 3) -> Column:
    """pandas-style rounding: half-even on the scaled float (``rint(x*10^p)/10^p``).

    Spark's ``round`` is half-up; pandas/numpy round half to even.
    """
    scale = float(10**places)
    return F.rint(col_(c) * F.lit(scale)) / F.lit(scale)


def r3(c: str | Column) -> Column:
    return round_half_even(c, 3)


def r9(c: str | Column) -> Column:
    """Rounding applied to statistics so that summation order cannot flip a compare."""
    return round_half_even(c, 9)


def safe_div(num: str | Column, den: str | Column) -> Column:
    """Division that yields NULL for a zero or NULL denominator (ANSI-safe)."""
    return F.try_divide(col_(num), col_(den))


def pair_complete(x: str | Column, y: str | Column) -> tuple[Column, Column]:
    """Null both sides together so every aggregate sees the same complete pairs."""
    x, y = col_(x), col_(y)
    return F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)


def safe_corr(x: str | Column, y: str | Column) -> Column:
    """Pearson r as an aggregate that is NULL (not an error, not NaN) for a constant side.

    Spark 4 with ANSI raises DIVIDE_BY_ZERO in ``corr`` when a side is constant;
    scipy/pandas return NaN. Pairs with a NULL side are dropped first.
    """
    xx, yy = pair_complete(x, y)
    return F.try_divide(F.covar_pop(xx, yy), F.stddev_pop(xx) * F.stddev_pop(yy))


def nan_to_null(c: str | Column) -> Column:
    c = col_(c)
    return F.when(F.isnan(c), F.lit(None)).otherwise(c)


def average_rank(value: str | Column, partition_by: Sequence[str | Column] = ()) -> Column:
    """Average rank with ties (pandas ``rank(method='average')``, scipy ``rankdata``).

    ``rank()`` is the lowest position of a tie group and the count over the default
    RANGE frame (all rows <= the value, peers included) the highest; their mean is
    the average position. Both use one window spec, so Spark evaluates them in one
    Window operator (one exchange, one sort). The window is partitioned by
    ``partition_by`` — callers only use it on per-group series whose size is bounded
    (days of a daily panel), never on raw rows.
    """
    v = col_(value)
    parts = [col_(p) for p in partition_by]
    w = Window.partitionBy(*parts).orderBy(v.asc())
    return (F.rank().over(w) + F.count(F.lit(1)).over(w)) / F.lit(2.0)


def top_k(df: DataFrame, k: int, order: Iterable[Column]) -> DataFrame:
    """Top-k with a deterministic order (callers add the key as the last sort column).

    Planned as TakeOrderedAndProject: each task keeps k rows, the driver merges k·tasks.
    """
    return df.orderBy(*order).limit(k)


#: Type of exact sums: 12 places, and room for sums below 1e26.
EXACT = "decimal(38,12)"


def exact_sum(c: str | Column) -> Column:
    """Sum in decimal arithmetic, the same in any order; cast it to double for a result.

    A float ``sum`` depends on the order of its rows, i.e. on partitioning, so a mean on a rounding
    edge (x.xxx5) could round either way from run to run. Doubles enter as their shortest
    decimal text, so data with up to 12 decimal places are summed without any cut.
    """
    return F.sum(col_(c).cast(EXACT))


def stable_avg(c: str | Column) -> Column:
    """Mean from an exact sum (order-independent)."""
    return F.try_divide(exact_sum(c).cast("double"), F.count(col_(c)))


def stable_sum(c: str | Column) -> Column:
    """Exact sum as a double."""
    return exact_sum(c).cast("double")
