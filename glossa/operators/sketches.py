"""Mergeable daily sketches: distinct counts and quantiles of any range of days without reading its rows again.

A day (and group) keeps one HyperLogLog sketch a distinct column and one quantile sketch a value column, of a few kilobytes
whatever its rows. Ranges merge the sketches. The stated error is that of the sketches: a distinct count's relative
standard error is about 1.04 / sqrt(2^lg_k), and a quantile's rank is off by about 1.33 % of the rows at k = 200.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LG_K, KLL_K = 12, 200
#: Relative bound of distinct counts (three standard errors) and bound of a quantile's rank.
DISTINCT_ERROR, RANK_ERROR = 3 * 1.04 / 2 ** (LG_K / 2), 0.0266


def daily_sketches(df: DataFrame, *, date_col: str, distinct: Sequence[str], values: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by..., day, n, distinct_<c>..., quantiles_<c>...): what to store for each day; rows without a date are left out."""
    return df.where(F.col(date_col).isNotNull()).groupBy(*by, F.to_date(date_col).alias("day")).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.hll_sketch_agg(F.col(c).cast("string"), F.lit(LG_K)).alias(f"distinct_{c}") for c in distinct],
        *[F.kll_sketch_agg_double(F.col(c).cast("double"), F.lit(KLL_K)).alias(f"quantiles_{c}") for c in values],
    )


def merged(sketches: DataFrame, *, distinct: Sequence[str], values: Sequence[str], by: Sequence[str] = (), first: str | None = None, last: str | None = None) -> DataFrame:
    """Sketches of the days from ``first`` to ``last`` (inclusive; default all) as one a group."""
    days = sketches
    if first is not None:
        days = days.where(F.col("day") >= F.to_date(F.lit(first)))
    if last is not None:
        days = days.where(F.col("day") <= F.to_date(F.lit(last)))
    return days.groupBy(*by).agg(
        F.sum("n").alias("n"),
        *[F.hll_union_agg(f"distinct_{c}").alias(f"distinct_{c}") for c in distinct],
        *[F.kll_merge_agg_double(f"quantiles_{c}").alias(f"quantiles_{c}") for c in values],
    )


def estimates(sketch: DataFrame, *, distinct: Sequence[str], values: Sequence[str], by: Sequence[str] = (), probs: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """(by..., n, <c>_distinct..., <c>_quantiles...): the numbers of merged sketches; quantiles are an array in order of ``probs``."""
    ranks = F.array(*map(F.lit, probs))
    return sketch.select(
        *by, "n",
        *[F.hll_sketch_estimate(f"distinct_{c}").alias(f"{c}_distinct") for c in distinct],
        *[F.kll_sketch_get_quantile_double(f"quantiles_{c}", ranks).alias(f"{c}_quantiles") for c in values],
    )
