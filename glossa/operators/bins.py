"""Histograms with automatic bins (F26): width by quartiles and count, rounded to a readable step.

The width is 2 (q3 - q1) / n^(1/3), or the range / (1 + log2 n) where the quartiles are equal, brought to the nearest of 1, 2, 5 or
10 times a power of ten; bins lie on multiples of the step, so histograms of different data line up. Quartiles are exact, from
value counts (no task holds all values). Equal values only: one bin of width 1. Nulls and NaN are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossa.operators.stats import quantiles


def readable(width: Column) -> Column:
    """The nearest of 1, 2, 5 and 10 times a power of ten."""
    base = F.pow(F.lit(10.0), F.floor(F.log10(width)).cast("double"))
    times = width / base
    return base * F.when(times < 1.5, 1.0).when(times < 3.5, 2.0).when(times < 7.5, 5.0).otherwise(10.0)


def auto_histogram(df: DataFrame, col: str) -> DataFrame:
    """(bin, n, bin_lo, bin_hi): a row for each bin that holds a value."""
    x = F.col(f"`{col}`").cast("double")
    rows = df.select(F.when(~F.isnan(x), x).alias("x")).where("x IS NOT NULL")
    quartiles = quantiles(rows, ["x"], [0.25, 0.75]).select("x").scalar()
    ends = rows.agg(F.struct(F.count("x").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi")).alias("e")).select("e").scalar()
    iqr, n, spread = F.get(quartiles, F.lit(1)) - F.get(quartiles, F.lit(0)), ends["n"].cast("double"), ends["hi"] - ends["lo"]
    width = F.when(iqr > 0, 2.0 * iqr / F.cbrt(n)).when(spread > 0, spread / (1.0 + F.log2(n)))
    step = F.coalesce(readable(width), F.lit(1.0))
    counts = rows.select(F.floor(F.col("x") / step).cast("long").alias("bin")).groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
    return counts.select("bin", "n", (F.col("bin") * step).alias("bin_lo"), ((F.col("bin") + 1) * step).alias("bin_hi"))
