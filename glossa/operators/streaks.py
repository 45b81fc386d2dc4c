"""Streak alerts (F38): a share or a correlation beyond its limit for days on end.

Days that meet a rule form runs of days in a row, found by gaps and islands: a day less its number among the days that meet
it is the same along a run, and a day without data ends one. Windows run over daily series, one a group, never over reviews.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from glossa.functions.numeric import safe_div
from glossa.operators.segments import LOW_RATING_MAX, LOW_RATING_SHARE_HIGH, NEGATIVE_SHARE_CRITICAL, WEAK_CORRELATION

# Severity, metric, limit, which side of it is bad, and the least number of days.
REVIEW_RULES = (
    ("CRITICO", "negative_share", NEGATIVE_SHARE_CRITICAL, "above", 3),
    ("ALTA", "low_rating_share", LOW_RATING_SHARE_HIGH, "above", 3),
)
CORRELATION_RULES = (("MEDIA", "social_correlation", WEAK_CORRELATION, "below", 7),)


def runs(days: DataFrame, bad: Column, value: Column, *, day: str = "day", by: Sequence[str] = (), min_days: int = 3, worst=F.max) -> DataFrame:
    """(by..., start_day, end_day, days, worst): the runs of at least ``min_days`` days in a row that are ``bad``; null is not bad."""
    met = days.where(bad).select(*by, F.col(day).alias("_day"), value.alias("_value"))
    number = F.row_number().over(Window.partitionBy(*by).orderBy("_day"))
    marked = met.withColumn("_run", F.date_sub("_day", number))
    found = marked.groupBy(*by, "_run").agg(F.min("_day").alias("start_day"), F.max("_day").alias("end_day"), F.count(F.lit(1)).alias("days"), worst("_value").alias("worst"))
    return found.where(F.col("days") >= min_days).drop("_run")


def streaks(days: DataFrame, rules: Sequence[tuple], *, day: str = "day", by: Sequence[str] = ()) -> DataFrame:
    """The runs of every rule in one table, ``severity, metric, by..., start_day, end_day, days, worst, threshold``.

    ``days`` has one row a day (and group) with a column for each rule's metric.
    """
    out = None
    for severity, metric, limit, side, least in rules:
        bad, worst = (F.col(metric) > limit, F.max) if side == "above" else (F.col(metric) < limit, F.min)
        found = runs(days, bad, F.col(metric), day=day, by=by, min_days=least, worst=worst)
        found = found.select(F.lit(severity).alias("severity"), F.lit(metric).alias("metric"), *by, "start_day", "end_day", "days", "worst", F.lit(float(limit)).alias("threshold"))
        out = found if out is None else out.unionByName(found)
    return out


def daily_shares(reviews: DataFrame, *, date_col: str = "review_date", by: Sequence[str] = ()) -> DataFrame:
    """(by..., day, negative_share, low_rating_share); rows without a date or group are left out."""
    share = lambda c: safe_div(F.count_if(F.coalesce(c, F.lit(False))).cast("double"), F.count(F.lit(1)))
    return reviews.dropna(subset=[date_col, *by]).groupBy(*by, F.to_date(date_col).alias("day")).agg(
        share(F.col("sentiment_label") == "negative").alias("negative_share"), share(F.col("rating") <= LOW_RATING_MAX).alias("low_rating_share")
    )


def review_streaks(reviews: DataFrame, *, date_col: str = "review_date", by: Sequence[str] = (), rules: Sequence[tuple] = REVIEW_RULES) -> DataFrame:
    """Streaks of bad days among reviews, of all or of every group."""
    return streaks(daily_shares(reviews, date_col=date_col, by=by), rules, by=by)


def rolling_correlation(panel: DataFrame, x: str, y: str, *, by: Sequence[str] = ("platform",), day: str = "date", days: int = 30, min_pairs: int = 10) -> DataFrame:
    """(by..., day, social_correlation): |Pearson| of the last ``days`` rows of a daily panel; null for a constant side or too few rows."""
    w = Window.partitionBy(*by).orderBy("day").rowsBetween(-(days - 1), 0)
    pair = panel.dropna(subset=[x, y, day, *by]).select(*by, F.col(day).alias("day"), F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y"))
    r = F.try_divide(F.covar_pop("_x", "_y").over(w), F.stddev_pop("_x").over(w) * F.stddev_pop("_y").over(w))
    return pair.select(*by, "day", F.when(F.count(F.lit(1)).over(w) >= min_pairs, F.abs(r)).alias("social_correlation"))


def correlation_streaks(panel: DataFrame, *, by: Sequence[str] = ("platform",), rules: Sequence[tuple] = CORRELATION_RULES, **window) -> DataFrame:
    """Streaks of weak correlation between review count and mentions, for every platform."""
    return streaks(rolling_correlation(panel, "review_count", "mention_volume", by=by, **window), rules, by=by)
