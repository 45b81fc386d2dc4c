"""Daily series operators: rolling means, z-score anomalies, variation, trend and forecast.

All windows here run on *daily aggregates* (one row per day, bounded by the
calendar: ~5k rows for 15 years), never on raw reviews. An optional
``partition_cols`` turns a single series into one series per key (brand,
platform, ...), which spreads the window work over tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from glossa.functions.numeric import safe_div


def _w(partition_cols: Sequence[str], order_col: str):
    return Window.partitionBy(*partition_cols).orderBy(F.col(order_col).asc())


def rolling_means(
    daily: DataFrame,
    *,
    date_col: str = "review_date",
    partition_cols: Sequence[str] = (),
    short: int = 7,
    long: int = 14,
) -> DataFrame:
    """G1 + G2 on a daily frame with ``avg_rating, avg_sentiment, review_count``.

    G1: ``short``-row trailing mean with min_periods=1, only when the series has at
    least ``short`` days (else the columns are NULL). G2: ``long``-row trailing mean
    that needs a full frame, only when the series has at least ``long`` days.
    Frames are by rows, not calendar days (gaps are not filled).
    """
    w = _w(partition_cols, date_col)
    ws = w.rowsBetween(-(short - 1), 0)
    wl = w.rowsBetween(-(long - 1), 0)
    n_days = F.count(F.lit(1)).over(Window.partitionBy(*partition_cols))
    has_short = n_days >= short
    has_long = n_days >= long
    full_long = F.count(F.lit(1)).over(wl) == long

    def gated(cond, c):
        return F.when(cond, c)

    return daily.select(
        "*",
        gated(has_short, F.avg("avg_rating").over(ws)).alias(f"rating_{short}d_avg"),
        gated(has_short, F.avg("avg_sentiment").over(ws)).alias(f"sentiment_{short}d_avg"),
        gated(has_short, F.avg("review_count").over(ws)).alias(f"volume_{short}d_avg"),
        gated(has_long & full_long, F.avg("avg_rating").over(wl)).alias("rating_trend"),
        gated(has_long & full_long, F.avg("review_count").over(wl)).alias("volume_trend"),
    )


def volume_zscores(
    daily: DataFrame,
    *,
    value_col: str = "review_count",
    threshold: float = 2.0,
    only_anomalies: bool = True,
) -> DataFrame:
    """Z-score of a daily value against the whole series (sample std).

    Mean and std are windows over the whole daily series (one row per day, bounded
    by the calendar), so the daily frame is computed once. A zero std gives NULL
    z-scores (no anomalies).
    """
    series = Window.partitionBy()
    m = F.avg(value_col).over(series)
    s = F.stddev_samp(value_col).over(series)
    z = safe_div(F.col(value_col) - m, s)
    out = daily.withColumn("volume_zscore", z).withColumn(
        "is_anomaly", F.coalesce(F.abs(F.col("volume_zscore")) > F.lit(threshold), F.lit(False))
    )
    return out.filter("is_anomaly") if only_anomalies else out


def volume_variation(daily: DataFrame, *, value_col: str = "review_count") -> DataFrame:
    """F32: variance, coefficient of variation (%), min and max of a daily value."""
    v = F.col(value_col)
    return daily.agg(
        F.var_samp(v).alias("vol_variance"),
        (safe_div(F.stddev_samp(v), F.avg(v)) * 100).alias("vol_cv_pct"),
        F.min(v).alias("min_vol"),
        F.max(v).alias("max_vol"),
    )


def with_row_index(daily: DataFrame, *, date_col: str = "review_date", partition_cols: Sequence[str] = ()) -> DataFrame:
    """0-based row index in date order."""
    return daily.withColumn("idx", F.row_number().over(_w(partition_cols, date_col)) - 1)


def trend_forecast(
    daily: DataFrame,
    *,
    date_col: str = "review_date",
    value_col: str = "review_count",
    horizon: int = 7,
    min_rows: int = 10,
    min_trend_rows: int = 14,
) -> DataFrame:
    """Least-squares slope of value over row index; ``horizon``-day projection.

    Projection for day i (1..horizon) after the last date is ``last_value + slope*i``.
    Needs more than ``min_rows`` rows and at least ``min_trend_rows`` for the trend;
    otherwise the result is empty. Gates are part of the query, not eager counts.
    """
    indexed = with_row_index(daily, date_col=date_col)
    fit = indexed.agg(
        F.regr_slope(F.col(value_col).cast("double"), F.col("idx").cast("double")).alias("slope"),
        F.count(F.lit(1)).alias("n"),
        F.max(date_col).alias("last_date"),
        F.max_by(F.col(value_col), F.col(date_col)).alias("last_value"),
    ).filter((F.col("n") > min_rows) & (F.col("n") >= min_trend_rows))
    steps = fit.select("*", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("step"))
    return steps.select(
        F.col("step"),
        F.date_add(F.col("last_date"), F.col("step")).alias("forecast_date"),
        (F.col("last_value") + F.col("slope") * F.col("step")).alias("forecast_value"),
        F.col("slope").alias("trend_slope"),
    )


def trend_regime(
    daily: DataFrame,
    *,
    date_col: str = "review_date",
    value_col: str = "review_count",
    recent: int = 7,
    history: int = 30,
    up: float = 1.2,
    down: float = 0.8,
    min_rows: int = 10,
    min_trend_rows: int = 14,
) -> DataFrame:
    """G7 + K11: mean of the last ``recent`` and last ``history`` rows, regime and direction.

    ``history`` falls back to ``recent`` when the series is shorter than ``history``.
    Direction is the sign of the row-index slope (needs ``min_trend_rows``).
    """
    w_desc = Window.orderBy(F.col(date_col).desc())
    ranked = with_row_index(daily, date_col=date_col).withColumn("rn", F.row_number().over(w_desc))
    v = F.col(value_col).cast("double")
    agg = ranked.agg(
        F.count(F.lit(1)).alias("n_days"),
        F.avg(F.when(F.col("rn") <= recent, v)).alias("last_recent_avg"),
        F.avg(F.when(F.col("rn") <= history, v)).alias("last_history_avg_raw"),
        F.regr_slope(v, F.col("idx").cast("double")).alias("trend_slope"),
    ).filter(F.col("n_days") > min_rows)
    hist = F.when(F.col("n_days") >= history, F.col("last_history_avg_raw")).otherwise(F.col("last_recent_avg"))
    slope = F.when(F.col("n_days") >= min_trend_rows, F.col("trend_slope"))
    return agg.select(
        "n_days",
        "last_recent_avg",
        hist.alias("last_history_avg"),
        slope.alias("trend_slope"),
        F.when(slope.isNull(), "needs_more_data")
        .when(slope > 0, "increasing")
        .when(slope < 0, "decreasing")
        .otherwise("stable")
        .alias("trend_direction"),
        F.when(F.col("last_recent_avg") > hist * up, "up")
        .when(F.col("last_recent_avg") < hist * down, "down")
        .otherwise("stable")
        .alias("regime"),
    )
