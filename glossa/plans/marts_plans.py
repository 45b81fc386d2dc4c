"""Registered queries: daily series, product/brand/category marts, distributions, top-k."""

from __future__ import annotations

from pyspark.sql import functions as F

from glossa.functions.numeric import r9
from glossa.operators import marts, timeseries
from glossa.plans.registry import r3 as q3
from glossa.plans.registry import r9 as q9
from glossa.plans.registry import register, savg
from glossa.sources.fixtures import view, with_views


def reviews(spark, sf_dir):
    return view(spark, sf_dir, "reviews_v")


# ---------------------------------------------------------------- daily series

DAILY_SQL = f"""
daily AS (
  SELECT review_date, {q3(savg('rating'))} AS avg_rating, count(rating) AS review_count,
         {q3(savg('sentiment_score'))} AS avg_sentiment
  FROM reviews_v WHERE review_date IS NOT NULL GROUP BY review_date)
"""


@register(
    "daily_metrics_rolling",
    covers="F1 G1 G2",
    oracle=with_views(
        f"""WITH {DAILY_SQL},
w AS (
  SELECT *, count(*) OVER () AS n_days,
         avg(avg_rating) OVER w7 AS r7, avg(avg_sentiment) OVER w7 AS s7, avg(review_count) OVER w7 AS v7,
         avg(avg_rating) OVER w14 AS r14, avg(review_count) OVER w14 AS v14, count(*) OVER w14 AS c14
  FROM daily
  WINDOW w7 AS (ORDER BY review_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW),
         w14 AS (ORDER BY review_date ROWS BETWEEN 13 PRECEDING AND CURRENT ROW))
SELECT review_date, avg_rating, review_count, avg_sentiment,
       CASE WHEN n_days >= 7 THEN {q9('r7')} END AS rating_7d_avg,
       CASE WHEN n_days >= 7 THEN {q9('s7')} END AS sentiment_7d_avg,
       CASE WHEN n_days >= 7 THEN {q9('v7')} END AS volume_7d_avg,
       CASE WHEN n_days >= 14 AND c14 = 14 THEN {q9('r14')} END AS rating_trend,
       CASE WHEN n_days >= 14 AND c14 = 14 THEN {q9('v14')} END AS volume_trend
FROM w""",
        "reviews_v",
    ),
)
def daily_metrics_rolling(spark, sf_dir):
    daily = marts.daily_metrics(reviews(spark, sf_dir))
    rolled = timeseries.rolling_means(daily)
    out = ["rating_7d_avg", "sentiment_7d_avg", "volume_7d_avg", "rating_trend", "volume_trend"]
    return rolled.select(
        "review_date", "avg_rating", "review_count", "avg_sentiment", *[r9(c).alias(c) for c in out]
    )


@register(
    "brand_daily_rolling",
    covers="F1 G1 G2",
    oracle=with_views(
        f"""WITH d AS (
  SELECT brand_name, review_date, {q3(savg('rating'))} AS avg_rating, count(rating) AS review_count,
         {q3(savg('sentiment_score'))} AS avg_sentiment
  FROM reviews_v WHERE review_date IS NOT NULL AND brand_name IS NOT NULL GROUP BY brand_name, review_date),
w AS (
  SELECT *, count(*) OVER (PARTITION BY brand_name) AS n_days,
         avg(avg_rating) OVER w7 AS r7, avg(avg_sentiment) OVER w7 AS s7, avg(review_count) OVER w7 AS v7,
         avg(avg_rating) OVER w14 AS r14, avg(review_count) OVER w14 AS v14, count(*) OVER w14 AS c14
  FROM d
  WINDOW w7 AS (PARTITION BY brand_name ORDER BY review_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW),
         w14 AS (PARTITION BY brand_name ORDER BY review_date ROWS BETWEEN 13 PRECEDING AND CURRENT ROW))
SELECT brand_name, review_date, avg_rating, review_count, avg_sentiment,
       CASE WHEN n_days >= 7 THEN {q9('r7')} END AS rating_7d_avg,
       CASE WHEN n_days >= 7 THEN {q9('s7')} END AS sentiment_7d_avg,
       CASE WHEN n_days >= 7 THEN {q9('v7')} END AS volume_7d_avg,
       CASE WHEN n_days >= 14 AND c14 = 14 THEN {q9('r14')} END AS rating_trend,
       CASE WHEN n_days >= 14 AND c14 = 14 THEN {q9('v14')} END AS volume_trend
FROM w""",
        "reviews_v",
    ),
)
def brand_daily_rolling(spark, sf_dir):
    """Per-brand daily series: the same rolling operator with ``partition_cols``,
    so the window work is spread over tasks by brand."""
    daily = marts.daily_metrics(reviews(spark, sf_dir), partition_cols=["brand_name"])
    rolled = timeseries.rolling_means(daily, partition_cols=["brand_name"])
    out = ["rating_7d_avg", "sentiment_7d_avg", "volume_7d_avg", "rating_trend", "volume_trend"]
    return rolled.select(
        "brand_name", "review_date", "avg_rating", "review_count", "avg_sentiment", *[r9(c).alias(c) for c in out]
    )


@register(
    "volume_anomalies",
    covers="G3",
    oracle=with_views(
        f"""WITH {DAILY_SQL},
s AS (SELECT avg(review_count) AS m, stddev_samp(review_count) AS sd FROM daily),
z AS (SELECT review_date, review_count,
             CASE WHEN sd > 0 THEN (review_count - m) / sd END AS zz FROM daily, s)
SELECT review_date, review_count, {q9('zz')} AS volume_zscore FROM z WHERE abs(zz) > 2""",
        "reviews_v",
    ),
)
def volume_anomalies(spark, sf_dir):
    daily = marts.daily_metrics(reviews(spark, sf_dir))
    z = timeseries.volume_zscores(daily, threshold=2.0)
    return z.select("review_date", "review_count", r9("volume_zscore").alias("volume_zscore"))


@register(
    "volume_variation",
    covers="F32",
    oracle=with_views(
        f"""WITH {DAILY_SQL}
SELECT {q9('var_samp(review_count)')} AS vol_variance,
       {q9('stddev_samp(review_count) / avg(review_count) * 100')} AS vol_cv_pct,
       min(review_count) AS min_vol, max(review_count) AS max_vol FROM daily""",
        "reviews_v",
    ),
)
def volume_variation(spark, sf_dir):
    daily = marts.daily_metrics(reviews(spark, sf_dir))
    v = timeseries.volume_variation(daily)
    return v.select(r9("vol_variance").alias("vol_variance"), r9("vol_cv_pct").alias("vol_cv_pct"), "min_vol", "max_vol")


@register(
    "trend_forecast",
    covers="G5 G8 K10",
    oracle=with_views(
        f"""WITH {DAILY_SQL},
idx AS (SELECT *, row_number() OVER (ORDER BY review_date) - 1 AS i FROM daily),
fit AS (SELECT regr_slope(review_count, i) AS slope, count(*) AS n, max(review_date) AS last_date,
               arg_max(review_count, review_date) AS last_value FROM idx),
steps AS (SELECT fit.*, s.step FROM fit, range(1, 8) s(step) WHERE n > 10 AND n >= 14)
SELECT CAST(step AS INTEGER) AS step, CAST(last_date + CAST(step AS INTEGER) AS DATE) AS forecast_date,
       {q9('last_value + slope * step')} AS forecast_value, {q9('slope')} AS trend_slope
FROM steps""",
        "reviews_v",
    ),
)
def trend_forecast(spark, sf_dir):
    daily = marts.daily_metrics(reviews(spark, sf_dir))
    f = timeseries.trend_forecast(daily)
    return f.select("step", "forecast_date", r9("forecast_value").alias("forecast_value"), r9("trend_slope").alias("trend_slope"))


@register(
    "trend_regime",
    covers="G7 K11",
    oracle=with_views(
        f"""WITH {DAILY_SQL},
r AS (SELECT *, row_number() OVER (ORDER BY review_date) - 1 AS i,
             row_number() OVER (ORDER BY review_date DESC) AS rn FROM daily),
a AS (SELECT count(*) AS n_days,
             avg(CASE WHEN rn <= 7 THEN review_count END) AS rec,
             avg(CASE WHEN rn <= 30 THEN review_count END) AS hist_raw,
             regr_slope(review_count, i) AS slope FROM r),
b AS (SELECT n_days, rec, CASE WHEN n_days >= 30 THEN hist_raw ELSE rec END AS hist,
             CASE WHEN n_days >= 14 THEN slope END AS sl FROM a WHERE n_days > 10)
SELECT n_days, {q9('rec')} AS last_recent_avg, {q9('hist')} AS last_history_avg, {q9('sl')} AS trend_slope,
       CASE WHEN sl IS NULL THEN 'needs_more_data' WHEN sl > 0 THEN 'increasing'
            WHEN sl < 0 THEN 'decreasing' ELSE 'stable' END AS trend_direction,
       CASE WHEN rec > hist * 1.2 THEN 'up' WHEN rec < hist * 0.8 THEN 'down' ELSE 'stable' END AS regime
FROM b""",
        "reviews_v",
    ),
)
def trend_regime(spark, sf_dir):
    daily = marts.daily_metrics(reviews(spark, sf_dir))
    t = timeseries.trend_regime(daily)
    return t.select(
        "n_days",
        r9("last_recent_avg").alias("last_recent_avg"),
        r9("last_history_avg").alias("last_history_avg"),
        r9("trend_slope").alias("trend_slope"),
        "trend_direction",
        "regime",
    )


# ---------------------------------------------------------------- marts


def _class_sql(rules, default, std: bool) -> str:
    parts = []
    for label, lo, hi_ex, hi_in, min_n, max_std in rules:
        conds = []
        if lo is not None:
            conds.append(f"avg_rating >= {lo}")
        if hi_ex is not None:
            conds.append(f"avg_rating < {hi_ex}")
        if hi_in is not None:
            conds.append(f"avg_rating <= {hi_in}")
        if min_n is not None:
            conds.append(f"review_count >= {min_n}")
        if max_std is not None and std:
            conds.append(f"coalesce(rating_std <= {max_std}, false)")
        parts.append(f"WHEN {' AND '.join(conds) or 'true'} THEN '{label}'")
    return f"CASE {' '.join(parts)} ELSE '{default}' END"


@register(
    "product_metrics",
    covers="F2 F3 F4",
    oracle=with_views(
        f"""WITH p AS (
  SELECT product_id, {q3(savg('rating'))} AS avg_rating, count(rating) AS review_count,
         {q3('stddev_samp(rating)')} AS rating_std, {q3(savg('sentiment_score'))} AS avg_sentiment,
         count(DISTINCT user_id) AS unique_users
  FROM reviews_v WHERE product_id IS NOT NULL GROUP BY product_id)
SELECT *, {_class_sql(marts.PRODUCT_RULES, marts.PRODUCT_DEFAULT, True)} AS performance_category,
       {q9('avg_rating * ln(1 + review_count)')} AS product_score FROM p""",
        "reviews_v",
    ),
)
def product_metrics(spark, sf_dir):
    p = marts.product_metrics(reviews(spark, sf_dir))
    return p.withColumn("product_score", r9("product_score"))


@register(
    "product_metrics_ui",
    covers="F5 E5",
    oracle=with_views(
        f"""WITH p AS (
  SELECT product_id, {q3(savg('rating'))} AS avg_rating, count(rating) AS review_count,
         {q3(savg('sentiment_score'))} AS avg_sentiment, min(product_name) AS product_name
  FROM reviews_v WHERE product_id IS NOT NULL GROUP BY product_id)
SELECT *, {_class_sql(marts.PRODUCT_RULES_UI, marts.PRODUCT_DEFAULT_UI, False)} AS performance_category FROM p""",
        "reviews_v",
    ),
)
def product_metrics_ui(spark, sf_dir):
    return marts.product_metrics_ui(reviews(spark, sf_dir))


@register(
    "brand_summary",
    covers="F6",
    oracle=with_views(
        f"""SELECT brand_name, {q3(savg('rating'))} AS avg_rating, count(rating) AS review_count,
       {q3('stddev_samp(rating)')} AS rating_std, {q3(savg('sentiment_score'))} AS avg_sentiment,
       count(DISTINCT product_id) AS product_count, count(DISTINCT user_id) AS unique_users
FROM reviews_v WHERE brand_name IS NOT NULL GROUP BY brand_name""",
        "reviews_v",
    ),
)
def brand_summary(spark, sf_dir):
    return marts.brand_summary(reviews(spark, sf_dir))


@register(
    "category_summary",
    covers="F8",
    oracle=with_views(
        f"""SELECT primary_category AS category, {q3(savg('rating'))} AS avg_rating,
       {q3(savg('sentiment_score'))} AS avg_sentiment, count(DISTINCT product_id) AS product_count,
       count(product_name) AS review_count
FROM reviews_v WHERE primary_category IS NOT NULL GROUP BY primary_category""",
        "reviews_v",
    ),
)
def category_summary(spark, sf_dir):
    # The product name stands in for the review text whose non-null count is taken.
    return marts.category_summary(reviews(spark, sf_dir), text_col="product_name")


def cluster_fixture(spark, sf_dir):
    """Reviews with a deterministic stand-in cluster key and text-derived columns."""
    r = reviews(spark, sf_dir)
    return r.select(
        "*",
        (F.col("user_id") % 4).cast("int").alias("user_cluster"),
        F.size(F.split(F.col("product_name"), " ")).cast("long").alias("text_word_count"),
        F.abs(F.col("sentiment_score")).alias("sentiment_intensity"),
    )


@register(
    "cluster_summary",
    covers="F9",
    oracle=with_views(
        f"""SELECT CAST(user_id % 4 AS INTEGER) AS cluster, {q3(savg('rating'))} AS avg_rating,
       count(rating) AS review_count, {q3(savg('sentiment_score'))} AS avg_sentiment,
       {q3(savg("len(string_split(product_name, ' '))"))} AS avg_word_count,
       {q3(savg('abs(sentiment_score)'))} AS avg_sentiment_intensity
FROM reviews_v GROUP BY 1""",
        "reviews_v",
    ),
)
def cluster_summary(spark, sf_dir):
    return marts.cluster_summary(cluster_fixture(spark, sf_dir))


@register(
    "cluster_view",
    covers="F10",
    oracle=with_views(
        f"""SELECT CAST(user_id % 4 AS INTEGER) AS user_cluster, {q3(savg('rating'))} AS rating_mean,
       count(rating) AS rating_count, {q3(savg('sentiment_score'))} AS sentiment_score_mean
FROM reviews_v GROUP BY 1""",
        "reviews_v",
    ),
)
def cluster_view(spark, sf_dir):
    return marts.cluster_view(cluster_fixture(spark, sf_dir))


@register(
    "sentiment_by_category",
    covers="F11 H5",
    oracle=with_views(
        f"""SELECT primary_category AS category, {q9('avg(sentiment_score)')} AS avg_sentiment,
       {q9('avg(rating)')} AS avg_rating, count(sentiment_score) AS review_count
FROM reviews_v WHERE primary_category IS NOT NULL GROUP BY primary_category
ORDER BY avg(sentiment_score) DESC, primary_category LIMIT 15""",
        "reviews_v",
    ),
)
def sentiment_by_category(spark, sf_dir):
    s = marts.sentiment_by_category(reviews(spark, sf_dir), k=15)
    return s.select("category", r9("avg_sentiment").alias("avg_sentiment"), r9("avg_rating").alias("avg_rating"), "review_count")


@register(
    "review_kpis",
    covers="F19",
    oracle=with_views(
        f"""SELECT count(*) AS total_reviews, {q9('avg(rating)')} AS avg_rating,
       {q9('avg(sentiment_score)')} AS avg_sentiment, count(DISTINCT product_id) AS unique_products,
       count(DISTINCT brand_name) AS unique_brands, count(DISTINCT primary_category) AS unique_categories
FROM reviews_v""",
        "reviews_v",
    ),
)
def review_kpis(spark, sf_dir):
    k = marts.review_kpis(reviews(spark, sf_dir))
    return k.withColumn("avg_rating", r9("avg_rating")).withColumn("avg_sentiment", r9("avg_sentiment"))


@register(
    "sentiment_distribution",
    covers="F23 C7",
    oracle=with_views(
        f"""SELECT sentiment_label, count(*) AS n,
       {q9('count(*) / sum(count(*)) OVER ()')} AS share
FROM reviews_v WHERE sentiment_label IS NOT NULL GROUP BY sentiment_label""",
        "reviews_v",
    ),
)
def sentiment_distribution(spark, sf_dir):
    d = marts.label_distribution(reviews(spark, sf_dir))
    return d.withColumn("share", r9("share"))


@register(
    "rating_distribution",
    covers="F24 F25",
    oracle=with_views(
        "SELECT rating, count(*) AS n FROM reviews_v WHERE rating IS NOT NULL GROUP BY rating", "reviews_v"
    ),
)
def rating_distribution(spark, sf_dir):
    return marts.value_distribution(reviews(spark, sf_dir), col="rating")


@register(
    "sentiment_histogram",
    covers="F26",
    oracle=with_views(
        f"""WITH rg AS (SELECT min(sentiment_score) AS lo, max(sentiment_score) AS hi FROM reviews_v),
b AS (SELECT CAST(least(greatest(coalesce(floor((sentiment_score - lo) / ((hi - lo) / 20.0)), 0), 0), 19) AS INTEGER) AS bin,
             lo, (hi - lo) / 20.0 AS w
      FROM reviews_v, rg WHERE sentiment_score IS NOT NULL)
SELECT bin, count(*) AS n, {q9('any_value(lo) + bin * any_value(w)')} AS bin_lo,
       {q9('any_value(lo) + (bin + 1) * any_value(w)')} AS bin_hi
FROM b GROUP BY bin""",
        "reviews_v",
    ),
)
def sentiment_histogram(spark, sf_dir):
    h = marts.histogram(reviews(spark, sf_dir), col="sentiment_score", bins=20)
    return h.select("bin", "n", r9("bin_lo").alias("bin_lo"), r9("bin_hi").alias("bin_hi"))


@register(
    "rating_histogram",
    covers="F26",
    oracle=with_views(
        f"""WITH rg AS (SELECT min(rating) AS lo, max(rating) AS hi FROM reviews_v),
b AS (SELECT CAST(least(greatest(coalesce(floor((rating - lo) / ((hi - lo) / 5.0)), 0), 0), 4) AS INTEGER) AS bin,
             lo, (hi - lo) / 5.0 AS w
      FROM reviews_v, rg WHERE rating IS NOT NULL)
SELECT bin, count(*) AS n, {q9('any_value(lo) + bin * any_value(w)')} AS bin_lo,
       {q9('any_value(lo) + (bin + 1) * any_value(w)')} AS bin_hi
FROM b GROUP BY bin""",
        "reviews_v",
    ),
)
def rating_histogram(spark, sf_dir):
    h = marts.histogram(reviews(spark, sf_dir), col="rating", bins=5)
    return h.select("bin", "n", r9("bin_lo").alias("bin_lo"), r9("bin_hi").alias("bin_hi"))


@register(
    "top_brands",
    covers="H2 F7",
    oracle=with_views(
        f"""WITH b AS (
  SELECT brand_name, {q3(savg('rating'))} AS avg_rating, count(rating) AS review_count,
         {q3(savg('sentiment_score'))} AS avg_sentiment, count(DISTINCT product_id) AS product_count
  FROM reviews_v WHERE brand_name IS NOT NULL GROUP BY brand_name)
(SELECT *, 'rating' AS ranking FROM b ORDER BY avg_rating DESC, brand_name LIMIT 10)
UNION ALL
(SELECT *, 'volume' AS ranking FROM b ORDER BY review_count DESC, brand_name LIMIT 10)""",
        "reviews_v",
    ),
)
def top_brands(spark, sf_dir):
    return marts.top_brands(reviews(spark, sf_dir), k=10)


@register(
    "top_products",
    covers="H3",
    oracle=with_views(
        f"""WITH p AS (
  SELECT product_id, {q3(savg('rating'))} AS avg_rating, count(rating) AS review_count,
         {q3(savg('sentiment_score'))} AS avg_sentiment, min(product_name) AS product_name
  FROM reviews_v WHERE product_id IS NOT NULL GROUP BY product_id)
SELECT *, {_class_sql(marts.PRODUCT_RULES_UI, marts.PRODUCT_DEFAULT_UI, False)} AS performance_category
FROM p ORDER BY avg_rating DESC, product_id LIMIT 10""",
        "reviews_v",
    ),
)
def top_products(spark, sf_dir):
    return marts.top_products(reviews(spark, sf_dir), k=10)
