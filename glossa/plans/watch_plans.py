"""Registered queries: streak alerts, automatic bins, mergeable sketches."""

from __future__ import annotations

from pyspark.sql import functions as F

from glossa.functions.numeric import r9
from glossa.operators import bins, sketches, social, stats, streaks
from glossa.plans.registry import r9 as q9
from glossa.plans.registry import register
from glossa.session import written
from glossa.sources.fixtures import view, with_views


def runs_sql(days: str, by: str, rules) -> str:
    """The runs of every rule over a relation (by, day, metrics)."""
    parts = []
    for severity, metric, limit, side, least in rules:
        sign, worst = (">", "max") if side == "above" else ("<", "min")
        parts.append(f"""SELECT '{severity}' AS severity, '{metric}' AS metric, {by}, min(day) AS start_day, max(day) AS end_day, count(*) AS days,
  {q9(f'{worst}({metric})')} AS worst, {float(limit)}::DOUBLE AS threshold
FROM (SELECT *, day - CAST(row_number() OVER (PARTITION BY {by} ORDER BY day) AS INTEGER) AS run FROM {days} WHERE {metric} {sign} {limit})
GROUP BY {by}, run HAVING count(*) >= {least}""")
    return " UNION ALL ".join(parts)


SHARES = """SELECT brand_name, CAST(review_date AS DATE) AS day, count(*) FILTER (WHERE sentiment_label = 'negative') / count(*) AS negative_share,
  count(*) FILTER (WHERE rating <= 2) / count(*) AS low_rating_share FROM reviews_v GROUP BY ALL"""


@register("streak_alerts", covers="F38", oracle=with_views(f"WITH shares AS ({SHARES}) {runs_sql('shares', 'brand_name', streaks.REVIEW_RULES)}", "reviews_v"))
def streak_alerts(spark, sf_dir):
    return streaks.review_streaks(view(spark, sf_dir, "reviews_v"), by=["brand_name"]).withColumn("worst", r9("worst"))


@register(
    "correlation_streaks",
    covers="F38 E3",
    oracle=with_views(
        f"""WITH daily AS (SELECT review_date AS date, count(product_id) AS review_count FROM reviews_v GROUP BY review_date),
panel AS (SELECT platform, date, sum(mention_volume) AS mention_volume FROM social_v GROUP BY ALL),
joined AS (SELECT platform, date AS day, review_count::DOUBLE AS x, mention_volume::DOUBLE AS y FROM daily JOIN panel USING (date)),
rolled AS (SELECT platform, day, count(*) OVER w AS n, covar_pop(x, y) OVER w / nullif(stddev_pop(x) OVER w * stddev_pop(y) OVER w, 0) AS r
  FROM joined WINDOW w AS (PARTITION BY platform ORDER BY day ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)),
weak AS (SELECT platform, day, CASE WHEN n >= 10 THEN abs(r) END AS social_correlation FROM rolled)
{runs_sql('weak', 'platform', streaks.CORRELATION_RULES)}""",
        "reviews_v", "social_v",
    ),
)
def correlation_streaks(spark, sf_dir):
    panel = stats.correlation_panel(social.daily_reviews(view(spark, sf_dir, "reviews_v")), social.daily_social(view(spark, sf_dir, "social_v")))
    return streaks.correlation_streaks(panel).withColumn("worst", r9("worst"))


def bins_sql(view_name: str, col: str) -> str:
    return f"""WITH e AS (SELECT count(x) AS n, quantile_cont(x, 0.75) - quantile_cont(x, 0.25) AS iqr, max(x) - min(x) AS spread FROM (SELECT {col}::DOUBLE AS x FROM {view_name})),
w AS (SELECT CASE WHEN iqr > 0 THEN 2.0 * iqr / cbrt(n) WHEN spread > 0 THEN spread / (1 + log2(n)) END AS width FROM e),
b AS (SELECT width, pow(10.0, floor(log10(width))) AS base FROM w),
s AS (SELECT coalesce(base * CASE WHEN width / base < 1.5 THEN 1 WHEN width / base < 3.5 THEN 2 WHEN width / base < 7.5 THEN 5 ELSE 10 END, 1.0) AS step FROM b)
SELECT CAST(floor({col} / step) AS BIGINT) AS bin, count(*) AS n, {q9('floor(' + col + ' / step) * any_value(step)')} AS bin_lo,
  {q9('(floor(' + col + ' / step) + 1) * any_value(step)')} AS bin_hi
FROM {view_name}, s WHERE {col} IS NOT NULL GROUP BY floor({col} / step)"""


def _binned(df, col):
    return bins.auto_histogram(df, col).withColumns({c: r9(c) for c in ("bin_lo", "bin_hi")})


@register("engagement_bins", covers="F26", oracle=with_views(bins_sql("social_v", "engagement"), "social_v"))
def engagement_bins(spark, sf_dir):
    return _binned(view(spark, sf_dir, "social_v"), "engagement")


@register("sentiment_bins", covers="F26", oracle=with_views(bins_sql("dirty_reviews_v", "sentiment_score"), "dirty_reviews_v"))
def sentiment_bins(spark, sf_dir):
    return _binned(view(spark, sf_dir, "dirty_reviews_v"), "sentiment_score")


SKETCHED = {"distinct": ["user_id", "product_id"], "values": ["sentiment_score"]}


@register(
    "sketched_brands",
    covers="F2 F6 F19 F34",
    oracle=with_views(
        """SELECT brand_name, count(*) AS n, count(DISTINCT user_id) AS users, count(DISTINCT product_id) AS products,
  true AS users_within, true AS products_within, true AS quartiles_within
FROM reviews_v WHERE review_date BETWEEN DATE '1994-01-01' AND DATE '1996-12-31' GROUP BY brand_name""",
        "reviews_v",
    ),
)
def sketched_brands(spark, sf_dir):
    """Three years of brands from their stored daily sketches, held against exact figures of the rows."""
    reviews = view(spark, sf_dir, "reviews_v")
    stored = written(sketches.daily_sketches(reviews, date_col="review_date", by=["brand_name"], **SKETCHED), "daily-sketches")
    whole = sketches.merged(stored, by=["brand_name"], first="1994-01-01", last="1996-12-31", **SKETCHED)
    found = sketches.estimates(whole, by=["brand_name"], **SKETCHED)
    rows = reviews.where(F.col("review_date").between("1994-01-01", "1996-12-31"))
    exact = rows.groupBy("brand_name").agg(F.countDistinct("user_id").alias("users"), F.countDistinct("product_id").alias("products"))
    q = F.col("sentiment_score_quartiles")
    ranks = rows.join(found.select("brand_name", F.col("sentiment_score_quantiles").alias("sentiment_score_quartiles")), "brand_name")
    x = F.col("sentiment_score")
    # A quartile's ranks, from the rows below it to those not above, must come within the bound of its place.
    inside = [
        (F.avg((x < F.get(q, F.lit(i))).cast("double")) <= p + sketches.RANK_ERROR) & (F.avg((x <= F.get(q, F.lit(i))).cast("double")) >= p - sketches.RANK_ERROR)
        for i, p in enumerate((0.25, 0.5, 0.75))
    ]
    ranks = ranks.groupBy("brand_name").agg((inside[0] & inside[1] & inside[2]).alias("quartiles_within"))
    near = lambda c, e: F.abs(F.col(c) - F.col(e)) <= F.greatest(F.lit(1.0), F.col(e) * sketches.DISTINCT_ERROR)
    joined = found.join(exact, "brand_name").join(ranks, "brand_name")
    return joined.select(
        "brand_name", "n", "users", "products", near("user_id_distinct", "users").alias("users_within"),
        near("product_id_distinct", "products").alias("products_within"), "quartiles_within",
    )
