"""Registered queries over dirty rows: null keys, out-of-range values, unknown labels, unmatched products."""

from __future__ import annotations

from pyspark.sql import functions as F

from glossa.functions.numeric import r9
from glossa.operators import joins, quality, segments, social
from glossa.plans.registry import r9 as q9
from glossa.plans.registry import register, ssum
from glossa.sources.fixtures import read_table, view, with_views


@register(
    "dirty_daily_social",
    covers="F13",
    oracle=with_views(
        f"""SELECT date, platform, CAST(sum(mention_volume) AS BIGINT) AS mention_volume, {q9(ssum('engagement'))} AS engagement
FROM dirty_social_v WHERE date IS NOT NULL AND platform IS NOT NULL GROUP BY date, platform""",
        "dirty_social_v",
    ),
)
def dirty_daily_social(spark, sf_dir):
    return social.daily_social(view(spark, sf_dir, "dirty_social_v")).withColumn("engagement", r9("engagement"))


@register(
    "dirty_platform_metrics",
    covers="F14",
    oracle=with_views(
        """SELECT platform, round_even(sum(mention_volume), 0)::DOUBLE AS total_mentions, round_even(avg(mention_volume), 0)::DOUBLE AS avg_mentions,
       round_even(sum(engagement), 0)::DOUBLE AS total_engagement, round_even(avg(engagement), 0)::DOUBLE AS avg_engagement
FROM dirty_social_v WHERE platform IS NOT NULL GROUP BY platform""",
        "dirty_social_v",
    ),
)
def dirty_platform_metrics(spark, sf_dir):
    return social.platform_metrics(view(spark, sf_dir, "dirty_social_v"))


@register(
    "dirty_social_kpis",
    covers="F18",
    oracle=with_views(
        f"""SELECT CAST(sum(mention_volume) AS BIGINT) AS total_mentions, {q9(ssum('engagement'))} AS total_engagement,
       (SELECT {q9('avg(m)')} FROM (SELECT sum(mention_volume) AS m FROM dirty_social_v WHERE date IS NOT NULL GROUP BY date)) AS avg_daily_mentions,
       (SELECT platform FROM (SELECT platform, sum(mention_volume) AS m FROM dirty_social_v WHERE platform IS NOT NULL GROUP BY platform)
        ORDER BY m DESC, platform LIMIT 1) AS top_platform
FROM dirty_social_v""",
        "dirty_social_v",
    ),
)
def dirty_social_kpis(spark, sf_dir):
    k = social.social_kpis(view(spark, sf_dir, "dirty_social_v"))
    return k.withColumn("total_mentions", F.col("total_mentions").cast("long")).withColumns({c: r9(c) for c in ("total_engagement", "avg_daily_mentions")})


@register(
    "dirty_hashtag_engagement_top",
    covers="F41 H8",
    oracle=with_views(
        f"""SELECT hashtag, {q9(ssum('engagement'))} AS engagement, (SELECT count(DISTINCT hashtag) FROM dirty_social_v) AS n_hashtags
FROM dirty_social_v WHERE hashtag IS NOT NULL GROUP BY hashtag ORDER BY engagement DESC, hashtag LIMIT 3""",
        "dirty_social_v",
    ),
)
def dirty_hashtag_engagement_top(spark, sf_dir):
    return social.hashtag_engagement_top(view(spark, sf_dir, "dirty_social_v"), k=3).withColumn("engagement", r9("engagement"))


@register(
    "dirty_alerts",
    covers="F38",
    oracle=with_views(
        f"""WITH k AS (SELECT avg(CASE WHEN sentiment_label = 'negative' THEN 1.0 ELSE 0.0 END) AS neg,
             avg(CASE WHEN rating <= 2.0 THEN 1.0 ELSE 0.0 END) AS low FROM dirty_reviews_v)
SELECT 'CRITICO' AS severity, 'negative_share' AS metric, {q9('neg')} AS value, 0.3::DOUBLE AS threshold, neg > 0.3 AS fired FROM k
UNION ALL SELECT 'ALTA', 'low_rating_share', {q9('low')}, 0.1::DOUBLE, low > 0.1 FROM k
UNION ALL SELECT 'INFO', 'social_correlation', NULL, NULL, true""",
        "dirty_reviews_v",
    ),
)
def dirty_alerts(spark, sf_dir):
    return segments.alerts(view(spark, sf_dir, "dirty_reviews_v")).withColumn("value", r9("value"))


@register(
    "validation_offenders",
    covers="V3 V4 V5",
    oracle=with_views(
        """WITH o AS (
  SELECT 'rating_range' AS "check", 'rating' AS "column", CAST(rating AS VARCHAR) AS value FROM dirty_reviews_v
  WHERE rating IS NULL OR rating NOT BETWEEN 1 AND 5
  UNION ALL SELECT 'label_values', 'sentiment_label', sentiment_label FROM dirty_reviews_v
  WHERE sentiment_label IS NULL OR sentiment_label NOT IN ('positive', 'negative', 'neutral'))
SELECT "check", "column", value, count(*) AS n FROM o GROUP BY ALL""",
        "dirty_reviews_v",
    ),
)
def validation_offenders(spark, sf_dir):
    # Scores print differently in the two engines; the next query compares them as numbers.
    return quality.validation_offenders(view(spark, sf_dir, "dirty_reviews_v").drop("sentiment_score"))


@register(
    "validation_offending_scores",
    covers="V4",
    oracle=with_views(
        f"""SELECT {q9('sentiment_score')} AS value, count(*) AS n FROM dirty_reviews_v
WHERE sentiment_score IS NULL OR sentiment_score NOT BETWEEN -1 AND 1 GROUP BY 1""",
        "dirty_reviews_v",
    ),
)
def validation_offending_scores(spark, sf_dir):
    o = quality.validation_offenders(view(spark, sf_dir, "dirty_reviews_v").select("sentiment_score"))
    return o.groupBy(r9(F.col("value").cast("double")).alias("value")).agg(F.sum("n").alias("n"))


def _completeness_sql(columns: tuple[str, ...]) -> str:
    nulls = " + ".join(f"count(*) FILTER (WHERE {c} IS NULL)" for c in columns)
    n = len(columns)
    return f"""SELECT count(*) AS n_rows, CAST({nulls} AS BIGINT) AS n_nulls, {n} * count(*) AS n_cells,
       {q9(f'(1 - ({nulls}) / ({n} * count(*))) * 100')} AS completeness_pct FROM dirty_reviews_v"""


DIRTY_COLUMNS = ("order_id", "line_no", "user_id", "product_id", "rating", "sentiment_score", "sentiment_label", "review_date")


@register("completeness_all_columns", covers="F28", oracle=with_views(_completeness_sql(DIRTY_COLUMNS), "dirty_reviews_v"))
def completeness_all_columns(spark, sf_dir):
    c = quality.completeness(view(spark, sf_dir, "dirty_reviews_v"))
    return c.withColumn("completeness_pct", r9("completeness_pct"))


@register(
    "dirty_match_rate",
    covers="E1 E2",
    oracle=with_views(
        f"""SELECT count(*) AS n_rows, count(p_name) AS n_matched, {q9('avg(CASE WHEN p_name IS NOT NULL THEN 1.0 ELSE 0.0 END) * 100')} AS match_pct
FROM dirty_reviews_v LEFT JOIN part ON product_id = p_partkey""",
        "dirty_reviews_v",
    ),
)
def dirty_match_rate(spark, sf_dir):
    products = read_table(spark, sf_dir, "part").select(F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"))
    return joins.match_rate(joins.merge_products(view(spark, sf_dir, "dirty_reviews_v"), products)).withColumn("match_pct", r9("match_pct"))
