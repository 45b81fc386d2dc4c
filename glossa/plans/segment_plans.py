"""Registered queries: RFM scores and segments, alerts, insights."""

from __future__ import annotations


from glossa.functions.numeric import r9
from glossa.operators import segments, social, stats
from glossa.plans.registry import r3 as q3
from glossa.plans.registry import r9 as q9
from glossa.plans.registry import register, savg
from glossa.sources.fixtures import view, with_views

RFM_SQL = f"""WITH base AS (
  SELECT user_id, CAST(date_diff('day', max(review_date), (SELECT max(review_date) FROM reviews_v)) AS INTEGER) AS recency,
         count(user_id) AS frequency, avg(rating) AS monetary, {savg('sentiment_score')} AS avg_sentiment
  FROM reviews_v WHERE user_id IS NOT NULL GROUP BY user_id),
e AS (SELECT quantile_cont(CAST(recency AS DOUBLE), [0.25, 0.5, 0.75]) AS er,
             quantile_cont(CAST(frequency AS DOUBLE), [0.25, 0.5, 0.75]) AS ef,
             quantile_cont(monetary, [0.25, 0.5, 0.75]) AS em FROM base),
s AS (SELECT base.*,
             5 - (1 + CAST(recency > er[1] AS INTEGER) + CAST(recency > er[2] AS INTEGER) + CAST(recency > er[3] AS INTEGER)) AS r_quartile,
             1 + CAST(frequency > ef[1] AS INTEGER) + CAST(frequency > ef[2] AS INTEGER) + CAST(frequency > ef[3] AS INTEGER) AS f_quartile,
             1 + CAST(monetary > em[1] AS INTEGER) + CAST(monetary > em[2] AS INTEGER) + CAST(monetary > em[3] AS INTEGER) AS m_quartile
      FROM base, e),
sc AS (SELECT *, CAST(r_quartile AS VARCHAR) || CAST(f_quartile AS VARCHAR) || CAST(m_quartile AS VARCHAR) AS rfm_score FROM s)"""


def _segment_case(col: str, first: bool = False) -> str:
    rules = segments.SEGMENT_RULES if first else tuple(reversed(segments.SEGMENT_RULES))
    parts = " ".join(f"WHEN regexp_matches({col}, '^(?:{p})') THEN '{name}'" for p, name in rules)
    return f"CASE {parts} ELSE {col} END"


@register(
    "rfm_scores",
    covers="F33 F34 F35 G9",
    oracle=with_views(
        f"""{RFM_SQL}
SELECT user_id, recency, frequency, {q9('monetary')} AS monetary, {q9('avg_sentiment')} AS avg_sentiment,
       r_quartile, f_quartile, m_quartile, rfm_score FROM sc""",
        "reviews_v",
    ),
)
def rfm_scores(spark, sf_dir):
    s = segments.rfm_scores(view(spark, sf_dir, "reviews_v"))
    return s.select(
        "user_id", "recency", "frequency", r9("monetary").alias("monetary"), r9("avg_sentiment").alias("avg_sentiment"),
        "r_quartile", "f_quartile", "m_quartile", "rfm_score",
    )


@register(
    "rfm_segments",
    covers="F36 F37",
    oracle=with_views(
        f"""{RFM_SQL}
SELECT {_segment_case('rfm_score')} AS segment, count(*) AS n_users, {q3('avg(recency)')} AS recency,
       {q3('avg(frequency)')} AS frequency, {q3('avg(monetary)')} AS monetary, {q3('avg(avg_sentiment)')} AS avg_sentiment
FROM sc GROUP BY 1""",
        "reviews_v",
    ),
)
def rfm_segments(spark, sf_dir):
    seg = segments.rfm_segments(segments.rfm_scores(view(spark, sf_dir, "reviews_v")))
    return segments.segment_summary(seg)


@register(
    "rfm_segments_first_match",
    covers="F36",
    oracle=with_views(
        f"""{RFM_SQL}
SELECT {_segment_case('rfm_score', first=True)} AS segment, count(*) AS n_users, {q3('avg(recency)')} AS recency,
       {q3('avg(frequency)')} AS frequency, {q3('avg(monetary)')} AS monetary, {q3('avg(avg_sentiment)')} AS avg_sentiment
FROM sc GROUP BY 1""",
        "reviews_v",
    ),
)
def rfm_segments_first_match(spark, sf_dir):
    seg = segments.rfm_segments(segments.rfm_scores(view(spark, sf_dir, "reviews_v")), precedence="first")
    return segments.segment_summary(seg)


def _alerts_sql() -> str:
    from glossa.plans.stats_plans import CORR_SQL

    return f"""WITH c AS ({CORR_SQL}),
k AS (SELECT avg(CASE WHEN sentiment_label = 'negative' THEN 1.0 ELSE 0.0 END) AS neg,
             avg(CASE WHEN rating <= 2.0 THEN 1.0 ELSE 0.0 END) AS low FROM reviews_v),
m AS (SELECT avg(abs(spearman_r)) AS cv FROM c WHERE pair = 'review_count_vs_mention_volume')
SELECT 'CRITICO' AS severity, 'negative_share' AS metric, {q9('neg')} AS value, 0.3::DOUBLE AS threshold,
       coalesce(neg > 0.3, false) AS fired FROM k
UNION ALL SELECT 'ALTA', 'low_rating_share', {q9('low')}, 0.1::DOUBLE, coalesce(low > 0.1, false) FROM k
UNION ALL SELECT 'MEDIA', 'social_correlation', {q9('cv')}, 0.3::DOUBLE, coalesce(cv < 0.3, false) FROM m"""


@register("alerts", covers="F38", oracle=with_views(_alerts_sql(), "reviews_v", "social_v"))
def alerts(spark, sf_dir):
    reviews = view(spark, sf_dir, "reviews_v")
    corr = stats.platform_correlations(social.daily_reviews(reviews), social.daily_social(view(spark, sf_dir, "social_v")))
    a = segments.alerts(reviews, corr)
    return a.withColumn("value", r9("value"))


@register(
    "insights",
    covers="J14",
    oracle=with_views(
        f"""WITH k AS (SELECT CASE WHEN stddev_pop(sentiment_score) > 0 AND stddev_pop(rating) > 0
                           THEN covar_pop(sentiment_score, rating) / (stddev_pop(sentiment_score) * stddev_pop(rating)) END AS c,
                      avg(CASE WHEN sentiment_label = 'negative' THEN 1.0 ELSE 0.0 END) AS neg,
                      avg(CASE WHEN sentiment_label = 'positive' THEN 1.0 ELSE 0.0 END) AS pos,
                      avg(rating) AS mr FROM reviews_v)
SELECT 'weak_sentiment_rating_corr' AS insight, '{segments.INSIGHT_TEXTS['weak_sentiment_rating_corr']}' AS text, {q9('c')} AS value, coalesce(c < 0.5, false) AS fired FROM k
UNION ALL SELECT 'many_negative', '{segments.INSIGHT_TEXTS['many_negative']}', {q9('neg')}, coalesce(neg > 0.3, false) FROM k
UNION ALL SELECT 'mostly_positive', '{segments.INSIGHT_TEXTS['mostly_positive']}', {q9('pos')}, coalesce(NOT (neg > 0.3) AND pos > 0.7, false) FROM k
UNION ALL SELECT 'high_rating', '{segments.INSIGHT_TEXTS['high_rating']}', {q9('mr')}, coalesce(mr >= 4.0, false) FROM k""",
        "reviews_v",
    ),
)
def insights(spark, sf_dir):
    i = segments.insights(view(spark, sf_dir, "reviews_v"))
    return i.withColumn("value", r9("value"))
