"""Registered queries: social rollups, KPIs, hashtags, pivot, hashtag impact, precedence."""

from __future__ import annotations

from pyspark.sql import functions as F

from glossa.functions.numeric import r9, round_half_even
from glossa.operators import filters, social
from glossa.plans.registry import r9 as q9
from glossa.plans.registry import register, rnd, savg, ssum
from glossa.sources.fixtures import read_table, view, with_views

PLATFORMS = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


def social_v(spark, sf_dir):
    return view(spark, sf_dir, "social_v")


def tweets_v(spark, sf_dir):
    return view(spark, sf_dir, "tweets_v")


@register(
    "daily_social",
    covers="F13",
    oracle=with_views(
        f"""SELECT date, platform, CAST(sum(mention_volume) AS BIGINT) AS mention_volume, {q9(ssum('engagement'))} AS engagement
FROM social_v WHERE date IS NOT NULL GROUP BY date, platform""",
        "social_v",
    ),
)
def daily_social(spark, sf_dir):
    d = social.daily_social(social_v(spark, sf_dir))
    return d.withColumn("mention_volume", F.col("mention_volume").cast("long")).withColumn("engagement", r9("engagement"))


@register(
    "daily_social_totals",
    covers="F16",
    oracle=with_views(
        f"""SELECT date, CAST(sum(mention_volume) AS BIGINT) AS mention_volume, {q9(ssum('engagement'))} AS engagement
FROM social_v WHERE date IS NOT NULL GROUP BY date""",
        "social_v",
    ),
)
def daily_social_totals(spark, sf_dir):
    d = social.daily_social(social_v(spark, sf_dir), keys=("date",))
    return d.withColumn("mention_volume", F.col("mention_volume").cast("long")).withColumn("engagement", r9("engagement"))


@register(
    "platform_metrics",
    covers="F14",
    oracle=with_views(
        """SELECT platform, round_even(sum(mention_volume), 0)::DOUBLE AS total_mentions,
       round_even(avg(mention_volume), 0)::DOUBLE AS avg_mentions,
       round_even(sum(engagement), 0)::DOUBLE AS total_engagement, round_even(avg(engagement), 0)::DOUBLE AS avg_engagement
FROM social_v GROUP BY platform""",
        "social_v",
    ),
)
def platform_metrics(spark, sf_dir):
    return social.platform_metrics(social_v(spark, sf_dir))


@register(
    "hashtag_totals",
    covers="F15 H4",
    oracle=with_views(
        """SELECT hashtag, round_even(sum(mention_volume), 0)::DOUBLE AS mention_volume,
       round_even(sum(engagement), 0)::DOUBLE AS engagement
FROM social_words_v WHERE hashtag IS NOT NULL GROUP BY hashtag
ORDER BY mention_volume DESC, hashtag LIMIT 10""",
        "social_words_v",
    ),
)
def hashtag_totals(spark, sf_dir):
    return social.hashtag_totals(view(spark, sf_dir, "social_words_v"), k=10)


@register(
    "hashtag_means",
    covers="F17 H1",
    oracle=with_views(
        f"""SELECT hashtag, {q9('avg(mention_volume)')} AS mention_volume, {q9('avg(engagement)')} AS engagement
FROM social_words_v WHERE hashtag IS NOT NULL GROUP BY hashtag ORDER BY avg(engagement) DESC, hashtag LIMIT 10""",
        "social_words_v",
    ),
)
def hashtag_means(spark, sf_dir):
    from glossa.functions.numeric import top_k

    m = top_k(social.hashtag_means(view(spark, sf_dir, "social_words_v")), 10, [F.col("engagement").desc(), F.col("hashtag").asc()])
    return m.select("hashtag", r9("mention_volume").alias("mention_volume"), r9("engagement").alias("engagement"))


@register(
    "social_kpis",
    covers="F18",
    oracle=with_views(
        f"""SELECT CAST(sum(mention_volume) AS BIGINT) AS total_mentions, {rnd('sum(engagement)', 2)} AS total_engagement,
       (SELECT {q9('avg(m)')} FROM (SELECT sum(mention_volume) AS m FROM social_v WHERE date IS NOT NULL GROUP BY date)) AS avg_daily_mentions,
       (SELECT platform FROM (SELECT platform, sum(mention_volume) AS m FROM social_v GROUP BY platform)
        ORDER BY m DESC, platform LIMIT 1) AS top_platform
FROM social_v""",
        "social_v",
    ),
)
def social_kpis(spark, sf_dir):
    k = social.social_kpis(social_v(spark, sf_dir))
    return k.select(
        F.col("total_mentions").cast("long").alias("total_mentions"),
        round_half_even("total_engagement", 2).alias("total_engagement"),
        r9("avg_daily_mentions").alias("avg_daily_mentions"),
        "top_platform",
    )


@register(
    "tweet_kpis",
    covers="F20",
    oracle=with_views(
        f"""SELECT count(*) AS n_tweets, {q9('sum(engagement)')} AS total_engagement, NULL::DOUBLE AS avg_sentiment,
       count(DISTINCT author_id) AS unique_authors, min(CAST(created_at AS DATE)) AS first_date,
       max(CAST(created_at AS DATE)) AS last_date
FROM tweets_v""",
        "tweets_v",
    ),
)
def tweet_kpis(spark, sf_dir):
    return social.tweet_kpis(tweets_v(spark, sf_dir)).withColumn("total_engagement", r9("total_engagement"))


@register(
    "tweets_by_day_label",
    covers="F21",
    oracle=with_views(
        "SELECT CAST(created_at AS DATE) AS date, sentiment_label, count(*) AS n FROM tweets_v GROUP BY ALL",
        "tweets_v",
    ),
)
def tweets_by_day_label(spark, sf_dir):
    return social.tweets_by_day_label(tweets_v(spark, sf_dir))


@register(
    "tweet_filter",
    covers="D5",
    oracle=with_views(
        """SELECT tweet_id, created_at, sentiment_label FROM tweets_v
WHERE CAST(created_at AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'
  AND sentiment_label IN ('positive', 'negative')""",
        "tweets_v",
    ),
)
def tweet_filter(spark, sf_dir):
    t = filters.tweet_filter(tweets_v(spark, sf_dir), date_range=("2024-01-05", "2024-01-20"), labels=["positive", "negative"])
    return t.select("tweet_id", "created_at", "sentiment_label")


@register(
    "hashtag_frequency",
    covers="F22",
    oracle=with_views(
        """WITH h AS (SELECT unnest(string_split(product_name, ' ')) AS hashtag FROM reviews_v)
SELECT hashtag, count(*) AS n FROM h GROUP BY hashtag ORDER BY n DESC, hashtag LIMIT 10""",
        "reviews_v",
    ),
)
def hashtag_frequency(spark, sf_dir):
    # Tag lists per review: the words of the product name (the text tables hold no real #tags).
    tagged = view(spark, sf_dir, "reviews_v").select(F.split("product_name", " ").alias("hashtags"))
    return social.hashtag_frequency(tagged, k=10)


@register(
    "hashtag_engagement_top",
    covers="F41",
    oracle=with_views(
        f"""SELECT hashtag, {q9(ssum('engagement'))} AS engagement,
       (SELECT count(DISTINCT hashtag) FROM social_words_v) AS n_hashtags
FROM social_words_v WHERE hashtag IS NOT NULL GROUP BY hashtag ORDER BY sum(engagement) DESC, hashtag LIMIT 10""",
        "social_words_v",
    ),
)
def hashtag_engagement_top(spark, sf_dir):
    t = social.hashtag_engagement_top(view(spark, sf_dir, "social_words_v"), k=10)
    return t.withColumn("engagement", r9("engagement"))


@register(
    "social_pivot",
    covers="F40",
    oracle=with_views(
        "WITH d AS (SELECT date, platform, sum(mention_volume) AS m, " + ssum("engagement") + " AS e FROM social_v "
        "WHERE date IS NOT NULL GROUP BY date, platform)\nSELECT date, "
        + ", ".join(
            f"CAST(coalesce(sum(m) FILTER (WHERE platform = '{p}'), 0) AS BIGINT) AS \"mention_volume_{p}\", "
            f"{q9(f'coalesce(sum(e) FILTER (WHERE platform = {chr(39)}{p}{chr(39)}), 0)')} AS \"engagement_{p}\""
            for p in PLATFORMS
        )
        + " FROM d GROUP BY date",
        "social_v",
    ),
)
def social_pivot(spark, sf_dir):
    p = social.social_pivot(social_v(spark, sf_dir), platforms=PLATFORMS)
    cols = [F.col("date")]
    for c in p.columns[1:]:
        cols.append((F.col(f"`{c}`").cast("long") if c.startswith("mention_volume_") else r9(F.col(f"`{c}`"))).alias(c))
    return p.select(*cols)


@register(
    "social_rollup_from_tweets",
    covers="F42 B18 B19",
    oracle=with_views(
        f"""SELECT CAST(created_at AS DATE) AS date, '#' || platform AS hashtag, 'twitter' AS platform,
       count(*) AS mention_volume, {q9('sum(CAST(like_count + retweet_count + reply_count AS DOUBLE))')} AS engagement
FROM tweet_payload_v GROUP BY 1, 2""",
        "tweet_payload_v",
    ),
)
def social_rollup_from_tweets(spark, sf_dir):
    t = social.plain_engagement(view(spark, sf_dir, "tweet_payload_v"))
    # Each query hashtag is tagged on its own rows (here: one query per event type).
    tagged = t.withColumns({"hashtag": F.concat(F.lit("#"), F.col("platform")), "platform": F.lit("twitter")})
    r = social.rollup_from_tweets(tagged)
    return r.withColumn("engagement", r9("engagement"))


@register(
    "daily_review_rollup",
    covers="F12 F43",
    oracle=with_views(
        f"""SELECT review_date AS date, {q9(savg('rating'))} AS avg_rating, {q9(savg('sentiment_score'))} AS avg_sentiment,
       count(product_id) AS review_count FROM reviews_v WHERE review_date IS NOT NULL GROUP BY review_date""",
        "reviews_v",
    ),
)
def daily_review_rollup(spark, sf_dir):
    d = social.daily_reviews(view(spark, sf_dir, "reviews_v"))
    return d.select("date", r9("avg_rating").alias("avg_rating"), r9("avg_sentiment").alias("avg_sentiment"), "review_count")


IMPACT_SQL = f"""WITH top AS (
  SELECT hashtag, lower(replace(hashtag, '#', '')) AS keyword FROM social_words_v WHERE hashtag IS NOT NULL
  GROUP BY hashtag ORDER BY avg(engagement) DESC, hashtag LIMIT 10),
r AS (SELECT lower(product_name) AS t, rating, sentiment_score FROM reviews_v),
m AS (SELECT top.hashtag, r.* FROM r JOIN top ON contains(r.t, top.keyword)),
tot AS (SELECT sum(rating) AS rs, count(rating) AS rc, sum(round_even(sentiment_score * 1000000.0, 0)) AS ss,
               count(sentiment_score) AS sc FROM r),
per AS (SELECT hashtag, count(*) AS n, sum(rating) AS rs, count(rating) AS rc,
               sum(round_even(sentiment_score * 1000000.0, 0)) AS ss, count(sentiment_score) AS sc FROM m GROUP BY hashtag)
SELECT hashtag, n AS reviews_with_keyword,
       {q9('per.rs / per.rc')} AS avg_rating_with_keyword,
       {q9('per.ss / per.sc / 1000000.0')} AS avg_sentiment_with_keyword,
       {q9('(tot.rs - per.rs) / (tot.rc - per.rc)')} AS avg_rating_without_keyword,
       {q9('(tot.ss - per.ss) / (tot.sc - per.sc) / 1000000.0')} AS avg_sentiment_without_keyword,
       {q9('per.rs / per.rc - (tot.rs - per.rs) / (tot.rc - per.rc)')} AS rating_difference,
       {q9('per.ss / per.sc / 1000000.0 - (tot.ss - per.ss) / (tot.sc - per.sc) / 1000000.0')} AS sentiment_difference
FROM per, tot"""


@register("hashtag_impact", covers="F39 E7 H1 B23", oracle=with_views(IMPACT_SQL, "social_words_v", "reviews_v"))
def hashtag_impact(spark, sf_dir):
    reviews = view(spark, sf_dir, "reviews_v").withColumn("cleaned_text", F.col("product_name"))
    out = social.hashtag_impact(reviews, view(spark, sf_dir, "social_words_v"), text_col="cleaned_text")
    return out.select("hashtag", "reviews_with_keyword", *[r9(c).alias(c) for c in out.columns[2:]])


PRECEDENCE_PRIMARY = """SELECT CAST(l_shipdate AS DATE) AS date, o_orderpriority AS platform, '#' || l_returnflag AS hashtag,
       1 AS mention_volume, l_extendedprice AS engagement
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey"""


@register(
    "source_precedence",
    covers="E8 H10 H11",
    oracle=with_views(
        f"""WITH p AS ({PRECEDENCE_PRIMARY.format(lineitem='lineitem', orders='orders')})
SELECT * FROM social_v s WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.date = s.date AND p.platform = s.platform)
UNION ALL SELECT * FROM p""",
        "social_v",
    ),
)
def source_precedence(spark, sf_dir):
    primary = spark.sql(
        PRECEDENCE_PRIMARY,
        lineitem=read_table(spark, sf_dir, "lineitem"),
        orders=read_table(spark, sf_dir, "orders"),
    )
    return social.prioritized_union(primary, social_v(spark, sf_dir), ["date", "platform"])


@register(
    "latest_snapshot",
    covers="A11",
    oracle=with_views(
        """SELECT tweet_id, created_at, platform FROM tweets_v
WHERE CAST(created_at AS DATE) = (SELECT max(CAST(created_at AS DATE)) FROM tweets_v)""",
        "tweets_v",
    ),
)
def latest_snapshot(spark, sf_dir):
    t = tweets_v(spark, sf_dir).withColumn("ingest_date", F.to_date("created_at"))
    return social.latest_snapshot(t).select("tweet_id", "created_at", "platform")


@register(
    "filter_social",
    covers="D4",
    oracle=with_views(
        """SELECT * FROM social_v WHERE date BETWEEN DATE '1996-01-01' AND DATE '1996-12-31'
AND hashtag IN ('#BUILDING', '#MACHINERY') AND platform IN ('1-URGENT', '2-HIGH')""",
        "social_v",
    ),
)
def filter_social(spark, sf_dir):
    return social.filter_social(
        social_v(spark, sf_dir),
        date_range=("1996-01-01", "1996-12-31"),
        hashtags=["#BUILDING", "#MACHINERY"],
        platforms=["1-URGENT", "2-HIGH"],
    )


@register(
    "tweet_label_distribution",
    covers="F44 C7",
    oracle=with_views(
        f"""SELECT sentiment_label, count(*) AS n, {q9('count(*) / (SELECT count(*) FROM tweets_v)')} AS share
FROM tweets_v WHERE sentiment_label IS NOT NULL GROUP BY sentiment_label""",
        "tweets_v",
    ),
)
def tweet_label_distribution(spark, sf_dir):
    from glossa.operators import marts

    # percentages over all tweets (unlabelled ones stay in the total)
    return marts.label_distribution(tweets_v(spark, sf_dir), dropna=False).withColumn("share", r9("share"))


@register(
    "featured_tweets",
    covers="H8 B21",
    oracle=with_views(
        """SELECT tweet_id, created_at, platform, engagement FROM tweets_v
ORDER BY engagement DESC, tweet_id LIMIT 5""",
        "tweets_v",
    ),
)
def featured_tweets(spark, sf_dir):
    return social.featured(tweets_v(spark, sf_dir), k=5).select("tweet_id", "created_at", "platform", "engagement")
