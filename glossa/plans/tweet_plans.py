"""Registered queries: tweet authors, query tags, keyword and prefix filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from glossa.operators import filters, joins, social
from glossa.plans.registry import register
from glossa.sources.fixtures import read_table, view, with_views


@register(
    "tweet_authors",
    covers="E6 A13",
    oracle=with_views(
        """SELECT tweet_id, author_id, CASE WHEN c_custkey IS NULL THEN 'unknown' ELSE c_name END AS author_name,
       CASE WHEN c_custkey IS NULL THEN 'unknown' ELSE lower(c_name) END AS author_username
FROM tweets_v LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 3 <> 0) ON author_id = c_custkey""",
        "tweets_v",
    ),
)
def tweet_authors(spark, sf_dir):
    # Every third customer has no profile, so some authors are unknown.
    profiles = read_table(spark, sf_dir, "customer").where("c_custkey % 3 <> 0")
    profiles = profiles.select(F.col("c_custkey").alias("author_id"), F.col("c_name").alias("author_name"), F.lower("c_name").alias("author_username"))
    return joins.lookup_authors(view(spark, sf_dir, "tweets_v"), profiles).select("tweet_id", "author_id", "author_name", "author_username")


TAGGED = """SELECT tweet_id, CASE WHEN tweet_id % 4 = 0 THEN 'es' ELSE 'en' END AS lang,
       CASE WHEN tweet_id % 5 = 0 THEN NULL ELSE tweet_id % 3 = 0 END AS is_retweet FROM {tweets}"""


@register(
    "tagged_tweets",
    covers="B19",
    oracle=with_views(
        f"""SELECT tweet_id, '#sale' AS hashtag, 'twitter' AS platform FROM ({TAGGED.format(tweets='tweets_v')})
WHERE lang = 'en' AND NOT coalesce(is_retweet, false)""",
        "tweets_v",
    ),
)
def tagged_tweets(spark, sf_dir):
    tweets = spark.sql(TAGGED, tweets=view(spark, sf_dir, "tweets_v"))
    return social.tag_query(tweets, hashtag="#sale", platform="twitter").select("tweet_id", "hashtag", "platform")


@register(
    "keyword_and_prefix_filter",
    covers="D10 D11",
    oracle=with_views(
        """SELECT brand_name, product_name LIKE '%' || 'ro' || '%' OR lower(product_name) LIKE '%ro%' AS has_keyword,
       regexp_matches(brand_name, '^(?:Brand#[12])') AS has_prefix, count(*) AS n
FROM reviews_v GROUP BY ALL""",
        "reviews_v",
    ),
)
def keyword_and_prefix_filter(spark, sf_dir):
    r = view(spark, sf_dir, "reviews_v")
    keys = ["brand_name", filters.contains_ci("product_name", "RO").alias("has_keyword"), filters.matches_prefix("brand_name", "Brand#[12]").alias("has_prefix")]
    return r.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
