"""Registered queries that land data and read it back: closed stream windows, rows set aside, dated snapshots."""

from __future__ import annotations

from pyspark.sql import functions as F

from glossa.plans.registry import register
from glossa.plans.stream_plans import wall_clock
from glossa.session import scratch_path
from glossa.sources import responses, snapshots
from glossa.sources.fixtures import TWEETS_V, read_table, view, with_views
from glossa.streaming import closing

# When the tweets arrived: within the hour, but every 37th three days later and every 101st before it was written.
LANDED = """
SELECT t.*, created_at + CASE WHEN tweet_id % 101 = 0 THEN INTERVAL '-1' HOUR WHEN tweet_id % 37 = 0 THEN INTERVAL '3' DAY
  WHEN tweet_id % 2 = 0 THEN INTERVAL '40' MINUTE ELSE INTERVAL '2' MINUTE END AS arrived_at FROM {tweets} t
"""
LANDED_CTE = f"landed AS ({LANDED.format(tweets='tweets_v')})"
IN_TIME = "created_at <= arrived_at AND created_at >= arrived_at - INTERVAL 1 DAY"


def landed_stream(spark, sf_dir, slices: int = 3):
    """All tweets, landed as files in order of arrival (each written twice in its slice), as a stream of one file a batch."""
    tweets = spark.sql(TWEETS_V, events=read_table(spark, sf_dir, "events"))
    utc = lambda c: F.concat(F.col(c).cast("string"), F.lit("+00:00")).cast("timestamp")
    rows = spark.sql(LANDED, tweets=tweets).select("tweet_id", "sentiment_label", utc("created_at").alias("created_at"), utc("arrived_at").alias("arrived_at"))
    first, last = rows.agg(F.min("arrived_at").cast("double"), F.max("arrived_at").cast("double")).first()
    at = F.least(F.floor((F.col("arrived_at").cast("double") - F.lit(first or 0.0)) / F.lit(((last or 0.0) - (first or 0.0)) / slices or 1.0)), F.lit(slices - 1))
    path = scratch_path(spark, "landing")
    for k in range(slices):
        part = rows.where(at == k)
        part.union(part).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(path)


@register(
    "closed_tweet_windows",
    covers="S1 S2",
    oracle=with_views(
        f"""WITH {LANDED_CTE}, seen AS (SELECT * FROM landed WHERE {IN_TIME})
SELECT date_trunc('day', created_at) AS window_start, date_trunc('day', created_at) + INTERVAL 1 DAY AS window_end, sentiment_label, count(*) AS n
FROM seen WHERE date_trunc('day', created_at) + INTERVAL 1 DAY <= (SELECT max(created_at) FROM seen) - INTERVAL 1 DAY GROUP BY ALL""",
        "tweets_v",
    ),
)
def closed_tweet_windows(spark, sf_dir):
    counts = closing.closed_label_counts(landed_stream(spark, sf_dir), delay="1 day")
    table, _ = closing.append_to_table(counts, spark, "closed-windows", state_partitions=spark.sparkContext.defaultParallelism)
    return table.select(wall_clock("window_start"), wall_clock("window_end"), "sentiment_label", "n")


@register(
    "tweets_set_aside",
    covers="S1",
    oracle=with_views(
        f"""WITH {LANDED_CTE}
SELECT tweet_id, created_at, arrived_at, CASE WHEN created_at > arrived_at THEN '{closing.AHEAD}' ELSE '{closing.LATE}' END AS reason, 2::BIGINT AS n
FROM landed WHERE NOT ({IN_TIME})""",
        "tweets_v",
    ),
)
def tweets_set_aside(spark, sf_dir):
    aside = closing.set_aside(landed_stream(spark, sf_dir), delay="1 day").select("tweet_id", "created_at", "arrived_at", "reason")
    table, _ = closing.append_to_table(aside, spark, "set-aside")
    return table.groupBy("tweet_id", wall_clock("created_at"), wall_clock("arrived_at"), "reason").agg(F.count(F.lit(1)).alias("n"))


def snapshot_table(spark, sf_dir) -> str:
    """Tweets by their day, then the newest day and one before it written again with twice the engagement."""
    path = scratch_path(spark, "tweet-snapshots")
    tweets = view(spark, sf_dir, "tweets_v").withColumn("ingest_date", F.to_date("created_at"))
    snapshots.write_days(tweets, path)
    held = snapshots.days(spark, path)
    again = tweets.where(F.col("ingest_date").isin(held[-1], held[len(held) // 2])).withColumn("engagement", F.col("engagement") * 2)
    snapshots.write_days(again, path)
    return path


@register(
    "newest_snapshot",
    covers="A11 A12",
    oracle=with_views(
        """SELECT tweet_id, created_at, platform, engagement * 2 AS engagement, created_at::DATE AS ingest_date FROM tweets_v
WHERE created_at::DATE = (SELECT max(created_at)::DATE FROM tweets_v)""",
        "tweets_v",
    ),
)
def newest_snapshot(spark, sf_dir):
    return snapshots.newest(spark, snapshot_table(spark, sf_dir)).select("tweet_id", "created_at", "platform", "engagement", "ingest_date")


@register(
    "snapshot_days",
    covers="A12 A10",
    oracle=with_views(
        """WITH d AS (SELECT DISTINCT created_at::DATE AS day FROM tweets_v),
k AS (SELECT day, row_number() OVER (ORDER BY day) - 1 AS k, count(*) OVER () AS n FROM d)
SELECT day AS ingest_date, count(*) AS n,
  CAST(sum(CAST(engagement * CASE WHEN k = n - 1 OR k = n // 2 THEN 2 ELSE 1 END AS DECIMAL(38,12))) AS DOUBLE) AS engagement
FROM tweets_v JOIN k ON created_at::DATE = day GROUP BY day""",
        "tweets_v",
    ),
)
def snapshot_days(spark, sf_dir):
    table = spark.read.parquet(snapshot_table(spark, sf_dir))
    return table.groupBy("ingest_date").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("engagement").cast("decimal(38,12)")).cast("double").alias("engagement"))


# Every event is a tweet; those of one type among 50 ids are one response. Every third author's profile is not delivered.
RESPONSE_TWEETS = """
SELECT event_id AS id, concat('a ', event_type, ' for @user', CAST(user_id AS STRING), ' #', event_type, ' #day', CAST(CAST(event_id % 7 AS INT) AS STRING)) AS text,
  ts AS created_at, user_id, concat('#', event_type) AS query,
  event_id % 50 AS like_count, event_id % 8 AS retweet_count, event_id % 5 AS reply_count FROM {events}
"""


def landed_responses(spark, sf_dir) -> str:
    """All events as search responses, with the profiles of their authors from the customers, written as JSON."""
    tweets = spark.sql(RESPONSE_TWEETS, events=read_table(spark, sf_dir, "events"))
    people = read_table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), "c_name")
    known = F.when(F.col("c_name").isNotNull() & (F.col("user_id") % 3 != 0), F.col("user_id").cast("string"))
    user = F.when(known.isNotNull(), F.struct(known.alias("id"), F.lower("c_name").alias("username"), F.col("c_name").alias("name"), F.struct((F.col("user_id") % 1000).alias("followers_count")).alias("public_metrics")))
    metrics = F.struct("like_count", "retweet_count", "reply_count").alias("public_metrics")
    tweet = F.struct("id", "text", F.date_format("created_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("created_at"), F.col("user_id").cast("string").alias("author_id"), metrics)
    page = F.floor(F.col("id") / 50).alias("page"), "query"  # at most 50 tweets
    pages = tweets.join(people, "user_id", "left").groupBy(*page).agg(F.collect_list(tweet).alias("data"), F.struct(F.collect_set(user).alias("users")).alias("includes"))
    path = scratch_path(spark, "responses")
    pages.drop("page").write.json(path)
    return path


@register(
    "response_tweets",
    covers="A13 B15 B16 B17",
    oracle=f"""SELECT id AS tweet_id, CAST(user_id AS VARCHAR) AS author_id, CASE WHEN user_id % 3 <> 0 AND c_name IS NOT NULL THEN c_name ELSE 'unknown' END AS author_name,
  CASE WHEN user_id % 3 <> 0 AND c_name IS NOT NULL THEN lower(c_name) ELSE 'unknown' END AS author_username,
  CASE WHEN user_id % 3 <> 0 AND c_name IS NOT NULL THEN user_id % 1000 END AS author_followers, strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created,
  like_count, 0::BIGINT AS impression_count, concat(query[2:], ',day', id % 7) AS hashtags, concat('user', user_id) AS mentions, query, 'twitter' AS platform,
  CAST(like_count + 2 * retweet_count + 1.5 * reply_count AS DOUBLE) AS weighted_engagement
FROM ({RESPONSE_TWEETS.format(events='events')}) LEFT JOIN customer ON user_id = c_custkey""",
)
def response_tweets(spark, sf_dir):
    rows = responses.read_responses(spark, landed_responses(spark, sf_dir))
    lists = {c: F.array_join(c, ",") for c in ("hashtags", "mentions")}
    rows = rows.withColumns({**lists, "created": F.date_format("created_at", "yyyy-MM-dd HH:mm:ss"), "weighted_engagement": F.col("weighted_engagement").cast("double")})
    return rows.drop("text", "created_at", "lang", "retweet_count", "reply_count")
