"""Registered query: the tweet stream's daily label counts (S1 + S2).

The events table is read as a *file stream* (the same Parquet file the batch
queries read), mapped to tweets, deduplicated within the watermark and counted
per (day, label); the stream runs to completion (``availableNow``) and the
result table is returned."""

from __future__ import annotations

from pyspark.sql import functions as F

from glossa.plans.registry import register
from glossa.sources.fixtures import TWEETS_V, table_path
from glossa.streaming import tweets as S


def tweet_stream(spark, sf_dir):
    events_schema = spark.read.parquet(table_path(sf_dir, "events")).schema
    events = spark.readStream.schema(events_schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    # Event-time watermarks need TIMESTAMP (LTZ); the table stores TIMESTAMP_NTZ. The wall clock is read as
    # UTC, on whose days windows are aligned, whatever the session's zone.
    utc = F.concat(F.col("created_at").cast("string"), F.lit("+00:00")).cast("timestamp")
    return spark.sql(TWEETS_V, events=events).withColumn("created_at", utc)


def wall_clock(instant: str):
    """The UTC wall clock of an instant, as stored in the tables."""
    return F.expr(f"convert_timezone('UTC', CAST({instant} AS TIMESTAMP_NTZ))").alias(instant)


@register(
    "tweet_stream_daily",
    covers="S1 S2",
    oracle="""SELECT date_trunc('day', ts) AS window_start, date_trunc('day', ts) + INTERVAL 1 DAY AS window_end,
       CASE WHEN event_type IN ('purchase','signup') THEN 'positive'
            WHEN event_type = 'error' THEN 'negative' ELSE 'neutral' END AS sentiment_label,
       count(*) AS n
FROM (SELECT DISTINCT ON (event_id) * FROM events) e GROUP BY ALL""",
)
def tweet_stream_daily(spark, sf_dir):
    tweets = S.dedup_tweets(tweet_stream(spark, sf_dir), watermark="1 day")
    counts = S.daily_label_counts(tweets)
    cores = spark.sparkContext.defaultParallelism
    return S.run_to_table(counts, spark, "tweet_stream_daily", state_partitions=cores).select(
        wall_clock("window_start"), wall_clock("window_end"), "sentiment_label", "n"
    )


def _counts_sql() -> str:
    return """SELECT date_trunc('day', ts) AS window_start, date_trunc('day', ts) + INTERVAL 1 DAY AS window_end, count(*) AS n_total,
       count(*) FILTER (WHERE event_type = 'error') AS n_negative
FROM (SELECT DISTINCT ON (event_id) * FROM events) e GROUP BY ALL"""


@register(
    "negative_share_alerts",
    covers="S3",
    oracle=f"""SELECT *, n_negative / n_total AS negative_share, n_negative / n_total > 0.15 AS alert FROM ({_counts_sql()})""",
)
def negative_share_alerts(spark, sf_dir):
    counts = tweet_stream_daily(spark, sf_dir)
    # A threshold near the usual share of the table's error events, so that both answers occur.
    alerts = S.negative_share_alerts(counts, threshold=0.15)
    return alerts.withColumns({c: F.col(c).cast("long") for c in ("n_total", "n_negative")})
