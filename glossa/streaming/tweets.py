"""Structured Streaming path for tweets.

S1: tweet payloads landed as JSON (or Parquet) files → flat tweet stream,
    duplicates by tweet id dropped within the watermark.
S2: tweets per (1-day window, sentiment label).
S3: negative-share alert per window, written by ``foreachBatch``.

State is bounded: dedup state lives for the watermark delay, and the window
counts hold one row per (day, label). Checkpoints go to the shared checkpoint
folder, so a restarted query resumes where it stopped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

from glossa.session import scratch_path

PAYLOAD_SCHEMA = StructType(
    [
        StructField("id", LongType()),
        StructField("text", StringType()),
        StructField("created_at", TimestampType()),  # event time: watermarks need TIMESTAMP
        StructField("author_id", StringType()),
        StructField("lang", StringType()),
        StructField(
            "public_metrics",
            StructType(
                [
                    StructField("like_count", LongType()),
                    StructField("retweet_count", LongType()),
                    StructField("reply_count", LongType()),
                    StructField("impression_count", LongType()),
                ]
            ),
        ),
    ]
)

NEGATIVE_SHARE_ALERT = 0.3  # fixed value: same threshold as the batch alert


def flatten_payload(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Payload struct → flat tweet columns (works on batch and stream), then the columns ``keep``."""
    m = "public_metrics"
    return raw.select(
        F.col("id").alias("tweet_id"),
        "text",
        "created_at",
        "author_id",
        "lang",
        F.coalesce(F.col(f"{m}.like_count"), F.lit(0)).alias("like_count"),
        F.coalesce(F.col(f"{m}.retweet_count"), F.lit(0)).alias("retweet_count"),
        F.coalesce(F.col(f"{m}.reply_count"), F.lit(0)).alias("reply_count"),
        F.coalesce(F.col(f"{m}.impression_count"), F.lit(0)).alias("impression_count"),
        *keep,
    )


def read_payload_stream(spark: SparkSession, path: str, *, max_files_per_trigger: int | None = None) -> DataFrame:
    """S1 source: JSON payload files of a landing folder as a stream."""
    r = spark.readStream.schema(PAYLOAD_SCHEMA)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return flatten_payload(r.json(path))


def dedup_tweets(stream: DataFrame, *, watermark: str = "1 day") -> DataFrame:
    """Drop repeated tweet ids seen within the watermark delay."""
    return stream.withWatermark("created_at", watermark).dropDuplicatesWithinWatermark(["tweet_id"])


def daily_label_counts(tweets: DataFrame, *, window: str = "1 day") -> DataFrame:
    """Tweets per (window, sentiment label), window flattened to start/end."""
    return (
        tweets.groupBy(F.window("created_at", window).alias("w"), "sentiment_label")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "sentiment_label", "n")
    )


def negative_share_alerts(counts: DataFrame, *, threshold: float = NEGATIVE_SHARE_ALERT) -> DataFrame:
    """S3: per window, share of negative tweets and whether it exceeds the threshold."""
    per = counts.groupBy("window_start", "window_end").agg(
        F.sum("n").alias("n_total"), F.sum(F.when(F.col("sentiment_label") == "negative", F.col("n")).otherwise(0)).alias("n_negative")
    )
    return per.withColumn("negative_share", F.col("n_negative") / F.col("n_total")).withColumn(
        "alert", F.col("negative_share") > threshold
    )


def run_to_table(
    stream: DataFrame, spark: SparkSession, name: str, *, output_mode: str = "complete", state_partitions: int | None = None
) -> DataFrame:
    """Run a streaming aggregate until all available input is processed
    (``availableNow``); every micro-batch overwrites a Parquet table in the shared
    checkpoint folder through ``foreachBatch``. Returns the table as a batch frame.

    ``state_partitions`` fixes the number of state-store partitions of a new query
    (Spark takes it from ``spark.sql.shuffle.partitions`` when the query first
    starts and keeps it in the checkpoint); bounded state such as (day, label)
    counts needs no more than one per core."""
    out_path = scratch_path(spark, f"{name}-out")
    ckpt = scratch_path(spark, f"{name}-ckpt")

    def write(batch: DataFrame, epoch_id: int) -> None:
        batch.write.mode("overwrite").parquet(out_path)

    writer = (
        stream.writeStream.outputMode(output_mode)
        .foreachBatch(write)
        .option("checkpointLocation", ckpt)
        .trigger(availableNow=True)
    )
    if state_partitions:
        key = "spark.sql.shuffle.partitions"
        previous = spark.conf.get(key)
        spark.conf.set(key, str(state_partitions))
        try:
            q = writer.start()  # the query copies the session conf when it starts
        finally:
            spark.conf.set(key, previous)
    else:
        q = writer.start()
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return spark.read.parquet(out_path)


def alert_sink(alert_path: str):
    """S3 sink: the windows whose negative share crossed the threshold, one folder for each epoch.

    A replayed epoch replaces its own folder, so no alert is stored twice; the reader sees
    ``epoch_id`` as a partition column.
    """

    def write(batch: DataFrame, epoch_id: int) -> None:
        alerts = negative_share_alerts(batch).filter("alert")
        alerts.write.mode("overwrite").parquet(f"{alert_path}/epoch_id={epoch_id}")

    return write
