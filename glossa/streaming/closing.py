"""Closed tweet windows in append mode, with every row that they miss kept aside.

Rows carry when they were written (``created_at``) and when they arrived (``arrived_at``, the landing's stamp or a file's
modification time). A row that arrives more than ``delay`` after it was written is late; one written after it
arrived has a wrong clock; both, and rows without a time, go to a table of their own with the reason. All others are no
older than the watermark, ``delay`` behind the newest row seen, as long as batches follow the order of arrival (as files
do): so the windows' own watermark drops none of them, and each row is in a window or set aside.

Windows are written once, when the watermark passes their end, and their state goes with them: the
state holds the labels of windows open at a time, and tweet ids for ``delay``, however long the stream runs. Both outputs
are file sinks with their own checkpoint, so a restarted query neither repeats nor loses a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from glossa.session import scratch_path
from glossa.streaming.tweets import daily_label_counts, dedup_tweets

LATE, AHEAD, UNDATED = "late", "ahead of its arrival", "no time"


def aside_reason(delay: str, created: str = "created_at", arrived: str = "arrived_at") -> Column:
    """Why a row is set aside; null for a row in time."""
    created_at, arrived_at = F.col(created), F.col(arrived)
    return (
        F.when(created_at.isNull() | arrived_at.isNull(), UNDATED)
        .when(created_at > arrived_at, AHEAD)
        .when(created_at < arrived_at - F.expr(f"INTERVAL {delay}"), LATE)
    )


def set_aside(tweets: DataFrame, *, delay: str = "1 day") -> DataFrame:
    """The rows that no window counts, with their ``reason`` (batch or stream)."""
    return tweets.withColumn("reason", aside_reason(delay)).where("reason IS NOT NULL")


def closed_label_counts(tweets: DataFrame, *, delay: str = "1 day", window: str = "1 day") -> DataFrame:
    """S2 in append mode: tweets per (window, label) of the rows in time, repeated tweet ids once."""
    in_time = tweets.where(aside_reason(delay).isNull())
    return daily_label_counts(dedup_tweets(in_time, watermark=delay), window=window)


def append_to_table(
    stream: DataFrame, spark: SparkSession, name: str, *, path: str | None = None, state_partitions: int | None = None
) -> tuple[DataFrame, list[dict]]:
    """Run an append-mode stream over all input there is into a Parquet file sink; the table, and the batches' progress.

    With a given ``path`` (and the checkpoint beside it) a later call goes on where the last one ended.
    """
    path = path or scratch_path(spark, name)
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    try:
        if state_partitions:  # a new query keeps the number of its start in the checkpoint
            spark.conf.set(key, str(state_partitions))
        query = (
            stream.writeStream.outputMode("append").format("parquet").option("path", path)
            .option("checkpointLocation", f"{path}-checkpoint").trigger(availableNow=True).start()
        )
    finally:
        spark.conf.set(key, before)
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return spark.read.schema(stream.schema).parquet(path), list(query.recentProgress)
