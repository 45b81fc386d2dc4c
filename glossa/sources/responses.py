"""Search responses landed as JSON (A13): pages of tweets with their authors' profiles → flat tweet rows.

One response holds ``data`` (a page of tweets), ``includes.users`` (each author of the page once) and the
``query`` it answers. Authors are looked up within their own response, row by row: a page is bounded by the
API, and nothing is shuffled. Works alike on batch and stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from glossa.functions.text import hashtags, mentions
from glossa.operators.social import weighted_engagement
from glossa.streaming.tweets import PAYLOAD_SCHEMA, flatten_payload

UNKNOWN = "unknown"

USER_METRICS = StructType([StructField(c, LongType()) for c in ("followers_count", "following_count", "tweet_count")])
USER_SCHEMA = StructType([StructField(c, StringType()) for c in ("id", "username", "name")] + [StructField("public_metrics", USER_METRICS)])
RESPONSE_SCHEMA = StructType(
    [
        StructField("query", StringType()),
        StructField("data", ArrayType(PAYLOAD_SCHEMA)),
        StructField("includes", StructType([StructField("users", ArrayType(USER_SCHEMA))])),
    ]
)


def flatten_responses(responses: DataFrame, *, platform: str = "twitter") -> DataFrame:
    """One row per tweet, with its author, tags, query, platform and weighted engagement.

    An author without a profile in the response, or whose profile lacks a name, is ``unknown`` there (followers:
    null). Of several profiles of one id the first counts. A response without tweets, or a null in
    place of a tweet, gives no row; missing counts are 0.
    """
    tweets = responses.select("query", F.col("includes.users").alias("users"), F.explode("data").alias("t")).where("t IS NOT NULL")
    of_author = F.filter("users", lambda u: u["id"] == F.col("t.author_id"))
    tweets = tweets.select("query", F.get(of_author, F.lit(0)).alias("author"), "t.*")
    extra = tweets.withColumns(
        {
            "author_username": F.coalesce("author.username", F.lit(UNKNOWN)),
            "author_name": F.coalesce("author.name", F.lit(UNKNOWN)),
            "author_followers": F.col("author.public_metrics.followers_count"),
            "hashtags": hashtags("text"),
            "mentions": mentions("text"),
            "platform": F.lit(platform),
        }
    )
    added = ["author_username", "author_name", "author_followers", "hashtags", "mentions", "query", "platform"]
    return weighted_engagement(flatten_payload(extra, keep=added))


def read_responses(spark: SparkSession, folder: str, *, platform: str = "twitter") -> DataFrame:
    """The flat tweets of all responses landed in ``folder``; a file that is no JSON response gives no row."""
    return flatten_responses(spark.read.schema(RESPONSE_SCHEMA).json(folder), platform=platform)


def read_response_stream(spark: SparkSession, folder: str, *, platform: str = "twitter", max_files_per_trigger: int | None = None) -> DataFrame:
    """The same as a stream of the files that land in ``folder``."""
    reader = spark.readStream.schema(RESPONSE_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return flatten_responses(reader.json(folder), platform=platform)
