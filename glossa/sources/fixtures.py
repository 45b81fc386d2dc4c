"""Fixture views over the driver's test tables.

The test tables (TPC-H-like star schema, events, documents, ...) carry no review
ratings and no social rows. The views below derive review-, social- and
tweet-shaped tables from them deterministically. Each view is one SQL template
with ``{table}`` placeholders; the *same text* runs on Spark (placeholders bound
to DataFrames through ``spark.sql(..., **frames)``) and inside the DuckDB
oracle (placeholders bound to the pre-registered view names, used as CTEs).
"""

from __future__ import annotations

import os
import re
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# reviews_v: one review per line item; user = ordering customer, product = part.
REVIEWS_V = """
SELECT l.l_orderkey AS order_id, l.l_linenumber AS line_no,
       o.o_custkey AS user_id, l.l_partkey AS product_id,
       p.p_brand AS brand_name, p.p_name AS product_name, p.p_type AS primary_category,
       CAST(1 + FLOOR((l.l_quantity - 1) / 10) AS DOUBLE) AS rating,
       l.l_discount * 20 - 1 AS sentiment_score,
       CASE WHEN l.l_discount * 20 - 1 > 0.1 THEN 'positive'
            WHEN l.l_discount * 20 - 1 < -0.1 THEN 'negative' ELSE 'neutral' END AS sentiment_label,
       CAST(l.l_shipdate AS DATE) AS review_date
FROM {lineitem} l JOIN {orders} o ON l.l_orderkey = o.o_orderkey
                  JOIN {part} p ON l.l_partkey = p.p_partkey
"""

# social_v: one mention per order; platform = order priority, hashtag = market segment.
SOCIAL_V = """
SELECT CAST(o_orderdate AS DATE) AS date, o_orderpriority AS platform,
       '#' || c_mktsegment AS hashtag, 1 AS mention_volume, o_totalprice AS engagement
FROM {orders} JOIN {customer} ON o_custkey = c_custkey
"""

# tweets_v: one tweet per event.
TWEETS_V = """
SELECT event_id AS tweet_id, ts AS created_at, user_id AS author_id, event_type AS platform,
       value AS engagement,
       CASE WHEN event_type IN ('purchase','signup') THEN 'positive'
            WHEN event_type = 'error' THEN 'negative' ELSE 'neutral' END AS sentiment_label
FROM {events}
"""

# social_words_v: mentions whose hashtag is the first word of a product name, so that
# hashtag keywords actually occur in review text (product names) — feeds hashtag impact.
SOCIAL_WORDS_V = """
SELECT CAST(o.o_orderdate AS DATE) AS date, o.o_orderpriority AS platform,
       '#' || split_part(p.p_name, ' ', 1) AS hashtag, 1 AS mention_volume,
       l.l_extendedprice AS engagement
FROM {lineitem} l JOIN {orders} o ON l.l_orderkey = o.o_orderkey
                  JOIN {part} p ON l.l_partkey = p.p_partkey
"""

# tweet_payload_v: API-shaped tweet rows (public metrics) derived from events.
TWEET_PAYLOAD_V = """
SELECT event_id AS tweet_id, ts AS created_at, CAST(user_id AS STRING) AS author_id,
       event_type AS platform,
       CAST(get_json_object(props, '$.k') AS BIGINT) AS like_count,
       CAST(FLOOR(value) AS BIGINT) AS retweet_count,
       CAST(length(event_type) AS BIGINT) AS reply_count
FROM {events}
"""

# raw_reviews_v: review-file-shaped rows (string rating with junk, string date) from conversations.
RAW_REVIEWS_V = """
SELECT conv_id, turn, text AS review_text,
       CASE WHEN role = 'user' THEN CAST(CAST(turn AS DOUBLE) / 2 AS STRING) ELSE role END AS rating,
       CAST(DATE '2024-01-01' + CAST(turn AS INTEGER) AS STRING) AS submission_time
FROM {conversations}
"""

# dirty_reviews_v: reviews with null keys, out-of-range values, unknown labels and unmatched products.
DIRTY_REVIEWS_V = """
SELECT l.l_orderkey AS order_id, l.l_linenumber AS line_no, o.o_custkey AS user_id,
       CASE WHEN l.l_orderkey % 11 = 0 THEN NULL WHEN l.l_orderkey % 7 = 0 THEN -l.l_partkey ELSE l.l_partkey END AS product_id,
       CASE WHEN l.l_orderkey % 13 = 0 THEN NULL ELSE CAST(1 + FLOOR((l.l_quantity - 1) / 7) AS DOUBLE) END AS rating,
       CASE WHEN l.l_orderkey % 17 = 0 THEN NULL ELSE l.l_discount * 24 - 1.2 END AS sentiment_score,
       CASE WHEN l.l_orderkey % 5 = 0 THEN NULL WHEN l.l_linenumber = 7 THEN 'mixed'
            WHEN l.l_discount * 20 - 1 < -0.1 THEN 'negative' ELSE 'positive' END AS sentiment_label,
       CASE WHEN l.l_orderkey % 19 = 0 THEN NULL ELSE CAST(l.l_shipdate AS DATE) END AS review_date
FROM {lineitem} l JOIN {orders} o ON l.l_orderkey = o.o_orderkey
"""

# dirty_social_v: mentions whose date, platform or hashtag is missing now and then.
DIRTY_SOCIAL_V = """
SELECT CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS date,
       CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderpriority END AS platform,
       CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE '#' || c_mktsegment END AS hashtag,
       1 AS mention_volume, o_totalprice AS engagement
FROM {orders} JOIN {customer} ON o_custkey = c_custkey
"""

VIEWS = {
    "dirty_reviews_v": DIRTY_REVIEWS_V,
    "dirty_social_v": DIRTY_SOCIAL_V,
    "reviews_v": REVIEWS_V,
    "social_v": SOCIAL_V,
    "tweets_v": TWEETS_V,
    "social_words_v": SOCIAL_WORDS_V,
    "tweet_payload_v": TWEET_PAYLOAD_V,
    "raw_reviews_v": RAW_REVIEWS_V,
}

_PLACEHOLDER = re.compile(r"\{(\w+)\}")


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan of a test table."""
    return spark.read.parquet(table_path(sf_dir, name))


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A fixture view as a lazy DataFrame over the parquet tables of ``sf_dir``."""
    sql = VIEWS[name]
    frames = {t: read_table(spark, sf_dir, t) for t in set(_PLACEHOLDER.findall(sql))}
    return spark.sql(sql, **frames)


@lru_cache(maxsize=None)
def duckdb_cte(name: str) -> str:
    """The view as DuckDB SQL (placeholders bound to the driver's view names).

    DuckDB spells Spark's ``get_json_object`` as ``json_extract_string``.
    """
    sql = VIEWS[name].format(**{t: t for t in TABLES})
    return sql.replace("get_json_object(", "json_extract_string(")


def with_views(sql: str, *names: str) -> str:
    """Prefix an oracle query with the fixture views it uses as CTEs."""
    if not names:
        return sql
    ctes = ",\n".join(f"{n} AS ({duckdb_cte(n)})" for n in names)
    body = sql.lstrip()
    if body[:5].upper() == "WITH ":
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
