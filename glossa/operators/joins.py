"""Joins with the product dimension and lookups.

The product dimension grows with the catalogue (20 billion parts at TPC-H
scale 100,000), so no broadcast is forced: Spark's size-checked broadcast
(``spark.sql.autoBroadcastJoinThreshold``) and AQE's runtime switch pick a
broadcast hash join when the dimension is small and a sort-merge join with
skew splitting otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def merge_products(reviews: DataFrame, products: DataFrame | None, *, key: str = "product_id", suffix: str = "_product") -> DataFrame:
    """Reviews ⟕ products on ``key``; clashing product columns get ``suffix``.

    Skipped (reviews returned) when the dimension or the key is missing. NULL keys
    match nothing (SQL equality), where pandas would pair NULL with NULL.
    Duplicate product ids fan out, as in any equi-join.
    """
    if products is None or key not in reviews.columns or key not in products.columns:
        return reviews
    clash = {c: f"{c}{suffix}" for c in products.columns if c != key and c in reviews.columns}
    right = products.withColumnsRenamed(clash) if clash else products
    return reviews.join(right, key, "left")


def match_rate(merged: DataFrame, *, name_col: str = "product_name") -> DataFrame:
    """% of rows with a non-null product name."""
    return merged.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count(name_col).alias("n_matched"),
        (F.avg(F.col(name_col).isNotNull().cast("double")) * 100).alias("match_pct"),
    )


def lookup_authors(tweets: DataFrame, users: DataFrame, *, key: str = "author_id") -> DataFrame:
    """Tweet ⟕ author profile; missing author → 'unknown' username and name."""
    joined = tweets.join(users, key, "left")
    return joined.withColumns(
        {
            "author_username": F.coalesce(F.col("author_username"), F.lit("unknown")),
            "author_name": F.coalesce(F.col("author_name"), F.lit("unknown")),
        }
    )
