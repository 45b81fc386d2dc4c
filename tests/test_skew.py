"""Hot keys: one product / brand / user / duplicate group holding a third of all rows.
Results must stay whole and exact; the plans must pre-aggregate before shuffling."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from glossa.operators import marts, quality, segments, social


@pytest.fixture(scope="module")
def skewed(spark):
    rng = np.random.default_rng(7)
    n = 30_000
    product = np.where(np.arange(n) < n // 3, 1, rng.integers(2, 500, n))  # product 1: a third of the rows
    brand = np.where(product == 1, "hot", np.char.add("b", (product % 17).astype(str)))
    user = np.where(np.arange(n) % 3 == 0, 42, rng.integers(1, 5000, n))  # user 42: a third of the rows
    rating = rng.integers(1, 6, n).astype(float)
    sentiment = np.round(rng.uniform(-1, 1, n), 3)
    day = pd.to_datetime("2024-01-01") + pd.to_timedelta(rng.integers(0, 60, n), unit="D")
    pdf = pd.DataFrame(
        {"product_id": product, "brand_name": brand, "user_id": user, "rating": rating, "sentiment_score": sentiment, "review_date": day.date}
    )
    pdf["sentiment_label"] = np.where(pdf.sentiment_score > 0.1, "positive", np.where(pdf.sentiment_score < -0.1, "negative", "neutral"))
    return spark.createDataFrame(pdf).repartition(8), pdf


def test_hot_product_metrics_exact(skewed):
    df, pdf = skewed
    out = {r.product_id: r for r in marts.product_metrics(df).collect()}
    hot = pdf[pdf.product_id == 1]
    assert out[1].review_count == len(hot) == 10_000
    assert out[1].unique_users == hot.user_id.nunique()
    assert out[1].avg_rating == pytest.approx(round(hot.rating.mean(), 3), abs=1e-3)
    assert sum(r.review_count for r in out.values()) == len(pdf)  # nothing dropped


def test_hot_brand_and_user(skewed):
    df, pdf = skewed
    b = {r.brand_name: r for r in marts.brand_summary(df).collect()}
    assert b["hot"].review_count == 10_000 and b["hot"].product_count == 1
    rfm = {r.user_id: r for r in segments.rfm_base(df).collect()}
    assert rfm[42].frequency == (pdf.user_id == 42).sum()


def test_hot_duplicate_group(skewed):
    df, pdf = skewed
    dup = df.withColumn("rating", F.when(F.col("product_id") == 1, F.lit(5.0)).otherwise(F.col("rating")))
    dup = dup.withColumn("sentiment_score", F.when(F.col("product_id") == 1, F.lit(0.5)).otherwise(F.col("sentiment_score")))
    dup = dup.withColumn("sentiment_label", F.when(F.col("product_id") == 1, F.lit("positive")).otherwise(F.col("sentiment_label")))
    got = quality.duplicates(dup).collect()[0]
    p = dup.toPandas()
    assert got.duplicate_rows == int(p.duplicated(["rating", "sentiment_score", "sentiment_label"]).sum())
    assert got.total_rows == len(p)


def test_hot_key_plans_pre_aggregate(skewed):
    df, _ = skewed
    plan = marts.brand_summary(df)._jdf.queryExecution().executedPlan().toString()
    assert "partial_" in plan  # map-side combine before the exchange


def test_hot_key_anti_join_whole(skewed, spark):
    df, pdf = skewed
    sec = df.select(F.col("review_date").alias("date"), F.col("brand_name").alias("platform"), "rating")
    pri = sec.filter(F.col("platform") == "hot").agg(F.min("date").alias("date")).select(
        "date", F.lit("hot").alias("platform"), F.lit(0.0).alias("rating")
    )
    out = social.prioritized_union(pri, sec, ["date", "platform"])
    first = pri.collect()[0]
    replaced = pdf[(pdf.brand_name == "hot") & (pdf.review_date == first.date)]
    assert out.count() == len(pdf) - len(replaced) + 1
