"""Steps whose rows, memory or passes grew faster than the input (findings of round 3)."""

import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from glossa.operators import marts, ml, sentiment, stats


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_lexicon_join_has_one_row_a_text_and_token(spark):
    texts = ["good good very good not good", "not bad and never very bad bad", "so so good good", "plain", "", None, "good good very good not good"]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "id long, cleaned_text string")
    words = {"good": 2.0, "bad": -1.5, "so": 0.5}
    polarity = {"good": 0.7, "bad": -0.4}
    lexicon = spark.createDataFrame([*words.items(), ("plain", None)], "token string, valence double")
    known = spark.createDataFrame([*polarity.items()], "token string, polarity double")
    scored = sentiment.score(df, lexicon, polarity=known)
    assert re.search(r"HashAggregate\(keys=\[_key#\d+, token#\d+\]", plan(scored))
    want = sentiment.score_map(df, words, polarity=polarity).orderBy("id").collect()
    got = scored.orderBy("id").collect()
    for c in ("vader_compound", "textblob_sentiment"):
        assert [r[c] for r in got] == pytest.approx([r[c] for r in want], abs=1e-12)


def test_two_distinct_counts_do_not_expand_the_rows(spark):
    rows = [("a", 1, 7, 5.0, 0.1), ("a", 1, 8, 4.0, None), ("a", None, 8, None, 0.3), ("b", 2, None, 1.0, 0.2), (None, 3, 9, 2.0, 0.1)]
    df = spark.createDataFrame(rows, "brand_name string, product_id long, user_id int, rating double, sentiment_score double")
    summary = marts.brand_summary(df)
    assert "Expand" not in plan(summary)
    got = {r["brand_name"]: r for r in summary.collect()}
    assert set(got) == {"a", "b"}
    assert [got[b][c] for b in "ab" for c in ("product_count", "unique_users", "review_count")] == [1, 2, 2, 1, 0, 1]


def test_equal_rows_meet_the_ranks_once(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"x": np.where(rng.random(5000) < 0.4, 1.0, rng.normal(size=5000)), "y": rng.integers(0, 5, 5000).astype(float), "z": rng.integers(0, 4000, 5000).astype(float)})
    pdf.loc[::97, "y"] = None
    df = spark.createDataFrame(pdf).replace(float("nan"), None)
    matrix = stats.spearman_matrix(df, ["x", "y", "z"])
    assert re.search(r"HashAggregate\(keys=\[x#\d+, y#\d+, z#\d+\]", plan(matrix))
    want = pdf.dropna().corr("spearman")
    got = {(r.var_x, r.var_y): r.spearman_r for r in matrix.collect()}
    assert got == pytest.approx({("x", "y"): want.x.y, ("x", "z"): want.x.z, ("y", "z"): want.y.z}, abs=1e-12)


def test_clusters_are_fitted_over_distinct_vectors(spark, monkeypatch):
    rng = np.random.default_rng(5)
    n = 2000
    pdf = pd.DataFrame({"text_length": rng.integers(3, 9, n), "rating": rng.integers(1, 6, n).astype(float), "sentiment_score": rng.integers(-2, 3, n) / 2})
    pdf["text_length"] += 3 * pdf["rating"].astype(int)
    pdf["sentiment_intensity"], pdf["text_sentence_count"] = pdf["sentiment_score"].abs(), 0.1  # 0.1: a constant has no deviation
    pdf.loc[: n // 2, :] = pdf.loc[0].values  # a hot vector
    df = spark.createDataFrame(pdf).withColumn("rating", F.when(F.col("rating") != 3, F.col("rating")))
    x = df.toPandas()[["text_length", "rating", "sentiment_score", "sentiment_intensity", "text_sentence_count"]].fillna(0).to_numpy(float)

    fitted = []
    fit = ml.PCA.fit
    monkeypatch.setattr(ml.PCA, "fit", lambda self, frame: fitted.append(frame.count()) or fit(self, frame))
    out, info = ml.cluster_reviews(df, n_init=3)
    assert fitted == [2 * len(np.unique(x, axis=0))]
    assert not re.search("UDF|lambda", plan(out))

    std = x.std(axis=0, ddof=1)
    z = (x - x.mean(axis=0)) / np.where(std < 1e-9, np.inf, std)
    shares, axes = np.linalg.eigh(np.cov(z.T))
    assert info["variance_explained"] == pytest.approx(shares[-3:].sum() / shares.sum(), abs=1e-12)
    y = z @ axes[:, -3:]
    cluster = np.array([r["user_cluster"] for r in out.select("user_cluster").collect()])
    cost = sum(((y[cluster == c] - y[cluster == c].mean(axis=0)) ** 2).sum() for c in set(cluster))
    assert len(set(cluster)) == info["n_clusters"] == 4 and info["training_cost"] == pytest.approx(cost, rel=1e-6)
