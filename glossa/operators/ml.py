"""Review clustering and the social-metrics rating model (K1–K8), on Spark ML.

Fits are iterative (many passes over the data), so the distinct feature vectors
are written to the shared checkpoint folder first: a lost executor then
reads them again instead of running the whole upstream plan.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pyspark.storagelevel import StorageLevel

from glossa.operators import kmeans
from glossa.session import written

# Candidate clustering features, in order.
CLUSTER_FEATURES = (
    "text_length",
    "rating",
    "sentiment_score",
    "sentiment_intensity",
    "text_word_count",
    "text_sentence_count",
    "text_avg_word_length",
)
MIN_FEATURES = 3

# Model grade thresholds on test R^2.
GRADES = ((0.3, "good"), (0.1, "moderate"))
LOW_GRADE = "low"


def cluster_reviews(
    reviews: DataFrame,
    *,
    features: Sequence[str] = CLUSTER_FEATURES,
    k: int = 4,
    n_components: int = 3,
    n_init: int = 10,
    seed: int = 42,
    checkpoint: bool = True,
    iterations: int = 20,
) -> tuple[DataFrame, dict]:
    """K1–K5: null→0, standardise, PCA to min(3, features), k-means with ``n_init``
    restarts (lowest cost kept; ties → first restart). Returns the reviews with
    ``user_cluster`` and an info dict.

    The fits only need the distinct feature vectors and how many reviews have each: they
    are written once in the shared checkpoint folder (``checkpoint``), and moments, PCA and the
    restarts' scans (``kmeans``) read that table. The full review rows are read once more at the
    end to attach the cluster of the best restart, by plain arithmetic.

    Fewer than ``MIN_FEATURES`` present features → every review in cluster 0.
    Features are scaled by the sample std (sklearn: population) — a common factor, same
    clusters. Cluster ids are arbitrary labels; interpret them through F9 profiles.
    """
    used = [c for c in features if c in reviews.columns]
    if len(used) < MIN_FEATURES:
        return reviews.withColumn("user_cluster", F.lit(0)), {"n_clusters": 1, "features_used": used, "variance_explained": 0.0}
    filled = reviews.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in used})
    x = [f"x{i}" for i in range(len(used))]
    vectors = filled.select(*[F.col(c).alias(a) for c, a in zip(used, x)]).groupBy(*x).agg(F.count(F.lit(1)).alias("w"))
    vectors = written(vectors, "review-vectors") if checkpoint else vectors.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        n, mean, scale = weighted_moments(vectors, x)
        k = min(k, n)  # as many clusters as rows at most
        if k < 2:
            return reviews.withColumn("user_cluster", F.lit(0)), {"n_clusters": k, "features_used": used, "variance_explained": 0.0}
        n_comp = min(n_components, len(used))
        axes, explained = weighted_pca(vectors, x, mean, scale, n_comp)
        points = kmeans.weighted_points(vectors, projected(x, mean, scale, axes), F.col("w"))
    finally:
        if not checkpoint:
            vectors.unpersist()
    best = kmeans.best(kmeans.fit(points, n_comp, k=k, restarts=n_init, iterations=iterations, seed=seed))
    pcs = {f"_pc{i}": c for i, c in enumerate(projected(used, mean, scale, axes))}
    out = filled.withColumns(pcs).withColumn("user_cluster", kmeans.cluster_of([F.col(c) for c in pcs], best)).drop(*pcs)
    info = {
        "n_clusters": len(best.centers),
        "features_used": used,
        "variance_explained": explained,
        "training_cost": best.cost / kmeans.SCALE**2,
    }
    return out, info


def weighted_moments(vectors: DataFrame, x: Sequence[str]) -> tuple[int, list[float], list[float]]:
    """Rows that the weighted vectors ``(x.., w)`` stand for, and per feature the mean and 1 / sample std (0 where it is constant).

    Deviations from the least value are summed, so the mean of a constant is that constant, and its std 0.
    """
    least = vectors.agg(F.sum("w").alias("n"), *[F.min(c).alias(c) for c in x]).first()
    n = least["n"] or 0
    if n < 2:
        return n, [0.0] * len(x), [0.0] * len(x)
    above = vectors.agg(*[F.sum(F.col("w") * (F.col(c) - least[c])).alias(c) for c in x]).first()
    mean = [least[c] + above[c] / n for c in x]
    squares = vectors.agg(*[F.sum(F.col("w") * (F.col(c) - m) * (F.col(c) - m)).alias(c) for c, m in zip(x, mean)]).first()
    return n, mean, [1.0 / math.sqrt(squares[c] / (n - 1)) if squares[c] else 0.0 for c in x]


def scaled(x: Sequence[str], mean: Sequence[float], scale: Sequence[float]) -> list[Column]:
    return [(F.col(c) - m) * s for c, m, s in zip(x, mean, scale)]


def weighted_pca(vectors: DataFrame, x: Sequence[str], mean: Sequence[float], scale: Sequence[float], n_comp: int) -> tuple[list[list[float]], float]:
    """Spark ML's PCA of the rows that the weighted vectors stand for: axes, and the share of variance they explain.

    A vector v of weight w goes in as v and -v times sqrt(w / 2): their mean is 0 and their products add up to
    those of w rows, so the covariance is that of all rows but for a common factor, which neither result has.
    """
    half = F.sqrt(F.col("w") / 2)
    both = [array_to_vector(F.array(*[sign * half * z for z in scaled(x, mean, scale)])) for sign in (1.0, -1.0)]
    model = PCA(k=n_comp, inputCol="_scaled", outputCol="_pca").fit(vectors.select(F.explode(F.array(*both)).alias("_scaled")))
    return model.pc.toArray().T.tolist(), float(sum(model.explainedVariance.toArray()))


def projected(x: Sequence[str], mean: Sequence[float], scale: Sequence[float], axes: Sequence[Sequence[float]]) -> list[Column]:
    """A row's coordinate on every axis."""
    z = scaled(x, mean, scale)
    return [reduce(add, [c * a for c, a in zip(z, axis)]) for axis in axes]


def cluster_info(clustered: DataFrame, info: dict) -> DataFrame:
    """K5: one row per cluster with its size, plus the run's k, features and variance."""
    sizes = clustered.groupBy("user_cluster").agg(F.count(F.lit(1)).alias("cluster_size"))
    return sizes.withColumns(
        {
            "n_clusters": F.lit(info["n_clusters"]),
            "features_used": F.lit(",".join(info["features_used"])),
            "variance_explained": F.lit(info["variance_explained"]),
        }
    )


def model_frame(daily_reviews: DataFrame, pivot: DataFrame, *, target: str = "avg_rating") -> tuple[DataFrame, list[str]]:
    """Daily reviews ⋈ pivoted social on date; feature columns = pivot columns."""
    feats = [c for c in pivot.columns if c != "date"]
    joined = daily_reviews.select("date", target).join(pivot, "date", "inner")
    return joined, feats


def social_rating_model(
    daily_reviews: DataFrame,
    pivot: DataFrame,
    *,
    target: str = "avg_rating",
    min_days: int = 20,
    train_pct: int = 80,
) -> tuple[DataFrame, DataFrame]:
    """K6–K8: OLS of the daily mean rating on pivoted social metrics.

    The 80/20 split is a hash of the date (``pmod(xxhash64(date), 100) < 80``), so it
    is deterministic and needs no shuffle. Returns (metrics row, coefficient table
    ordered by |coefficient|). Fewer than ``min_days`` joined days → empty results.
    """
    spark = daily_reviews.sparkSession
    joined, feats = model_frame(daily_reviews, pivot, target=target)
    # The model frame has one row per day (bounded by the calendar); it is read by
    # the gate count, the fit and the evaluation, so it is cached for the fit.
    joined = joined.withColumns({c: F.col(f"`{c}`").cast("double") for c in feats}).persist()
    try:
        return _fit_social_model(spark, joined, feats, target, min_days, train_pct)
    finally:
        joined.unpersist()


def _fit_social_model(spark, joined, feats, target, min_days, train_pct):
    n_days = joined.count()
    metrics_schema = "n_days long, n_train long, n_test long, r2 double, mse double, mae double, grade string, top_feature string, top_sign string"
    coef_schema = "feature string, coefficient double, abs_coefficient double"
    if n_days < min_days:
        return spark.createDataFrame([], metrics_schema), spark.createDataFrame([], coef_schema)
    safe = [f"f{i}" for i in range(len(feats))]
    renamed = joined.select("date", F.col(target).alias("label"), *[F.col(f"`{c}`").alias(s) for c, s in zip(feats, safe)])
    vec = VectorAssembler(inputCols=safe, outputCol="features").transform(renamed)
    bucket = F.pmod(F.xxhash64("date"), F.lit(100))
    train = vec.filter(bucket < train_pct)
    test = vec.filter(bucket >= train_pct)
    model = LinearRegression(featuresCol="features", labelCol="label", solver="normal", regParam=0.0).fit(train)
    pred = model.transform(test)
    # Test metrics in one pass (same definitions as RegressionEvaluator:
    # r2 = 1 - SS_res / SS_tot, mse, mae), instead of one evaluation job each.
    err = F.col("label") - F.col("prediction")
    m = pred.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(err * err).alias("mse"),
        F.avg(F.abs(err)).alias("mae"),
        F.var_pop("label").alias("var"),
    ).collect()[0]
    if not m["n"]:  # no day fell into the test part
        return spark.createDataFrame([], metrics_schema), spark.createDataFrame([], coef_schema)
    mse, mae = float(m["mse"]), float(m["mae"])
    r2 = 1.0 - mse / m["var"] if m["var"] else None  # no R^2 of a constant target
    coefs = [(f, float(c), abs(float(c))) for f, c in zip(feats, model.coefficients.toArray())]
    coef_df = spark.createDataFrame(coefs, coef_schema).orderBy(F.col("abs_coefficient").desc(), F.col("feature"))
    top = max(coefs, key=lambda t: (t[2], [-ord(ch) for ch in t[0]])) if coefs else (None, 0.0, 0.0)
    grade = next((g for thr, g in GRADES if r2 is not None and r2 > thr), LOW_GRADE)
    n_train = int(model.summary.numInstances)
    row = (n_days, n_train, int(m["n"]), r2, mse, mae, grade, top[0], "positive" if top[1] > 0 else "negative")
    return spark.createDataFrame([row], metrics_schema), coef_df
