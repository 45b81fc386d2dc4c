"""Pairwise ranks, models by moments, and restarts that share their scans."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from glossa.operators import kmeans, pairwise, regression


def test_pairwise_spearman_equals_pandas(spark):
    rng = np.random.default_rng(2)
    n = 300
    frame = pd.DataFrame({"a": rng.integers(0, 5, n).astype(float), "b": rng.normal(size=n), "c d": rng.integers(-3, 3, n).astype(float), "e": 7.0, "f": np.nan})
    frame["b"] += frame["a"]
    for c, share in (("a", 0.3), ("b", 0.2), ("c d", 0.5)):
        frame.loc[rng.random(n) < share, c] = np.nan
    frame.loc[:99, "c d"] = 0.0  # a hot value
    df = spark.createDataFrame(frame.astype(object).where(frame.notna(), None).values.tolist(), "a double, b double, `c d` double, e double, f double")
    df = df.withColumn("a", F.when(F.col("a") == 4, float("nan")).otherwise(F.col("a")))  # NaN is no value
    frame.loc[frame["a"] == 4, "a"] = np.nan
    got = {(r["var_x"], r["var_y"]): (r["n"], r["spearman_r"]) for r in pairwise.spearman_pairwise(df, list(frame.columns)).collect()}
    assert len(got) == 10
    for (x, y), (rows, r) in got.items():
        both = frame[[x, y]].dropna()
        assert rows == len(both)
        want = both[x].rank().corr(both[y].rank()) if len(both) and both[x].nunique() > 1 and both[y].nunique() > 1 else None
        assert r is None if want is None else r == pytest.approx(want, abs=1e-12), (x, y)


def test_pairwise_of_nothing(spark):
    rows = pairwise.spearman_pairwise(spark.createDataFrame([], "a double, b int"), ["a", "b"]).collect()
    assert [(r["n"], r["spearman_r"]) for r in rows] == [(0, None)]


def fitted(spark, frame, features, **kw):
    df = spark.createDataFrame(frame)
    model = regression.fit(df, "y", features, by=["g"], **kw)
    return df, model, {r["g"]: r for r in model.collect()}


def test_models_of_every_group_equal_least_squares(spark):
    rng = np.random.default_rng(4)
    parts = []
    for g in range(3):
        x = rng.normal(size=(60, 3)) * [1, 1000, 0.001] + [5, 1e6, 0]
        parts.append(pd.DataFrame({"g": g, "x0": x[:, 0], "x1": x[:, 1], "x 2": x[:, 2], "y": g + x @ [2.0, -0.01 * g, 300.0] + rng.normal(size=60), "t": rng.random(60) < 0.8}))
    few = parts[0].head(10).assign(g=9)
    frame = pd.concat([*parts, few])
    features = ["x0", "x1", "x 2"]
    df, model, got = fitted(spark, frame, features, train=F.col("t"))
    assert sorted(got) == [0, 1, 2]  # ten rows are no model
    scores = {r["g"]: r for r in regression.metrics(model, df, "y", features, by=["g"], train=F.col("t")).collect()}
    for g, part in enumerate(parts):
        train, test = part[part["t"]], part[~part["t"]]
        a = np.column_stack([np.ones(len(train)), train[features]])
        want = np.linalg.lstsq(a, train["y"], rcond=None)[0]
        assert got[g]["intercept"] == pytest.approx(want[0], rel=1e-5, abs=1e-5) and got[g]["coefficients"] == pytest.approx(want[1:].tolist(), rel=1e-6)
        error = test["y"] - np.column_stack([np.ones(len(test)), test[features]]) @ want
        assert scores[g]["mse"] == pytest.approx((error**2).mean()) and scores[g]["r2"] == pytest.approx(1 - (error**2).mean() / test["y"].var(ddof=0))
        assert (scores[g]["n_rows"], scores[g]["n_train"], scores[g]["n_test"]) == (60, len(train), len(test))
        assert scores[g]["top_feature"] == "x 2" and scores[g]["top_sign"] == "positive"
    table = regression.coefficients(model, features, by=["g"]).collect()
    assert [r["feature"] for r in table][:2] == ["x 2", "x0"] and len(table) == 9


def test_constant_and_dependent_features_get_no_weight(spark):
    x = np.arange(30.0)
    frame = pd.DataFrame({"g": 0, "one": 1.0, "x": x, "twice": 2 * x, "y": 3 * x + 1})
    _, _, got = fitted(spark, frame, ["one", "x", "twice"])
    assert got[0]["coefficients"] == pytest.approx([0.0, 3.0, 0.0], abs=1e-9) and got[0]["intercept"] == pytest.approx(1.0)
    _, _, flat = fitted(spark, frame.assign(y=5.0), ["one", "x"])
    assert flat[0]["coefficients"] == [0.0, 0.0] and flat[0]["intercept"] == 5.0


def test_one_model_of_all_rows(spark):
    x = np.arange(40.0)
    df = spark.createDataFrame(pd.DataFrame({"x": x, "y": 2 * x + 1}))
    model = regression.fit(df, "y", ["x"])
    row = regression.metrics(model, df, "y", ["x"]).first()
    assert (row["n_rows"], row["n_test"], row["grade"], row["top_feature"]) == (40, 40, "good", "x") and row["r2"] == pytest.approx(1.0)
    assert regression.coefficients(model, ["x"]).first()["coefficient"] == pytest.approx(2.0)
    few = regression.fit(df.limit(5), "y", ["x"])
    assert few.count() == 0 and regression.metrics(few, df, "y", ["x"]).count() == 0


def plain_kmeans(points, weights, ends):
    """Lloyd's rounds from a restart's end must not move it."""
    centers = np.array(ends.centers)
    nearest = ((points[:, None, :] - centers[None]) ** 2).sum(axis=2).argmin(axis=1)
    return np.array([np.average(points[nearest == c], axis=0, weights=weights[nearest == c]) for c in range(len(centers))])


def test_restarts_end_at_the_means_of_their_members(spark):
    rng = np.random.default_rng(3)
    rows = [tuple(float(x) for x in m + rng.normal(0, 0.1, 2)) for m in ([0, 0], [5, 0], [0, 5]) for _ in range(40)] + [(0.0, 0.0)] * 300 + [(None, 5.0)]
    df = spark.createDataFrame(rows, "x double, y double")
    points = kmeans.weighted_points(df, [F.col("x"), F.col("y")])
    assert points.count() < 130  # equal points are one row
    table = points.toPandas()
    ends = kmeans.fit(points, 2, k=3, restarts=4, iterations=50)
    assert len(ends) == 4
    for end in ends:
        means = plain_kmeans(table[["q0", "q1"]].to_numpy(), table["w"].to_numpy(), end)
        assert np.allclose(means, end.means) and np.allclose(end.means, end.centers) and sum(end.sizes) == 421
    first = kmeans.best(ends)
    assert first.cost == min(e.cost for e in ends)
    sizes = df.withColumn("c", kmeans.cluster_of([F.col("x"), F.col("y")], first)).groupBy("c").count().collect()
    assert sorted(r["count"] for r in sizes) == sorted(first.sizes) == [40, 41, 340]


def test_fewer_points_than_clusters(spark):
    df = spark.createDataFrame([(1.0,), (1.0,), (2.0,)], "x double")
    points = kmeans.weighted_points(df, [F.col("x")])
    assert [sorted(e.sizes) for e in kmeans.fit(points, 1, k=4, restarts=2)] == [[1, 2], [1, 2]]
    assert kmeans.fit(kmeans.weighted_points(df.where("x > 9"), [F.col("x")]), 1) == []


def test_one_scan_an_iteration(spark):
    df = spark.createDataFrame([(float(k % 17), float(k % 5)) for k in range(200)], "x double, y double")
    points = kmeans.weighted_points(df, [F.col("x"), F.col("y")])
    scans = []
    real, kmeans.scan = kmeans.scan, lambda *a: scans.append(a[2]) or real(*a)
    try:
        kmeans.fit(points, 2, k=3, restarts=5, iterations=3)
    finally:
        kmeans.scan = real
    assert len(scans) <= 4 and len(scans[0]) == 5
