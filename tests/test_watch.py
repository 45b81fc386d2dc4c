"""Streaks of bad days, automatic bins, and sketches that merge."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from glossa.operators import bins, sketches, streaks


def test_runs_end_at_a_good_day_and_at_a_gap(spark):
    share = {1: 0.5, 2: 0.4, 3: 0.31, 4: 0.3, 5: 0.9, 6: 0.9, 8: 0.9, 9: 0.9, 10: 0.35, 11: 0.8, 12: None}
    rows = [("a", f"2024-01-{d:02d}", x) for d, x in share.items()] + [("b", f"2024-02-{d:02d}", 0.5) for d in (28, 29)] + [("b", "2024-03-01", 0.6)]
    days = spark.createDataFrame(rows, "g string, day string, negative_share double").withColumn("day", F.to_date("day"))
    got = sorted((r["g"], str(r["start_day"]), str(r["end_day"]), r["days"], r["worst"]) for r in streaks.streaks(days, streaks.REVIEW_RULES[:1], by=["g"]).collect())
    assert got == [("a", "2024-01-01", "2024-01-03", 3, 0.5), ("a", "2024-01-08", "2024-01-11", 4, 0.9), ("b", "2024-02-28", "2024-03-01", 3, 0.6)]


def test_review_streaks_over_all_rows(spark):
    rows = [("negative", 1.0, f"2024-01-0{d}") for d in range(1, 5)] + [("positive", 5.0, "2024-01-03"), ("positive", 5.0, "2024-01-03"), ("positive", 5.0, "2024-01-03")]
    rows += [(None, None, "2024-01-05"), ("negative", 1.0, None)]
    df = spark.createDataFrame(rows, "sentiment_label string, rating double, review_date string")
    got = {(r["severity"], r["metric"]): (str(r["start_day"]), r["days"], r["worst"]) for r in streaks.review_streaks(df).collect()}
    assert got == {("ALTA", "low_rating_share"): ("2024-01-01", 4, 1.0)}  # the third day is a quarter negative
    assert streaks.review_streaks(df.limit(0)).count() == 0


def test_a_week_of_weak_correlation(spark):
    rng = np.random.default_rng(1)
    rows = [("p", f"2024-{1 + d // 28:02d}-{1 + d % 28:02d}", float(d), float(d) if d < 28 else float(rng.normal())) for d in range(84)]
    rows += [("flat", f"2024-01-{d:02d}", 1.0, 2.0) for d in range(1, 29)]
    panel = spark.createDataFrame(rows, "platform string, date string, review_count double, mention_volume double").withColumn("date", F.to_date("date"))
    got = streaks.correlation_streaks(panel, days=14).collect()
    assert got and all(r["platform"] == "p" and r["days"] >= 7 and r["worst"] < 0.3 and str(r["start_day"]) > "2024-01-28" for r in got)
    rolled = streaks.rolling_correlation(panel, "review_count", "mention_volume", days=14).where("platform = 'p'").orderBy("day").collect()
    assert [r["social_correlation"] for r in rolled[:9]] == [None] * 9 and rolled[20]["social_correlation"] == pytest.approx(1.0)


def test_bins_by_quartiles_and_count(spark):
    df = spark.createDataFrame([(float(x),) for x in range(1000)] + [(None,), (float("nan"),)], "x double")
    got = {r["bin"]: (r["n"], r["bin_lo"], r["bin_hi"]) for r in bins.auto_histogram(df, "x").collect()}
    # 2 * 499.5 / 10 = 99.9, so bins of 100
    assert got == {k: (100, 100.0 * k, 100.0 * (k + 1)) for k in range(10)}
    rng = np.random.default_rng(0)
    x = rng.normal(0, 0.01, 5000)
    rows = bins.auto_histogram(spark.createDataFrame([(float(v),) for v in x], "x double"), "x").orderBy("bin").collect()
    q1, q3 = np.percentile(x, [25, 75])
    width = 2 * (q3 - q1) / 5000 ** (1 / 3)
    step = rows[0]["bin_hi"] - rows[0]["bin_lo"]
    assert step == pytest.approx(0.002) and 0.5 < step / width < 2 and sum(r["n"] for r in rows) == 5000
    assert [r["n"] for r in rows] == [int(((x >= r["bin"] * 0.002) & (x < (r["bin"] + 1) * 0.002)).sum()) for r in rows]


def test_bins_without_spread(spark):
    one = bins.auto_histogram(spark.createDataFrame([(2.5,)] * 9, "x double"), "x").collect()
    assert [(r["bin"], r["n"], r["bin_lo"], r["bin_hi"]) for r in one] == [(2, 9, 2.0, 3.0)]
    equal = bins.auto_histogram(spark.createDataFrame([(0.0,)] * 90 + [(8.0,)], "x double"), "x")  # quartiles alike
    assert sum(r["n"] for r in equal.collect()) == 91 and equal.count() == 2
    assert bins.auto_histogram(spark.createDataFrame([], "x double"), "x").collect() == []


def test_merged_sketches_stay_within_their_error(spark):
    df = spark.range(120_000).select(
        (F.col("id") % 7).alias("g"), F.expr("date_add(DATE '2024-01-01', cast(id % 30 as int))").alias("day"),
        F.expr("cast(pow(id % 20011, 2) as long)").alias("user"), F.expr("(id * 7919) % 100003").cast("double").alias("x"),
    )
    names = {"distinct": ["user"], "values": ["x"]}
    daily = sketches.daily_sketches(df, date_col="day", by=["g"], **names)
    assert daily.count() == 7 * 30
    assert daily.select(F.max(F.octet_length("distinct_user"))).first()[0] < 5000 and daily.select(F.max(F.octet_length("quantiles_x"))).first()[0] < 10_000
    for first, last in ((None, None), ("2024-01-05", "2024-01-11")):
        found = sketches.estimates(sketches.merged(daily, first=first, last=last, **names), probs=(0.1, 0.5, 0.9), **names).first()
        rows = df.where(F.col("day").between(first or "2024-01-01", last or "2024-12-31")).toPandas()
        assert found["n"] == len(rows)
        assert abs(found["user_distinct"] / rows["user"].nunique() - 1) < sketches.DISTINCT_ERROR
        for p, q in zip((0.1, 0.5, 0.9), found["x_quantiles"]):
            assert abs((rows["x"] <= q).mean() - p) < sketches.RANK_ERROR
    assert sketches.merged(daily, first="2030-01-01", by=["g"], **names).count() == 0
