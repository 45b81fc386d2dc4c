"""Unit tests per operator on hand-made rows (cases the driver tables do not contain)."""

import math
import os

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from glossa.functions import numeric as N
from glossa.functions import text as T
from glossa.functions.pvalues import betainc_np
from glossa.operators import filters, joins, marts, quality, segments, sentiment, social, stats, timeseries
from glossa.operators import text as X


# ------------------------------------------------------------------ numeric

def test_round_half_even(spark):
    df = spark.createDataFrame([(2.5,), (3.5,), (0.0125,), (-0.0125,)], "x double")
    got = [r[0] for r in df.select(N.round_half_even("x", 0)).collect()[:2]]
    assert got == [2.0, 4.0]


def test_safe_corr_constant_side_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 2.0), (3.0, 2.0)], "x double, y double")
    assert df.agg(N.safe_corr("x", "y")).collect()[0][0] is None


def test_safe_corr_drops_incomplete_pairs(spark):
    rows = [(1.0, 1.0), (2.0, 2.1), (3.0, None), (4.0, 3.9), (None, 7.0), (5.0, 5.2)]
    df = spark.createDataFrame(rows, "x double, y double")
    got = df.agg(N.safe_corr("x", "y")).collect()[0][0]
    pdf = pd.DataFrame(rows, columns=["x", "y"]).dropna()
    assert got == pytest.approx(pdf.x.corr(pdf.y), abs=1e-12)


def test_average_rank_matches_pandas(spark):
    vals = [3.0, 1.0, 3.0, 2.0, 3.0, 5.0, 1.0]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, v double")
    got = [r[1] for r in df.select("i", N.average_rank("v")).orderBy("i").collect()]
    assert got == list(pd.Series(vals).rank(method="average"))


def test_stable_avg_exact(spark):
    df = spark.createDataFrame([(0.1,), (0.2,), (0.3,)], "x double")
    assert df.agg(N.stable_avg("x")).collect()[0][0] == pytest.approx(0.2, abs=1e-15)


# ------------------------------------------------------------------ p-values

def test_betainc_textbook_values():
    # t(10) critical 2.228 → p = .05 ; F(3, 20) critical 3.098 → p = .05
    assert betainc_np(5.0, 0.5, 10 / (10 + 2.228**2)) == pytest.approx(0.05, abs=2e-4)
    assert betainc_np(10.0, 1.5, 20 / (20 + 3 * 3.098)) == pytest.approx(0.05, abs=2e-4)
    assert betainc_np(2.0, 3.0, 0.5) == pytest.approx(0.6875, abs=1e-12)
    assert betainc_np(2.0, 3.0, 0.0) == 0.0 and betainc_np(2.0, 3.0, 1.0) == 1.0


def test_corr_pvalue_perfect_is_zero(spark):
    from glossa.functions.pvalues import corr_pvalue

    df = spark.createDataFrame([(1.0, 20.0), (0.3, 12.0)], "r double, n double")
    p = [r[0] for r in df.select(corr_pvalue(F.col("r"), F.col("n"))).collect()]
    # r = .3, n = 12: t = .9945 with 10 df → two-sided p = .3434
    assert p[0] == 0.0 and p[1] == pytest.approx(0.3434, abs=1e-3)


# ------------------------------------------------------------------ text

def test_clean_text_unicode_and_urls(spark):
    rows = [("Café  crème! http://x.y/z #tag @me",), (None,), ("a b\tc",)]
    df = spark.createDataFrame(rows, "t string")
    got = [r[0] for r in df.select(T.clean_text("t")).collect()]
    assert got == ["Café crème #tag @me", "", "a b c"]


def test_text_features(spark):
    df = spark.createDataFrame([("Hello world. Is it ok?! Yes",), ("",), (None,), ("one",)], "t string")
    out = X.text_features(df, text_col="t").collect()
    a = out[0]
    assert (a.text_word_count, a.text_sentence_count, a.text_exclamation_count, a.text_question_count) == (6, 3, 1, 1)
    assert a.text_avg_word_length == pytest.approx(np.mean([len(w) for w in "Hello world. Is it ok?! Yes".split()]))
    assert (out[1].text_word_count, out[1].text_sentence_count, out[1].text_avg_word_length) == (0, 0, 0.0)
    assert out[3].text_sentence_count == 1


def test_keyword_rules_are_substring_and_ordered(spark):
    df = spark.createDataFrame([("nice package",), ("hair and skin",), ("anti aging serum",), ("nothing here",)], "t string")
    cat = [r[0] for r in df.select(T.first_matching_rule("t", X.CATEGORY_RULES, "Other")).collect()]
    # 'age' hits 'package'; Skincare precedes Hair Care; the hyphenated keyword can't match cleaned text
    assert cat == ["Anti-Aging", "Skincare", "Skincare", "Other"]


def test_main_concerns_first_two(spark):
    df = spark.createDataFrame([("acne and dry skin glow pore",)], "t string")
    got = df.select(T.all_matching_rules("t", X.CONCERN_RULES, 2)).collect()[0][0]
    assert got == ["acne", "brightening"]


def test_hashtags_mentions(spark):
    df = spark.createDataFrame([("Love #Skincare and #café_1 by @ana!",), (None,)], "t string")
    out = df.select(T.hashtags("t").alias("h"), T.mentions("t").alias("m")).collect()
    assert out[0].h == ["Skincare", "café_1"] and out[0].m == ["ana"]
    assert out[1].h == [] and out[1].m == []


def test_clean_reviews_roles_dates_demographics(spark):
    rows = [("Great stuff here", "4.45", "2024-01-03", " Fair "), ("Bad thing really", "x", "2024-01-04", None),
            ("Nice product", "5", "not a date", "dark"), ("Short", "3", "2024-01-05", "x")]
    df = spark.createDataFrame(rows, "Review_Text string, Rating string, submission_time string, skin_tone string")
    out = X.clean_reviews(df).collect()
    assert len(out) == 1
    r = out[0]
    assert r.rating == 4.4 and r.skin_tone == "fair" and r.review_date.day == 3


def test_detect_roles_requires_text_and_rating():
    with pytest.raises(KeyError):
        X.detect_roles(["id", "rating"])


# ------------------------------------------------------------------ sentiment

def test_negation_and_booster(spark):
    df = spark.createDataFrame([("good",), ("very good",), ("not good",), ("",)], "t string")
    out = [r.vader_compound for r in sentiment.score_map(df, text_col="t").collect()]
    assert out[1] > out[0] > 0 > out[2]
    assert out[3] == 0.0


def test_map_and_join_plans_agree(spark):
    rows = [(1, "not bad at all, very good"), (2, "worst idea"), (3, "no words"), (4, "")]
    df = spark.createDataFrame(rows, "id long, t string")
    a = {r.id: r.vader_compound for r in sentiment.score_map(df, text_col="t").collect()}
    b = {r.id: r.vader_compound for r in sentiment.score(df, text_col="t").collect()}
    assert a.keys() == b.keys()
    for k in a:
        assert a[k] == pytest.approx(b[k], abs=1e-12)


def test_sentiment_of_repeated_rows_and_odd_lexicons(spark):
    df = spark.createDataFrame([(1, "good day"), (1, "good day"), (2, None), (None, "bad")], "id long, t string")
    got = [(r.id, r.vader_compound) for r in sentiment.score(df, text_col="t").collect()]
    assert len(got) == 4 and got.count((2, 0.0)) == 1 and len({v for k, v in got if k == 1}) == 1
    assert all(r.vader_compound == 0 for r in sentiment.score(df, {}, text_col="t").collect())
    twice = spark.createDataFrame([("good", 1.0), ("good", 3.0)], "token string, valence double")
    one = {r.vader_compound for r in sentiment.score(df.where("id = 1"), twice, text_col="t").collect()}
    assert one == {r.vader_compound for r in sentiment.score(df.where("id = 1"), {"good": 2.0}, text_col="t").collect()}


def test_tweet_label_thresholds_inclusive(spark):
    df = spark.createDataFrame([(0.05,), (-0.05,), (0.049,)], "c double")
    got = [r.sentiment_label for r in sentiment.tweet_labels(df, compound_col="c").collect()]
    assert got == ["positive", "negative", "neutral"]


# ------------------------------------------------------------------ marts

def test_product_rules_null_std_and_rounding(spark):
    rows = [(1, 5.0, 0.5, 1), (2, 4.0, 0.5, 1), (2, 4.0, 0.5, 2), (2, 5.0, 0.5, 3), (2, 4.0, 0.5, 4), (2, 4.0, 0.5, 5), (3, 1.0, -0.5, 1), (3, 2.0, -0.5, 2), (3, 2.0, -0.5, 2)]
    df = spark.createDataFrame(rows, "product_id long, rating double, sentiment_score double, user_id long")
    out = {r.product_id: r for r in marts.product_metrics(df).collect()}
    assert out[1].rating_std is None and out[1].performance_category == "new_or_low_volume"
    assert out[2].performance_category == "high_performer" and out[2].unique_users == 5
    assert out[3].performance_category == "low_performer"
    assert out[2].product_score == pytest.approx(4.2 * math.log1p(5))


def test_rolling_gates(spark):
    rows = [(f"2024-01-0{i}", float(i), 1.0, i) for i in range(1, 7)]
    df = spark.createDataFrame(rows, "review_date string, avg_rating double, avg_sentiment double, review_count long")
    out = timeseries.rolling_means(df).collect()
    assert all(r.rating_7d_avg is None and r.rating_trend is None for r in out)  # fewer than 7 days


def test_zscore_constant_series_has_no_anomaly(spark):
    df = spark.createDataFrame([(i, 5) for i in range(10)], "d int, review_count long")
    assert timeseries.volume_zscores(df).count() == 0


def test_histogram_top_edge_in_last_bin(spark):
    df = spark.createDataFrame([(0.0,), (0.5,), (1.0,)], "x double")
    got = {r.bin: r.n for r in marts.histogram(df, col="x", bins=2).collect()}
    assert got == {0: 1, 1: 2}


# ------------------------------------------------------------------ filters / joins / quality

def test_date_range_at_midnight(spark):
    df = spark.createDataFrame([("2024-01-31 00:00:00",), ("2024-01-31 10:00:00",), ("2024-01-01 00:00:00",)], "review_date string")
    df = df.withColumn("review_date", F.to_timestamp("review_date"))
    assert filters.filter_reviews(df, date_range=("2024-01-01", "2024-01-31")).count() == 2


def test_category_candidates_fallback(spark):
    df = spark.createDataFrame([("a", "x", 1), ("b", "x", 2), ("c", "y", 3)], "name string, kind string, n int")
    out = filters.category_candidates(df).collect()
    assert {r.column_name for r in out} == {"name", "kind"}
    assert [r.column_name for r in out if r.chosen] == ["name"]


def test_merge_products_suffix_and_unmatched(spark):
    reviews = spark.createDataFrame([(1, "r-brand"), (2, "b"), (None, "c")], "product_id long, brand_name string")
    products = spark.createDataFrame([(1, "P1", "B1"), (None, "PN", "BN")], "product_id long, product_name string, brand_name string")
    out = {r.brand_name: r for r in joins.merge_products(reviews, products).collect()}
    assert out["r-brand"].brand_name_product == "B1"
    assert out["b"].product_name is None and out["c"].product_name is None  # NULL keys match nothing
    rate = joins.match_rate(joins.merge_products(reviews, products)).collect()[0]
    assert rate.n_matched == 1


def test_duplicates_null_safe(spark):
    rows = [(5.0, 0.2, "positive"), (5.0, 0.2, "positive"), (None, None, None), (None, None, None), (1.0, -0.2, "negative")]
    df = spark.createDataFrame(rows, "rating double, sentiment_score double, sentiment_label string")
    assert quality.duplicates(df).collect()[0].duplicate_rows == 2


def test_validation_checks_flag_offenders(spark):
    rows = [("good text here", 6.0, 0.5, "positive"), (None, 3.0, 1.5, "meh"), ("short", None, -0.2, "negative")]
    df = spark.createDataFrame(rows, "review_text string, rating double, sentiment_score double, sentiment_label string")
    out = {(r.check, r.column): r for r in quality.validation_checks(df).collect()}
    assert out[("rating_range", "rating")].status == "fail" and out[("rating_range", "rating")].observed.startswith("2:")
    assert out[("label_values", "sentiment_label")].status == "fail"
    assert out[("null_texts", "review_text")].observed == "1"
    assert out[("required_column", "review_text")].status == "pass"


def test_completeness(spark):
    df = spark.createDataFrame([(1, None), (None, "a")], "a int, b string")
    assert quality.completeness(df).collect()[0].completeness_pct == pytest.approx(50.0)


# ------------------------------------------------------------------ social

def test_prioritized_union(spark):
    sec = spark.createDataFrame([("2024-01-01", "tw", 1), ("2024-01-01", "ig", 2)], "date string, platform string, v int")
    pri = spark.createDataFrame([("2024-01-01", "tw", 10)], "date string, platform string, v int")
    out = sorted((r.platform, r.v) for r in social.prioritized_union(pri, sec, ["date", "platform"]).collect())
    assert out == [("ig", 2), ("tw", 10)]


def test_hashtag_impact_small(spark):
    reviews = spark.createDataFrame(
        [("i love glow serum", 5.0, 0.5), ("dull skin", 2.0, -0.5), ("glow", 4.0, 0.1)], "cleaned_text string, rating double, sentiment_score double"
    )
    soc = spark.createDataFrame([("#Glow", 1, 10.0), ("#none", 1, 1.0)], "hashtag string, mention_volume int, engagement double")
    out = {r.hashtag: r for r in social.hashtag_impact(reviews, soc).collect()}
    assert set(out) == {"#Glow"}
    g = out["#Glow"]
    assert g.reviews_with_keyword == 2 and g.avg_rating_with_keyword == 4.5 and g.avg_rating_without_keyword == 2.0
    assert g.sentiment_difference == pytest.approx(0.3 - (-0.5))


def test_social_pivot_fills_zero(spark):
    rows = [("2024-01-01", "a", 1, 2.0), ("2024-01-02", "b", 3, 4.0)]
    df = spark.createDataFrame(rows, "date string, platform string, mention_volume long, engagement double")
    out = {str(r.date): r.asDict() for r in social.social_pivot(df, platforms=["a", "b"]).collect()}
    assert out["2024-01-01"]["mention_volume_b"] == 0 and out["2024-01-02"]["engagement_b"] == 4.0


def test_latest_snapshot_prunes_partitions(spark, tmpdir_fresh):
    from glossa.sources import files

    base = spark.createDataFrame([(1,), (2,)], "tweet_id long")
    path = os.path.join(tmpdir_fresh, "snap")
    files.write_snapshot(base, path, "2024-01-01")
    files.write_snapshot(base.limit(1), path, "2024-01-02")
    df = spark.read.parquet(path)
    out = social.latest_snapshot(df)
    assert out.count() == 1
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan


# ------------------------------------------------------------------ statistics

def test_group_correlations_match_pandas(spark):
    rng = np.random.default_rng(1)
    x = rng.integers(0, 5, 40).astype(float)
    y = x + rng.normal(0, 1, 40)
    df = spark.createDataFrame([("p", "k", float(a), float(b)) for a, b in zip(x, y)], "platform string, pair string, x double, y double")
    df = df.withColumn("n_days", F.lit(40))
    r = stats.group_correlations(df, ["platform", "pair"], min_n=10).collect()[0]
    s = pd.DataFrame({"x": x, "y": y})
    assert r.pearson_r == pytest.approx(s.x.corr(s.y), abs=1e-10)
    # Spearman = Pearson of average ranks (scipy is not installed)
    assert r.spearman_r == pytest.approx(s.x.rank().corr(s.y.rank()), abs=1e-10)


def test_spearman_invariant_under_monotone_map(spark):
    rows = [(float(i), float((i * 7) % 11)) for i in range(30)]
    df = spark.createDataFrame(rows, "a double, b double")
    m1 = stats.spearman_matrix(df, ["a", "b"]).collect()[0].spearman_r
    m2 = stats.spearman_matrix(df.withColumn("a", F.exp("a")), ["a", "b"]).collect()[0].spearman_r
    assert m1 == pytest.approx(m2, abs=1e-12) and abs(m1) <= 1


def test_anova_matches_numpy(spark):
    groups = {"a": [1.0, 2.0, 3.0, 2.0], "b": [4.0, 5.0, 4.0], "c": [1.0, 1.0, 2.0, 5.0, 3.0]}
    rows = [(g, v) for g, vs in groups.items() for v in vs]
    df = spark.createDataFrame(rows, "g string, rating double")
    out = stats.one_way_anova(df, group_col="g", with_p=True).collect()[0]
    allv = np.concatenate([np.array(v) for v in groups.values()])
    ssb = sum(len(v) * (np.mean(v) - allv.mean()) ** 2 for v in groups.values())
    ssw = sum(((np.array(v) - np.mean(v)) ** 2).sum() for v in groups.values())
    f = (ssb / 2) / (ssw / (len(allv) - 3))
    assert out.f_stat == pytest.approx(f)
    assert out.p_value == pytest.approx(betainc_np((len(allv) - 3) / 2, 1.0, (len(allv) - 3) / ((len(allv) - 3) + 2 * f)))


def test_welch_matches_numpy(spark):
    a = [5.0, 4.0, 5.0, 4.0, 5.0, 3.0, 5.0]
    b = [1.0, 2.0, 1.0, 3.0, 1.0, 2.0]
    rows = [("positive", v) for v in a] + [("negative", v) for v in b]
    df = spark.createDataFrame(rows, "sentiment_label string, rating double")
    out = stats.welch_ttest(df, with_p=True).collect()[0]
    va, vb = np.var(a, ddof=1) / len(a), np.var(b, ddof=1) / len(b)
    assert out.t_stat == pytest.approx((np.mean(a) - np.mean(b)) / math.sqrt(va + vb))
    assert 0 <= out.p_value < 0.001


def test_ols_fit(spark):
    df = spark.createDataFrame([(float(x), 2.0 + 3.0 * x) for x in range(10)], "sentiment_score double, rating double")
    f = stats.ols_fit(df).collect()[0]
    assert (f.intercept, f.slope, f.r2) == (pytest.approx(2.0), pytest.approx(3.0), pytest.approx(1.0))
    assert stats.ols_line(stats.ols_fit(df)).count() == 100


def test_strength_labels_from_report(spark):
    # Labels re-derived from the committed sample report: .299 → MUY DEBIL, .332 → DEBIL, .992 → FUERTE
    df = spark.createDataFrame([(0.299, 0.0), (0.332, 0.0), (0.992, 0.0), (-0.6, 0.01), (0.9, 0.2)], "spearman_r double, spearman_p double")
    out = [r.strength for r in stats.correlation_report(df).collect()]
    assert out == ["MUY DEBIL", "DEBIL", "FUERTE", "MODERADA", "NO SIGNIFICATIVA"]


# ------------------------------------------------------------------ segments

def test_segments_last_match_wins(spark):
    df = spark.createDataFrame([("444",), ("333",), ("222",), ("233",), ("412",), ("141",)], "s string")
    got = [r[0] for r in df.select(segments.segment_expr(F.col("s"))).collect()]
    assert got == ["Loyal Customers", "Potential Loyalists", "Lost Customers", "At Risk", "New Customers", "141"]
    first = [r[0] for r in df.select(segments.segment_expr(F.col("s"), precedence="first")).collect()]
    assert first[0] == "Champions"


def test_quartile_score_equals_qcut(spark):
    vals = [1.0, 3.0, 7.0, 9.0, 12.0, 15.0, 20.0, 21.0, 30.0, 31.0, 40.0, 50.0]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    edges = df.select(F.percentile("x", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))).scalar()
    got = [r[0] for r in df.select(segments.quartile_score(F.col("x"), edges)).collect()]
    assert got == list(pd.qcut(pd.Series(vals), 4, labels=[1, 2, 3, 4]).astype(int))


def test_alerts_and_insights(spark):
    rows = [(1.0, "negative", -0.5)] * 4 + [(5.0, "positive", 0.5)] * 6
    df = spark.createDataFrame(rows, "rating double, sentiment_label string, sentiment_score double")
    a = {r.severity: r.fired for r in segments.alerts(df).collect()}
    assert a == {"CRITICO": True, "ALTA": True, "INFO": True}
    i = {r.insight: r.fired for r in segments.insights(df).collect()}
    assert i["many_negative"] and not i["mostly_positive"] and not i["high_rating"]


# ------------------------------------------------------------------ ML (K1–K8)

def test_clusters_recover_separated_groups(spark):
    from glossa.operators import ml

    rng = np.random.default_rng(3)
    centers = [(0, 0, 0), (10, 0, 0), (0, 10, 0), (0, 0, 10)]
    rows = []
    for g, c in enumerate(centers):
        for _ in range(25):
            x = np.array(c) + rng.normal(0, 0.3, 3)
            rows.append((g, float(x[0]), float(x[1]), float(x[2])))
    df = spark.createDataFrame(rows, "g int, rating double, sentiment_score double, text_length double")
    out, info = ml.cluster_reviews(df, n_init=3)
    pairs = out.groupBy("g").agg(F.countDistinct("user_cluster").alias("k"), F.count("*").alias("n")).collect()
    assert all(r.k == 1 and r.n == 25 for r in pairs)  # every group maps to one cluster
    assert out.select("user_cluster").distinct().count() == 4
    assert 0.9 < info["variance_explained"] <= 1.0 + 1e-9


def test_too_few_features_single_cluster(spark):
    from glossa.operators import ml

    df = spark.createDataFrame([(1.0, 2.0)], "rating double, other double")
    out, info = ml.cluster_reviews(df)
    assert out.collect()[0].user_cluster == 0 and info["n_clusters"] == 1


def test_social_rating_model_linear(spark):
    from glossa.operators import ml

    days = [f"2024-01-{d:02d}" for d in range(1, 29)] + [f"2024-02-{d:02d}" for d in range(1, 29)]
    daily = spark.createDataFrame([(d, 1.0 + 0.05 * i) for i, d in enumerate(days)], "date string, avg_rating double")
    pivot = spark.createDataFrame([(d, float(i), float(i % 5)) for i, d in enumerate(days)], "date string, m_a double, e_a double")
    metrics, coefs = ml.social_rating_model(daily.withColumn("date", F.to_date("date")), pivot.withColumn("date", F.to_date("date")))
    m = metrics.collect()[0]
    assert m.r2 > 0.999 and m.grade == "good" and m.top_feature == "m_a" and m.top_sign == "positive"
    assert m.n_train + m.n_test == m.n_days == 56
    assert coefs.first().feature == "m_a"
    small, _ = ml.social_rating_model(daily.limit(5).withColumn("date", F.to_date("date")), pivot.withColumn("date", F.to_date("date")))
    assert small.count() == 0  # fewer than 20 joined days


# ------------------------------------------------------------------ small predicates and lookups

def test_contains_ci_and_prefix_match(spark):
    df = spark.createDataFrame([("Hello World",), (None,), ("444",)], "t string")
    out = df.select(filters.contains_ci("t", "WORLD").alias("c"), filters.matches_prefix("t", "[3-4][3-4]").alias("m")).collect()
    assert [(r.c, r.m) for r in out] == [(True, False), (False, False), (False, True)]


def test_tag_query_filters_language_and_retweets(spark):
    rows = [(1, "en", False), (2, "es", False), (3, "en", True), (4, "en", None)]
    df = spark.createDataFrame(rows, "tweet_id long, lang string, is_retweet boolean")
    out = social.tag_query(df, hashtag="skincare", platform="twitter").collect()
    assert sorted(r.tweet_id for r in out) == [1, 4]
    assert {(r.hashtag, r.platform) for r in out} == {("#skincare", "twitter")}


def test_lookup_authors_unknown(spark):
    tweets = spark.createDataFrame([(1, "a"), (2, "zz")], "tweet_id long, author_id string")
    users = spark.createDataFrame([("a", "ana", "Ana")], "author_id string, author_username string, author_name string")
    out = {r.tweet_id: r for r in joins.lookup_authors(tweets, users).collect()}
    assert out[1].author_username == "ana" and out[2].author_username == "unknown" and out[2].author_name == "unknown"


def test_label_shares_sum_to_one(spark):
    df = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "sentiment_label string")
    shares = [r.share for r in marts.label_distribution(df).collect()]
    assert sum(shares) == pytest.approx(1.0)  # normalised over labelled rows (F23)
    shares_all = {r.sentiment_label: r.share for r in marts.label_distribution(df, dropna=False).collect()}
    assert shares_all == {"a": 0.25, "b": 0.5}  # unlabelled rows stay in the total


def test_trend_forecast_and_regime(spark):
    rows = [(f"2024-01-{d:02d}", float(d)) for d in range(1, 31)]
    df = spark.createDataFrame(rows, "review_date string, review_count double").withColumn("review_date", F.to_date("review_date"))
    f = timeseries.trend_forecast(df).orderBy("step").collect()
    assert len(f) == 7 and f[0].forecast_value == pytest.approx(31.0) and str(f[-1].forecast_date) == "2024-02-06"
    r = timeseries.trend_regime(df).collect()[0]
    assert r.trend_direction == "increasing" and r.last_recent_avg == pytest.approx(27.0) and r.last_history_avg == pytest.approx(15.5)
    assert r.regime == "up"


# ------------------------------------------------------------------ dirty rows and sizes

def test_sums_beyond_64_bit_units_and_small_means(spark):
    from glossa.functions.numeric import exact_sum, r3, stable_avg, stable_sum

    df = spark.createDataFrame([(9.3e12,), (9.3e12,), (0.01,)], "x double")
    assert df.agg(stable_sum("x")).first()[0] == 18600000000000.01
    assert str(df.agg(exact_sum("x")).first()[0]) == "18600000000000.010000000000"
    assert spark.createDataFrame([(0.0014999996,)], "x double").agg(r3(stable_avg("x"))).first()[0] == 0.001


def test_few_reviews_cluster(spark):
    from glossa.operators import ml

    for n in (1, 2, 3):
        rows = [(float(k), float(k) / 2, float(k), float(k)) for k in range(n)]
        df = spark.createDataFrame(rows, "rating double, sentiment_score double, text_word_count double, text_length double")
        out, info = ml.cluster_reviews(df, n_init=1)
        assert out.count() == n and info["n_clusters"] <= n


def test_checkpoint_folder_must_be_shared_on_a_cluster():
    from glossa.session import ensure_checkpoint_dir

    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "yarn"}.get(key, default)

    class Session:
        conf = Conf()

    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(Session())


def test_spearman_of_constant_wide_and_negative_columns(spark):
    import numpy as np

    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(size=200) * 10.0 ** rng.integers(-9, 9, 200), [0.0, 0.0, -1.0, 1.0]])
    y = np.round(x + rng.normal(size=204), 1)
    df = spark.createDataFrame([(float(a), float(b), 7.0) for a, b in zip(x, y)], "x double, y double, z double")
    got = {(r.var_x, r.var_y): r.spearman_r for r in stats.spearman_matrix(df, ["x", "y", "z"]).collect()}
    assert got["x", "y"] == pytest.approx(pd.Series(x).rank().corr(pd.Series(y).rank()), abs=1e-12)
    assert got["x", "z"] is None and got["y", "z"] is None


def test_offending_bounds_are_numbers(spark):
    df = spark.createDataFrame([(10.0, 0.0, "positive", "a long text"), (9.0, 0.0, "positive", None), (-2.0, 0.0, None, "x")], "rating double, sentiment_score double, sentiment_label string, review_text string")
    got = {(r.check, r.column): r.observed for r in quality.validation_checks(df).collect()}
    assert got["rating_range", "rating"] == "3: -2.0..10.0"
    listed = {(r.column, r.value): r.n for r in quality.validation_offenders(df).collect()}
    assert listed == {("rating", "10.0"): 1, ("rating", "9.0"): 1, ("rating", "-2.0"): 1, ("sentiment_label", None): 1}
