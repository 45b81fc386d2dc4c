"""Physical-plan properties of the registered queries (static plans, AQE off so the
plan is the one Catalyst picks before runtime re-planning)."""

import re

import pytest

from glossa.plans.registry import all_queries

SF = "/root/testdata/sf0.001"
QUERIES = all_queries()
PVALUE_QUERIES = {"correlation_document", "correlation_strength", "platform_recommendations", "statistical_tests", "correlation_report_lines", "alerts", "correlation_pvalues", "lag_pvalues"}
SKIP = {"review_clusters", "cluster_info", "social_rating_model", "social_rating_coefficients", "tweet_stream_daily", "negative_share_alerts"}


@pytest.fixture(scope="module")
def static(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield spark
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def plan_of(spark, name):
    df = QUERIES[name].build(spark, SF)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n not in SKIP))
def test_no_cartesian_no_row_udf(static, name):
    plan = plan_of(static, name)
    assert "CartesianProduct" not in plan
    assert "BatchEvalPython" not in plan  # no row-at-a-time Python UDF anywhere
    if name not in PVALUE_QUERIES:
        assert "ArrowEvalPython" not in plan


def test_filters_and_projection_reach_the_scan(static):
    plan = plan_of(static, "filter_reviews")
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(p_brand,Brand#12\)", plan)
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(l_shipdate", plan)
    plan = plan_of(static, "product_metrics")
    lineitem_schema = re.search(r"ReadSchema: struct<(l_[^>]*)>", plan).group(1)
    assert "l_tax" not in lineitem_schema and "l_extendedprice" not in lineitem_schema


def test_aggregates_are_partial_before_the_shuffle(static):
    plan = plan_of(static, "brand_summary")
    assert "partial_" in plan
    first_exchange = plan.index("Exchange")
    assert plan.find("partial_", first_exchange) > first_exchange  # a partial agg sits below the exchange


def test_text_work_is_row_local(static):
    for name in ("clean_text", "text_features", "keyword_category", "extract_hashtags"):
        plan = plan_of(static, name)
        assert "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan, name


def test_sentiment_and_spearman_build_without_jobs(static):
    from glossa.operators import sentiment, stats

    tracker = static.sparkContext.statusTracker()
    reviews = static.range(1000).selectExpr("id", "cast(id % 7 as double) AS x", "cast(id % 5 as double) AS y", "'good day' AS t")
    static.sparkContext.setJobGroup("build", "building plans")
    try:
        sentiment.analyze(reviews, text_col="t", lexicon=reviews.selectExpr("t AS token", "x AS valence"))
        stats.spearman_matrix(reviews, ["x", "y"])
        assert list(tracker.getJobIdsForGroup("build")) == []
    finally:
        static.sparkContext.setJobGroup("", "")


def test_one_scan_of_the_rows(static):
    for name, table in (("anova_brand", "l_partkey"), ("anova_category", "l_partkey"), ("social_kpis", "o_orderdate"), ("hashtag_engagement_top", "l_extendedprice")):
        plan = plan_of(static, name)
        assert len(re.findall(rf"ReadSchema: struct<[^>]*{table}", plan)) == 1, name


def test_only_bounded_sides_are_broadcast_by_hint(static):
    # hashtag impact: the keyword side is a top-10 (TakeOrderedAndProject) under the broadcast
    plan = plan_of(static, "hashtag_impact")
    assert "BroadcastNestedLoopJoin" in plan and "TakeOrderedAndProject" in plan
