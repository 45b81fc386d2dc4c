"""Registered queries: filters, product join, data quality, validation."""

from __future__ import annotations

from pyspark.sql import functions as F

from glossa.functions.numeric import r9
from glossa.operators import filters, joins, quality
from glossa.plans.registry import r9 as q9
from glossa.plans.registry import oracle_of, register
from glossa.sources.fixtures import read_table, view, with_views

BRAND = "Brand#12"
CATEGORY = ("primary_category", "MEDIUM")
DATE_RANGE = ("1997-01-01", "1998-12-31")


def reviews(spark, sf_dir):
    return view(spark, sf_dir, "reviews_v")


REVIEW_COLS = "order_id, line_no, user_id, product_id, brand_name, primary_category, rating, sentiment_score, review_date"


@register(
    "filter_reviews",
    covers="D1 D2 D3",
    oracle=with_views(
        f"""SELECT {REVIEW_COLS} FROM reviews_v
WHERE brand_name = '{BRAND}' AND primary_category = '{CATEGORY[1]}'
  AND CAST(review_date AS TIMESTAMP) BETWEEN TIMESTAMP '{DATE_RANGE[0]}' AND TIMESTAMP '{DATE_RANGE[1]}'""",
        "reviews_v",
    ),
)
def filter_reviews(spark, sf_dir):
    f = filters.filter_reviews(reviews(spark, sf_dir), brand=BRAND, category=CATEGORY, date_range=DATE_RANGE)
    return f.selectExpr(*REVIEW_COLS.split(", "))


@register(
    "filter_summary",
    covers="D9",
    oracle=with_views(
        f"""SELECT count(*) AS rows_initial,
       count(*) FILTER (WHERE brand_name = '{BRAND}') AS rows_after_brand,
       count(*) FILTER (WHERE brand_name = '{BRAND}' AND primary_category = '{CATEGORY[1]}') AS rows_after_category,
       count(*) FILTER (WHERE brand_name = '{BRAND}' AND primary_category = '{CATEGORY[1]}'
                        AND CAST(review_date AS TIMESTAMP) BETWEEN TIMESTAMP '{DATE_RANGE[0]}' AND TIMESTAMP '{DATE_RANGE[1]}') AS rows_after_date_range,
       {q9(f"(1 - count(*) FILTER (WHERE brand_name = '{BRAND}' AND primary_category = '{CATEGORY[1]}' AND CAST(review_date AS TIMESTAMP) BETWEEN TIMESTAMP '{DATE_RANGE[0]}' AND TIMESTAMP '{DATE_RANGE[1]}') / count(*)) * 100")} AS reduction_pct
FROM reviews_v""",
        "reviews_v",
    ),
)
def filter_summary(spark, sf_dir):
    s = filters.filter_summary(reviews(spark, sf_dir), brand=BRAND, category=CATEGORY, date_range=DATE_RANGE)
    return s.withColumn("reduction_pct", r9("reduction_pct"))


@register(
    "category_candidates",
    covers="D6 D7",
    oracle=with_views(
        """WITH c AS (
  SELECT 'primary_category' AS column_name, count(DISTINCT primary_category) AS n_distinct, 0 AS ord FROM reviews_v
  UNION ALL SELECT 'brand_name', count(DISTINCT brand_name), 1 FROM reviews_v
  UNION ALL SELECT 'product_name', count(DISTINCT product_name), 2 FROM reviews_v),
k AS (SELECT * FROM c WHERE n_distinct > 1 AND n_distinct <= 50)
SELECT column_name, CAST(n_distinct AS BIGINT) AS n_distinct,
       row_number() OVER (ORDER BY n_distinct DESC, ord) = 1 AS chosen FROM k""",
        "reviews_v",
    ),
)
def category_candidates(spark, sf_dir):
    return filters.category_candidates(reviews(spark, sf_dir))


@register(
    "brand_options",
    covers="D8",
    oracle=with_views(
        """SELECT DISTINCT brand_name FROM reviews_v WHERE brand_name IS NOT NULL""",
        "reviews_v",
    ),
)
def brand_options(spark, sf_dir):
    return filters.option_values(reviews(spark, sf_dir), "brand_name")


@register(
    "review_date_bounds",
    covers="D8",
    oracle=with_views("SELECT min(review_date) AS min_date, max(review_date) AS max_date FROM reviews_v", "reviews_v"),
)
def review_date_bounds(spark, sf_dir):
    return filters.date_bounds(reviews(spark, sf_dir), "review_date")


PRODUCTS_SQL = "SELECT p_partkey AS product_id, p_name AS product_name, p_brand AS brand_name, p_type, p_retailprice FROM part"


def _raw_reviews(spark, sf_dir):
    """Review rows before enrichment (line item + order), with a review-side brand column
    that clashes with the dimension's."""
    li = read_table(spark, sf_dir, "lineitem")
    o = read_table(spark, sf_dir, "orders")
    return li.join(o, li.l_orderkey == o.o_orderkey).select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_no"),
        F.col("l_partkey").alias("product_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderpriority").alias("brand_name"),
    )


def _products(spark, sf_dir):
    p = read_table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_brand").alias("brand_name"),
        "p_type",
        "p_retailprice",
    )


@register(
    "review_product_join",
    covers="E1",
    oracle=f"""WITH r AS (SELECT l_orderkey AS order_id, l_linenumber AS line_no, l_partkey AS product_id,
                  o_custkey AS user_id, o_orderpriority AS brand_name
           FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
p AS ({PRODUCTS_SQL})
SELECT r.*, p.product_name, p.brand_name AS brand_name_product, p.p_type, p.p_retailprice
FROM r LEFT JOIN p ON r.product_id = p.product_id""",
)
def review_product_join(spark, sf_dir):
    return joins.merge_products(_raw_reviews(spark, sf_dir), _products(spark, sf_dir))


@register(
    "join_match_rate",
    covers="E2",
    oracle=f"""WITH r AS (SELECT l_partkey AS product_id FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
p AS ({PRODUCTS_SQL})
SELECT count(*) AS n_rows, count(p.product_name) AS n_matched,
       {q9('avg(CASE WHEN p.product_name IS NOT NULL THEN 1.0 ELSE 0.0 END) * 100')} AS match_pct
FROM r LEFT JOIN p ON r.product_id = p.product_id""",
)
def join_match_rate(spark, sf_dir):
    m = joins.match_rate(joins.merge_products(_raw_reviews(spark, sf_dir), _products(spark, sf_dir)))
    return m.withColumn("match_pct", r9("match_pct"))


@register(
    "ingestion_report",
    covers="F27",
    oracle=f"""WITH r AS (SELECT l_partkey AS product_id, CAST(l_quantity AS VARCHAR) AS rating, l_shipdate AS submission_time
           FROM lineitem)
SELECT count(*) AS total_rows, count(DISTINCT product_id) AS unique_products,
       {q9('avg(TRY_CAST(rating AS DOUBLE))')} AS avg_rating, min(TRY_CAST(rating AS DOUBLE)) AS min_rating,
       max(TRY_CAST(rating AS DOUBLE)) AS max_rating, min(submission_time) AS first_submission,
       max(submission_time) AS last_submission, (SELECT count(DISTINCT p_brand) FROM part) AS unique_brands
FROM r""",
)
def ingestion_report(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("string").alias("rating"),
        F.col("l_shipdate").alias("submission_time"),
    )
    rep = quality.ingestion_report(li, _products(spark, sf_dir))
    return rep.withColumn("avg_rating", r9("avg_rating"))


@register(
    "completeness",
    covers="F28",
    oracle=with_views(
        f"""SELECT count(*) AS n_rows,
       CAST(count(*) FILTER (WHERE brand_name IS NULL) + count(*) FILTER (WHERE product_name IS NULL)
          + count(*) FILTER (WHERE rating IS NULL) + count(*) FILTER (WHERE sentiment_score IS NULL)
          + count(*) FILTER (WHERE review_date IS NULL) AS BIGINT) AS n_nulls,
       5 * count(*) AS n_cells,
       {q9('(1 - (count(*) FILTER (WHERE brand_name IS NULL) + count(*) FILTER (WHERE product_name IS NULL) + count(*) FILTER (WHERE rating IS NULL) + count(*) FILTER (WHERE sentiment_score IS NULL) + count(*) FILTER (WHERE review_date IS NULL)) / (5 * count(*))) * 100')} AS completeness_pct
FROM reviews_v""",
        "reviews_v",
    ),
)
def completeness(spark, sf_dir):
    cols = ["brand_name", "product_name", "rating", "sentiment_score", "review_date"]
    c = quality.completeness(reviews(spark, sf_dir), cols)
    return c.withColumn("completeness_pct", r9("completeness_pct"))


@register(
    "duplicates",
    covers="F29",
    oracle=with_views(
        """WITH g AS (SELECT rating, sentiment_score, sentiment_label, count(*) AS n FROM reviews_v GROUP BY ALL)
SELECT CAST(sum(n - 1) AS BIGINT) AS duplicate_rows, count(*) AS distinct_rows, CAST(sum(n) AS BIGINT) AS total_rows FROM g""",
        "reviews_v",
    ),
)
def duplicates(spark, sf_dir):
    return quality.duplicates(reviews(spark, sf_dir))


@register(
    "consistency",
    covers="F30",
    oracle=with_views(
        f"""SELECT {q9("avg(CASE WHEN sentiment_label = 'positive' AND rating >= 4 THEN 1.0 ELSE 0.0 END) * 100")} AS consistency_pct
FROM reviews_v""",
        "reviews_v",
    ),
)
def consistency(spark, sf_dir):
    return quality.consistency(reviews(spark, sf_dir)).withColumn("consistency_pct", r9("consistency_pct"))


@register(
    "validation_checks",
    covers="V1 V2 V3 V4 V5 V6 V7 V9",
    oracle=with_views(
        """WITH r AS (SELECT *, product_name AS review_text FROM reviews_v),
k AS (SELECT count(*) FILTER (WHERE review_text IS NULL) AS n_text, count(*) FILTER (WHERE rating IS NULL) AS n_rating,
             count(*) FILTER (WHERE sentiment_score IS NULL) AS n_sent, count(*) FILTER (WHERE sentiment_label IS NULL) AS n_label,
             count(*) FILTER (WHERE NOT coalesce(rating BETWEEN 1 AND 5, false)) AS bad_rating,
             count(*) FILTER (WHERE NOT coalesce(sentiment_score BETWEEN -1 AND 1, false)) AS bad_sent,
             count(*) FILTER (WHERE NOT coalesce(sentiment_label IN ('positive', 'negative', 'neutral'), false)) AS bad_label,
             count(*) FILTER (WHERE length(review_text) < 10) AS short_texts,
             avg(rating) AS mean_r, stddev_samp(rating) AS std_r, min(rating) AS min_r, max(rating) AS max_r,
             avg(sentiment_score) AS mean_s, stddev_samp(sentiment_score) AS std_s, min(sentiment_score) AS min_s,
             max(sentiment_score) AS max_s FROM r)
SELECT 'required_column' AS "check", c AS "column", 'pass' AS status, 'present' AS observed
  FROM (VALUES ('review_text'), ('rating'), ('sentiment_score'), ('sentiment_label')) v(c)
UNION ALL SELECT 'null_count', 'review_text', CASE WHEN n_text = 0 THEN 'pass' ELSE 'fail' END, CAST(n_text AS VARCHAR) FROM k
UNION ALL SELECT 'null_count', 'rating', CASE WHEN n_rating = 0 THEN 'pass' ELSE 'fail' END, CAST(n_rating AS VARCHAR) FROM k
UNION ALL SELECT 'null_count', 'sentiment_score', CASE WHEN n_sent = 0 THEN 'pass' ELSE 'fail' END, CAST(n_sent AS VARCHAR) FROM k
UNION ALL SELECT 'null_count', 'sentiment_label', CASE WHEN n_label = 0 THEN 'pass' ELSE 'fail' END, CAST(n_label AS VARCHAR) FROM k
UNION ALL SELECT 'rating_range', 'rating', CASE WHEN bad_rating = 0 THEN 'pass' ELSE 'fail' END, CAST(bad_rating AS VARCHAR) FROM k
UNION ALL SELECT 'sentiment_range', 'sentiment_score', CASE WHEN bad_sent = 0 THEN 'pass' ELSE 'fail' END, CAST(bad_sent AS VARCHAR) FROM k
UNION ALL SELECT 'label_values', 'sentiment_label', CASE WHEN bad_label = 0 THEN 'pass' ELSE 'fail' END, CAST(bad_label AS VARCHAR) FROM k
UNION ALL SELECT 'null_texts', 'review_text', CASE WHEN n_text = 0 THEN 'pass' ELSE 'fail' END, CAST(n_text AS VARCHAR) FROM k
UNION ALL SELECT 'short_texts', 'review_text', CASE WHEN short_texts = 0 THEN 'pass' ELSE 'fail' END, CAST(short_texts AS VARCHAR) FROM k
UNION ALL SELECT 'mean', 'rating', 'pass', printf('%.6f', mean_r) FROM k
UNION ALL SELECT 'std', 'rating', 'pass', printf('%.6f', std_r) FROM k
UNION ALL SELECT 'min', 'rating', 'pass', printf('%.6f', min_r) FROM k
UNION ALL SELECT 'max', 'rating', 'pass', printf('%.6f', max_r) FROM k
UNION ALL SELECT 'mean', 'sentiment_score', 'pass', printf('%.6f', mean_s) FROM k
UNION ALL SELECT 'std', 'sentiment_score', 'pass', printf('%.6f', std_s) FROM k
UNION ALL SELECT 'min', 'sentiment_score', 'pass', printf('%.6f', min_s) FROM k
UNION ALL SELECT 'max', 'sentiment_score', 'pass', printf('%.6f', max_s) FROM k""",
        "reviews_v",
    ),
)
def validation_checks(spark, sf_dir):
    r = reviews(spark, sf_dir).withColumn("review_text", F.col("product_name"))
    return quality.validation_checks(r)


@register(
    "cluster_distribution",
    covers="V8 F25",
    oracle=with_views(
        "SELECT CAST(user_id % 4 AS INTEGER) AS user_cluster, count(*) AS n FROM reviews_v GROUP BY 1", "reviews_v"
    ),
)
def cluster_distribution(spark, sf_dir):
    r = reviews(spark, sf_dir).withColumn("user_cluster", (F.col("user_id") % 4).cast("int"))
    return quality.cluster_distribution(r)


@register(
    "validation_report_lines",
    covers="A15 V1 V2 V3 V4 V5 V6 V7 V9",
    oracle=f"""SELECT "check", "column", printf('%s [%s] %s: %s', "check", "column", status, observed) AS line
FROM ({oracle_of("validation_checks")}) v""",
)
def validation_report_lines(spark, sf_dir):
    from glossa.sources import files

    r = reviews(spark, sf_dir).withColumn("review_text", F.col("product_name"))
    checks = quality.validation_checks(r)
    return files.report_lines(checks, "%s [%s] %s: %s", ["check", "column", "status", "observed"], ["check", "column"])
