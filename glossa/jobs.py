"""End-to-end batch jobs: ingest → transform (processed reviews + marts) →
correlate (report) → validate. One SparkSession; each stage is a function of
DataFrames; Parquet only at the durable points.

The transform job builds one lazy plan up to the clustering step, checkpoints
it to the shared checkpoint folder (the k-means fits and the five marts all
read it), and writes the processed table partitioned by review month.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glossa.operators import joins, marts, ml, quality, report, social, stats, timeseries, valence
from glossa.operators import text as X
from glossa.session import durable, written
from glossa.sources import files


def ingest_job(spark: SparkSession, raw_folder: str, products_path: str | None, out_dir: str) -> dict:
    """Steps A1–A5, E1, E2, F27: combined reviews (Parquet), quarantine list, report."""
    reviews, quarantine = files.read_review_parts(spark, raw_folder)
    products = files.read_products(spark, products_path) if products_path else None
    merged = joins.merge_products(reviews, products)
    files.write_parquet(merged, os.path.join(out_dir, "combined"))
    files.write_parquet(quarantine, os.path.join(out_dir, "quarantine"))
    combined = spark.read.parquet(os.path.join(out_dir, "combined"))
    report = quality.ingestion_report(combined, products)
    if "product_name" in combined.columns:
        report = report.withColumn("match_pct", joins.match_rate(combined).select("match_pct").scalar())
    files.write_parquet(report, os.path.join(out_dir, "ingestion_report"))
    return {"combined": combined, "quarantine": quarantine, "report": report}


def transform_job(spark: SparkSession, combined: DataFrame, out_dir: str, *, n_init: int = 10) -> dict:
    """Steps B*, C*, K1–K5, F1–F9, A7, A8: processed reviews and the five marts."""
    cleaned = X.clean_reviews(combined)
    enriched = X.keyword_insights(valence.analyze(X.categorize(cleaned)))
    featured = X.text_features(enriched).withColumn("text_length", F.length("cleaned_text").cast("long"))
    base = durable(featured)
    clustered, info = ml.cluster_reviews(base, n_init=n_init, checkpoint=False)
    processed = os.path.join(out_dir, "processed")
    files.write_processed(clustered, processed)
    clustered = spark.read.parquet(processed)  # the marts read what was written, not the fits again
    outputs = {}
    if "review_date" in clustered.columns:
        daily = timeseries.rolling_means(marts.daily_metrics(clustered))
        outputs["temporal_metrics"] = daily
    if "product_id" in clustered.columns:
        outputs["product_metrics"] = marts.product_metrics(clustered)
    if "brand_name" in clustered.columns:
        outputs["brand_summary"] = marts.brand_summary(clustered)
    outputs["category_summary"] = marts.category_summary(clustered)
    outputs["cluster_summary"] = marts.cluster_summary(clustered)
    for name, df in outputs.items():
        files.write_parquet(df, os.path.join(out_dir, name))
    outputs["processed"] = clustered
    outputs["cluster_info"] = info
    return outputs


def correlation_job(spark: SparkSession, processed: DataFrame, social_df: DataFrame, out_dir: str) -> DataFrame:
    """Steps J1–J7, E7, A14: correlation table, report table of five sections and its text."""
    daily_r = written(social.daily_reviews(processed), "daily-reviews")
    daily_s = written(social.daily_social(social_df), "daily-social")
    path = os.path.join(out_dir, "correlations")
    files.write_parquet(stats.correlation_report(stats.platform_correlations(daily_r, daily_s, with_p=True)), path)
    corr = spark.read.parquet(path)
    lags = written(stats.lag_correlations(daily_r, daily_s), "lags")
    top = impact = None
    if "hashtag" in social_df.columns and "cleaned_text" in processed.columns:
        top = written(report.top_hashtags(social_df), "top-hashtags")
        impact = written(social.hashtag_impact(processed, social_df), "hashtag-impact")
    document = report.correlation_document(corr, lags, top=top, impact=impact)
    table = os.path.join(out_dir, "correlation_document")
    files.write_parquet(document, table)
    files.write_report(report.as_text(spark.read.parquet(table)), os.path.join(out_dir, "correlation_report"))
    return corr


def validation_job(spark: SparkSession, processed: DataFrame, out_dir: str) -> DataFrame:
    """Steps V1–V9, A15: validation table and the rendered report."""
    checks = quality.validation_checks(processed)
    files.write_parquet(checks, os.path.join(out_dir, "validation"))
    lines = files.report_lines(checks, "%s [%s] %s: %s", ["check", "column", "status", "observed"], ["check", "column"])
    files.write_report(lines, os.path.join(out_dir, "validation_report"))
    return checks
