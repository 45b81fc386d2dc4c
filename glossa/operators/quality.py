"""Data-quality operators: ingestion report, completeness, duplicates, consistency,
text-length stats (F27–F31) and the validation checks V1–V9.

Each report is one aggregation pass (partial aggregates per task, one tiny
final merge); results are long tables ``check, column, status, observed``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossa.functions.numeric import safe_div

REQUIRED_COLUMNS = ("review_text", "rating", "sentiment_score", "sentiment_label")
LABELS = ("positive", "negative", "neutral")


def ingestion_report(reviews: DataFrame, products: DataFrame | None = None, *, date_col: str = "submission_time") -> DataFrame:
    """rows, distinct products, submission-time range, rating mean/min/max, brands of the dimension."""
    r = F.col("rating").cast("string").try_cast("double")
    aggs = [
        F.count(F.lit(1)).alias("total_rows"),
        F.countDistinct("product_id").alias("unique_products"),
        F.avg(r).alias("avg_rating"),
        F.min(r).alias("min_rating"),
        F.max(r).alias("max_rating"),
    ]
    if date_col in reviews.columns:
        aggs += [F.min(date_col).alias("first_submission"), F.max(date_col).alias("last_submission")]
    out = reviews.agg(*aggs)
    if products is not None and "brand_name" in products.columns:
        out = out.withColumn("unique_brands", products.select(F.countDistinct("brand_name")).scalar())
    return out


def completeness(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``100 * (1 - nulls / cells)`` over all (or the given) columns, one pass."""
    cols = list(columns or df.columns)
    nulls = sum((F.sum(F.col(c).isNull().cast("long")) for c in cols), F.lit(0))
    return df.agg(F.count(F.lit(1)).alias("n_rows"), nulls.alias("n_nulls")).select(
        "n_rows",
        "n_nulls",
        (F.lit(len(cols)) * F.col("n_rows")).alias("n_cells"),
        ((1 - safe_div(F.col("n_nulls"), F.lit(len(cols)) * F.col("n_rows"))) * 100).alias("completeness_pct"),
    )


def duplicates(df: DataFrame, cols: Sequence[str] = ("rating", "sentiment_score", "sentiment_label")) -> DataFrame:
    """rows that repeat an earlier row on ``cols`` (all but the first of each group).

    groupBy with a partial count per task, so a group holding a third of all rows
    costs one row per task in the shuffle. NULLs group together, as in pandas.
    """
    groups = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(
        F.sum(F.col("n") - 1).alias("duplicate_rows"),
        F.count(F.lit(1)).alias("distinct_rows"),
        F.sum("n").alias("total_rows"),
    )


def consistency(df: DataFrame, *, label: str = "positive", min_rating: float = 4.0) -> DataFrame:
    """% of all rows with the positive label and rating >= 4."""
    ok = (F.col("sentiment_label") == label) & (F.col("rating") >= min_rating)
    return df.agg((F.avg(F.coalesce(ok, F.lit(False)).cast("double")) * 100).alias("consistency_pct"))


def text_length_stats(df: DataFrame, *, text_col: str = "cleaned_text", short: int = 10, long: int = 1000) -> DataFrame:
    """mean and max text length, texts shorter than ``short`` and longer than ``long``."""
    n = F.length(text_col)
    return df.agg(
        F.avg(n).alias("avg_length"),
        F.max(n).alias("max_length"),
        F.count_if(n < short).alias("n_short"),
        F.count_if(n > long).alias("n_long"),
    )


def _row(check: str, column: str, ok, observed) -> F.Column:
    return F.struct(
        F.lit(check).alias("check"),
        F.lit(column).alias("column"),
        F.when(ok, "pass").otherwise("fail").alias("status"),
        observed.cast("string").alias("observed"),
    )


def _bounds(bad, column: str, name: str) -> list:
    """Smallest and largest offending value, compared as what they are and not as text; ``null`` if only nulls offend."""
    text = lambda v: F.coalesce(v.cast("string"), F.lit("null"))
    return [text(F.min(F.when(bad, F.col(column)))).alias(f"{name}_lo"), text(F.max(F.when(bad, F.col(column)))).alias(f"{name}_hi")]


def validation_offenders(df: DataFrame, *, labels: Sequence[str] = LABELS) -> DataFrame:
    """V3–V5: every offending value with its number of rows: ``check, column, value, n``.

    One pass: a row gives an entry for each of its offending columns, counted by value.
    """
    tests = (
        ("rating_range", "rating", F.col("rating").between(1, 5)),
        ("sentiment_range", "sentiment_score", F.col("sentiment_score").between(-1, 1)),
        ("label_values", "sentiment_label", F.col("sentiment_label").isin(list(labels))),
    )
    rows = [
        F.when(~F.coalesce(ok, F.lit(False)), F.struct(F.lit(check).alias("check"), F.lit(c).alias("column"), F.col(c).cast("string").alias("value")))
        for check, c, ok in tests
        if c in df.columns
    ]
    return df.select(F.inline(F.array_compact(F.array(*rows)))).groupBy("check", "column", "value").agg(F.count(F.lit(1)).alias("n"))


def validation_checks(
    df: DataFrame,
    *,
    required: Sequence[str] = REQUIRED_COLUMNS,
    labels: Sequence[str] = LABELS,
    min_text: int = 10,
) -> DataFrame:
    """V1–V7, V9 in one aggregation pass → long table ``check, column, status, observed``.

    Offenders are reported as their exact count and the smallest / largest bad
    value (bounded aggregate state, whatever the number of offending rows).
    """
    present = set(df.columns)
    rows = []
    for c in required:  # V1: schema check on the driver, no data pass
        rows.append(_row("required_column", c, F.lit(c in present), F.lit("present" if c in present else "missing")))
    aggs = []
    crit = [c for c in required if c in present]
    for c in crit:  # V2
        aggs.append(F.count_if(F.col(c).isNull()).alias(f"null_{c}"))
    if "rating" in present:  # V3
        bad = ~F.coalesce(F.col("rating").between(1, 5), F.lit(False))
        aggs += [F.count_if(bad).alias("bad_rating"), *_bounds(bad, "rating", "bad_rating")]
    if "sentiment_score" in present:  # V4
        bad = ~F.coalesce(F.col("sentiment_score").between(-1, 1), F.lit(False))
        aggs += [F.count_if(bad).alias("bad_sentiment"), *_bounds(bad, "sentiment_score", "bad_sentiment")]
    if "sentiment_label" in present:  # V5
        bad = ~F.coalesce(F.col("sentiment_label").isin(list(labels)), F.lit(False))
        aggs += [F.count_if(bad).alias("bad_label"), F.min(F.when(bad, F.coalesce(F.col("sentiment_label"), F.lit("null")))).alias("bad_label_lo"), F.max(F.when(bad, F.coalesce(F.col("sentiment_label"), F.lit("null")))).alias("bad_label_hi")]
    if "review_text" in present:  # V6, V7
        aggs += [
            F.count_if(F.col("review_text").isNull()).alias("null_texts"),
            F.count_if(F.length("review_text") < min_text).alias("short_texts"),
        ]
    for c in ("rating", "sentiment_score"):  # V9
        if c in present:
            aggs += [
                F.avg(c).alias(f"mean_{c}"),
                F.stddev_samp(c).alias(f"std_{c}"),
                F.min(c).alias(f"min_{c}"),
                F.max(c).alias(f"max_{c}"),
            ]
    one = df.agg(*aggs) if aggs else None
    if one is None:
        return df.sparkSession.createDataFrame([], "check string, column string, status string, observed string").unionByName(
            df.sparkSession.range(1).select(F.inline(F.array(*rows)))
        )

    def offenders(prefix):
        return F.concat_ws("..", F.col(f"{prefix}_lo"), F.col(f"{prefix}_hi"))

    for c in crit:
        rows.append(_row("null_count", c, F.col(f"null_{c}") == 0, F.col(f"null_{c}")))
    if "rating" in present:
        rows.append(_row("rating_range", "rating", F.col("bad_rating") == 0, F.when(F.col("bad_rating") == 0, F.lit("0")).otherwise(F.concat(F.col("bad_rating").cast("string"), F.lit(": "), offenders("bad_rating")))))
    if "sentiment_score" in present:
        rows.append(_row("sentiment_range", "sentiment_score", F.col("bad_sentiment") == 0, F.when(F.col("bad_sentiment") == 0, F.lit("0")).otherwise(F.concat(F.col("bad_sentiment").cast("string"), F.lit(": "), offenders("bad_sentiment")))))
    if "sentiment_label" in present:
        rows.append(_row("label_values", "sentiment_label", F.col("bad_label") == 0, F.when(F.col("bad_label") == 0, F.lit("0")).otherwise(F.concat(F.col("bad_label").cast("string"), F.lit(": "), offenders("bad_label")))))
    if "review_text" in present:
        rows.append(_row("null_texts", "review_text", F.col("null_texts") == 0, F.col("null_texts")))
        rows.append(_row("short_texts", "review_text", F.col("short_texts") == 0, F.col("short_texts")))
    for c in ("rating", "sentiment_score"):
        if c in present:
            for stat in ("mean", "std", "min", "max"):
                v = F.col(f"{stat}_{c}")
                rows.append(_row(f"{stat}", c, F.lit(True), F.format_string("%.6f", v)))
    return one.select(F.inline(F.array(*rows)))


def cluster_distribution(df: DataFrame, *, key: str = "user_cluster") -> DataFrame:
    """V8: rows per cluster."""
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
