"""Review marts: daily, product, brand, category, cluster summaries and distributions.

Each is one ``groupBy().agg()`` — Spark runs a partial (map-side) aggregate
before the shuffle, so a hot key (one brand with a third of all reviews)
costs one pre-aggregated row per task, not a third of the data in one task.
Distinct counts are planned by Spark as a two-level aggregate keyed first on
(group, value), which also spreads a hot group over many tasks.
Null grouping keys are dropped (pandas' groupby default).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from glossa.functions.numeric import r3, safe_div, stable_avg, top_k

# Product classes of the processing job (first matching rule wins).
# (label, min_avg, max_avg_exclusive, max_avg_inclusive, min_count, max_std)
PRODUCT_RULES = (
    ("high_performer", 4.0, None, None, 5, 1.0),
    ("low_performer", None, None, 2.0, 3, None),
    ("average_performer", 3.0, 4.0, None, 2, None),
)
PRODUCT_DEFAULT = "new_or_low_volume"

# Product classes of the dashboard variant.
PRODUCT_RULES_UI = (
    ("alto_desempeno", 4.0, None, None, 2, None),
    ("bajo_desempeno", None, None, 2.0, 1, None),
    ("desempeno_promedio", 3.0, 4.0, None, None, None),
)
PRODUCT_DEFAULT_UI = "nuevo_o_bajo_volumen"


def _nonnull(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    cond = None
    for k in keys:
        c = F.col(k).isNotNull()
        cond = c if cond is None else cond & c
    return df.filter(cond) if cond is not None else df


def daily_metrics(
    reviews: DataFrame,
    *,
    date_col: str = "review_date",
    rating_col: str = "rating",
    sentiment_col: str = "sentiment_score",
    partition_cols: Sequence[str] = (),
    rounded: bool = True,
) -> DataFrame:
    """F1 (rounded to 3, the processing job) / F12 (unrounded, for correlation).

    Mean and count of rating, mean sentiment per day. ``review_count`` counts
    non-null ratings, like pandas ``count``.
    """
    keys = [*partition_cols, date_col]
    rnd = r3 if rounded else (lambda c: c)
    return _nonnull(reviews, keys).groupBy(*keys).agg(
        rnd(stable_avg(rating_col)).alias("avg_rating"),
        F.count(rating_col).alias("review_count"),
        rnd(stable_avg(sentiment_col)).alias("avg_sentiment"),
    )


def _rule_expr(avg: Column, n: Column, std: Column | None, rules, default: str) -> Column:
    expr = None
    for label, lo, hi_ex, hi_in, min_n, max_std in rules:
        cond = F.lit(True)
        if lo is not None:
            cond = cond & (avg >= lo)
        if hi_ex is not None:
            cond = cond & (avg < hi_ex)
        if hi_in is not None:
            cond = cond & (avg <= hi_in)
        if min_n is not None:
            cond = cond & (n >= min_n)
        if max_std is not None and std is not None:
            # NULL std (one review) is not <= 1, as in pandas.
            cond = cond & F.coalesce(std <= max_std, F.lit(False))
        cond = F.coalesce(cond, F.lit(False))
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(default) if expr is not None else F.lit(default)


def product_metrics(
    reviews: DataFrame,
    *,
    key: str = "product_id",
    user_col: str | None = "user_id",
    rules=PRODUCT_RULES,
    default: str = PRODUCT_DEFAULT,
) -> DataFrame:
    """Per product mean/count/std rating, mean sentiment, distinct users (r3),
    performance class on the rounded values, and ``product_score = avg * ln(1+n)``."""
    users = F.countDistinct(user_col) if user_col and user_col in reviews.columns else F.lit(None).cast("long")
    agg = _nonnull(reviews, [key]).groupBy(key).agg(
        r3(stable_avg("rating")).alias("avg_rating"),
        F.count("rating").alias("review_count"),
        r3(F.stddev_samp("rating")).alias("rating_std"),
        r3(stable_avg("sentiment_score")).alias("avg_sentiment"),
        users.alias("unique_users"),
    )
    return agg.withColumn(
        "performance_category",
        _rule_expr(F.col("avg_rating"), F.col("review_count"), F.col("rating_std"), rules, default),
    ).withColumn("product_score", F.col("avg_rating") * F.log1p(F.col("review_count")))


def product_metrics_ui(
    reviews: DataFrame,
    *,
    key: str = "product_id",
    name_col: str = "product_name",
    rules=PRODUCT_RULES_UI,
    default: str = PRODUCT_DEFAULT_UI,
) -> DataFrame:
    """F5 + E5: dashboard product metrics with a product name folded into the aggregate.

    "First name" has no meaning without row order; the smallest name is taken.
    Without a name column the id is used as the name.
    """
    name = F.min(name_col) if name_col in reviews.columns else F.first(F.col(key).cast("string"))
    agg = _nonnull(reviews, [key]).groupBy(key).agg(
        r3(stable_avg("rating")).alias("avg_rating"),
        F.count("rating").alias("review_count"),
        r3(stable_avg("sentiment_score")).alias("avg_sentiment"),
        name.alias("product_name"),
    )
    return agg.withColumn(
        "performance_category", _rule_expr(F.col("avg_rating"), F.col("review_count"), None, rules, default)
    )


def brand_summary(reviews: DataFrame, *, key: str = "brand_name", full: bool = True) -> DataFrame:
    """F6 (full) / F7 (dashboard: no std, no users).

    Two distinct counts in one aggregate would hold every row twice with all its sums and moments, so
    the ids are counted beside it, from distinct (key, id) rows of nothing else.
    """
    rows = _nonnull(reviews, [key])
    aggs = [
        r3(stable_avg("rating")).alias("avg_rating"),
        F.count("rating").alias("review_count"),
    ]
    if full:
        aggs.append(r3(F.stddev_samp("rating")).alias("rating_std"))
    aggs.append(r3(stable_avg("sentiment_score")).alias("avg_sentiment"))
    if not full or "user_id" not in reviews.columns:
        users = [F.lit(None).cast("long").alias("unique_users")] if full else []
        return rows.groupBy(key).agg(*aggs, F.countDistinct("product_id").alias("product_count"), *users)
    product, user = F.col("product_id").alias("_product"), F.col("user_id").alias("_user")
    each = F.array(F.struct(product, F.lit(None).cast(reviews.schema["user_id"].dataType).alias("_user")), F.struct(F.lit(None).cast(reviews.schema["product_id"].dataType).alias("_product"), user))
    ids = rows.select(key, F.inline(each)).distinct()
    counts = ids.groupBy(key).agg(F.count("_product").alias("product_count"), F.count("_user").alias("unique_users"))
    return rows.groupBy(key).agg(*aggs).join(counts, key)


def category_summary(reviews: DataFrame, *, key: str = "primary_category", text_col: str = "review_text") -> DataFrame:
    """F8: per category mean rating, mean sentiment, distinct products, review count (r3).

    ``review_count`` counts non-null texts; without a text column it counts rows.
    """
    cnt = F.count(text_col) if text_col in reviews.columns else F.count(F.lit(1))
    return (
        _nonnull(reviews, [key])
        .groupBy(key)
        .agg(
            r3(stable_avg("rating")).alias("avg_rating"),
            r3(stable_avg("sentiment_score")).alias("avg_sentiment"),
            F.countDistinct("product_id").alias("product_count"),
            cnt.alias("review_count"),
        )
        .withColumnRenamed(key, "category")
    )


def cluster_summary(reviews: DataFrame, *, key: str = "user_cluster") -> DataFrame:
    """per cluster mean/count rating, mean sentiment, word count, intensity (r3)."""
    return (
        _nonnull(reviews, [key])
        .groupBy(key)
        .agg(
            r3(stable_avg("rating")).alias("avg_rating"),
            F.count("rating").alias("review_count"),
            r3(stable_avg("sentiment_score")).alias("avg_sentiment"),
            r3(stable_avg("text_word_count")).alias("avg_word_count"),
            r3(stable_avg("sentiment_intensity")).alias("avg_sentiment_intensity"),
        )
        .withColumnRenamed(key, "cluster")
    )


def cluster_view(reviews: DataFrame, *, key: str = "user_cluster") -> DataFrame:
    """dashboard cluster table with flattened names ``rating_mean`` etc."""
    return (
        _nonnull(reviews, [key])
        .groupBy(key)
        .agg(
            r3(stable_avg("rating")).alias("rating_mean"),
            F.count("rating").alias("rating_count"),
            r3(stable_avg("sentiment_score")).alias("sentiment_score_mean"),
        )
    )


CATEGORY_PREFERENCE = ("primary_category", "secondary_category", "brand_name")


def sentiment_by_category(reviews: DataFrame, *, key: str | None = None, k: int | None = None) -> DataFrame:
    """F11 (+ H5 with ``k``): mean sentiment, mean rating, count per category.

    ``key`` defaults to the first present of primary/secondary category, brand.
    """
    if key is None:
        key = next(c for c in CATEGORY_PREFERENCE if c in reviews.columns)
    agg = (
        _nonnull(reviews, [key])
        .groupBy(key)
        .agg(
            F.avg("sentiment_score").alias("avg_sentiment"),
            F.avg("rating").alias("avg_rating"),
            F.count("sentiment_score").alias("review_count"),
        )
        .withColumnRenamed(key, "category")
    )
    if k is not None:
        agg = top_k(agg, k, [F.col("avg_sentiment").desc(), F.col("category").asc()])
    return agg


def review_kpis(reviews: DataFrame) -> DataFrame:
    """rows, mean rating, mean sentiment, distinct products / brands / categories."""
    return reviews.agg(
        F.count(F.lit(1)).alias("total_reviews"),
        F.avg("rating").alias("avg_rating"),
        F.avg("sentiment_score").alias("avg_sentiment"),
        F.countDistinct("product_id").alias("unique_products"),
        F.countDistinct("brand_name").alias("unique_brands"),
        F.countDistinct("primary_category").alias("unique_categories"),
    )


def label_distribution(df: DataFrame, *, label_col: str = "sentiment_label", dropna: bool = True) -> DataFrame:
    """Count and share per label, in one pass.

    ``dropna=True`` (F23, normalised value counts): shares over the labelled rows,
    summing to 1. ``dropna=False`` (F44): shares over all rows, unlabelled ones
    included in the total. The total is a window over the per-label counts (one
    row per label), so the input is scanned once.
    """
    counts = df.groupBy(label_col).agg(F.count(F.lit(1)).alias("n"))
    if dropna:
        counts = counts.filter(F.col(label_col).isNotNull())
    total = F.sum("n").over(Window.partitionBy())
    return counts.withColumn("share", safe_div(F.col("n"), total)).filter(F.col(label_col).isNotNull())


def value_distribution(df: DataFrame, *, col: str = "rating") -> DataFrame:
    """Count per value."""
    return df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))


def histogram(df: DataFrame, *, col: str, bins: int = 20, lo: float | None = None, hi: float | None = None) -> DataFrame:
    """fixed-width histogram with ``bins`` bins over [lo, hi] (data range by default).

    The range is one global min/max aggregate used as scalar subqueries; the top
    edge falls into the last bin.
    """
    x = F.col(col)
    rng = df.agg(F.struct(F.min(x).alias("lo"), F.max(x).alias("hi"))).scalar()  # one pass for both bounds
    lo_c = F.lit(lo) if lo is not None else rng["lo"]
    hi_c = F.lit(hi) if hi is not None else rng["hi"]
    width = safe_div(hi_c - lo_c, F.lit(float(bins)))
    b = F.coalesce(F.floor(safe_div(x - lo_c, width)), F.lit(0))
    b = F.least(F.greatest(b, F.lit(0)), F.lit(bins - 1))
    return (
        df.filter(x.isNotNull() & (x >= lo_c) & (x <= hi_c))
        .groupBy(b.cast("int").alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("bin_lo", lo_c + F.col("bin") * width)
        .withColumn("bin_hi", lo_c + (F.col("bin") + 1) * width)
    )


def top_brands(reviews: DataFrame, *, k: int = 10) -> DataFrame:
    """H2: top-k brands by mean rating and by volume, as one long table ``ranking, rank``."""
    summary = brand_summary(reviews, full=False)
    by_rating = top_k(summary, k, [F.col("avg_rating").desc(), F.col("brand_name").asc()])
    by_volume = top_k(summary, k, [F.col("review_count").desc(), F.col("brand_name").asc()])
    return by_rating.withColumn("ranking", F.lit("rating")).unionByName(by_volume.withColumn("ranking", F.lit("volume")))


def top_products(reviews: DataFrame, *, k: int = 10) -> DataFrame:
    """H3: top-k products by mean rating (ties by product id)."""
    return top_k(product_metrics_ui(reviews), k, [F.col("avg_rating").desc(), F.col("product_id").asc()])


def top_groups_by_count(df: DataFrame, key: str, k: int = 5) -> DataFrame:
    """H7: the k largest groups by row count (ties by key)."""
    counts = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return top_k(counts, k, [F.col("n").desc(), F.col(key).asc()])
