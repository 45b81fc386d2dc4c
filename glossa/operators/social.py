"""Social-media operators: daily rollups, platform/hashtag metrics, KPIs, pivot,
hashtag impact on reviews, source precedence (F12–F22, F39–F43, E3, E7, E8, B17–B19).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from glossa.functions import text as T
from glossa.functions.numeric import exact_sum, safe_div, stable_avg, stable_sum, top_k


def daily_reviews(
    reviews: DataFrame, *, date_col: str = "review_date", count_col: str = "product_id", out_date: str = "date"
) -> DataFrame:
    """Unrounded daily mean rating, mean sentiment and count per day."""
    return (
        reviews.filter(F.col(date_col).isNotNull())
        .groupBy(F.to_date(date_col).alias(out_date))
        .agg(
            stable_avg("rating").alias("avg_rating"),
            stable_avg("sentiment_score").alias("avg_sentiment"),
            F.count(count_col).alias("review_count"),
        )
    )


def daily_social(social: DataFrame, *, keys: Sequence[str] = ("date", "platform")) -> DataFrame:
    """F13 / F16 (keys=('date',)): summed mentions and engagement per key."""
    return (
        social.dropna(subset=["date", *keys])  # null keys are no group
        .groupBy(F.to_date("date").alias("date"), *[k for k in keys if k != "date"])
        .agg(F.sum("mention_volume").alias("mention_volume"), stable_sum("engagement").alias("engagement"))
    )


def platform_metrics(social: DataFrame) -> DataFrame:
    """sum and mean of mentions and engagement per platform, rounded to 0 (half-even)."""
    return social.dropna(subset=["platform"]).groupBy("platform").agg(
        F.rint(F.sum("mention_volume")).alias("total_mentions"),
        F.rint(F.avg("mention_volume")).alias("avg_mentions"),
        F.rint(F.sum("engagement")).alias("total_engagement"),
        F.rint(F.avg("engagement")).alias("avg_engagement"),
    )


def hashtag_totals(social: DataFrame, *, k: int | None = None) -> DataFrame:
    """F15 (+ H4 with ``k``): summed mentions and engagement per hashtag (rounded 0)."""
    agg = social.filter(F.col("hashtag").isNotNull()).groupBy("hashtag").agg(
        F.rint(F.sum("mention_volume")).alias("mention_volume"), F.rint(F.sum("engagement")).alias("engagement")
    )
    return top_k(agg, k, [F.col("mention_volume").desc(), F.col("hashtag").asc()]) if k else agg


def hashtag_means(social: DataFrame) -> DataFrame:
    """mean mentions and mean engagement per hashtag."""
    return social.filter(F.col("hashtag").isNotNull()).groupBy("hashtag").agg(
        F.avg("mention_volume").alias("mention_volume"), F.avg("engagement").alias("engagement")
    )


def social_kpis(social: DataFrame) -> DataFrame:
    """total mentions, total engagement, mean of the daily mention sums, top platform.

    One pass over the rows makes a (day, platform) table, two rows at most for each calendar
    day and platform; days, platforms and totals are rolled up from it by grouping sets.
    Rows without a date or platform count in the totals only.
    """
    cells = social.groupBy(F.to_date("date").alias("date"), "platform").agg(F.sum("mention_volume").alias("m"), exact_sum("engagement").alias("e"))
    sets = cells.withColumn("level", F.explode(F.array(F.lit("all"), F.lit("day"), F.lit("platform"))))
    key = F.when(F.col("level") == "day", F.col("date").cast("string")).when(F.col("level") == "platform", F.col("platform"))
    rolled = sets.withColumn("key", key).groupBy("level", "key").agg(F.sum("m").alias("m"), F.sum("e").alias("e"))
    first = F.struct(-F.col("m"), F.col("key"))
    at = lambda level: (F.col("level") == level) & (F.col("key").isNotNull() if level != "all" else F.lit(True))
    return rolled.agg(
        F.max(F.when(at("all"), F.col("m"))).alias("total_mentions"),
        F.max(F.when(at("all"), F.col("e"))).cast("double").alias("total_engagement"),
        F.avg(F.when(at("day"), F.col("m"))).alias("avg_daily_mentions"),
        F.min(F.when(at("platform"), first))["key"].alias("top_platform"),
    )


def tweet_kpis(tweets: DataFrame) -> DataFrame:
    """rows, total engagement, mean sentiment, distinct authors, first/last date."""
    sent = F.avg("sentiment_score") if "sentiment_score" in tweets.columns else F.lit(None).cast("double")
    return tweets.agg(
        F.count(F.lit(1)).alias("n_tweets"),
        F.sum("engagement").alias("total_engagement"),
        sent.alias("avg_sentiment"),
        F.countDistinct("author_id").alias("unique_authors"),
        F.min(F.to_date("created_at")).alias("first_date"),
        F.max(F.to_date("created_at")).alias("last_date"),
    )


def tweets_by_day_label(tweets: DataFrame) -> DataFrame:
    """tweets per (day, sentiment label)."""
    return tweets.dropna(subset=["created_at", "sentiment_label"]).groupBy(F.to_date("created_at").alias("date"), "sentiment_label").agg(F.count(F.lit(1)).alias("n"))


def hashtag_frequency(df: DataFrame, *, list_col: str = "hashtags", k: int = 10) -> DataFrame:
    """explode hashtag lists, count, top ``k`` (ties by hashtag)."""
    counts = (
        df.select(F.explode(F.col(list_col)).alias("hashtag"))
        .groupBy("hashtag")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return top_k(counts, k, [F.col("n").desc(), F.col("hashtag").asc()])


def hashtag_engagement_top(social: DataFrame, *, k: int = 10) -> DataFrame:
    """summed engagement per hashtag, top ``k``, with the number of distinct hashtags."""
    sums = social.filter(F.col("hashtag").isNotNull()).groupBy("hashtag").agg(stable_sum("engagement").alias("engagement"))
    # The number of hashtags is a totals row of the same aggregate, so the rows are read once.
    marked = sums.withColumn("_total", F.explode(F.array(F.lit(False), F.lit(True))))
    key = F.when(~F.col("_total"), F.col("hashtag"))
    both = marked.groupBy("_total", key.alias("hashtag")).agg(F.sum("engagement").alias("engagement"), F.count(F.lit(1)).alias("n"))
    top = top_k(both, k + 1, [F.col("_total").desc(), F.col("engagement").desc(), F.col("hashtag").asc()])
    n_hashtags = F.max(F.when(F.col("_total"), F.col("n"))).over(Window.partitionBy())  # k + 1 rows
    return top.withColumn("n_hashtags", n_hashtags).where(~F.col("_total")).select("hashtag", "engagement", "n_hashtags")


def featured(tweets: DataFrame, *, k: int = 5) -> DataFrame:
    """H8 (re-aimed): the reference shows the first 5 rows of an unordered frame;
    Spark has no row order, so the featured tweets are the top-k by engagement."""
    return top_k(tweets, k, [F.col("engagement").desc(), F.col("tweet_id").asc()])


def rollup_from_tweets(tweets: DataFrame) -> DataFrame:
    """social day rows from tweet rows (each tweet one mention)."""
    tweets = tweets.dropna(subset=["created_at", "hashtag", "platform"])
    return tweets.groupBy(F.to_date("created_at").alias("date"), "hashtag", "platform").agg(
        F.count(F.lit(1)).alias("mention_volume"), F.sum("engagement").alias("engagement")
    )


def weighted_engagement(tweets: DataFrame) -> DataFrame:
    """``likes + 2*retweets + 1.5*replies``."""
    return tweets.withColumn(
        "weighted_engagement", F.col("like_count") + 2 * F.col("retweet_count") + 1.5 * F.col("reply_count")
    )


def plain_engagement(tweets: DataFrame) -> DataFrame:
    """``likes + retweets + replies`` as engagement, one mention each, day of creation."""
    return tweets.withColumns(
        {
            "engagement": (F.col("like_count") + F.col("retweet_count") + F.col("reply_count")).cast("double"),
            "mention_volume": F.lit(1),
            "date": F.to_date("created_at"),
        }
    )


def tag_query(tweets: DataFrame, *, hashtag: str, platform: str, english_only: bool = True) -> DataFrame:
    """Tag rows with the query hashtag and platform; keep English non-retweets."""
    out = tweets
    if english_only and "lang" in tweets.columns:
        out = out.filter(F.col("lang") == "en")
    if "is_retweet" in tweets.columns:
        out = out.filter(~F.coalesce(F.col("is_retweet"), F.lit(False)))
    return out.withColumns({"hashtag": F.lit(f"#{hashtag.lstrip('#')}"), "platform": F.lit(platform)})


def social_pivot(
    social: DataFrame, *, platforms: Sequence[str] | None = None, measures=("mention_volume", "engagement")
) -> DataFrame:
    """(date) x (platform) sums, missing → 0, columns ``<measure>_<platform>``.

    With ``platforms`` given the pivot needs no extra pass; otherwise Spark
    finds the distinct platforms first (bounded by ``spark.sql.pivotMaxValues``).
    """
    daily = daily_social(social)
    grouped = daily.groupBy("date")
    piv = grouped.pivot("platform", list(platforms)) if platforms is not None else grouped.pivot("platform")
    wide = piv.agg(*[F.sum(m).alias(m) for m in measures])
    renames = {}
    for c in wide.columns:
        if c == "date":
            continue
        for m in measures:
            suffix = f"_{m}"
            if c.endswith(suffix):
                renames[c] = f"{m}_{c[: -len(suffix)]}"
    wide = wide.withColumnsRenamed(renames) if len(measures) > 1 else wide
    return wide.na.fill(0)


def hashtag_impact(
    reviews: DataFrame, social: DataFrame, *, text_col: str = "cleaned_text", k: int = 10
) -> DataFrame:
    """F39 + E7: for the top-``k`` hashtags by mean engagement, reviews whose text
    contains the keyword vs the rest: count, mean rating and sentiment, differences.

    The keyword side is a top-k (``k`` rows, a proven bound), broadcast into a
    non-equi join, so every review is tested against k keywords in one pass and
    only matching pairs are emitted. "Without" means come from totals minus
    matched sums; sentiment sums are exact decimals.
    """
    top = top_k(hashtag_means(social), k, [F.col("engagement").desc(), F.col("hashtag").asc()])
    keywords = top.select("hashtag", T.normalize_hashtag("hashtag").alias("keyword"))
    low = reviews.select(F.lower(F.col(text_col)).alias("_t"), "rating", "sentiment_score")
    matched = low.join(F.broadcast(keywords), F.col("_t").contains(F.col("keyword")), "inner")
    per = matched.groupBy("hashtag").agg(
        F.count(F.lit(1)).alias("reviews_with_keyword"),
        F.sum("rating").alias("_rs"),
        F.count("rating").alias("_rc"),
        exact_sum("sentiment_score").alias("_ss"),
        F.count("sentiment_score").alias("_sc"),
    )
    # All four totals in one scalar subquery (one extra pass over the reviews).
    tot = reviews.agg(
        F.struct(
            F.sum("rating").alias("rs"),
            F.count("rating").alias("rc"),
            exact_sum("sentiment_score").alias("ss"),
            F.count("sentiment_score").alias("sc"),
        )
    ).scalar()
    rs, rc, ss, sc = (tot[c] for c in ("rs", "rc", "ss", "sc"))
    out = per.select(
        "hashtag",
        "reviews_with_keyword",
        safe_div(F.col("_rs"), F.col("_rc")).alias("avg_rating_with_keyword"),
        safe_div(F.col("_ss").cast("double"), F.col("_sc")).alias("avg_sentiment_with_keyword"),
        safe_div(rs - F.col("_rs"), rc - F.col("_rc")).alias("avg_rating_without_keyword"),
        safe_div((ss - F.col("_ss")).cast("double"), sc - F.col("_sc")).alias("avg_sentiment_without_keyword"),
    )
    return out.withColumns(
        {
            "rating_difference": F.col("avg_rating_with_keyword") - F.col("avg_rating_without_keyword"),
            "sentiment_difference": F.col("avg_sentiment_with_keyword") - F.col("avg_sentiment_without_keyword"),
        }
    )


def prioritized_union(primary: DataFrame, secondary: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``secondary`` whose key also occurs in ``primary`` are replaced by
    the primary rows (left-anti join on the key, then union by name)."""
    kept = secondary.join(primary.select(*keys).distinct(), list(keys), "left_anti")
    return kept.unionByName(primary, allowMissingColumns=True)


def filter_social(
    social: DataFrame,
    *,
    date_range: tuple | None = None,
    hashtags: Sequence[str] | None = None,
    platforms: Sequence[str] | None = None,
    all_token: str = "Todas",
) -> DataFrame:
    """Inclusive day range, hashtag IN list, platform IN list ('all' token = no filter)."""
    out = social
    if date_range and len(date_range) == 2:
        d = F.to_date("date")
        out = out.filter(d.between(F.to_date(F.lit(str(date_range[0]))), F.to_date(F.lit(str(date_range[1])))))
    if hashtags and all_token not in hashtags:
        out = out.filter(F.col("hashtag").isin(list(hashtags)))
    if platforms and all_token not in platforms:
        out = out.filter(F.col("platform").isin(list(platforms)))
    return out


def latest_snapshot(df: DataFrame, *, snapshot_col: str = "ingest_date") -> DataFrame:
    """Rows of the newest snapshot. On a table partitioned by ``snapshot_col``
    the max comes from partition metadata and the filter prunes partitions."""
    newest = df.select(F.max(snapshot_col)).scalar()
    return df.filter(F.col(snapshot_col) == newest)
