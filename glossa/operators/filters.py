"""Filters and filter profiling.

Filters are plain predicates, so Catalyst pushes them into the Parquet scan
(row-group skipping by min/max statistics) whenever the column comes straight
from a table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossa.functions.numeric import safe_div

ALL = "Todas"  # fixed value: the "no filter" choice of the selection lists

# Category-column candidates, in preference order.
CATEGORY_CANDIDATES = ("primary_category", "secondary_category", "category", "product_type", "brand_name", "product_name")


def review_predicates(
    *,
    brand: str | None = None,
    category: tuple[str, str] | None = None,
    date_range: tuple | None = None,
    date_col: str = "review_date",
) -> list[tuple[str, Column]]:
    """D1–D3 as named predicates (brand, category, inclusive date range at midnight).

    The date range compares timestamps with the bounds at midnight, so rows later
    than 00:00 on the end day are outside, as in the dashboard.
    """
    preds = []
    if brand and brand != ALL:
        preds.append(("brand", F.col("brand_name") == brand))
    if category and category[1] != ALL:
        preds.append(("category", F.col(category[0]) == category[1]))
    if date_range and len(date_range) == 2:
        ts = F.col(date_col).cast("timestamp")
        lo = F.to_timestamp(F.lit(str(date_range[0])))
        hi = F.to_timestamp(F.lit(str(date_range[1])))
        preds.append(("date_range", ts.between(lo, hi)))
    return preds


def filter_reviews(df: DataFrame, **kwargs) -> DataFrame:
    """Apply every given predicate."""
    out = df
    for _, p in review_predicates(**kwargs):
        out = out.filter(p)
    return out


def filter_summary(df: DataFrame, **kwargs) -> DataFrame:
    """Rows before and after each successive filter, % reduction — one pass."""
    preds = review_predicates(**kwargs)
    aggs = [F.count(F.lit(1)).alias("rows_initial")]
    acc = None
    for name, p in preds:
        acc = p if acc is None else (acc & p)
        aggs.append(F.count_if(F.coalesce(acc, F.lit(False))).alias(f"rows_after_{name}"))
    out = df.agg(*aggs)
    last = f"rows_after_{preds[-1][0]}" if preds else "rows_initial"
    return out.withColumn(
        "reduction_pct", (1 - safe_div(F.col(last), F.col("rows_initial"))) * 100
    )


def tweet_filter(tweets: DataFrame, *, date_range: tuple | None = None, labels: Sequence[str] | None = None) -> DataFrame:
    """Inclusive day range on ``created_at`` and sentiment IN list (empty = all)."""
    out = tweets
    if date_range and len(date_range) == 2:
        d = F.to_date("created_at")
        out = out.filter(d.between(F.to_date(F.lit(str(date_range[0]))), F.to_date(F.lit(str(date_range[1])))))
    if labels:
        out = out.filter(F.col("sentiment_label").isin(list(labels)))
    return out


def category_candidates(
    df: DataFrame,
    *,
    candidates: Sequence[str] = CATEGORY_CANDIDATES,
    max_distinct: int = 50,
    fallback_max: int = 20,
    approximate: bool = False,
) -> DataFrame:
    """D6 + D7: candidate columns with ``1 < distinct <= max_distinct``; if none, any
    string column with ``1 < distinct <= fallback_max``. Marks the chosen one
    (most distinct values, ties → candidate order).

    One aggregation pass over all involved columns; ``approximate=True`` uses
    HyperLogLog sketches (fixed memory per column) for very large tables.
    """
    strings = [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
    present = [c for c in candidates if c in df.columns]
    cols = list(dict.fromkeys(present + strings))
    if not cols:
        return df.sparkSession.createDataFrame([], "column_name string, n_distinct long, chosen boolean")
    cd = F.approx_count_distinct if approximate else F.countDistinct
    counts = df.agg(*[cd(F.col(c)).alias(f"c{i}") for i, c in enumerate(cols)])
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.col(f"c{i}").cast("long").alias("n_distinct"),
                F.lit(c in present).alias("is_candidate"),
                F.lit(present.index(c) if c in present else len(present) + strings.index(c)).alias("ord"),
            )
            for i, c in enumerate(cols)
        ]
    )
    long = counts.select(F.inline(rows))
    primary = F.col("is_candidate") & (F.col("n_distinct") > 1) & (F.col("n_distinct") <= max_distinct)
    fallback = (F.col("n_distinct") > 1) & (F.col("n_distinct") <= fallback_max)
    flagged = long.withColumn("primary", primary).withColumn("fallback", fallback)
    # The frame has one row per column (bounded by the schema): a global window is fine.
    from pyspark.sql import Window

    w_all = Window.partitionBy()
    any_primary = F.max(F.col("primary").cast("int")).over(w_all) == 1
    keep = F.when(any_primary, F.col("primary")).otherwise(F.col("fallback"))
    kept = flagged.withColumn("keep", keep).filter("keep")
    w_rank = Window.orderBy(F.col("n_distinct").desc(), F.col("ord").asc())
    return kept.select("column_name", "n_distinct", (F.row_number().over(w_rank) == 1).alias("chosen"))


def option_values(df: DataFrame, col: str) -> DataFrame:
    """Sorted distinct non-null values of a column (a selection list)."""
    return df.filter(F.col(col).isNotNull()).select(col).distinct().orderBy(col)


def date_bounds(df: DataFrame, col: str = "review_date") -> DataFrame:
    """Min / max date."""
    return df.agg(F.min(col).alias("min_date"), F.max(col).alias("max_date"))


def contains_ci(c: str | Column, keyword: str) -> Column:
    """Case-insensitive substring test, NULL → false."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.lower(c).contains(keyword.lower()), F.lit(False))


def matches_prefix(c: str | Column, pattern: str) -> Column:
    """Regex anchored at the start (``re.match``), NULL → false."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c.rlike(f"^(?:{pattern})"), F.lit(False))
