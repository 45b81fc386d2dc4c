"""Statistics: Pearson/Spearman per group, lagged Spearman, correlation matrices,
one-way ANOVA, Welch t-test, OLS (J1–J14, K9).

Group statistics are computed from moments in one aggregation; ranks (for
Spearman) use windows partitioned by the group on *daily panels* whose size is
bounded by the calendar. Review-level Spearman matrices rank from per-value
counts (see ``spearman_matrix``).
p-values come from U1 on the aggregated rows only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from glossa.functions.numeric import average_rank, safe_corr, safe_div, top_k
from glossa.functions.pvalues import corr_pvalue, f_pvalue, t_pvalue

# The correlated pairs (review metric, social metric).
PAIRS = (
    ("review_count_vs_mention_volume", "review_count", "mention_volume"),
    ("sentiment_vs_engagement", "avg_sentiment", "engagement"),
    ("rating_vs_engagement", "avg_rating", "engagement"),
)

# Strength labels and interpretation texts of the correlation report.
STRENGTH_LABELS = ((0.7, "FUERTE"), (0.5, "MODERADA"), (0.3, "DEBIL"))
WEAKEST_LABEL = "MUY DEBIL"
NOT_SIGNIFICANT = "NO SIGNIFICATIVA"
SIGNIFICANT_TEXT = "Correlacion {strength} {direction} (ESTADISTICAMENTE SIGNIFICATIVA)"
NOT_SIGNIFICANT_TEXT = "Correlacion NO significativa (p > 0.05)"


#: A value of a column is common when more than one row in this many has it.
COMMON = 1000


def correlation_panel(daily_reviews: DataFrame, daily_social: DataFrame) -> DataFrame:
    """One inner join of the daily review series with the (date, platform) social
    series — every platform at once, no loop. Adds ``n_days`` per platform."""
    panel = daily_reviews.join(daily_social, "date", "inner")
    return panel.withColumn("n_days", F.count(F.lit(1)).over(Window.partitionBy("platform")))


def long_pairs(panel: DataFrame, pairs=PAIRS, keys: Sequence[str] = ("platform", "date")) -> DataFrame:
    """Stack the panel into ``(keys..., pair, x, y)``, one row per pair."""
    arr = F.array(*[F.struct(F.lit(n).alias("pair"), F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")) for n, x, y in pairs])
    return panel.select(*keys, "n_days", F.inline(arr))


def group_correlations(long: DataFrame, group: Sequence[str], *, min_n: int = 10, with_p: bool = False) -> DataFrame:
    """J1 + J2: Pearson and Spearman (tie-averaged ranks) per group, complete pairs
    only, groups below ``min_n`` pairs dropped (HAVING, not an eager count)."""
    complete = long.filter(F.col("x").isNotNull() & F.col("y").isNotNull())
    ranked = complete.withColumn("rx", average_rank("x", group)).withColumn("ry", average_rank("y", group))
    agg = ranked.groupBy(*group).agg(
        F.count(F.lit(1)).alias("n"),
        safe_corr("x", "y").alias("pearson_r"),
        safe_corr("rx", "ry").alias("spearman_r"),
    ).filter(F.col("n") >= min_n)
    if with_p:
        agg = agg.withColumns(
            {"pearson_p": corr_pvalue(F.col("pearson_r"), F.col("n")), "spearman_p": corr_pvalue(F.col("spearman_r"), F.col("n"))}
        )
    return agg


def platform_correlations(daily_reviews: DataFrame, daily_social: DataFrame, *, min_n: int = 10, with_p: bool = False) -> DataFrame:
    """J1/J2 (min_n=10) and J3 (min_n=5) over the joined panel."""
    panel = correlation_panel(daily_reviews, daily_social)
    return group_correlations(long_pairs(panel), ["platform", "pair"], min_n=min_n, with_p=with_p)


def strength_label(r, p, alpha: float = 0.05):
    """J4: 'NO SIGNIFICATIVA' when p >= alpha, else FUERTE / MODERADA / DEBIL / MUY DEBIL
    by |r| with the sign ``positiva`` / ``negativa``."""
    a = F.abs(r)
    lab = None
    for thr, name in STRENGTH_LABELS:
        lab = F.when(a > thr, name) if lab is None else lab.when(a > thr, name)
    lab = lab.otherwise(WEAKEST_LABEL)
    return F.when(r.isNull() | p.isNull(), F.lit(None)).when(p >= alpha, NOT_SIGNIFICANT).otherwise(lab)


def direction_label(r):
    return F.when(r > 0, "positiva").otherwise("negativa")


def interpretation(r, p, alpha: float = 0.05):
    """J4 as the report sentence."""
    pre, rest = SIGNIFICANT_TEXT.split("{strength}")
    mid, post = rest.split("{direction}")
    text = F.concat(F.lit(pre), strength_label(r, p, alpha), F.lit(mid), direction_label(r), F.lit(post))
    return F.when(r.isNull() | p.isNull(), F.lit(None)).when(p >= alpha, NOT_SIGNIFICANT_TEXT).otherwise(text)


def correlation_report(corr: DataFrame, *, strong_r: float = 0.5, alpha: float = 0.05) -> DataFrame:
    """J4 + J6: strength label, direction, report sentence and the strong flag
    (|spearman| > 0.5 and p < .05)."""
    r, p = F.col("spearman_r"), F.col("spearman_p")
    return corr.withColumns(
        {
            "strength": strength_label(r, p, alpha),
            "direction": direction_label(r),
            "interpretation": interpretation(r, p, alpha),
            "is_strong": F.coalesce((F.abs(r) > strong_r) & (p < alpha), F.lit(False)),
        }
    )


def platform_recommendations(report: DataFrame, *, threshold: float = 0.4) -> DataFrame:
    """Per platform mean |Spearman|, number of strong pairs, and whether it is a
    platform to act on (mean |r| > 0.4)."""
    return report.groupBy("platform").agg(
        F.avg(F.abs("spearman_r")).alias("mean_abs_spearman"),
        F.count_if("is_strong").alias("n_strong"),
    ).withColumn("recommended", F.col("mean_abs_spearman") > threshold)


def lag_correlations(
    daily_reviews: DataFrame,
    daily_social: DataFrame,
    *,
    max_lag: int = 14,
    min_days: int = 30,
    min_pairs: int = 10,
    x_col: str = "review_count",
    y_col: str = "mention_volume",
    with_p: bool = False,
) -> DataFrame:
    """Spearman of ``x`` shifted by k rows (k = 0..max_lag) against ``y``, per
    platform with at least ``min_days`` joined days; lags with fewer than
    ``min_pairs`` complete pairs are dropped; ranks are recomputed per lag.
    ``is_best`` marks the greatest |r| per platform (ties → smallest lag).
    A positive best lag means reviews lead mentions.
    """
    panel = correlation_panel(daily_reviews, daily_social).filter(F.col("n_days") >= min_days)
    w = Window.partitionBy("platform").orderBy("date")
    shifted = panel.select(
        "platform", "date", F.col(y_col).cast("double").alias("y"),
        *[F.lag(F.col(x_col), k).over(w).cast("double").alias(f"_x{k}") for k in range(max_lag + 1)],
    )
    lags = F.array(*[F.struct(F.lit(k).alias("lag"), F.col(f"_x{k}").alias("x")) for k in range(max_lag + 1)])
    long = shifted.select("platform", "date", "y", F.inline(lags))
    corr = group_correlations(long, ["platform", "lag"], min_n=min_pairs, with_p=with_p)
    best = Window.partitionBy("platform").orderBy(F.abs(F.col("spearman_r")).desc_nulls_last(), F.col("lag").asc())
    p = ["spearman_p"] if with_p else []
    return corr.select("platform", "lag", "n", "spearman_r", *p).withColumn("is_best", F.row_number().over(best) == 1)


def _bin(v: Column) -> Column:
    """A step function of a double that never falls: 4096 steps in each power of two.

    Bins spread the distinct values of a column over tasks whatever its range.
    """
    size = F.abs(v)
    power = F.greatest(F.lit(-1000.0), F.floor(F.log2(F.when(size > 0, size))).cast("double"))
    step = (power + 1100) * 4096 + F.floor(size / F.pow(F.lit(2.0), power) * 4096) - 4096
    return F.when(size > 0, F.signum(v) * step).otherwise(F.lit(0.0))


def value_places(counts: DataFrame) -> DataFrame:
    """Rows below every value, and rows in all: ``_col, _v, _c`` → ``_col, _v, _c, _before, _n``.

    Prefix sums over the distinct values, in two levels: bins first, then the values of a bin. So
    no task holds all the distinct values of a column.
    """
    binned = counts.withColumn("_b", _bin(F.col("_v")))
    bins = binned.groupBy("_col", "_b").agg(F.sum("_c").alias("_t"))
    below = Window.partitionBy("_col").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    all_bins = Window.partitionBy("_col")
    bins = bins.select("_col", "_b", F.coalesce(F.sum("_t").over(below), F.lit(0)).alias("_below"), F.sum("_t").over(all_bins).alias("_n"))
    inside = Window.partitionBy("_col", "_b").orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    placed = binned.withColumn("_in", F.coalesce(F.sum("_c").over(inside), F.lit(0))).join(bins, ["_col", "_b"])
    return placed.select("_col", "_v", "_c", (F.col("_below") + F.col("_in")).alias("_before"), "_n")


def value_ranks(counts: DataFrame) -> DataFrame:
    """Average rank of every value, ``_col, _v, _r``, centred on (n + 1) / 2 so that squares
    stay small enough for sums over very many rows, and whether the value is ``_common``."""
    rank = F.col("_before") + (F.col("_c") + 1) / 2.0 - (F.col("_n") + 1) / 2.0
    return value_places(counts).select("_col", "_v", rank.alias("_r"), (F.col("_c") * COMMON > F.col("_n")).alias("_common"))


def quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """One row with an array of exact quantiles (linear interpolation) per column, from value counts."""
    stacked = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("_col"), F.col(c).cast("double").alias("_v")) for c in cols])))
    places = value_places(stacked.where("_v IS NOT NULL").groupBy("_col", "_v").agg(F.count(F.lit(1)).alias("_c")))

    def at(c: str, k: Column) -> Column:
        return F.max(F.when((F.col("_col") == c) & (F.col("_before") <= k) & (k < F.col("_before") + F.col("_c")), F.col("_v")))

    out = []
    for c in cols:
        edges = []
        for p in probs:
            pos = F.lit(p) * (F.col("_n") - 1)
            share = F.max(F.when(F.col("_col") == c, pos - F.floor(pos)))
            lo, hi = at(c, F.floor(pos)), at(c, F.ceil(pos))
            edges.append(lo + (hi - lo) * share)
        out.append(F.array(*edges).alias(c))
    return places.agg(*out)


def spearman_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Spearman matrix as long pairs ``(var_x, var_y, spearman_r)``, i < j,
    over rows complete in every column (pandas would drop pairwise). NULL for a constant column.

    One plan for every size, and nothing runs while it is built: equal rows become one weighted row before the
    shuffle; their values are stacked into ``(column, value)``, counted and ranked by prefix sums (``value_ranks``), and the
    ranks join back by value. A value with more than one in ``COMMON`` rows has its rank from a
    broadcast table, which holds fewer than ``COMMON`` of them by their definition; its rows go through the join of
    the other values under keys of their own. So no task gathers the rows of a common value. Ranks are
    centred, so the sums of their products are the covariances times n.
    """
    cols = list(cols)
    complete = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).dropna()
    combos = complete.groupBy(*[F.col(f"`{c}`").alias(f"_v_{i}") for i, c in enumerate(cols)]).agg(F.count(F.lit(1)).alias("_w"))
    values = [f"_v_{i}" for i in range(len(cols))]
    stacked = combos.select("_w", F.inline(F.array(*[F.struct(F.lit(i).alias("_col"), F.col(v).alias("_v")) for i, v in enumerate(values)])))
    ranks = value_ranks(stacked.groupBy("_col", "_v").agg(F.sum("_w").alias("_c")))
    ranked = combos.withColumn("_row", F.xxhash64(*values))
    for i, v in enumerate(values):
        table = ranks.where(F.col("_col") == i)
        common = table.where("_common").select(F.col("_v").alias(v), F.col("_r").alias("_rc"))
        other = table.where("NOT _common").select(F.lit(0).cast("long").alias("_k"), F.col("_v").alias(v), F.col("_r").alias("_ro"))
        ranked = ranked.join(F.broadcast(common), v, "left")
        ranked = ranked.withColumn("_k", F.when(F.col("_rc").isNull(), F.lit(0)).otherwise(F.col("_row"))).join(other, ["_k", v], "left")
        ranked = ranked.withColumn(f"_r_{i}", F.coalesce("_rc", "_ro")).drop("_k", "_rc", "_ro")
    pairs = [(i, j) for i in range(len(cols)) for j in range(i, len(cols))]
    sums = ranked.agg(*[F.sum(F.col("_w") * F.col(f"_r_{i}") * F.col(f"_r_{j}")).alias(f"_p_{i}_{j}") for i, j in pairs])

    def corr(i: int, j: int) -> Column:
        den = F.sqrt(F.col(f"_p_{i}_{i}") * F.col(f"_p_{j}_{j}"))
        return F.when(den > 0, F.col(f"_p_{i}_{j}") / den)

    rows = [F.struct(F.lit(cols[i]).alias("var_x"), F.lit(cols[j]).alias("var_y"), corr(i, j).alias("spearman_r")) for i, j in pairs if i < j]
    return sums.select(F.inline(F.array(*rows)))


def top_pairs(pairs: DataFrame, *, k: int = 10) -> DataFrame:
    """H6: top-k variable pairs by |r|."""
    return top_k(pairs, k, [F.abs(F.col("spearman_r")).desc(), F.col("var_x").asc(), F.col("var_y").asc()])


def group_moments(df: DataFrame, group_col: str, value_col: str) -> DataFrame:
    """Per non-null group: rows, and count, mean and variance of the value — one pass over the data."""
    return df.filter(F.col(group_col).isNotNull()).groupBy(group_col).agg(
        F.count(F.lit(1)).alias("rows"), F.count(value_col).alias("n"), F.avg(value_col).alias("m"), F.var_samp(value_col).alias("v")
    )


def anova_of(moments: DataFrame, *, with_p: bool = False) -> DataFrame:
    """F of a table of group moments: SSB = sum n_i (m_i - m)^2, SSW = sum (n_i - 1) s_i^2
    (central moments: numerically stable). The grand mean is a window over the group
    table, one row per group, so the data are read once.
    """
    g = moments.filter(F.col("n") > 0)
    all_groups = Window.partitionBy()
    grand = F.sum(F.col("n") * F.col("m")).over(all_groups) / F.sum("n").over(all_groups)
    tot = g.withColumn("grand", grand).agg(
        F.count(F.lit(1)).alias("k"),
        F.sum("n").alias("n_total"),
        F.sum(F.col("n") * (F.col("m") - F.col("grand")) * (F.col("m") - F.col("grand"))).alias("ssb"),
        F.sum(F.coalesce((F.col("n") - 1) * F.col("v"), F.lit(0.0))).alias("ssw"),
    )
    out = tot.select(
        F.col("k").alias("n_groups"),
        F.col("n_total"),
        (F.col("k") - 1).alias("df_between"),
        (F.col("n_total") - F.col("k")).alias("df_within"),
        safe_div(safe_div(F.col("ssb"), F.col("k") - 1), safe_div(F.col("ssw"), F.col("n_total") - F.col("k"))).alias("f_stat"),
    )
    if with_p:
        out = out.withColumn("p_value", f_pvalue(F.col("f_stat"), F.col("df_between").cast("double"), F.col("df_within").cast("double")))
    return out


def one_way_anova(df: DataFrame, *, group_col: str, value_col: str = "rating", with_p: bool = False) -> DataFrame:
    """J10 / J11 core: F over all groups."""
    return anova_of(group_moments(df, group_col, value_col), with_p=with_p)


def anova_top_groups(df: DataFrame, *, group_col: str = "brand_name", value_col: str = "rating", k: int = 5, with_p: bool = False) -> DataFrame:
    """ANOVA over the ``k`` largest groups: H7 top-k of the group table, so the data are read once."""
    moments = group_moments(df, group_col, value_col)
    return anova_of(top_k(moments, k, [F.col("rows").desc(), F.col(group_col).asc()]), with_p=with_p)


def anova_first_groups(
    df: DataFrame, *, group_col: str = "primary_category", value_col: str = "rating", k: int = 5, min_rows: int = 5, min_groups: int = 3, with_p: bool = False
) -> DataFrame:
    """ANOVA over the first ``k`` groups (by name — Spark has no row order),
    keeping groups with at least ``min_rows`` rows; empty unless ``min_groups`` remain."""
    first = top_k(group_moments(df, group_col, value_col), k, [F.col(group_col).asc()]).filter(F.col("n") >= min_rows)
    return anova_of(first, with_p=with_p).filter(F.col("n_groups") >= min_groups)


def welch_ttest(
    df: DataFrame, *, label_col: str = "sentiment_label", value_col: str = "rating", a: str = "positive", b: str = "negative", min_rows: int = 5, with_p: bool = False
) -> DataFrame:
    """Welch t-test of ``value`` between two labels (each needs > ``min_rows`` rows).

    Conditional moments in one pass; Welch–Satterthwaite degrees of freedom.
    """
    v = F.col(value_col)
    ia, ib = F.col(label_col) == a, F.col(label_col) == b
    m = df.agg(
        F.count(F.when(ia, v)).alias("n_a"),
        F.avg(F.when(ia, v)).alias("mean_a"),
        F.var_samp(F.when(ia, v)).alias("var_a"),
        F.count(F.when(ib, v)).alias("n_b"),
        F.avg(F.when(ib, v)).alias("mean_b"),
        F.var_samp(F.when(ib, v)).alias("var_b"),
    ).filter((F.col("n_a") > min_rows) & (F.col("n_b") > min_rows))
    sa = F.col("var_a") / F.col("n_a")
    sb = F.col("var_b") / F.col("n_b")
    out = m.select(
        "n_a",
        "n_b",
        "mean_a",
        "mean_b",
        safe_div(F.col("mean_a") - F.col("mean_b"), F.sqrt(sa + sb)).alias("t_stat"),
        safe_div((sa + sb) * (sa + sb), sa * sa / (F.col("n_a") - 1) + sb * sb / (F.col("n_b") - 1)).alias("df"),
    )
    if with_p:
        out = out.withColumn("p_value", t_pvalue(F.col("t_stat"), F.col("df")))
    return out


def pearson(df: DataFrame, x: str, y: str) -> DataFrame:
    """Pearson r of two columns (NULL for a constant side)."""
    return df.agg(safe_corr(x, y).alias("pearson_r"), F.count(F.when(F.col(x).isNotNull() & F.col(y).isNotNull(), 1)).alias("n"))


def scatter_points(df: DataFrame, x: str, y: str, *, keys: Sequence[str] = (), fraction: float | None = None, seed: int = 42) -> DataFrame:
    """Point set of a scatter chart (complete pairs). ``fraction`` is the
    sampling operator for chart rendering at scale (Bernoulli per row, seeded);
    without it every point is returned."""
    pts = df.select(*keys, x, y).filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    return pts.sample(fraction=fraction, seed=seed) if fraction is not None else pts


def ols_fit(df: DataFrame, *, y: str = "rating", x: str = "sentiment_score") -> DataFrame:
    """K9: intercept, slope and R^2 of y ~ x over all complete rows (one aggregation)."""
    return df.agg(
        F.regr_intercept(y, x).alias("intercept"),
        F.regr_slope(y, x).alias("slope"),
        F.regr_r2(y, x).alias("r2"),
        F.regr_count(y, x).alias("n"),
        F.min(F.when(F.col(y).isNotNull(), F.col(x))).alias("x_min"),
        F.max(F.when(F.col(y).isNotNull(), F.col(x))).alias("x_max"),
    )


def ols_line(fit: DataFrame, *, points: int = 100) -> DataFrame:
    """K9: ``points`` evenly spaced fitted points between min and max x."""
    step = F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("i")
    pts = fit.select("*", step)
    x = F.col("x_min") + (F.col("x_max") - F.col("x_min")) * F.col("i") / F.lit(points - 1)
    return pts.select("i", x.alias("x"), (F.col("intercept") + F.col("slope") * x).alias("y_hat"))
