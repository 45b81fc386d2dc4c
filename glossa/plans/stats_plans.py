"""Registered queries: correlations, lagged correlations, Spearman matrices, ANOVA,
Welch t-test, OLS. Oracle-checked queries carry the statistics (r, F, t, df);
p-values (U1) are compared with numeric integration to five places."""

from __future__ import annotations

from pyspark.sql import functions as F

from glossa.functions.numeric import r9, round_half_even
from glossa.operators import social, stats
from glossa.plans.registry import r9 as q9
from glossa.plans.registry import register, rnd, savg, ssum
from glossa.sources.fixtures import view, with_views


def _daily(spark, sf_dir):
    reviews = view(spark, sf_dir, "reviews_v")
    return social.daily_reviews(reviews), social.daily_social(view(spark, sf_dir, "social_v"))


PANEL_SQL = f"""
dr AS (SELECT review_date AS date, {savg('rating')} AS avg_rating, {savg('sentiment_score')} AS avg_sentiment,
              count(product_id) AS review_count FROM reviews_v WHERE review_date IS NOT NULL GROUP BY 1),
ds AS (SELECT date, platform, sum(mention_volume) AS mention_volume, {ssum('engagement')} AS engagement
       FROM social_v WHERE date IS NOT NULL GROUP BY 1, 2),
p AS (SELECT *, count(*) OVER (PARTITION BY platform) AS n_days FROM dr JOIN ds USING (date))
"""


def _rank(v: str, part: str) -> str:
    return f"(rank() OVER (PARTITION BY {part} ORDER BY {v}) + (count(*) OVER (PARTITION BY {part}, {v}) - 1) / 2.0)"


def _corr(x: str, y: str) -> str:
    return (
        f"CASE WHEN stddev_pop({x}) > 0 AND stddev_pop({y}) > 0 "
        f"THEN covar_pop({x}, {y}) / (stddev_pop({x}) * stddev_pop({y})) END"
    )


CORR_SQL = f"""WITH {PANEL_SQL},
l AS (SELECT platform, 'review_count_vs_mention_volume' AS pair, CAST(review_count AS DOUBLE) AS x, CAST(mention_volume AS DOUBLE) AS y FROM p
      UNION ALL SELECT platform, 'sentiment_vs_engagement', avg_sentiment, engagement FROM p
      UNION ALL SELECT platform, 'rating_vs_engagement', avg_rating, engagement FROM p),
rk AS (SELECT *, {_rank('x', 'platform, pair')} AS rx, {_rank('y', 'platform, pair')} AS ry
       FROM l WHERE x IS NOT NULL AND y IS NOT NULL)
SELECT platform, pair, count(*) AS n, {q9(_corr('x', 'y'))} AS pearson_r, {q9(_corr('rx', 'ry'))} AS spearman_r
FROM rk GROUP BY platform, pair HAVING count(*) >= 10"""


@register("platform_correlations", covers="J1 J2 E3 G6", oracle=with_views(CORR_SQL, "reviews_v", "social_v"))
def platform_correlations(spark, sf_dir):
    dr, ds = _daily(spark, sf_dir)
    c = stats.platform_correlations(dr, ds, min_n=10)
    return c.select("platform", "pair", "n", r9("pearson_r").alias("pearson_r"), r9("spearman_r").alias("spearman_r"))


def _simpson(f, lo: str, hi: str, steps: int = 4000) -> str:
    """Integral of ``f(t)`` from ``lo`` to ``hi`` by Simpson's rule."""
    weight = f"(CASE WHEN k IN (0, {steps}) THEN 1 WHEN k % 2 = 1 THEN 4 ELSE 2 END)"
    at = f"({lo} + k * (({hi}) - ({lo})) / {float(steps)})"
    return f"((SELECT sum({weight} * {f(at)}) FROM range({steps + 1}) s(k)) * (({hi}) - ({lo})) / {3.0 * steps})"


def t_tail(theta: str, df: str) -> str:
    """Two-sided p of Student's t with tan(theta) = |t| / sqrt(df): the tail of cos^(df-1) over its whole.

    The whole is a beta function; the tail ends where cos^(df-1) has fallen by e^-80.
    """
    end = f"least(pi() / 2, ({theta}) + sqrt(160.0 / greatest({df} - 1, 1e-9)))"
    whole = f"(0.5 * sqrt(pi()) * exp(lgamma(({df}) / 2.0) - lgamma((({df}) + 1) / 2.0)))"
    return f"least(1.0, {_simpson(lambda t: f'pow(greatest(cos({t}), 0.0), ({df}) - 1)', theta, end)} / {whole})"


def f_tail(f: str, d1: str, d2: str) -> str:
    """Upper p of F (two or more degrees above): the incomplete beta integral with t = x e^(-s / a)."""
    a, b = f"(({d2}) / 2.0)", f"(({d1}) / 2.0)"
    x = f"(({d2}) / (({d2}) + ({d1}) * ({f})))"
    head = f"exp({a} * ln({x}) + lgamma({a} + {b}) - lgamma({a}) - lgamma({b}) - ln({a}))"
    return f"least(1.0, {head} * {_simpson(lambda t: f'exp(-{t}) * pow(greatest(1 - {x} * exp(-{t} / {a}), 0.0), {b} - 1)', '0.0', '60.0')})"


#: Platform correlations with p-values, labels and sentences.
STRENGTH_SQL = f"""WITH c AS ({CORR_SQL}),
q AS (SELECT *, {q9(t_tail('asin(least(abs(pearson_r), 1.0))', '(n - 2)'))} AS pearson_p,
             {q9(t_tail('asin(least(abs(spearman_r), 1.0))', '(n - 2)'))} AS spearman_p FROM c),
s AS (SELECT *, CASE WHEN spearman_r IS NULL OR spearman_p IS NULL THEN NULL WHEN spearman_p >= 0.05 THEN 'NO SIGNIFICATIVA'
             WHEN abs(spearman_r) > 0.7 THEN 'FUERTE' WHEN abs(spearman_r) > 0.5 THEN 'MODERADA'
             WHEN abs(spearman_r) > 0.3 THEN 'DEBIL' ELSE 'MUY DEBIL' END AS strength,
             CASE WHEN spearman_r > 0 THEN 'positiva' ELSE 'negativa' END AS direction FROM q)
SELECT platform, pair, n, pearson_r, pearson_p, spearman_r, spearman_p, strength, direction,
       CASE WHEN strength IS NULL THEN NULL WHEN spearman_p >= 0.05 THEN 'Correlacion NO significativa (p > 0.05)'
            ELSE 'Correlacion ' || strength || ' ' || direction || ' (ESTADISTICAMENTE SIGNIFICATIVA)' END AS interpretation,
       coalesce(abs(spearman_r) > 0.5 AND spearman_p < 0.05, false) AS is_strong
FROM s"""


@register("correlation_strength", covers="J1 J2 J4 J6 U1", oracle=with_views(STRENGTH_SQL, "reviews_v", "social_v"))
def correlation_strength(spark, sf_dir):
    dr, ds = _daily(spark, sf_dir)
    c = stats.correlation_report(stats.platform_correlations(dr, ds, min_n=10, with_p=True))
    return c.select(
        "platform", "pair", "n",
        *[r9(x).alias(x) for x in ("pearson_r", "pearson_p", "spearman_r", "spearman_p")],
        "strength", "direction", "interpretation", "is_strong",
    )


@register(
    "platform_recommendations",
    covers="J7",
    oracle=with_views(
        f"""WITH rep AS ({STRENGTH_SQL})
SELECT platform, {q9('avg(abs(spearman_r))')} AS mean_abs_spearman, count(*) FILTER (WHERE is_strong) AS n_strong,
       avg(abs(spearman_r)) > 0.4 AS recommended FROM rep GROUP BY platform""",
        "reviews_v",
        "social_v",
    ),
)
def platform_recommendations(spark, sf_dir):
    dr, ds = _daily(spark, sf_dir)
    rep = stats.correlation_report(stats.platform_correlations(dr, ds, min_n=10, with_p=True))
    rec = stats.platform_recommendations(rep)
    return rec.withColumn("mean_abs_spearman", r9("mean_abs_spearman"))


@register(
    "dashboard_correlations",
    covers="J3",
    oracle=with_views(
        f"""WITH {PANEL_SQL},
l AS (SELECT platform, 'review_count_vs_mention_volume' AS pair, CAST(review_count AS DOUBLE) AS x, CAST(mention_volume AS DOUBLE) AS y FROM p
      UNION ALL SELECT platform, 'sentiment_vs_engagement', avg_sentiment, engagement FROM p),
rk AS (SELECT *, {_rank('x', 'platform, pair')} AS rx, {_rank('y', 'platform, pair')} AS ry
       FROM l WHERE x IS NOT NULL AND y IS NOT NULL)
SELECT platform, pair, count(*) AS n, {q9(_corr('rx', 'ry'))} AS spearman_r
FROM rk GROUP BY platform, pair HAVING count(*) >= 5""",
        "reviews_v",
        "social_v",
    ),
)
def dashboard_correlations(spark, sf_dir):
    dr, ds = _daily(spark, sf_dir)
    panel = stats.correlation_panel(dr, ds)
    long = stats.long_pairs(panel, stats.PAIRS[:2])
    c = stats.group_correlations(long, ["platform", "pair"], min_n=5)
    return c.select("platform", "pair", "n", r9("spearman_r").alias("spearman_r"))


LAG_SQL = f"""WITH {PANEL_SQL},
q AS (SELECT platform, date, mention_volume,
             {', '.join(f'lag(review_count, {i}) OVER (PARTITION BY platform ORDER BY date) AS x{i}' for i in range(15))}
      FROM p WHERE n_days >= 30),
l AS (SELECT platform, date, CAST(mention_volume AS DOUBLE) AS y, k.lag,
             CAST(CASE k.lag {' '.join(f'WHEN {i} THEN x{i}' for i in range(15))} END AS DOUBLE) AS x
      FROM q, range(0, 15) k(lag)),
rk AS (SELECT *, {_rank('x', 'platform, lag')} AS rx, {_rank('y', 'platform, lag')} AS ry FROM l WHERE x IS NOT NULL),
c AS (SELECT platform, CAST(lag AS INTEGER) AS lag, count(*) AS n, {_corr('rx', 'ry')} AS r FROM rk GROUP BY platform, lag HAVING count(*) >= 10)
SELECT platform, lag, n, {q9('r')} AS spearman_r,
       row_number() OVER (PARTITION BY platform ORDER BY abs(r) DESC NULLS LAST, lag) = 1 AS is_best FROM c"""


@register("lag_correlations", covers="J5 G4", oracle=with_views(LAG_SQL, "reviews_v", "social_v"))
def lag_correlations(spark, sf_dir):
    dr, ds = _daily(spark, sf_dir)
    c = stats.lag_correlations(dr, ds)
    return c.select("platform", "lag", "n", r9("spearman_r").alias("spearman_r"), "is_best")


def _null_tail(r: str, steps: int = 100_000) -> str:
    """p of a correlation by numeric integration: the tail beyond asin|r| of cos^(n-3) over its whole (midpoint rule)."""
    at = f"asin(least(abs({r}), 1.0))"
    area = lambda lo: f"(SELECT sum(pow(cos({lo} + (k + 0.5) / {steps} * (pi() / 2 - {lo})), n - 3)) FROM range({steps}) s(k)) * (pi() / 2 - {lo})"
    return f"({area(at)}) / ({area('0.0')})"


@register(
    "correlation_pvalues",
    covers="U1 J1 J2",
    oracle=with_views(
        f"""WITH c AS ({CORR_SQL})
SELECT platform, pair, n, {rnd(_null_tail('pearson_r'), 5)} AS pearson_p, {rnd(_null_tail('spearman_r'), 5)} AS spearman_p FROM c""",
        "reviews_v",
        "social_v",
    ),
)
def correlation_pvalues(spark, sf_dir):
    dr, ds = _daily(spark, sf_dir)
    c = stats.platform_correlations(dr, ds, with_p=True)
    return c.select("platform", "pair", "n", round_half_even("pearson_p", 5).alias("pearson_p"), round_half_even("spearman_p", 5).alias("spearman_p"))


@register(
    "lag_pvalues",
    covers="J5 U1",
    oracle=with_views(
        f"""WITH c AS ({LAG_SQL}) SELECT platform, lag, n, is_best, {rnd(_null_tail('spearman_r'), 5)} AS spearman_p FROM c""", "reviews_v", "social_v"
    ),
)
def lag_pvalues(spark, sf_dir):
    dr, ds = _daily(spark, sf_dir)
    c = stats.lag_correlations(dr, ds, with_p=True)
    return c.select("platform", "lag", "n", "is_best", round_half_even("spearman_p", 5).alias("spearman_p"))


MATRIX_COLS = ("rating", "sentiment_score", "sentiment_intensity")


def _matrix_sql(cols, table_sql: str) -> str:
    ranks = ", ".join(f"(rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0) AS r_{c}" for c in cols)
    pairs = " UNION ALL ".join(
        f"SELECT '{a}' AS var_x, '{b}' AS var_y, {q9(_corr('r_' + a, 'r_' + b))} AS spearman_r FROM rk"
        for i, a in enumerate(cols)
        for b in cols[i + 1 :]
    )
    nn = " AND ".join(f"{c} IS NOT NULL" for c in cols)
    return f"WITH t AS ({table_sql}), rk AS (SELECT {ranks} FROM t WHERE {nn})\n{pairs}"


@register(
    "spearman_matrix",
    covers="J8",
    oracle=with_views(
        _matrix_sql(MATRIX_COLS, "SELECT rating, sentiment_score, abs(sentiment_score) AS sentiment_intensity FROM reviews_v"),
        "reviews_v",
    ),
)
def spearman_matrix(spark, sf_dir):
    r = view(spark, sf_dir, "reviews_v").withColumn("sentiment_intensity", F.abs("sentiment_score"))
    return stats.spearman_matrix(r, MATRIX_COLS).withColumn("spearman_r", r9("spearman_r"))


ALL_NUMERIC = ("order_id", "line_no", "user_id", "product_id", "rating", "sentiment_score")


ALL_PAIRS_SQL = _matrix_sql(ALL_NUMERIC, "SELECT * FROM reviews_v").replace("WITH t AS", "WITH t0 AS", 1).replace("FROM t WHERE", "FROM t0 WHERE")


def _all_pairs(spark, sf_dir):
    r = view(spark, sf_dir, "reviews_v")
    numeric = [f.name for f in r.schema.fields if f.dataType.typeName() in ("integer", "long", "double")]
    return stats.spearman_matrix(r, numeric).withColumn("spearman_r", r9("spearman_r"))


@register("spearman_pairs", covers="J9", oracle=with_views(ALL_PAIRS_SQL, "reviews_v"))
def spearman_pairs(spark, sf_dir):
    return _all_pairs(spark, sf_dir)


@register(
    "spearman_all_pairs",
    covers="J9 H6",
    oracle=with_views(f"WITH m AS ({ALL_PAIRS_SQL}) SELECT * FROM m ORDER BY abs(spearman_r) DESC, var_x, var_y LIMIT 10", "reviews_v"),
)
def spearman_all_pairs(spark, sf_dir):
    return stats.top_pairs(_all_pairs(spark, sf_dir), k=10)


def _anova_sql(sub_sql: str, group: str) -> str:
    return f"""WITH s AS ({sub_sql}),
g AS (SELECT {group}, count(rating) AS n, avg(rating) AS m, var_samp(rating) AS v, sum(rating) AS sm FROM s WHERE rating IS NOT NULL GROUP BY {group}),
t AS (SELECT count(*) AS k, sum(n) AS n_total, sum(sm) / sum(n) AS grand, sum(coalesce((n - 1) * v, 0)) AS ssw FROM g),
b AS (SELECT sum(n * (m - (SELECT grand FROM t)) * (m - (SELECT grand FROM t))) AS ssb FROM g)
SELECT k AS n_groups, CAST(n_total AS BIGINT) AS n_total, k - 1 AS df_between, CAST(n_total - k AS BIGINT) AS df_within,
       {q9('(ssb / (k - 1)) / (ssw / (n_total - k))')} AS f_stat FROM t, b"""


ANOVA_BRAND_SQL = _anova_sql(
    """SELECT * FROM reviews_v WHERE brand_name IN (
         SELECT brand_name FROM reviews_v WHERE brand_name IS NOT NULL GROUP BY brand_name ORDER BY count(*) DESC, brand_name LIMIT 5)""",
    "brand_name",
)


@register("anova_brand", covers="J10 H7", oracle=with_views(ANOVA_BRAND_SQL, "reviews_v"))
def anova_brand(spark, sf_dir):
    a = stats.anova_top_groups(view(spark, sf_dir, "reviews_v"), group_col="brand_name", k=5)
    return a.withColumn("f_stat", r9("f_stat"))


ANOVA_CAT_SQL = (
    _anova_sql(
        """SELECT * FROM reviews_v WHERE primary_category IN (
         SELECT primary_category FROM (SELECT primary_category, count(rating) AS c FROM reviews_v WHERE primary_category IS NOT NULL
                                       GROUP BY 1 ORDER BY 1 LIMIT 5) WHERE c >= 5)""",
        "primary_category",
    )
    + " WHERE k >= 3"
)


@register("anova_category", covers="J11", oracle=with_views(ANOVA_CAT_SQL, "reviews_v"))
def anova_category(spark, sf_dir):
    a = stats.anova_first_groups(view(spark, sf_dir, "reviews_v"), group_col="primary_category", k=5)
    return a.withColumn("f_stat", r9("f_stat"))


@register(
    "welch_ttest",
    covers="J12",
    oracle=with_views(
        f"""WITH m AS (SELECT count(rating) FILTER (WHERE sentiment_label = 'positive') AS n_a,
       avg(rating) FILTER (WHERE sentiment_label = 'positive') AS mean_a,
       var_samp(rating) FILTER (WHERE sentiment_label = 'positive') AS var_a,
       count(rating) FILTER (WHERE sentiment_label = 'negative') AS n_b,
       avg(rating) FILTER (WHERE sentiment_label = 'negative') AS mean_b,
       var_samp(rating) FILTER (WHERE sentiment_label = 'negative') AS var_b FROM reviews_v)
SELECT n_a, n_b, {q9('mean_a')} AS mean_a, {q9('mean_b')} AS mean_b,
       {q9('(mean_a - mean_b) / sqrt(var_a / n_a + var_b / n_b)')} AS t_stat,
       {q9('(var_a / n_a + var_b / n_b) * (var_a / n_a + var_b / n_b) / ((var_a / n_a) * (var_a / n_a) / (n_a - 1) + (var_b / n_b) * (var_b / n_b) / (n_b - 1))')} AS df
FROM m WHERE n_a > 5 AND n_b > 5""",
        "reviews_v",
    ),
)
def welch_ttest(spark, sf_dir):
    t = stats.welch_ttest(view(spark, sf_dir, "reviews_v"))
    return t.select("n_a", "n_b", *[r9(c).alias(c) for c in ("mean_a", "mean_b", "t_stat", "df")])


WELCH_SQL = """SELECT (mean_a - mean_b) / sqrt(va + vb) AS t_stat, (va + vb) * (va + vb) / (va * va / (n_a - 1) + vb * vb / (n_b - 1)) AS df
FROM (SELECT *, var_a / n_a AS va, var_b / n_b AS vb FROM (
  SELECT count(rating) FILTER (WHERE sentiment_label = 'positive') AS n_a, avg(rating) FILTER (WHERE sentiment_label = 'positive') AS mean_a,
         var_samp(rating) FILTER (WHERE sentiment_label = 'positive') AS var_a,
         count(rating) FILTER (WHERE sentiment_label = 'negative') AS n_b, avg(rating) FILTER (WHERE sentiment_label = 'negative') AS mean_b,
         var_samp(rating) FILTER (WHERE sentiment_label = 'negative') AS var_b FROM reviews_v)
WHERE n_a > 5 AND n_b > 5)"""


@register(
    "statistical_tests",
    covers="J10 J11 J12 U1",
    oracle=with_views(
        f"""WITH brand AS ({ANOVA_BRAND_SQL}), cat AS ({ANOVA_CAT_SQL}), welch AS ({WELCH_SQL}),
tests AS (SELECT 'anova_brand' AS test, f_stat AS statistic, {f_tail('f_stat', 'df_between', 'df_within')} AS p FROM brand
  UNION ALL SELECT 'anova_category', f_stat, {f_tail('f_stat', 'df_between', 'df_within')} FROM cat
  UNION ALL SELECT 'welch_t', t_stat, {t_tail('atan(abs(t_stat) / sqrt(df))', 'df')} FROM welch)
SELECT test, {q9('statistic')} AS statistic, {q9('p')} AS p_value, coalesce(p < 0.05, false) AS significant FROM tests""",
        "reviews_v",
    ),
)
def statistical_tests(spark, sf_dir):
    r = view(spark, sf_dir, "reviews_v")
    brand = stats.anova_top_groups(r, group_col="brand_name", k=5, with_p=True)
    cat = stats.anova_first_groups(r, group_col="primary_category", k=5, with_p=True)
    welch = stats.welch_ttest(r, with_p=True)

    def rows(df, test, stat):
        return df.select(
            F.lit(test).alias("test"),
            r9(stat).alias("statistic"),
            r9("p_value").alias("p_value"),
            F.coalesce(F.col("p_value") < 0.05, F.lit(False)).alias("significant"),
        )

    return rows(brand, "anova_brand", "f_stat").unionByName(rows(cat, "anova_category", "f_stat")).unionByName(rows(welch, "welch_t", "t_stat"))


@register(
    "sentiment_rating_corr",
    covers="J13",
    oracle=with_views(
        f"SELECT {q9(_corr('sentiment_score', 'rating'))} AS pearson_r, count(*) FILTER (WHERE sentiment_score IS NOT NULL AND rating IS NOT NULL) AS n FROM reviews_v",
        "reviews_v",
    ),
)
def sentiment_rating_corr(spark, sf_dir):
    return stats.pearson(view(spark, sf_dir, "reviews_v"), "sentiment_score", "rating").withColumn("pearson_r", r9("pearson_r"))


OLS_SQL = """SELECT regr_intercept(rating, sentiment_score) AS intercept, regr_slope(rating, sentiment_score) AS slope,
       regr_r2(rating, sentiment_score) AS r2, regr_count(rating, sentiment_score) AS n,
       min(sentiment_score) FILTER (WHERE rating IS NOT NULL) AS x_min, max(sentiment_score) FILTER (WHERE rating IS NOT NULL) AS x_max
FROM reviews_v"""


@register(
    "rating_on_sentiment_ols",
    covers="K9",
    oracle=with_views(
        f"WITH f AS ({OLS_SQL}) SELECT {q9('intercept')} AS intercept, {q9('slope')} AS slope, {q9('r2')} AS r2, CAST(n AS BIGINT) AS n FROM f",
        "reviews_v",
    ),
)
def rating_on_sentiment_ols(spark, sf_dir):
    f = stats.ols_fit(view(spark, sf_dir, "reviews_v"))
    return f.select(r9("intercept").alias("intercept"), r9("slope").alias("slope"), r9("r2").alias("r2"), "n")


@register(
    "ols_fit_line",
    covers="K9",
    oracle=with_views(
        f"""WITH f AS ({OLS_SQL}), pts AS (SELECT f.*, CAST(i AS INTEGER) AS i FROM f, range(0, 100) s(i))
SELECT i, {q9('x_min + (x_max - x_min) * i / 99')} AS x, {q9('intercept + slope * (x_min + (x_max - x_min) * i / 99)')} AS y_hat FROM pts""",
        "reviews_v",
    ),
)
def ols_fit_line(spark, sf_dir):
    line = stats.ols_line(stats.ols_fit(view(spark, sf_dir, "reviews_v")))
    return line.select("i", r9("x").alias("x"), r9("y_hat").alias("y_hat"))


@register(
    "sentiment_rating_points",
    covers="B24",
    oracle=with_views("SELECT order_id, line_no, sentiment_score, rating FROM reviews_v", "reviews_v"),
)
def sentiment_rating_points(spark, sf_dir):
    pts = stats.scatter_points(view(spark, sf_dir, "reviews_v"), "sentiment_score", "rating", keys=("order_id", "line_no"))
    return pts


def fixed(x: str, pattern: str = "%.3f") -> str:
    """DuckDB spelling of ``report.figure``."""
    return f"CASE WHEN ({x}) IS NULL THEN 'nan' ELSE printf('{pattern}', {rnd(x, int(pattern.split('.')[1][0]))} + 0.0) END"


@register(
    "correlation_report_lines",
    covers="A14 J4 J6",
    oracle=with_views(
        f"""WITH rep AS ({STRENGTH_SQL})
SELECT platform, pair, pair || '_' || platform || ': Spearman ' || {fixed('spearman_r')} || ' (p-value: ' || {fixed('spearman_p')} || ') | Pearson '
  || {fixed('pearson_r')} || ' (p-value: ' || {fixed('pearson_p')} || ') | Muestra ' || n || ' | ' || interpretation AS line FROM rep""",
        "reviews_v",
        "social_v",
    ),
)
def correlation_report_lines(spark, sf_dir):
    from glossa.sources import files

    dr, ds = _daily(spark, sf_dir)
    rep = stats.correlation_report(stats.platform_correlations(dr, ds, min_n=10, with_p=True))
    return files.report_lines(
        rep,
        "%s_%s: Spearman %.3f (p-value: %.3f) | Pearson %.3f (p-value: %.3f) | Muestra %d | %s",
        ["pair", "platform", "spearman_r", "spearman_p", "pearson_r", "pearson_p", "n", "interpretation"],
        ["platform", "pair"],
    )
