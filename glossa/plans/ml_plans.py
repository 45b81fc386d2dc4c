"""Registered queries: review clustering, k-means restarts, and the social rating models.

The clustering over Spark ML's PCA, and the model split by Spark's own hash, have no SQL oracle; the
restarts and the models by moments do."""

from __future__ import annotations

from pyspark.sql import functions as F

from glossa.functions.numeric import r9
from glossa.functions.numeric import round_half_even
from glossa.operators import kmeans, marts, ml, pairwise, regression, social, stats
from glossa.operators import text as X
from glossa.plans.registry import r9 as q9
from glossa.plans.registry import register, rnd, savg, ssum
from glossa.sources.fixtures import view, with_views

PLATFORMS = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


def clustering_input(spark, sf_dir):
    """Reviews with text features of the product name (the review text stand-in)."""
    r = view(spark, sf_dir, "reviews_v").withColumn("sentiment_intensity", F.abs("sentiment_score"))
    return X.text_features(r, text_col="product_name")


@register("review_clusters", covers="K1 K2 K3 K4 F9", oracle=None)
def review_clusters(spark, sf_dir):
    clustered, _ = ml.cluster_reviews(clustering_input(spark, sf_dir))
    return marts.cluster_summary(clustered)


@register("cluster_info", covers="K5 V8", oracle=None)
def cluster_info(spark, sf_dir):
    clustered, info = ml.cluster_reviews(clustering_input(spark, sf_dir))
    return ml.cluster_info(clustered, info).withColumn("variance_explained", r9("variance_explained"))


def _model(spark, sf_dir):
    daily = social.daily_reviews(view(spark, sf_dir, "reviews_v"))
    pivot = social.social_pivot(view(spark, sf_dir, "social_v"), platforms=PLATFORMS)
    return ml.social_rating_model(daily, pivot)


@register("social_rating_model", covers="K6 K8 E4", oracle=None)
def social_rating_model(spark, sf_dir):
    metrics, _ = _model(spark, sf_dir)
    return metrics


@register("social_rating_coefficients", covers="K7", oracle=None)
def social_rating_coefficients(spark, sf_dir):
    _, coefs = _model(spark, sf_dir)
    return coefs


# ---------------------------------------------------------------- models by moments

DAILY = f"""daily AS (SELECT review_date AS date, {savg('rating')} AS avg_rating, {savg('sentiment_score')} AS avg_sentiment, count(*) AS review_count FROM reviews_v GROUP BY review_date),
panel AS (SELECT date, platform, sum(mention_volume) AS mention_volume, {ssum('engagement')} AS engagement FROM social_v GROUP BY date, platform)"""
PLATFORM_FEATURES = ["mention_volume", "engagement", "review_count"]
PIVOTED = [f"{m}_{p}" for p in PLATFORMS for m in ("mention_volume", "engagement")]


def trains(date) -> F.Column:
    """About four in five days, by the md5 of the date."""
    return F.substring(F.md5(date.cast("string").cast("binary")), 1, 1) < "d"


def ols_sql(frame: str, features: list[str], by: str) -> str:
    """CTEs up to ``model`` (by, i, beta, coefficient), ``inter`` and ``test`` over a frame (by, date, y, features): elimination step by step."""
    k = len(features)
    x = {i: f'"{f}"' for i, f in enumerate(features)} | {k: "y"}
    cells = " UNION ALL ".join(
        f"SELECT {by}, {i} AS i, {j} AS j, coalesce(covar_pop({x[i]}, {x[j]}) / nullif(stddev_pop({x[i]}) * stddev_pop({x[j]}), 0), 0) AS v FROM train GROUP BY {by}"
        for i in range(k)
        for j in range(k + 1)
    )
    steps = [f"s0 AS MATERIALIZED ({cells})"]
    for p in range(k):
        steps.append(f"""s{p + 1} AS MATERIALIZED (
  SELECT m.{by}, m.i, m.j, CASE WHEN m.i = {p} THEN m.v / piv.v ELSE m.v - r.v * c.v / piv.v END AS v
  FROM s{p} m JOIN s{p} piv ON piv.{by} = m.{by} AND piv.i = {p} AND piv.j = {p}
  JOIN s{p} c ON c.{by} = m.{by} AND c.i = {p} AND c.j = m.j JOIN s{p} r ON r.{by} = m.{by} AND r.i = m.i AND r.j = {p})""")
    scale = " UNION ALL ".join(f"SELECT {by}, {i} AS i, '{f}' AS feature, avg({x[i]}) AS mean, stddev_pop(y) / stddev_pop({x[i]}) AS scale FROM train GROUP BY {by}" for i, f in enumerate(features))
    columns = ", ".join(f"max(coefficient) FILTER (WHERE i = {i}) AS k{i}" for i in range(k))
    wide = " + ".join(f"{x[i]} * k{i}" for i in range(k))
    return f"""frame AS MATERIALIZED ({frame}),
enough AS (SELECT {by} FROM frame GROUP BY {by} HAVING count(*) >= 20),
train AS MATERIALIZED (SELECT frame.* FROM frame JOIN enough USING ({by}) WHERE substr(md5(CAST(date AS VARCHAR)), 1, 1) < 'd'),
{', '.join(steps)},
scaled AS ({scale}),
model AS MATERIALIZED (SELECT scaled.*, v AS beta, v * scale AS coefficient FROM s{k} JOIN scaled USING ({by}, i) WHERE j = {k}),
inter AS (SELECT {by}, my - sum(coefficient * mean) AS b FROM model JOIN (SELECT {by}, avg(y) AS my FROM train GROUP BY {by}) USING ({by}) GROUP BY {by}, my),
counted AS (SELECT {by}, count(*) AS n_rows, count(*) FILTER (WHERE substr(md5(CAST(date AS VARCHAR)), 1, 1) < 'd') AS n_train FROM frame GROUP BY {by}),
wide AS (SELECT {by}, {columns} FROM model GROUP BY {by}),
test AS (SELECT {by}, y, y - b - ({wide}) AS e FROM frame JOIN inter USING ({by}) JOIN wide USING ({by}) WHERE substr(md5(CAST(date AS VARCHAR)), 1, 1) >= 'd'),
top AS (SELECT {by}, feature, coefficient FROM model QUALIFY row_number() OVER (PARTITION BY {by} ORDER BY abs(coefficient) DESC, feature) = 1),
scored AS (SELECT {by}, count(*) AS n_test, 1 - avg(e * e) / nullif(var_pop(y), 0) AS r2, avg(e * e) AS mse, avg(abs(e)) AS mae FROM test GROUP BY {by})"""


def metrics_sql(by: str) -> str:
    return f"""SELECT {by}, n_rows, n_train, n_test, {q9('r2')} AS r2, {q9('mse')} AS mse, {q9('mae')} AS mae,
  CASE WHEN r2 > 0.3 THEN 'good' WHEN r2 > 0.1 THEN 'moderate' ELSE 'low' END AS grade, feature AS top_feature,
  CASE WHEN coefficient > 0 THEN 'positive' ELSE 'negative' END AS top_sign
FROM scored JOIN counted USING ({by}) JOIN top USING ({by})"""


PLATFORM_FRAME = "SELECT platform, date, avg_rating AS y, mention_volume, engagement, review_count FROM daily JOIN panel USING (date)"
PIVOT_FRAME = (
    "SELECT 'all' AS model, date, any_value(avg_rating) AS y, "
    + ", ".join(f"coalesce(max({f.split('_' + p)[0]}) FILTER (WHERE platform = '{p}'), 0) AS \"{f}\"" for p in PLATFORMS for f in PIVOTED if f.endswith(p))
    + " FROM daily JOIN panel USING (date) GROUP BY date"
)


def platform_frame(spark, sf_dir):
    return stats.correlation_panel(social.daily_reviews(view(spark, sf_dir, "reviews_v")), social.daily_social(view(spark, sf_dir, "social_v")))


def pivot_frame(spark, sf_dir):
    daily = social.daily_reviews(view(spark, sf_dir, "reviews_v"))
    frame, _ = ml.model_frame(daily, social.social_pivot(view(spark, sf_dir, "social_v"), platforms=PLATFORMS))
    return frame


def model_metrics(frame, features, *by):
    train = trains(F.col("date"))
    model = regression.fit(frame, "avg_rating", features, by=by, train=train)
    out = regression.metrics(model, frame, "avg_rating", features, by=by, train=train)
    return out.withColumns({c: r9(c) for c in ("r2", "mse", "mae")})


def model_coefficients(frame, features, *by):
    model = regression.fit(frame, "avg_rating", features, by=by, train=trains(F.col("date")))
    out = regression.coefficients(model, features, by=by)
    return out.select(*by, "feature", r9("beta").alias("beta"), round_half_even("coefficient", 15).alias("coefficient"))


COEFFICIENTS_SQL = "SELECT {by}, feature, {beta} AS beta, {coefficient} AS coefficient FROM model"


@register("platform_models", covers="K6 K8 E3", oracle=with_views(f"WITH {DAILY}, {ols_sql(PLATFORM_FRAME, PLATFORM_FEATURES, 'platform')} {metrics_sql('platform')}", "reviews_v", "social_v"))
def platform_models(spark, sf_dir):
    return model_metrics(platform_frame(spark, sf_dir), PLATFORM_FEATURES, "platform")


@register(
    "platform_model_coefficients",
    covers="K7",
    oracle=with_views(
        f"WITH {DAILY}, {ols_sql(PLATFORM_FRAME, PLATFORM_FEATURES, 'platform')} "
        + COEFFICIENTS_SQL.format(by="platform", beta=q9("beta"), coefficient=rnd("coefficient", 15)),
        "reviews_v", "social_v",
    ),
)
def platform_model_coefficients(spark, sf_dir):
    return model_coefficients(platform_frame(spark, sf_dir), PLATFORM_FEATURES, "platform")


@register("rating_model", covers="K6 K8 E4", oracle=with_views(f"WITH {DAILY}, {ols_sql(PIVOT_FRAME, PIVOTED, 'model')} {metrics_sql('model')}", "reviews_v", "social_v"))
def rating_model(spark, sf_dir):
    return model_metrics(pivot_frame(spark, sf_dir), PIVOTED).withColumn("model", F.lit("all"))


@register(
    "rating_model_coefficients",
    covers="K7",
    oracle=with_views(
        f"WITH {DAILY}, {ols_sql(PIVOT_FRAME, PIVOTED, 'model')} " + COEFFICIENTS_SQL.format(by="model", beta=q9("beta"), coefficient=rnd("coefficient", 15)),
        "reviews_v", "social_v",
    ),
)
def rating_model_coefficients(spark, sf_dir):
    return model_coefficients(pivot_frame(spark, sf_dir), PIVOTED).withColumn("model", F.lit("all"))


# ---------------------------------------------------------------- pairwise Spearman

PAIRWISE = ["user_id", "product_id", "rating", "sentiment_score", "line_no"]


def pairwise_sql() -> str:
    pairs = [(a, b) for i, a in enumerate(PAIRWISE) for b in PAIRWISE[i + 1 :]]
    parts = " UNION ALL ".join(f"SELECT '{a}' AS var_x, '{b}' AS var_y, {a}::DOUBLE AS x, {b}::DOUBLE AS y FROM dirty_reviews_v WHERE {a} IS NOT NULL AND {b} IS NOT NULL" for a, b in pairs)
    rank = lambda c: f"rank() OVER (PARTITION BY var_x, var_y ORDER BY {c}) + (count(*) OVER (PARTITION BY var_x, var_y, {c}) - 1) / 2.0"
    return f"""WITH p AS ({parts}), r AS (SELECT var_x, var_y, {rank('x')} AS rx, {rank('y')} AS ry FROM p)
SELECT var_x, var_y, count(*) AS n, {q9('corr(rx, ry)')} AS spearman_r FROM r GROUP BY var_x, var_y"""


@register("spearman_pairwise", covers="J9", oracle=with_views(pairwise_sql(), "dirty_reviews_v"))
def spearman_pairwise(spark, sf_dir):
    return pairwise.spearman_pairwise(view(spark, sf_dir, "dirty_reviews_v"), PAIRWISE).withColumn("spearman_r", r9("spearman_r"))


# ---------------------------------------------------------------- k-means restarts

KMEANS = {"k": 4, "restarts": 4, "iterations": 3, "seed": 42}
KMEANS_FEATURES = {"rating": "rating / 5.0", "sentiment_score": "sentiment_score", "name_length": "length(product_name) / 40.0"}


def kmeans_sql() -> str:
    k, restarts, iterations, seed = KMEANS.values()
    d = range(len(KMEANS_FEATURES))
    q = ", ".join(f"q{i}" for i in d)
    points = ", ".join(f"CAST(round_even(({e}) * 1e6, 0) AS BIGINT) AS q{i}" for i, e in enumerate(KMEANS_FEATURES.values()))
    square = " + ".join(f"(p.q{i} - c.m{i}) * (p.q{i} - c.m{i})" for i in d)
    pick = ", ".join(f"p.q{i}::DOUBLE AS m{i}" for i in d)
    steps, seen = [], "SELECT NULL::BIGINT AS r, NULL::BIGINT AS c, " + ", ".join(f"NULL::DOUBLE AS m{i}" for i in d) + " WHERE false"
    for step in range(k):
        key = f"md5(concat_ws(':', '{seed}', r, '{step}', {', '.join(f'p.q{i}' for i in d)}))"
        distance = "1.0" if step == 0 else f"(SELECT min({square}) FROM g{step - 1} c WHERE c.r = rr.r)"
        steps.append(f"""g{step} AS MATERIALIZED ({seen if step == 0 else f'SELECT * FROM g{step - 1}'} UNION ALL
  SELECT r, {step} AS c, {pick} FROM (
    SELECT r, p, -ln((('0x' || substr({key}, 1, 8))::BIGINT + 0.5) / 4294967296.0) / (w * {distance}) AS e FROM p, rr WHERE {distance} > 0
  ) x QUALIFY row_number() OVER (PARTITION BY r ORDER BY e, {', '.join(f'p.q{i}' for i in d)}) = 1)""")
    last = f"g{k - 1}"
    for t in range(iterations + 1):
        steps.append(f"""a{t} AS MATERIALIZED (SELECT r, {q}, w, min({{'d': d, 'c': c}}) AS best FROM (SELECT c.r, {', '.join(f'p.q{i}' for i in d)}, w, c.c, {square} AS d FROM p, {last} c) GROUP BY r, {q}, w),
u{t} AS MATERIALIZED (SELECT r, best.c AS c, sum(w) AS n, CAST(sum(CAST(best.d * w AS DECIMAL(38,6))) AS DOUBLE) AS cost, {', '.join(f'sum(q{i} * w)::DOUBLE / sum(w) AS m{i}' for i in d)} FROM a{t} GROUP BY ALL)""")
        if t < iterations:
            steps.append(f"c{t} AS MATERIALIZED (SELECT r, c, {', '.join(f'coalesce(u{t}.m{i}, {last}.m{i}) AS m{i}' for i in d)} FROM {last} LEFT JOIN u{t} USING (r, c))")
            last = f"c{t}"
    means = ", ".join(f"{q9(f'm{i} / 1e6')} AS {name}" for i, name in enumerate(KMEANS_FEATURES))
    return f"""WITH p AS MATERIALIZED (SELECT {q}, count(*) AS w FROM (SELECT {points} FROM reviews_v) GROUP BY ALL), rr AS (SELECT unnest(range({restarts})) AS r),
{', '.join(steps)}, total AS (SELECT r, sum(cost) AS cost FROM u{iterations} GROUP BY r)
SELECT r::INTEGER AS restart, c::INTEGER AS cluster, n::BIGINT AS n, {means}, {q9('total.cost / 1e12')} AS cost, r = (SELECT arg_min(r, cost) FROM total) AS is_best
FROM u{iterations} JOIN total USING (r)"""


@register("kmeans_restarts", covers="K3", oracle=with_views(kmeans_sql(), "reviews_v"))
def kmeans_restarts(spark, sf_dir):
    r = view(spark, sf_dir, "reviews_v")
    points = kmeans.weighted_points(r, [F.expr(e) for e in KMEANS_FEATURES.values()])
    ends = kmeans.fit(points, len(KMEANS_FEATURES), **KMEANS)
    first = kmeans.best(ends).restart
    rows = [
        (e.restart, c, n, *[x / kmeans.SCALE for x in mean], e.cost / kmeans.SCALE**2, e.restart == first)
        for e in ends
        for c, (n, mean) in enumerate(zip(e.sizes, e.means))
        if n
    ]
    names = ", ".join(f"{name} double" for name in KMEANS_FEATURES)
    out = spark.createDataFrame(rows, f"restart int, cluster int, n long, {names}, cost double, is_best boolean")
    return out.withColumns({c: r9(c) for c in (*KMEANS_FEATURES, "cost")})
