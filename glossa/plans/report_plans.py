"""Registered query: the correlation report of five sections as one ordered table."""

from __future__ import annotations

from glossa.operators import report, social, stats
from glossa.plans.registry import register, rnd
from glossa.plans.social_plans import IMPACT_SQL
from glossa.plans.stats_plans import LAG_SQL, STRENGTH_SQL, fixed
from glossa.session import written
from glossa.sources.fixtures import view, with_views


def _rows(section: int, major: str, minor: str, lines: list[str], source: str) -> str:
    """Lines of a section from a relation, one row a line."""
    listed = ", ".join(f"({pos}, {line})" for pos, line in enumerate(lines))
    return f"SELECT {section} AS section, ({major})::DOUBLE AS major, {minor} AS minor, l.pos, l.line FROM {source}, LATERAL (VALUES {listed}) l(pos, line)"


KEY = "pair || '_' || platform"
ORDER = "platform || chr(9) || pair"
PARTS = [
    _rows(1, "0", "''", [f"CASE WHEN n > 0 THEN '{report.STRONG_FOUND}' ELSE '{report.NONE_FOUND}' END"], "strong"),
    _rows(1, "1", ORDER, [f"'- ' || {KEY} || ': ' || {fixed('spearman_r')}"], "(SELECT * FROM rep WHERE is_strong)"),
    _rows(
        2, "0", ORDER,
        [
            f"{KEY} || ':'",
            f"'  Spearman: ' || {fixed('spearman_r')} || ' (p-value: ' || {fixed('spearman_p')} || ')'",
            f"'  Pearson:  ' || {fixed('pearson_r')} || ' (p-value: ' || {fixed('pearson_p')} || ')'",
            "'  Muestra:  ' || n || ' puntos'",
            f"'  Interpretacion: ' || coalesce(interpretation, '{stats.NOT_SIGNIFICANT_TEXT}')",
        ],
        "rep",
    ),
    _rows(3, "-1", "''", ["'Top hashtags por engagement: ' || names"], "(SELECT coalesce(string_agg(hashtag, ', ' ORDER BY place), '') AS names FROM tags)"),
    _rows(
        3, "place", "hashtag",
        [
            "'Hashtag: ' || hashtag",
            "'  Reviews que mencionan: ' || reviews_with_keyword",
            *[f"'  {name}: ' || {fixed(c, pattern)}" for name, c, pattern in report.IMPACT_FIGURES],
        ],
        "(SELECT * FROM impact JOIN tags USING (hashtag))",
    ),
    _rows(
        4, "0", "platform",
        ["'Plataforma: ' || platform", "'  Mejor lag: ' || lag || ' dias'", f"'  Correlacion en mejor lag: ' || {fixed('spearman_r')}"],
        "(SELECT * FROM lags WHERE is_best)",
    ),
    _rows(
        5, "0", "''",
        [f"CASE WHEN n > 0 THEN printf('{a}', n) ELSE '{b}' END" if "%d" in a else f"CASE WHEN n > 0 THEN '{a}' ELSE '{b}' END"
         for a, b in zip(report.COUNT_ADVICE, report.NO_COUNT_ADVICE)],
        "strong",
    ),
    _rows(
        5, "1", "platform",
        [f"printf('{report.PLATFORM_ADVICE}', upper(platform[1]) || lower(substring(platform, 2)))"],
        "(SELECT platform FROM rep GROUP BY platform HAVING avg(abs(spearman_r)) > 0.4)",
    ),
]
HEADING = "CASE section " + " ".join(f"WHEN {i} THEN '{h}'" for i, h in enumerate(report.HEADINGS, 1)) + " END"
DOCUMENT_SQL = f"""WITH rep AS MATERIALIZED ({STRENGTH_SQL}), lags AS ({LAG_SQL}), impact AS ({IMPACT_SQL}),
strong AS (SELECT count(*) FILTER (WHERE is_strong) AS n FROM rep),
tags AS (SELECT hashtag, row_number() OVER (ORDER BY avg(engagement) DESC, hashtag) AS place FROM social_words_v WHERE hashtag IS NOT NULL
  GROUP BY hashtag ORDER BY place LIMIT 10),
lines AS ({' UNION ALL '.join(PARTS)})
SELECT section, {HEADING} AS heading, CAST(row_number() OVER (PARTITION BY section ORDER BY major, minor, pos) AS INTEGER) AS place, line FROM lines"""


@register(
    "correlation_document",
    covers="A14 J4 J5 J6 J7 E7 F39 H1",
    oracle=with_views(DOCUMENT_SQL, "reviews_v", "social_v", "social_words_v"),
)
def correlation_document(spark, sf_dir):
    reviews, words = view(spark, sf_dir, "reviews_v"), view(spark, sf_dir, "social_words_v")
    daily_r = written(social.daily_reviews(reviews), "daily-reviews")
    daily_s = written(social.daily_social(view(spark, sf_dir, "social_v")), "daily-social")
    corr = written(stats.correlation_report(stats.platform_correlations(daily_r, daily_s, with_p=True)), "correlations")
    lags = written(stats.lag_correlations(daily_r, daily_s), "lags")
    top = written(report.top_hashtags(words), "top-hashtags")
    impact = social.hashtag_impact(reviews.withColumnRenamed("product_name", "cleaned_text"), words)
    return report.correlation_document(corr, lags, top=top, impact=impact)
