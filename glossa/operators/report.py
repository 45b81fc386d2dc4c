"""The correlation report as one ordered table of lines, and as text.

Five sections: strong correlations, all correlations, hashtag impact, best lags, recommendations. Every
input is a small result table (platforms x pairs, top hashtags, platforms x lags), so the order of the
lines is a window over each section. An undefined figure (a constant side, no review without the keyword)
is written ``nan``; numbers are rounded half to even.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from glossa.functions.numeric import col_, round_half_even, top_k
from glossa.operators import social, stats

# Title, headings and sentences of the report.
TITLE = "Reporte de Correlacion: Reviews vs Redes Sociales"
HEADINGS = (
    "RESUMEN EJECUTIVO:",
    "CORRELACIONES POR PLATAFORMA:",
    "IMPACTO DE HASHTAGS:",
    "ANALISIS DE SERIES TEMPORALES:",
    "RECOMENDACIONES:",
)
STRONG_FOUND = "Correlaciones significativas encontradas (|r| > 0.5, p < 0.05):"
NONE_FOUND = "No se encontraron correlaciones fuertes significativas."
IMPACT_FIGURES = (
    ("Rating promedio (con keyword)", "avg_rating_with_keyword", "%.2f"),
    ("Rating promedio (sin keyword)", "avg_rating_without_keyword", "%.2f"),
    ("Diferencia en rating", "rating_difference", "%+.2f"),
    ("Sentimiento promedio (con keyword)", "avg_sentiment_with_keyword", "%.3f"),
    ("Sentimiento promedio (sin keyword)", "avg_sentiment_without_keyword", "%.3f"),
    ("Diferencia en sentimiento", "sentiment_difference", "%+.3f"),
)
COUNT_ADVICE = ("- Se encontraron %d correlaciones fuertes significativas", "- Considera monitorear estas metricas para prediccion de ventas")
NO_COUNT_ADVICE = ("- No se encontraron correlaciones fuertes consistentes", "- Considera revisar la estrategia de redes sociales")
PLATFORM_ADVICE = "- %s muestra correlaciones moderadas, buena plataforma para campañas"


def figure(c: str | Column, pattern: str = "%.3f") -> Column:
    """A number by ``pattern`` (``%.2f``, ``%+.3f``); without a negative zero, NULL as ``nan``."""
    places = int(pattern.split(".")[1].rstrip("f"))
    value = round_half_even(c, places) + F.lit(0.0)
    return F.when(col_(c).isNull(), F.lit("nan")).otherwise(F.format_string(pattern, value))


def _lines(df: DataFrame, section: int, order: tuple[Column, Column], lines: Column) -> DataFrame:
    major, minor = order
    return df.select(F.lit(section).alias("section"), major.cast("double").alias("_major"), minor.cast("string").alias("_minor"), F.posexplode(lines).alias("_pos", "line"))


def _key() -> Column:
    return F.concat_ws("_", "pair", "platform")


def _summary(report: DataFrame) -> DataFrame:
    strong = report.where("is_strong")
    head = report.agg(F.count_if("is_strong").alias("n")).select(F.array(F.when(F.col("n") > 0, STRONG_FOUND).otherwise(NONE_FOUND)).alias("lines"))
    items = F.array(F.concat(F.lit("- "), _key(), F.lit(": "), figure("spearman_r")))
    return _lines(head, 1, (F.lit(0), F.lit("")), F.col("lines")).unionByName(_lines(strong, 1, (F.lit(1), F.concat_ws("\t", "platform", "pair")), items))


def _correlations(report: DataFrame) -> DataFrame:
    both = lambda name, r, p: F.concat(F.lit(name), figure(r), F.lit(" (p-value: "), figure(p), F.lit(")"))
    lines = F.array(
        F.concat(_key(), F.lit(":")),
        both("  Spearman: ", "spearman_r", "spearman_p"),
        both("  Pearson:  ", "pearson_r", "pearson_p"),
        F.format_string("  Muestra:  %d puntos", "n"),
        F.concat(F.lit("  Interpretacion: "), F.coalesce("interpretation", F.lit(stats.NOT_SIGNIFICANT_TEXT))),
    )
    return _lines(report, 2, (F.lit(0), F.concat_ws("\t", "platform", "pair")), lines)


def _hashtags(top: DataFrame, impact: DataFrame) -> DataFrame:
    """The top list, then the hashtags found in reviews, best engagement first."""
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("engagement")).alias("by"), "hashtag")))
    names = top.agg(F.array_join(F.transform(ordered, lambda s: s["hashtag"]), ", ").alias("names"))
    head = _lines(names, 3, (F.lit(-1.0), F.lit("")), F.array(F.concat(F.lit("Top hashtags por engagement: "), F.col("names"))))
    ranked = top.select("hashtag", F.row_number().over(Window.orderBy(F.col("engagement").desc(), "hashtag")).alias("_rank"))
    lines = F.array(
        F.concat(F.lit("Hashtag: "), F.col("hashtag")),
        F.format_string("  Reviews que mencionan: %d", "reviews_with_keyword"),
        *[F.concat(F.lit(f"  {name}: "), figure(c, pattern)) for name, c, pattern in IMPACT_FIGURES],
    )
    return head.unionByName(_lines(impact.join(ranked, "hashtag"), 3, (F.col("_rank"), F.col("hashtag")), lines))


def _best_lags(lags: DataFrame) -> DataFrame:
    lines = F.array(
        F.concat(F.lit("Plataforma: "), F.col("platform")),
        F.format_string("  Mejor lag: %d dias", "lag"),
        F.concat(F.lit("  Correlacion en mejor lag: "), figure("spearman_r")),
    )
    return _lines(lags.where("is_best"), 4, (F.lit(0), F.col("platform")), lines)


def _advice(report: DataFrame) -> DataFrame:
    n = report.agg(F.count_if("is_strong").alias("n"))
    found = F.array(F.format_string(COUNT_ADVICE[0], "n"), F.lit(COUNT_ADVICE[1]))
    head = _lines(n, 5, (F.lit(0), F.lit("")), F.when(F.col("n") > 0, found).otherwise(F.array(*map(F.lit, NO_COUNT_ADVICE))))
    name = F.concat(F.upper(F.substring("platform", 1, 1)), F.lower(F.expr("substring(platform, 2)")))
    platforms = stats.platform_recommendations(report).where("recommended")
    return head.unionByName(_lines(platforms, 5, (F.lit(1), F.col("platform")), F.array(F.format_string(PLATFORM_ADVICE, name))))


def correlation_document(report: DataFrame, lags: DataFrame, *, top: DataFrame | None = None, impact: DataFrame | None = None) -> DataFrame:
    """The report as ``(section, heading, place, line)``, lines numbered from 1 within their section.

    ``report``: ``stats.correlation_report`` with p-values; ``lags``: ``stats.lag_correlations``; ``top``: the
    hashtags by mean engagement (``hashtag, engagement``); ``impact``: ``social.hashtag_impact``. Without hashtags
    their section is empty. A NULL platform counts as an empty name in keys. Inputs are read
    several times: store them first where they are not small to compute.
    """
    parts = _summary(report).unionByName(_correlations(report)).unionByName(_best_lags(lags)).unionByName(_advice(report))
    if top is not None and impact is not None:
        parts = parts.unionByName(_hashtags(top, impact))
    place = F.row_number().over(Window.partitionBy("section").orderBy("_major", "_minor", "_pos"))
    headings = F.element_at(F.array(*map(F.lit, HEADINGS)), F.col("section"))
    return parts.select("section", headings.alias("heading"), place.alias("place"), "line")


def top_hashtags(social_rows: DataFrame, k: int = 10) -> DataFrame:
    """H1: the ``k`` hashtags of greatest mean engagement (ties: smaller name)."""
    means = social.hashtag_means(social_rows).select("hashtag", "engagement")
    return top_k(means, k, [F.col("engagement").desc(), F.col("hashtag").asc()])


def as_text(document: DataFrame) -> DataFrame:
    """The whole report in order, ``(section, place, line)``: title, headings with their rules, lines, blank lines."""
    spark = document.sparkSession
    heads = [(0, 1, TITLE), (0, 2, "=" * len(TITLE))]
    for i, heading in enumerate(HEADINGS, 1):
        heads += [(i, -2, ""), (i, -1, heading), (i, 0, "-" * (len(heading) - 1))]
    fixed = spark.createDataFrame(heads, "section int, place int, line string")
    return fixed.unionByName(document.select("section", "place", "line")).orderBy("section", "place")
