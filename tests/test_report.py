"""The correlation report as a table of lines and as text."""

import os

from pyspark.sql import functions as F

from glossa.operators import report, stats

CORR = "platform string, pair string, n long, pearson_r double, spearman_r double, pearson_p double, spearman_p double"


def _corr(spark, rows):
    return stats.correlation_report(spark.createDataFrame(rows, CORR))


def _lags(spark, rows=()):
    return spark.createDataFrame(list(rows), "platform string, lag int, n long, spearman_r double, is_best boolean")


def _lines(document, section):
    return [r.line for r in document.where(F.col("section") == section).orderBy("place").collect()]


def test_five_sections_by_hand(spark):
    corr = _corr(spark, [("tikTok", "a_vs_b", 40, 0.61, 0.7204, 0.001, 0.0004), ("x", "a_vs_b", 12, -0.2, -0.00004, 0.5, 0.9)])
    lags = _lags(spark, [("x", 0, 40, 0.1, False), ("x", 3, 37, -0.4567, True)])
    top = spark.createDataFrame([("#b", 5.0), ("#a", 5.0), ("#c", 9.0)], "hashtag string, engagement double")
    names = ["hashtag", "reviews_with_keyword", *[c for _, c, _ in report.IMPACT_FIGURES]]
    impact = spark.createDataFrame(
        [("#b", 3, 4.0, 3.5, 0.5, -0.25, 0.12345, -0.37345), ("#c", 7, 2.125, None, None, 0.1, None, None)],
        ", ".join(f"{c} {'string' if c == 'hashtag' else 'long' if c == 'reviews_with_keyword' else 'double'}" for c in names),
    )
    doc = report.correlation_document(corr, lags, top=top, impact=impact)
    assert _lines(doc, 1) == [report.STRONG_FOUND, "- a_vs_b_tikTok: 0.720"]
    assert _lines(doc, 2)[:5] == [
        "a_vs_b_tikTok:", "  Spearman: 0.720 (p-value: 0.000)", "  Pearson:  0.610 (p-value: 0.001)", "  Muestra:  40 puntos",
        "  Interpretacion: Correlacion FUERTE positiva (ESTADISTICAMENTE SIGNIFICATIVA)",
    ]
    assert _lines(doc, 2)[6] == "  Spearman: 0.000 (p-value: 0.900)"  # no negative zero
    tags = _lines(doc, 3)
    assert tags[0] == "Top hashtags por engagement: #c, #a, #b"
    assert tags[1:3] == ["Hashtag: #c", "  Reviews que mencionan: 7"] and tags[9] == "Hashtag: #b"
    b = dict(zip(names, impact.where("hashtag = '#b'").first()))
    assert tags[11:] == [f"  {name}: {pattern % b[c]}" for name, c, pattern in report.IMPACT_FIGURES]
    c = dict(zip(names, impact.where("hashtag = '#c'").first()))
    assert tags[3:9] == [f"  {name}: {pattern % c[col] if c[col] is not None else 'nan'}" for name, col, pattern in report.IMPACT_FIGURES]
    assert _lines(doc, 4) == ["Plataforma: x", "  Mejor lag: 3 dias", "  Correlacion en mejor lag: -0.457"]
    assert _lines(doc, 5) == [report.COUNT_ADVICE[0] % 1, report.COUNT_ADVICE[1], report.PLATFORM_ADVICE % "Tiktok"]


def test_empty_and_undefined(spark):
    empty = report.correlation_document(_corr(spark, []), _lags(spark))
    assert [(r.section, r.place, r.line) for r in empty.orderBy("section", "place").collect()] == [
        (1, 1, report.NONE_FOUND), (5, 1, report.NO_COUNT_ADVICE[0]), (5, 2, report.NO_COUNT_ADVICE[1]),
    ]
    undefined = report.correlation_document(_corr(spark, [("x", "p", 10, None, None, None, None)]), _lags(spark))
    assert _lines(undefined, 2)[1] == "  Spearman: nan (p-value: nan)"
    assert _lines(undefined, 2)[4] == f"  Interpretacion: {stats.NOT_SIGNIFICANT_TEXT}"


def test_text_in_order(spark, tmpdir_fresh):
    from glossa.sources import files

    doc = report.correlation_document(_corr(spark, [("x", "p", 10, 0.1, 0.2, 0.9, 0.9)]), _lags(spark))
    path = os.path.join(tmpdir_fresh, "report")
    files.write_report(report.as_text(doc), path)
    (part,) = [f for f in os.listdir(path) if f.startswith("part-")]
    text = open(os.path.join(path, part), encoding="utf-8").read().splitlines()
    assert text[:5] == [report.TITLE, "=" * len(report.TITLE), "", report.HEADINGS[0], "-" * (len(report.HEADINGS[0]) - 1)]
    assert [line for line in text if line in report.HEADINGS] == list(report.HEADINGS)
    assert text[text.index("p_x:") + 3] == "  Muestra:  10 puntos"
