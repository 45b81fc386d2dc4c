"""Rule-based sentiment: scores worked out by hand."""

import math

import pytest

from glossa.operators import valence as V

LEXICON = [("good", 2.0), ("bad", -2.0), ("fine", 1.0), ("fine", 3.0), ("kiss", 2.0), ("kiss of death", -1.5), ("of death", -3.0), ("ü", 1.0)]
POLARITY = [("good", 0.7), ("bad", -0.7), ("not bad at", 0.9), ("dull", -0.4)]
MODIFIERS = [("very", 1.3), ("really", 1.2), ("slightly", 0.5), ("zero", 0.0)]


def compound(s):
    return s / math.sqrt(s * s + 15)


def scores(spark, fn, texts, *tables, **kw):
    rows = [(k, t, "x") for k, t in enumerate(texts)]
    out = fn(spark.createDataFrame(rows, "id long, t string, ahead string"), *tables, text_col="t", out="score", **kw).orderBy("id").collect()
    assert [r["ahead"] for r in out] == ["x"] * len(texts)
    return [r["score"] for r in out]


def test_valence_rules(spark):
    cases = {
        "good": 2.0,
        "Good film": 2.0,
        "a GOOD film": 2.733,                      # capitals among others
        "GOOD FILM": 2.0,                          # nothing but capitals
        "very good": 2.293,
        "really very good": 2.293 + 0.293 * 0.95,
        "very bad": -2.293,                        # away from zero
        "VERY good": 2 + 0.293 + 0.733,
        "slightly good": 2 - 0.293,
        "not good": 2 * -0.74,
        "not so very good": (2 + 0.293 + 0.293 * 0.95) * -0.74,
        "not one two three good": 2.0,             # four tokens before
        "good but bad": 2 * 0.5 - 2 * 1.5,
        "bad but good but good": -2 * 0.5 + 2 * 1.5 * 2,
        "good!!": 2 + 2 * 0.292,
        "bad !!!!!!": -2 - 4 * 0.292,
        "good??": 2 + 2 * 0.18,
        "good ????": 2 + 0.96,
        "fine": 2.0,                               # listed twice
        "the kiss of death": -1.5,                 # the longest at its place, and nothing inside
        "of death": -3.0,
        "kiss of": 2.0,
        "Ü ü": 1.733 + 1.0,
        "": 0.0,
        None: 0.0,
        "nothing known": 0.0,
    }
    lexicon = spark.createDataFrame(LEXICON + [(None, 1.0), ("good", None)], "token string, valence double")
    got = scores(spark, V.valence_scores, [*cases, *cases], lexicon)  # every text twice
    assert got == pytest.approx([compound(s) for s in cases.values()] * 2, abs=1e-12)


def test_polarity_runs_of_modifiers(spark):
    cases = {
        "good": 0.7,
        "very good": 0.91,
        "really very good": 1.0,                   # 0.7 * 1.2 * 1.3 = 1.092, at most 1
        "slightly very dull": -0.4 * 0.5 * 1.3,
        "very slightly": 0.0,                      # modifiers alone
        "not good": -0.35,
        "not very good": 0.7 * -0.5 / 1.3,
        "not really very good": 0.7 * -0.5 / 1.2 / 1.3,
        "not x good": 0.7,
        "very x good": 0.7,
        "not not bad": 0.35,
        "not bad at all": 0.9,                     # the phrase before its words
        "good and bad": 0.0,
        "good dull": 0.15,
        "zero good": 0.7,                          # no intensity of zero
        "": 0.0,
        None: 0.0,
    }
    polarity = spark.createDataFrame(POLARITY, "token string, polarity double")
    modifiers = spark.createDataFrame(MODIFIERS, "token string, intensity double")
    assert scores(spark, V.polarity_scores, list(cases), polarity, modifiers) == pytest.approx(list(cases.values()), abs=1e-12)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "token string, valence double")
    assert scores(spark, V.valence_scores, ["good"], none) == [0.0]
    assert V.valence_scores(spark.createDataFrame([], "t string"), none, text_col="t").collect() == []


def test_analyze_blends_both(spark):
    out = V.analyze(spark.createDataFrame([("This is great",), ("It is not good",), ("plain",)], "cleaned_text string"))
    got = {r["cleaned_text"]: r for r in out.collect()}
    assert got["This is great"]["sentiment_label"] == "positive" and got["It is not good"]["sentiment_label"] == "negative"
    assert got["plain"]["sentiment_score"] == 0 and got["plain"]["sentiment_label"] == "neutral"
    r = got["It is not good"]
    assert r["sentiment_score"] == (r["vader_compound"] + r["textblob_sentiment"]) / 2 and r["sentiment_intensity"] == -r["sentiment_score"]


def test_a_long_text_and_a_hot_text(spark):
    long = " ".join(["very good filler"] * 30_000)
    lexicon = spark.createDataFrame(LEXICON, "token string, valence double")
    got = scores(spark, V.valence_scores, [long] + ["good"] * 50, lexicon)
    assert got[0] > 0.999 and got[1:] == [compound(2.0)] * 50


def plan_of(spark, name):
    from glossa.plans.registry import all_queries

    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20k")  # less than the texts
    try:
        return all_queries()[name].build(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_valence_tokens_stay_with_their_text(spark):
    plan = plan_of(spark, "rule_valence")
    assert "hashpartitioning(first" not in plan and "hashpartitioning(lower(" not in plan  # one exchange of texts, none of tokens


def test_polarity_tokens_stay_with_their_text(spark):
    plan = plan_of(spark, "rule_polarity")
    assert "hashpartitioning(first" not in plan and "hashpartitioning(lower(" not in plan
