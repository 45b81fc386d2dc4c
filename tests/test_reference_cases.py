"""The reference's own test cases, on our operators."""

from glossa.operators import sentiment, text


def test_data_cleaning(spark):
    rows = [("Great product!", 5.0, 1), ("Not good", 1.0, 2), ("Average product", 3.0, 3), ("", None, 4), ("   ", 2.0, 5)]
    df = spark.createDataFrame(rows, "review_text string, rating double, product_id long")
    out = text.clean_reviews(df).collect()
    assert len(out) == 3
    assert all(1 <= r["rating"] <= 5 for r in out)
    assert sorted(r["product_id"] for r in out) == [1, 2, 3]


def test_sentiment_analysis(spark):
    rows = [("I love this product!", 5.0), ("This is terrible", 1.0), ("It is okay", 3.0)]
    df = spark.createDataFrame(rows, "cleaned_text string, rating double")
    out = sentiment.analyze(df).collect()
    assert {"sentiment_score", "sentiment_label"} <= set(out[0].asDict())
    assert all(-1 <= r["sentiment_score"] <= 1 for r in out)
    labels = {r["cleaned_text"]: r["sentiment_label"] for r in out}
    assert labels["I love this product!"] == "positive"
    assert labels["This is terrible"] == "negative"
