"""Sources/sinks on temporary CSV/JSON/Parquet written from the test tables, and
the streaming path (S1–S3)."""

import json
import os

import pytest
from pyspark.sql import functions as F

from glossa.sources import files
from glossa.sources.fixtures import read_table
from glossa.streaming import tweets as S

SF = "/root/testdata/sf0.001"


def _write_csv(path, header, rows):
    with open(path, "w", encoding="utf-8") as f:
        f.write(",".join(header) + "\n")
        for r in rows:
            f.write(",".join('"' + str(v).replace('"', '""') + '"' if v is not None else "" for v in r) + "\n")


@pytest.fixture()
def review_folder(spark, tmpdir_fresh):
    docs = read_table(spark, SF, "documents").select("doc_id", "text").orderBy("doc_id").limit(40).collect()
    rows = [(d.text, (d.doc_id % 5) + 1, d.doc_id % 7, "2024-01-0%d" % (d.doc_id % 9 + 1)) for d in docs]
    _write_csv(os.path.join(tmpdir_fresh, "reviews_0.csv"), ["review_text", "rating", "product_id", "submission_time"], rows[:20])
    _write_csv(os.path.join(tmpdir_fresh, "reviews_1.csv"), ["review_text", "rating", "product_id", "skin_type"], [(r[0], r[1], r[2], "Oily ") for r in rows[20:]])
    _write_csv(os.path.join(tmpdir_fresh, "reviews_2.csv"), ["text_only", "rating"], [("x", 1)])
    open(os.path.join(tmpdir_fresh, "reviews_3.csv"), "w").close()
    _write_csv(os.path.join(tmpdir_fresh, "product_info.csv"), ["product_id", "product_name", "brand_name", "price"], [(i, f"p{i}", f"b{i % 3}", 9.5) for i in range(5)])
    _write_csv(os.path.join(tmpdir_fresh, "product_bad.csv"), ["product_id", "name"], [(1, "x")])
    return tmpdir_fresh


def test_list_and_admit(spark, review_folder):
    paths = files.list_files(spark, review_folder)
    # the zero-byte part is in no scan: it holds no rows
    assert sorted(os.path.basename(p) for p in paths) == ["reviews_0.csv", "reviews_1.csv", "reviews_2.csv"]
    combined, quarantine = files.read_review_parts(spark, review_folder)
    reasons = {os.path.basename(r.path): r.reason for r in quarantine.collect()}
    assert set(reasons) == {"reviews_2.csv", "reviews_3.csv"} and reasons["reviews_2.csv"].startswith("missing columns")
    assert reasons["reviews_3.csv"] == "empty"
    assert combined.count() == 40
    assert {"submission_time", "skin_type", "user_id"} <= set(combined.columns)
    assert combined.filter(F.col("skin_type").isNull()).count() == 20


def test_headers_of_a_thousand_files_in_one_job(spark, tmpdir_fresh):
    for k in range(1000):
        header = ["review_text", "rating", "product_id"] if k % 3 else ["product_id", "rating", "review_text", "extra col"]
        _write_csv(os.path.join(tmpdir_fresh, f"reviews_{k:04d}.csv"), header if k % 100 else ["rating"], [("t", k, 1)])
    paths = files.list_files(spark, tmpdir_fresh)
    spark.sparkContext.setJobGroup("headers", "headers")
    try:
        admitted, quarantine = files.admit_files(spark, paths)
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("headers")
    finally:
        spark.sparkContext.setJobGroup("", "")
    assert len(admitted) == 990 and quarantine.count() == 10
    assert len(jobs) <= 8  # the lines of all files, their merge, and one read for each of three headers


def test_headers_that_a_line_does_not_hold(spark, tmpdir_fresh):
    for name, text in {"a": '"review_text","rating","product_id\nlong"\nx,1,2\n', "b": "\ufeffreview_text,rating,product_id\nx,1,2\n", "c": "\n", "d e": "review_text,rating,product_id\nx,1,2\n"}.items():
        with open(os.path.join(tmpdir_fresh, f"reviews_{name}.csv"), "w", encoding="utf-8") as f:
            f.write(text)
    admitted, quarantine = files.admit_files(spark, files.list_files(spark, tmpdir_fresh))
    assert sorted(os.path.basename(files.unquote(p)) for p in admitted) == ["reviews_b.csv", "reviews_d e.csv"]
    reasons = {os.path.basename(r.path): r.reason for r in quarantine.collect()}
    assert reasons == {"reviews_a.csv": "missing columns: product_id", "reviews_c.csv": "empty"}


def test_uniform_parts_single_scan_with_corrupt_rows(spark, tmpdir_fresh):
    from pyspark.sql.types import StringType, StructField, StructType

    hdr = ["review_text", "rating", "product_id"]
    _write_csv(os.path.join(tmpdir_fresh, "reviews_a.csv"), hdr, [("good one", 5, 1), ("fine", 4, 2)])
    with open(os.path.join(tmpdir_fresh, "reviews_b.csv"), "w") as f:
        f.write("review_text,rating,product_id\n\"ok\",3,3\n\"too\",\"many\",\"fields\",\"here\"\n")
    schema = StructType([StructField(c, StringType()) for c in hdr])
    good, quarantine = files.read_review_parts(spark, tmpdir_fresh, schema=schema)
    assert good.count() == 3
    q = quarantine.collect()
    assert len(q) == 1 and q[0].path.endswith("reviews_b.csv")


def test_every_row_is_admitted_or_quarantined(spark, tmpdir_fresh):
    with open(os.path.join(tmpdir_fresh, "reviews_a.csv"), "w") as f:
        f.write('review_text,rating,product_id\n"a, b",3,p1\ntoo,many,fields,here\nfew\n"two\nlines",5,p2\n')
    with open(os.path.join(tmpdir_fresh, "reviews_b.csv"), "w") as f:
        f.write("product_id,review_text,rating\np3,world,4\n")
    good, quarantine = files.read_review_parts(spark, tmpdir_fresh)
    rows = {(r.review_text, r.rating, r.product_id) for r in good.collect()}
    assert rows == {("a, b", "3", "p1"), ("two\nlines", "5", "p2"), ("world", "4", "p3")}
    assert quarantine.count() == 2 and {r.record for r in quarantine.collect()} == {"too,many,fields,here", "few"}
    assert good.select("rating").count() == 3 and good.count() + quarantine.count() == 5


def test_no_files_is_an_error(spark, tmpdir_fresh):
    with pytest.raises(files.NoInputError):
        files.list_files(spark, tmpdir_fresh)


def test_products_dimension(spark, review_folder):
    assert files.read_products(spark, os.path.join(review_folder, "product_info.csv")).count() == 5
    assert files.read_products(spark, os.path.join(review_folder, "product_bad.csv")) is None
    assert files.read_products(spark, os.path.join(review_folder, "missing.csv")) is None


def test_ingest_to_processed(spark, review_folder, tmpdir_fresh):
    from glossa.operators import joins, sentiment
    from glossa.operators import text as X

    combined, _ = files.read_review_parts(spark, review_folder)
    products = files.read_products(spark, os.path.join(review_folder, "product_info.csv"))
    merged = joins.merge_products(combined, products)
    cleaned = X.clean_reviews(merged.drop("submission_time"))
    scored = sentiment.analyze(X.keyword_insights(X.categorize(cleaned)))
    feats = X.text_features(scored)
    out = os.path.join(tmpdir_fresh, "processed")
    files.write_processed(feats, out)
    back = files.read_parquet(spark, out)
    assert back.count() == cleaned.count() > 0
    assert back.columns[:3] == ["review_text", "cleaned_text", "rating"]
    assert files.read_parquet(spark, os.path.join(tmpdir_fresh, "nope")) is None
    minimal = files.processed_projection(feats, minimal=True)
    assert minimal.columns == ["review_text", "cleaned_text", "rating", "sentiment_score", "sentiment_label"]


def test_jobs_end_to_end(spark, review_folder, tmpdir_fresh):
    from glossa import jobs

    out = os.path.join(tmpdir_fresh, "out")
    ing = jobs.ingest_job(spark, review_folder, os.path.join(review_folder, "product_info.csv"), out)
    rep = ing["report"].collect()[0]
    assert rep.total_rows == 40 and rep.unique_brands == 3 and rep.match_pct is not None
    tr = jobs.transform_job(spark, ing["combined"], out, n_init=2)
    processed = spark.read.parquet(os.path.join(out, "processed"))
    assert processed.count() == tr["processed"].count() > 0
    assert {"user_cluster", "sentiment_label", "main_concerns", "text_word_count"} <= set(processed.columns)
    for name in ("temporal_metrics", "product_metrics", "brand_summary", "category_summary", "cluster_summary"):
        assert spark.read.parquet(os.path.join(out, name)).count() > 0
    days = processed.select(F.to_date("review_date").alias("date")).distinct()
    soc = days.select(
        "date", F.explode(F.array(F.lit("ig"), F.lit("tt"))).alias("platform"), F.lit("#x").alias("hashtag"),
        F.lit(1).alias("mention_volume"), F.lit(2.0).alias("engagement"),
    )
    jobs.correlation_job(spark, processed, soc, out)
    assert os.path.isdir(os.path.join(out, "correlation_report"))
    checks = jobs.validation_job(spark, processed, out)
    assert checks.filter("check = 'required_column'").count() == 4


def _payloads(spark, folder, n_files=3):
    ev = read_table(spark, SF, "events").orderBy("event_id").collect()
    os.makedirs(folder, exist_ok=True)
    chunk = len(ev) // n_files + 1
    for i in range(n_files):
        with open(os.path.join(folder, f"batch_{i}.json"), "w") as f:
            for e in ev[i * chunk : (i + 1) * chunk]:
                rec = {
                    "id": e.event_id,
                    "text": f"{e.event_type} event #{e.event_type} @user{e.user_id}",
                    "created_at": e.ts.isoformat(),
                    "author_id": str(e.user_id),
                    "lang": "en",
                    "public_metrics": {"like_count": int(e.value), "retweet_count": 1, "reply_count": None},
                }
                f.write(json.dumps(rec) + "\n")
                if e.event_id % 50 == 0:  # a repeated payload
                    f.write(json.dumps(rec) + "\n")
    return len(ev)


def test_payload_flatten_batch(spark, tmpdir_fresh):
    n = _payloads(spark, os.path.join(tmpdir_fresh, "in"))
    df = S.flatten_payload(spark.read.schema(S.PAYLOAD_SCHEMA).json(os.path.join(tmpdir_fresh, "in")))
    assert df.select("tweet_id").distinct().count() == n
    assert df.filter(F.col("reply_count") != 0).count() == 0  # missing metric → 0


def test_stream_dedup_counts_and_alerts(spark, tmpdir_fresh):
    from glossa.operators import sentiment

    folder = os.path.join(tmpdir_fresh, "landing")
    n = _payloads(spark, folder)
    stream = S.dedup_tweets(S.read_payload_stream(spark, folder, max_files_per_trigger=1))
    labelled = sentiment.tweet_labels(sentiment.score_map(stream, text_col="text"))
    counts = S.run_to_table(S.daily_label_counts(labelled), spark, "test_counts")
    assert counts.agg(F.sum("n")).collect()[0][0] == n
    alert_path = os.path.join(tmpdir_fresh, "alerts")
    batch = counts.withColumn("sentiment_label", F.when(F.col("window_start").isNotNull(), "negative"))
    S.alert_sink(alert_path)(batch, 0)
    assert spark.read.parquet(alert_path).filter("alert").count() > 0


def test_stream_days_and_alerts_in_any_zone(spark):
    from glossa.plans.registry import all_queries
    from scripts.check_oracle import compare, duck_connect

    sf, zone = "/root/testdata/sf0.001", spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        for name in ("tweet_stream_daily", "negative_share_alerts"):
            status, *rest = compare(spark, duck_connect(sf), all_queries()[name], sf)
            assert status == "OK", (name, rest)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_replayed_alerts_are_stored_once(spark, tmpdir_fresh):
    counts = spark.createDataFrame([("a", "b", "negative", 5), ("a", "b", "positive", 1)], "window_start string, window_end string, sentiment_label string, n long")
    sink = S.alert_sink(os.path.join(tmpdir_fresh, "alerts"))
    for epoch in (0, 0, 1):
        sink(counts, epoch)
    assert spark.read.parquet(os.path.join(tmpdir_fresh, "alerts")).count() == 2
