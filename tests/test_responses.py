"""Search responses with authors (A13), rows worked out by hand."""

import json
import os

from glossa.sources import responses
from glossa.session import scratch_path

PROFILE = {"id": "7", "username": "ann", "name": "Ann", "public_metrics": {"followers_count": 12}}


def land(folder, name, *pages):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write("\n".join(json.dumps(p) if not isinstance(p, str) else p for p in pages))


def tweet(k, author, text="hello", **metrics):
    return {"id": k, "text": text, "created_at": "2024-05-01T10:00:00", "author_id": author, "public_metrics": metrics}


def pages():
    first = {"query": "#skin", "data": [tweet(1, "7", "#Skin care by @ann_b", like_count=4, retweet_count=3, reply_count=2), tweet(2, "8"), tweet(3, "9"), None]}
    first["includes"] = {"users": [PROFILE, {"id": "9", "username": "zoe"}, {**PROFILE, "name": "Second"}, None]}
    # Profiles hold for their own response only.
    return first, {"query": "#lip", "data": [tweet(4, "7"), tweet(5, None)]}, {"query": "#none", "includes": {"users": [PROFILE]}}, {"query": "#none", "data": []}


def check(rows):
    by_id = {r.tweet_id: r for r in rows}
    assert sorted(by_id) == [1, 2, 3, 4, 5] and len(rows) == 5
    names = {k: (r.author_username, r.author_name, r.author_followers) for k, r in by_id.items()}
    assert names == {1: ("ann", "Ann", 12), 2: ("unknown", "unknown", None), 3: ("zoe", "unknown", None), 4: ("unknown", "unknown", None), 5: ("unknown", "unknown", None)}
    one = by_id[1]
    assert (one.hashtags, one.mentions, one.query, one.platform) == (["Skin"], ["ann_b"], "#skin", "twitter")
    assert float(one.weighted_engagement) == 4 + 2 * 3 + 1.5 * 2 and one.impression_count == 0
    assert by_id[5].query == "#lip" and by_id[5].hashtags == [] and float(by_id[5].weighted_engagement) == 0


def test_batch(spark, tmpdir_fresh):
    land(tmpdir_fresh, "a.json", *pages(), "no json at all")
    check(responses.read_responses(spark, tmpdir_fresh).collect())


def test_stream(spark, tmpdir_fresh):
    one, *others = pages()
    land(tmpdir_fresh, "a.json", one)
    land(tmpdir_fresh, "b.json", *others)
    out = scratch_path(spark, "response-rows")
    writer = responses.read_response_stream(spark, tmpdir_fresh, max_files_per_trigger=1).writeStream.trigger(availableNow=True)
    writer.option("checkpointLocation", scratch_path(spark, "response-ckpt")).start(out, format="parquet").awaitTermination()
    check(spark.read.parquet(out).collect())


def test_no_shuffle(spark, tmpdir_fresh):
    land(tmpdir_fresh, "a.json", *pages())
    plan = responses.read_responses(spark, tmpdir_fresh)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
