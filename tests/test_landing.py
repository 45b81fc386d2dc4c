"""Closed windows and rows set aside; dated snapshots."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from glossa.plans import landing_plans
from glossa.sources import snapshots
from glossa.streaming import closing

START = dt.datetime(2024, 3, 1)
SCHEMA = "tweet_id long, sentiment_label string, created_at timestamp, arrived_at timestamp"


def landed(spark, path, slices):
    for rows in slices:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(path)


def row(i, days, late_days=0.0, label="positive"):
    at = START + dt.timedelta(days=days)
    return (i, label, at, at + dt.timedelta(days=late_days))


def test_every_row_is_in_a_window_or_aside(spark, tmpdir_fresh):
    slices = [[row(10 * d + k, d + 0.1 * k) for k in range(5)] for d in range(12)]
    slices[6] += [row(900, 1.5, 5), row(901, 3.5, 3.0), row(902, 6.0, -1.0), (903, "negative", None, START), (904, "negative", START, None)]
    slices[7] += [row(71, 7.1), row(70, 7.0)]  # repeated ids
    stream = landed(spark, os.path.join(tmpdir_fresh, "in"), slices)
    counts, progress = closing.append_to_table(closing.closed_label_counts(stream), spark, "t-closed", state_partitions=2)
    aside, _ = closing.append_to_table(closing.set_aside(stream), spark, "t-aside")
    # The newest row in time is of day 11.4: the watermark is 10.4, and windows up to that of day 9 are closed.
    got = {r["window_start"].date(): r["n"] for r in counts.collect()}
    assert got == {(START + dt.timedelta(days=d)).date(): 5 for d in range(10)}
    reasons = {r["tweet_id"]: r["reason"] for r in aside.collect()}
    assert reasons == {900: closing.LATE, 901: closing.LATE, 902: closing.AHEAD, 903: closing.UNDATED, 904: closing.UNDATED}
    # Nothing fell out silently, and closed windows left the state.
    dropped = [op["numRowsDroppedByWatermark"] for p in progress for op in p["stateOperators"]]
    assert sum(dropped) == 0
    windows, ids = progress[-1]["stateOperators"]
    assert windows["numRowsTotal"] <= 3 and ids["numRowsTotal"] <= 15
    assert max(p["stateOperators"][0]["numRowsTotal"] for p in progress) <= 4


def test_a_later_run_goes_on(spark, tmpdir_fresh):
    source, path = os.path.join(tmpdir_fresh, "in"), os.path.join(tmpdir_fresh, "out")
    stream = landed(spark, source, [[row(1, 0.2), row(2, 2.5)]])
    run = lambda: closing.append_to_table(closing.closed_label_counts(stream), spark, "x", path=path, state_partitions=2)[0]
    assert run().count() == 1
    assert run().count() == 1  # no input, no window twice
    landed(spark, source, [[row(3, 2.6), row(4, 5.0)]])
    assert sorted(r["n"] for r in run().collect()) == [1, 2]


def test_snapshots_replace_days_and_read_one_partition(spark, tmpdir_fresh):
    path = os.path.join(tmpdir_fresh, "s")
    assert snapshots.days(spark, path) == [] and snapshots.newest(spark, path) is None
    rows = [(k, f"2024-01-0{1 + k % 3}", 1.0) for k in range(30)]
    df = spark.createDataFrame(rows, "id long, ingest_date string, x double")
    snapshots.write_days(df, path, files_a_day=2)
    snapshots.write_days(df.where("ingest_date = '2024-01-03' AND id < 9").withColumn("x", F.lit(2.0)), path)
    assert snapshots.days(spark, path) == [dt.date(2024, 1, d) for d in (1, 2, 3)]
    last = snapshots.newest(spark, path)
    assert sorted((r["id"], r["x"]) for r in last.collect()) == [(2, 2.0), (5, 2.0), (8, 2.0)]
    plan = last._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ingest_date" in plan and "(ingest_date" in plan
    assert {r[0].split("/")[-2] for r in last.select("_metadata.file_path").distinct().collect()} == {"ingest_date=2024-01-03"}
    assert snapshots.newest(spark, path, until=dt.date(2024, 1, 2)).count() == 10
    assert snapshots.newest(spark, path, until=dt.date(2023, 1, 2)) is None
    assert spark.read.parquet(path).count() == 23


def test_a_row_without_a_day_is_an_error(spark, tmpdir_fresh):
    df = spark.createDataFrame([(1, None)], "id long, ingest_date string")
    with pytest.raises(Exception, match="without ingest_date"):
        snapshots.write_days(df, os.path.join(tmpdir_fresh, "s"))


def test_the_registered_read_is_pruned(spark):
    plan = landing_plans.newest_snapshot(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ingest_date" in plan
