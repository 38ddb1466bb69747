"""Stored bitmaps and sketches of users against exact counts."""

import datetime as dt
import random

import pytest

from pulselens.operators import lifecycle, rollups


@pytest.fixture(scope="module")
def activity(spark):
    r = random.Random(1)
    rows = []
    for day in range(21):
        for _ in range(60):
            u = r.choice([r.randint(0, 40), r.randint(32_700, 32_800), r.randint(10**12, 10**12 + 50)])
            rows.append((u, dt.datetime(2024, 1, 1) + dt.timedelta(days=day, minutes=r.randint(0, 1439)), r.choice(["iOS", "Android", None])))
    rows += [(None, dt.datetime(2024, 1, 1), "iOS"), rows[0], rows[0]]
    return spark.createDataFrame(rows, "user_id long, time timestamp_ntz, os string")


def test_bitmaps_are_exact_over_any_period(spark, activity, tmp_path):
    path = rollups.write_rollup(rollups.user_bitmaps(activity), str(tmp_path / "bits"))
    stored = spark.read.parquet(path)
    periods = [("a", "2024-01-01", "2024-01-07"), ("b", "2024-01-05", "2024-01-21"), ("none", "2025-01-01", "2025-01-02")]
    got = {(r.period, r.os, r.all_slices): r.users for r in rollups.period_users(stored, periods).collect()}
    rows = [r for r in activity.collect() if r.user_id is not None]
    want = {}
    for name, a, b in periods:
        held = [r for r in rows if a <= r.time.date().isoformat() <= b]
        for os in {r.os for r in held}:
            want[name, os, False] = len({r.user_id for r in held if r.os == os})
        if held:
            want[name, None, True] = len({r.user_id for r in held})
    assert got == want
    daily = {(r.date, r.os): r.users for r in rollups.bitmap_users(stored, ["date", "os"]).collect()}
    assert daily == {k: len({r.user_id for r in rows if (r.time.date(), r.os) == k}) for k in {(r.time.date(), r.os) for r in rows}}


def test_a_second_run_replaces_only_its_days_and_reads_no_events(spark, activity, tmp_path):
    path = str(tmp_path / "bits")
    rollups.write_rollup(rollups.user_bitmaps(activity), path)
    day = activity.where("time < '2024-01-02'")
    rollups.write_rollup(rollups.user_bitmaps(day.where("user_id < 10")), path)
    stored = spark.read.schema("os string, bucket long, bits binary, date date").parquet(path)
    got = {r.date: r.users for r in rollups.bitmap_users(stored, ["date"]).collect()}
    assert got[dt.date(2024, 1, 1)] == day.where("user_id < 10").select("user_id").distinct().count()
    assert len(got) == 21
    scans = rollups.period_users(stored, [("x", "2024-01-01", "2024-01-02")])._jdf.queryExecution().executedPlan().toString()
    assert "bits" in scans and "user_id" not in scans and "PartitionFilters" in scans


def test_sketches_of_few_users_are_exact(spark, activity, tmp_path):
    path = rollups.write_rollup(rollups.weekly_sketches(activity), str(tmp_path / "week"), "week")
    got = rollups.sketch_lifecycle(spark.read.parquet(path), "2024-01-21").collect()
    want = lifecycle.weekly_lifecycle(activity.where("user_id is not null"), "2024-01-21").collect()
    key = lambda r: (r.this_week, r.previous_week, r.status, r.num_users)
    assert sorted(map(key, got)) == sorted(map(key, want))
    both = rollups.sketch_period_users(spark.read.parquet(path), "2024-01-01", "2024-01-08").first().users
    assert both == activity.where("time < '2024-01-15'").where("user_id is not null").select("user_id").distinct().count()


def test_sketches_of_many_users_stay_within_their_error(spark, tmp_path):
    act = spark.range(150_000).selectExpr("id as user_id", "explode(array(0, 7)) as d").where("d = 0 or user_id % 3 = 0").selectExpr(
        "user_id + if(d = 7 and user_id % 2 = 0, 1000000, 0) as user_id", "cast(timestamp_ntz'2024-01-01 10:00:00' + make_interval(0, 0, 0, d) as timestamp_ntz) as time")
    path = rollups.write_rollup(rollups.weekly_sketches(act), str(tmp_path / "week"), "week")
    sketches = spark.read.parquet(path)
    rows = rollups.sketch_lifecycle_check(act, sketches, "2024-01-14").collect()
    assert {r.status for r in rows} == {"new", "retained", "gone"} and all(r.within_4_errors for r in rows)
    assert {(str(r.this_week), r.status): r.num_users for r in rows}["2024-01-08", "retained"] == 25_000
    estimate = {(str(r.this_week), r.status): r.num_users for r in rollups.sketch_lifecycle(sketches, "2024-01-14").collect()}
    assert estimate["2024-01-08", "retained"] != 25_000  # an estimate it is


def test_no_activity_gives_no_rows(spark, activity):
    none = activity.where("false")
    assert rollups.bitmap_users(rollups.user_bitmaps(none), ["date"]).collect() == []
    assert rollups.sketch_lifecycle(rollups.weekly_sketches(none), "2024-01-21").collect() == []
