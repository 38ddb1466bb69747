"""Daily merges of user state against full runs."""

import datetime as dt
import random

import pytest

from pulselens.operators import lifecycle, retention, userstate
from pulselens.sources import sink

D0 = dt.date(2024, 1, 1)
FEED = "user_id long, source string, time timestamp_ntz"


def day(k):
    return D0 + dt.timedelta(days=k)


@pytest.fixture(scope="module")
def feed(spark):
    r = random.Random(3)
    rows = []
    for k in range(40):
        if k in (13, 14):
            continue                                   # days without anyone
        for _ in range(r.randint(1, 25)):
            u = r.choice([7, r.randint(0, 30), r.randint(0, 3 * k + 1)])
            rows.append((u, r.choice(["ads", "organic", None]) if u % 3 else "ads", dt.datetime.combine(day(k), dt.time(r.randint(0, 23), 59))))
    rows += [(None, "ads", dt.datetime(2024, 1, 3)), (5, "ads", None), rows[0], rows[0]]
    return spark.createDataFrame(rows, FEED).cache()


def rows_of(df):
    return sorted(map(str, df.collect()))


def full(feed, keys):
    known = feed.where("user_id is not null and time is not null")
    return (retention.retention_by_source(known, day(30)), lifecycle.weekly_lifecycle(known, day(39)),
            lifecycle.weekly_lifecycle(known, day(39), strict=True))


def test_merges_equal_the_full_run(spark, feed, tmp_path):
    by_source, base = f"{tmp_path}/s", f"{tmp_path}/u"
    userstate.merge_all(feed, by_source, 3, ["source"])
    userstate.merge(feed, base, day(0), day(9))
    for a, b in ((10, 10), (11, 11), (12, 16), (17, 17), (18, 37), (38, 38), (39, 39)):
        userstate.merge(feed, base, day(a), day(b))
    ret, life, strict = full(feed, ["source"])
    got = userstate.retention(userstate.day_counts(spark, by_source), day(30), 20, ["source"])
    assert rows_of(got.select(ret.columns)) == rows_of(ret)
    counts = userstate.day_counts(spark, base)
    assert rows_of(userstate.weekly_lifecycle(counts, day(39))) == rows_of(life)
    assert rows_of(userstate.weekly_lifecycle(counts, day(39), strict=True)) == rows_of(strict)


def test_a_merge_reads_one_day_and_the_newest_state(spark, feed, tmp_path):
    base = f"{tmp_path}/u"
    userstate.merge(feed, base, day(0), day(20))
    only = feed.where(f"time >= '{day(21)}' and time < '{day(22)}'")
    userstate.merge(only, base, day(21))               # the events before that day are gone, as in a pruned table
    userstate.expire(spark, base, keep=1)
    userstate.merge(feed.where(f"time >= '{day(22)}' and time < '{day(23)}'"), base, day(22))
    known = feed.where(f"user_id is not null and time < '{day(23)}'")
    got = userstate.weekly_lifecycle(userstate.day_counts(spark, base), day(22))
    assert rows_of(got) == rows_of(lifecycle.weekly_lifecycle(known, day(22)))
    with pytest.raises(ValueError, match="removed"):
        userstate.merge(feed, base, day(21))           # its state has been removed by expire


def test_a_repeated_or_restated_day_counts_once(spark, feed, tmp_path):
    base = f"{tmp_path}/u"
    userstate.merge(feed.where(f"time < '{day(6)}' or user_id % 2 = 0"), base, day(0), day(5))
    partial = feed.where("user_id % 2 = 0")
    for k in (6, 7, 7, 8):
        userstate.merge(partial, base, day(k))
    userstate.merge(feed, base, day(7))                # late rows of that day: later merges are stale until run again
    assert [r.last_day for r in userstate.merges(spark, base)] == [day(5), day(6), day(7)]
    userstate.merge(feed, base, day(6))
    userstate.merge(feed, base, day(7), day(8))
    known = feed.where(f"user_id is not null and time < '{day(9)}'")
    got = userstate.weekly_lifecycle(userstate.day_counts(spark, base), day(8))
    assert rows_of(got) == rows_of(lifecycle.weekly_lifecycle(known, day(8)))


def test_a_failed_merge_leaves_nothing_that_is_read(spark, feed, tmp_path, monkeypatch):
    base = f"{tmp_path}/u"
    userstate.merge(feed, base, day(0), day(5))
    before = rows_of(userstate.day_counts(spark, base))

    def fail(*_):
        raise RuntimeError("lost")
    with monkeypatch.context() as m:
        m.setattr(userstate, "_count", fail)
        with pytest.raises(RuntimeError):
            userstate.merge(feed, base, day(6))
    assert rows_of(userstate.day_counts(spark, base)) == before
    userstate.merge(feed, base, day(6))
    known = feed.where(f"user_id is not null and time < '{day(7)}'")
    assert rows_of(userstate.weekly_lifecycle(userstate.day_counts(spark, base), day(6))) == rows_of(lifecycle.weekly_lifecycle(known, day(6)))


def test_gaps_and_wrong_orders_are_refused(spark, feed, tmp_path):
    base = f"{tmp_path}/u"
    with pytest.raises(ValueError):
        userstate.day_counts(spark, base)
    userstate.merge(feed, base, day(3), day(5))
    for a, b in ((7, 7), (2, 2), (8, 7), (4, 4)):
        with pytest.raises(ValueError):
            userstate.merge(feed, base, day(a), day(b))
    assert len(userstate.merges(spark, base)) == 1


def test_no_events_give_no_rows(spark, feed, tmp_path):
    base = userstate.merge_all(feed.where("false"), f"{tmp_path}/u", 3)
    assert rows_of(userstate.weekly_lifecycle(userstate.day_counts(spark, base), day(0))) == []
    assert not sink.path_exists(spark, f"{tmp_path}/none")
