"""Hand fixtures (FIXTURES.md section 4): tiny literal frames, exact expectations."""

import datetime as dt

from pyspark.sql import functions as F

from pulselens.functions.bins import cut
from pulselens.operators import anomaly, etl, lifecycle, metrics
from pulselens.sources.sink import read_slices, write_slices
from pulselens.sources.tables import FEED_SCHEMA, MESSAGE_SCHEMA

D = dt.datetime(2024, 1, 30, 12, 0)


def feed_rows(spark, rows):
    return spark.createDataFrame(rows, FEED_SCHEMA)


def msg_rows(spark, rows):
    return spark.createDataFrame(rows, MESSAGE_SCHEMA)


def test_age_edges(spark):
    ages = [0, 17, 18, 25, 26, 45, 46, 100, 101]
    df = spark.createDataFrame([(a,) for a in ages], "age int").select("age", cut(F.col("age")).alias("g"))
    got = {r.age: r.g for r in df.collect()}
    assert [got[a] for a in ages] == [None, "0-17", "18-25", "18-25", "26-35", "36-45", "45+", "45+", None]


def test_sender_only_receiver_only(spark):
    # A -> B, C -> A: parity keeps only A, strict keeps A, B, C
    m = msg_rows(spark, [(1, 2, D, "iOS"), (3, 1, D, "iOS")])
    parity = {r.user_id for r in etl.sender_receiver(m).collect()}
    strict = {r.user_id: r for r in etl.sender_receiver(m, strict=True).collect()}
    assert parity == {1}
    assert set(strict) == {1, 2, 3}
    assert strict[2].messages_sent == 0 and strict[2].messages_received == 1
    assert strict[3].messages_received == 0 and strict[3].messages_sent == 1


def test_two_os_counts_messages_twice_in_parity(spark):
    f = feed_rows(spark, [(1, 1, "view", D, 0, 20, "iOS", "ads", 1),
                          (1, 2, "view", D + dt.timedelta(minutes=1), 0, 20, "Android", "ads", 1),
                          (2, 3, "like", D, 1, 30, "iOS", "ads", 1)])
    m = msg_rows(spark, [(1, 2, D, "iOS"), (1, 2, D, "iOS"), (1, 2, D, "iOS"), (2, 1, D, "iOS")])
    day = D.date()
    par = {(r.dimension, r.dimension_value): r for r in etl.slice_report(f, m, day).collect()}
    st = {(r.dimension, r.dimension_value): r for r in etl.slice_report_strict(f, m, day).collect()}
    # parity: user 1 has two feed rows (iOS, Android) -> its 3 sent messages counted under both
    assert par[("os", "iOS")].messages_sent + par[("os", "Android")].messages_sent == 3 + 3 + 1
    assert par[("gender", "0")].messages_sent == 6
    # strict: one row per user (latest profile: Android for user 1)
    assert st[("gender", "0")].messages_sent == 3
    assert st[("os", "Android")].messages_sent == 3 and st[("os", "iOS")].messages_sent == 1


def test_slices_totals_equal_day_total(spark):
    f = feed_rows(spark, [(u, u, "view" if u % 2 else "like", D, u % 2, 20 + u, "iOS", "ads", 1) for u in range(10)])
    m = msg_rows(spark, [(u, (u + 1) % 10, D, "iOS") for u in range(10)])
    rep = etl.slice_report(f, m, D.date())
    tot = rep.groupBy("dimension").agg(F.sum("likes").alias("l"), F.sum("views").alias("v")).collect()
    assert {(r.l, r.v) for r in tot} == {(5, 5)}


def _weeks_feed(spark, user, mondays):
    return [(user, dt.datetime.combine(m, dt.time(10))) for m in mondays]


def test_weekly_gap_and_future_week(spark):
    w1 = dt.date(2024, 1, 1)
    weeks = [w1, w1 + dt.timedelta(7), w1 + dt.timedelta(21)]          # weeks 1, 2, 4
    act = spark.createDataFrame(_weeks_feed(spark, 1, weeks), "user_id long, time timestamp_ntz")
    as_of = w1 + dt.timedelta(days=23)                                  # inside week 4
    rows = lifecycle.weekly_lifecycle(act, as_of).collect()
    got = {(r.this_week, r.status): r.num_users for r in rows}
    assert got == {(w1, "new"): 1, (w1 + dt.timedelta(7), "retained"): 1, (w1 + dt.timedelta(14), "gone"): -1,
                   (w1 + dt.timedelta(21), "new"): 1}          # no gone row for week 5 (not started)
    strict = {(r.this_week, r.status) for r in lifecycle.weekly_lifecycle(act, as_of, strict=True).collect()}
    assert (w1 + dt.timedelta(21), "returned") in strict
    later = {(r.this_week, r.status) for r in lifecycle.weekly_lifecycle(act, w1 + dt.timedelta(40)).collect()}
    assert (w1 + dt.timedelta(28), "gone") in later


def _series(spark, values):
    t0 = dt.datetime(2024, 1, 30)
    rows = [(t0 + dt.timedelta(minutes=15 * i), "m", None if v is None else float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "ts timestamp_ntz, metric string, value double")


def _bands(spark, values):
    return sorted(anomaly.iqr_bands(_series(spark, values)).collect(), key=lambda r: r.ts)


def test_short_series_all_null(spark):
    rows = _bands(spark, [1, 2, 3, 4, 5])
    assert all(r.q25 is None and r.q75 is None and r.up is None and r.low is None for r in rows)
    last = anomaly.latest_alerts(anomaly.iqr_bands(_series(spark, [1, 2, 3, 4, 5]))).first()
    assert last.is_alert is False


def test_seven_rows_edges(spark):
    rows = _bands(spark, [3, 1, 4, 1, 5, 9, 2])
    assert [r.q25 is None for r in rows] == [True] * 5 + [False] * 2
    assert [r.up is None for r in rows] == [True] * 3 + [False] * 4
    # q25 of rows 1..5 (3,1,4,1,5) with linear interpolation
    assert rows[5].q25 == 1.0 and rows[5].q75 == 4.0


def test_spike_one_alert(spark):
    vals = [10.0] * 20 + [100.0]
    b = anomaly.iqr_bands(_series(spark, vals))
    alerts = [r for r in anomaly.backtest(b).collect() if r.is_alert]
    assert len(alerts) == 1 and alerts[0].value == 100.0
    last = anomaly.latest_alerts(b).first()
    assert last.is_alert is True and last.text.startswith("Metric m:")


def test_constant_series_no_alert(spark):
    rows = _bands(spark, [7.0] * 12)
    assert rows[-1].iqr == 0.0 and rows[-1].up == 7.0 and rows[-1].low == 7.0
    assert not any(r.is_alert for r in anomaly.backtest(anomaly.iqr_bands(_series(spark, [7.0] * 12))).collect())


def test_null_ctr_in_range(spark):
    vals = [1.0, 2.0, 3.0, 4.0, 5.0, 6.0, None, 8.0, 9.0, 10.0, 11.0, 12.0, 13.0, 14.0]
    rows = _bands(spark, vals)
    # rows 8..12 (0-based 7..11) see the NULL in their previous 5 -> quartiles NULL
    assert [rows[i].q25 is None for i in range(7, 12)] == [True] * 5
    assert rows[12].q25 is not None
    # the centered mean only goes NULL where all five smoothing rows are NULL
    assert rows[9].up is None and rows[7].up is not None


def test_missing_window_parity_vs_strict(spark):
    t0 = dt.datetime(2024, 1, 30, 0, 0)
    f = feed_rows(spark, [(1, 1, "view", t0 + dt.timedelta(minutes=15 * i + 1), 0, 20, "iOS", "ads", 1) for i in range(4)])
    m = msg_rows(spark, [(1, 2, t0 + dt.timedelta(minutes=15 * i + 2), "iOS") for i in (0, 1, 3)])
    as_of = dt.datetime(2024, 1, 30, 1, 0)
    par = anomaly.kpi_15min(f, m, as_of, history_days=0)
    st = anomaly.kpi_15min_strict(f, m, as_of, history_days=0)
    assert par.count() == 3
    rows = {r.hm: r for r in st.collect()}
    assert len(rows) == 4 and rows["00:30"].sent_messages == 0 and rows["00:30"].views == 1


def test_missing_day_gives_null_change(spark):
    days = [dt.date(2024, 1, d) for d in (1, 2, 3, 5, 6, 7)]
    df = spark.createDataFrame([(d, "DAU", float(i + 1)) for i, d in enumerate(days)], "date date, metric string, value double")
    got = {r.date: r.pct_change for r in metrics.day_over_day(df).collect()}
    assert got[dt.date(2024, 1, 5)] is None and got[dt.date(2024, 1, 1)] is None
    assert got[dt.date(2024, 1, 2)] == 1.0


def test_write_twice_is_idempotent(spark, tmp_path):
    f = feed_rows(spark, [(1, 1, "view", D, 0, 20, "iOS", "ads", 1)])
    m = msg_rows(spark, [(1, 1, D, "iOS")])
    rep = etl.slice_report(f, m, D.date())
    path = str(tmp_path / "slices")
    write_slices(rep, path)
    n1 = read_slices(spark, path).count()
    write_slices(rep, path)
    assert read_slices(spark, path).count() == n1 == 3


def test_fill_bins_adds_zero_rows(spark):
    f = feed_rows(spark, [(1, 1, "view", D, 0, 20, "iOS", "ads", 1), (2, 2, "like", D, 1, 40, "iOS", "ads", 1)])
    m = msg_rows(spark, [(1, 2, D, "iOS")])
    observed = {r.dimension_value for r in etl.slice_report(f, m, D.date()).where("dimension = 'age'").collect()}
    filled = {r.dimension_value: r for r in etl.slice_report(f, m, D.date(), fill_bins=True)
              .where("dimension = 'age'").collect()}
    assert observed == {"18-25", "36-45"}
    assert set(filled) == {"0-17", "18-25", "26-35", "36-45", "45+"}
    assert filled["45+"].views == 0 and filled["18-25"].views == 1


def test_drop_open_week(spark):
    w1 = dt.date(2024, 1, 1)
    act = spark.createDataFrame([(1, dt.datetime(2024, 1, 2, 10)), (2, dt.datetime(2024, 1, 3, 10)),
                                 (2, dt.datetime(2024, 1, 9, 10))], "user_id long, time timestamp_ntz")
    as_of = w1 + dt.timedelta(days=8)          # inside week 2, which is still running
    keep = {(r.this_week, r.status): r.num_users for r in lifecycle.weekly_lifecycle(act, as_of).collect()}
    drop = {(r.this_week, r.status): r.num_users
            for r in lifecycle.weekly_lifecycle(act, as_of, drop_open_week=True).collect()}
    assert keep[(w1 + dt.timedelta(7), "gone")] == -1
    assert (w1 + dt.timedelta(7), "gone") not in drop
