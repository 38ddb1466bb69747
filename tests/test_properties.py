
import datetime as dt

import pytest
from pyspark.sql import functions as F

from pulselens.functions.timeexpr import monday
from pulselens.operators import anomaly, etl, experiments, lifecycle, metrics, retention
from pulselens.plans import params as P
from pulselens.sources import tables
from pulselens.streaming import jobs
from pulselens.streaming.catalog import STREAM_Q

from conftest import SF01


@pytest.fixture(scope="module")
def feed(spark):
    return tables.feed_actions(spark, SF01)


@pytest.fixture(scope="module")
def msgs(spark):
    return tables.message_actions(spark, SF01)


def test_lifecycle_identities(spark):
    act = tables.order_activity(spark, SF01)
    as_of = dt.date(2030, 1, 1)                      # after all data: no week is excluded
    rows = lifecycle.weekly_lifecycle(act, as_of).collect()
    by = {}
    for r in rows:
        by[(r.this_week, r.status)] = r.num_users
    active = {r.week: r.n for r in act.select("user_id", monday("time").alias("week")).distinct()
              .groupBy("week").agg(F.count(F.lit(1)).alias("n")).collect()}
    for w, n in active.items():
        assert by.get((w, "new"), 0) + by.get((w, "retained"), 0) == n
        nxt = w + dt.timedelta(7)
        assert by.get((nxt, "retained"), 0) - by.get((nxt, "gone"), 0) == n


def test_retention_never_exceeds_cohort(spark, feed):
    r = retention.retention_by_source(feed, P.RETENTION_AS_OF, P.HORIZON)
    assert r.where("users > cohort_users").count() == 0
    assert r.where("day = start_day AND users <> cohort_users").count() == 0


def test_bands_ordered(spark, feed, msgs):
    kpi = anomaly.kpi_15min(feed, msgs, P.AS_OF_TS, history_days=7)
    b = anomaly.anomaly_bands(kpi)
    assert b.where("low > up OR low_live > up_live OR q25 > q75").count() == 0


def test_slice_totals_equal_per_dimension(spark, feed, msgs):
    rep = etl.slice_report(feed, msgs, dt.date(2024, 1, 1), dt.date(2024, 1, 30))
    tot = rep.groupBy("event_date", "dimension").agg(*[F.sum(c).alias(c) for c in etl.COUNT_COLS])
    per_day = tot.groupBy("event_date").agg(*[F.countDistinct(c).alias(c) for c in etl.COUNT_COLS])
    assert per_day.where(" OR ".join(f"{c} <> 1" for c in etl.COUNT_COLS)).count() == 0
    day_likes = {r.d: r.n for r in metrics.daily_feed_kpi(feed).select(F.col("date").alias("d"), F.col("likes").alias("n")).collect()}
    for r in tot.where("dimension = 'gender'").collect():
        assert r.likes == day_likes[r.event_date]


def test_mann_whitney_identities_on_data(spark, feed):
    users = metrics.user_ctr(feed, *P.AB_PERIOD, P.AB_GROUPS)
    r = experiments.mann_whitney(users, "ctr", *P.AB_GROUPS).first()
    assert r.u_a + r.u_b == pytest.approx(r.n_a * r.n_b)
    assert r.p_a_gt_b + r.p_b_gt_a + r.p_tie == pytest.approx(1.0)
    assert 0.0 <= r.p_value <= 1.0


def test_stream_equals_batch_on_closed_windows(spark, tmp_path):
    path = jobs.run_to_parquet(jobs.kpi_stream(jobs.tagged_events(jobs.stream_events(spark, SF01)), "10 minutes"), str(tmp_path))
    s = spark.read.parquet(path)
    f = tables.feed_actions(spark, SF01)
    batch = (f.groupBy(F.window("time", "15 minutes").start.alias("ts"))
              .agg(F.count_if(F.col("action") == "like").alias("likes"), F.count_if(F.col("action") == "view").alias("views")))
    diff = s.alias("s").join(batch.alias("b"), "ts", "left").where(
        "coalesce(b.likes, 0) <> s.likes OR coalesce(b.views, 0) <> s.views")
    assert diff.count() == 0
    assert s.count() > 0


def test_partitioned_tables_give_same_results(spark, feed, msgs, tmp_path):
    """Production layout (Parquet partitioned by event_date): same answers."""
    fp, mp = str(tmp_path / "feed"), str(tmp_path / "msgs")
    tables.write_event_table(feed, fp)
    tables.write_event_table(msgs, mp)
    pf, pm = tables.read_feed_table(spark, fp), tables.read_message_table(spark, mp)
    day = P.AS_OF - dt.timedelta(days=1)

    def same(a, b):
        ra = sorted(tuple(r) for r in a.collect())
        rb = sorted(tuple(r) for r in b.collect())
        assert ra == rb

    same(etl.slice_report(pf, pm, day), etl.slice_report(feed, msgs, day))
    same(etl.slice_report_strict(pf, pm, day), etl.slice_report_strict(feed, msgs, day))
    same(retention.retention(pf, "ads", P.RETENTION_AS_OF), retention.retention(feed, "ads", P.RETENTION_AS_OF))
    same(anomaly.kpi_15min(pf, pm, P.AS_OF_TS), anomaly.kpi_15min(feed, msgs, P.AS_OF_TS))
    same(metrics.digest_app_week(pf, pm, P.AS_OF), metrics.digest_app_week(feed, msgs, P.AS_OF))


def test_stream_alert_batch_is_idempotent(spark, tmp_path):
    import datetime as dt2
    t0 = dt2.datetime(2024, 1, 30)
    rows = [(t0 + dt2.timedelta(minutes=15 * i), t0 + dt2.timedelta(minutes=15 * i + 15), 10 + i % 3, 20, 0.5, 7, 3, 4)
            for i in range(12)]
    batch = spark.createDataFrame(rows, "ts timestamp_ntz, ts_end timestamp_ntz, likes long, views long, CTR double, "
                                        "users_feed long, users_message long, sent_messages long")
    hist, alerts = str(tmp_path / "h"), str(tmp_path / "a")
    write = jobs.alert_batch_writer(hist, alerts)
    write(batch, 0)
    first = spark.read.parquet(hist).count(), spark.read.parquet(alerts).count()
    write(batch, 0)                     # the same batch again, as after a failure
    assert (spark.read.parquet(hist).count(), spark.read.parquet(alerts).count()) == first == (12, 72)     # every window, six metrics


def test_strict_spine_is_gap_free_and_contains_parity(spark, feed, msgs):
    strict = anomaly.kpi_15min_strict(feed, msgs, P.AS_OF_TS)
    parity = anomaly.kpi_15min(feed, msgs, P.AS_OF_TS)
    assert strict.count() == 96 and strict.select("ts").distinct().count() == 96
    cond = None
    for c in parity.columns:                  # null-safe: CTR is NULL where a window has no views
        e = parity[c].eqNullSafe(strict[c])
        cond = e if cond is None else cond & e
    missing = parity.join(strict, cond, "left_anti")
    assert missing.count() == 0           # every joined window is in the spine with the same values


def _event_rows(spark, rows):
    """``(user, event type, day, hour, minute)``"""
    full = [(i, dt.datetime(2024, 1, d, h, m), u, t, "{}") for i, (u, t, d, h, m) in enumerate(rows)]
    names = {f.name: f.dataType for f in tables.EVENTS_SCHEMA.fields}
    df = spark.createDataFrame(full, "event_id long, ts timestamp_ntz, user_id long, event_type string, props string")
    return df.select(*[(F.col(c) if c in df.columns else F.lit(None)).cast(t).alias(c) for c, t in names.items()])


def test_streams_resume_and_read_only_new_files(spark, tmp_path):
    src, base = f"{tmp_path}/events.parquet", f"{tmp_path}/base"
    _event_rows(spark, [(1, "view", 1, 0, 1), (2, "click", 1, 0, 2), (1, "purchase", 1, 1, 0)]).coalesce(1).write.parquet(src)

    def run():
        q = jobs._run(jobs.kpi_stream(jobs.tagged_events(jobs.stream_events(spark, str(tmp_path))), "10 minutes"), base)
        return sum(p["numInputRows"] for p in q.recentProgress)
    assert run() == 3
    _event_rows(spark, [(3, "view", 1, 5, 0), (4, "view", 1, 6, 0)]).coalesce(1).write.mode("append").parquet(src)
    assert run() == 2
    assert run() == 0
    got = {(r.ts.hour, r.views, r.likes, r.sent_messages) for r in spark.read.parquet(f"{base}/data").collect()}
    assert got == {(0, 1, 1, 0), (1, 0, 0, 1), (5, 1, 0, 0)}


def test_every_newly_closed_window_is_judged_once(spark, tmp_path):
    src, base = f"{tmp_path}/events.parquet", f"{tmp_path}/base"
    one = [(u, "view", 1, h, m) for h in range(4) for m in (0, 15, 30, 45) for u in range(3)]
    _event_rows(spark, one).coalesce(1).write.parquet(src)
    tagged = lambda: jobs.tagged_events(jobs.stream_events(spark, str(tmp_path)))
    path = jobs.alerts_stream(tagged(), base)
    assert spark.read.parquet(path).where("metric = 'users_feed'").count() == 14        # up to 03:30; the watermark is 03:35
    _event_rows(spark, [(u, "click", 1, 4, m) for m in (0, 15) for u in range(50)] + [(1, "view", 1, 6, 0)]).coalesce(1).write.mode("append").parquet(src)
    jobs.alerts_stream(tagged(), base)
    rows = spark.read.parquet(path).where("metric = 'users_feed'").collect()
    assert len(rows) == len({r.ts for r in rows}) == 18
    assert sorted((r.ts.hour, r.ts.minute, r.value) for r in rows if r.is_alert) == [(4, 0, 50.0), (4, 15, 50.0)]
    assert {r.metric for r in spark.read.parquet(path).select("metric").distinct().collect()} == set(anomaly.KPI_METRICS)


def test_two_table_stream_equals_one_table_stream(spark, tmp_path):
    ev = jobs.stream_events(spark, SF01)
    feed, msgs = tables.feed_from_events(ev), ev.where("event_type in ('purchase', 'signup')").select("user_id", F.col("ts").alias("time"))
    a = jobs.run_to_parquet(jobs.kpi_stream(jobs.tagged_activity(feed, msgs)), f"{tmp_path}/a")
    b = jobs.run_to_parquet(jobs.kpi_stream(jobs.tagged_events(jobs.stream_events(spark, SF01))), f"{tmp_path}/b")
    assert sorted(spark.read.parquet(a).collect()) == sorted(spark.read.parquet(b).collect())


def test_late_rows_are_counted_over_runs(spark, tmp_path):
    src, base = f"{tmp_path}/events.parquet", f"{tmp_path}/base"
    late = lambda: sorted((r.batch_id, r.rows_read, r.late_rows) for r in
                          jobs.late_data_stream(jobs.stream_events(spark, str(tmp_path)), base).collect())
    _event_rows(spark, [(1, "view", 2, 12, 0), (2, "view", 2, 12, 20)]).coalesce(1).write.parquet(src)
    assert late() == [(0, 2, 0)]
    # the watermark is 12:10: windows up to 12:00 are closed, that of 12:05 is not
    _event_rows(spark, [(1, "view", 1, 9, 0), (1, "view", 2, 11, 59), (1, "view", 2, 12, 5), (1, "view", 2, 13, 0)]
                ).coalesce(1).write.mode("append").parquet(src)
    assert late() == [(0, 2, 0), (1, 4, 2)]


def test_registered_late_data_meets_a_watermark(spark, tmp_path):
    src = f"{tmp_path}/events.parquet"
    _event_rows(spark, [(1, "view", 2, 12, 0), (2, "view", 2, 12, 20)]).coalesce(1).write.parquet(src)
    _event_rows(spark, [(1, "view", 1, 9, 0), (1, "view", 2, 11, 59), (1, "view", 2, 12, 5), (1, "view", 2, 13, 0)]
                ).coalesce(1).write.mode("append").parquet(src)
    got = sorted((r.batch_id, r.rows_read, r.late_rows, r.watermark) for r in STREAM_Q["stream_late_data"](spark, str(tmp_path)).collect())
    assert got == [(0, 2, 0, None), (1, 4, 2, dt.datetime(2024, 1, 2, 12, 10))]


def test_daily_slices_rewrite_only_touched_days(spark, feed, msgs, tmp_path, monkeypatch):
    done = []
    monkeypatch.setattr(jobs, "write_slices", lambda df, table: done.append(sorted({r.event_date for r in df.select("event_date").collect()})))
    src = f"{tmp_path}/events.parquet"
    _event_rows(spark, [(1, "view", 2, 1, 0), (1, "view", 3, 1, 0), (1, "view", 20, 1, 0)]).write.parquet(src)
    jobs.daily_slices_stream(jobs.stream_events(spark, str(tmp_path)), feed, msgs, f"{tmp_path}/base", "ts")
    assert done == [[dt.date(2024, 1, 2), dt.date(2024, 1, 3)], [dt.date(2024, 1, 20)]]


def test_slice_table_replaces_days(spark, feed, msgs, tmp_path):
    from pulselens.sources.sink import read_slices, write_slices
    path = str(tmp_path / "slices")
    for day in (29, 30, 30):          # a retried run replaces its day
        write_slices(etl.slice_report(feed, msgs, dt.date(2024, 1, day)), path)
    got = read_slices(spark, path).groupBy("event_date").count().collect()
    want = etl.slice_report(feed, msgs, dt.date(2024, 1, 29), dt.date(2024, 1, 30)).groupBy("event_date").count().collect()
    assert sorted(got) == sorted(want) and len(got) == 2


def test_heatmap_has_a_column_for_every_day(spark):
    rows = [(1, dt.datetime(2024, 1, 1), "ads"), (1, dt.datetime(2024, 1, 31), "ads"), (1, dt.datetime(2024, 2, 10), "ads"),
            (1, dt.datetime(2024, 2, 11), "ads")]
    f = spark.createDataFrame(rows, "user_id long, time timestamp_ntz, source string")
    r, = retention.retention_heatmap(f, "ads", dt.date(2024, 1, 1), 0, dt.date(2024, 2, 10)).collect()
    assert {k for k, v in r.asDict().items() if v == 1} == {"d0", "d30", "d40"} and "d41" not in r.asDict()


def test_large_day_has_many_writers(spark, tmp_path):
    """A day is split by its size, whatever its users."""
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        df = (spark.range(0, 200_000, 1, 40).select(F.lit(7).cast("long").alias("user_id"), F.col("id").alias("post_id"),
                                          F.lit("view").alias("action"), F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz").alias("time")))
        tables.write_event_table(df, str(tmp_path / "t"))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    out = spark.read.parquet(str(tmp_path / "t"))
    assert out.count() == 200_000 and len(out.inputFiles()) > 16


def test_batch_queries_need_no_checkpoint_folder(monkeypatch, spark):
    from pulselens import session
    from pulselens.plans.catalog import Q
    monkeypatch.setattr(session, "checkpoint_base", lambda s: pytest.fail("a batch query asked for the checkpoint folder"))
    assert Q["agg_daily_feed_kpi"](spark, SF01).count() > 0


def test_checkpoint_folder_rules(spark):
    from types import SimpleNamespace as N
    from pulselens import session
    conf = lambda v: N(get=lambda k, d=None: v)
    sc = lambda master, d=None: N(master=master, getCheckpointDir=lambda: d, setCheckpointDir=lambda x: None)
    assert session.shared_dir(N(conf=conf("/shared/x"), sparkContext=sc("yarn")), "a", fresh=False) == "/shared/x/pulselens/a"
    assert session.shared_dir(N(conf=conf("hdfs://n/x/"), sparkContext=sc("yarn")), "a", fresh=False) == "hdfs://n/x/pulselens/a"
    with pytest.raises(ValueError):
        session.checkpoint_base(N(conf=conf(None), sparkContext=sc("yarn")))
    assert session.checkpoint_base(N(conf=conf(None), sparkContext=sc("local[2]")))


def test_impact_scans_only_its_period(spark):
    from pulselens.operators import impact
    feed = tables.feed_actions(spark, SF01)
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    for fn in (impact.impact_prepost, impact.impact_trend, impact.impact_local_level):
        df = fn(impact.daily_metric_long(feed, first_day=P.PRE[0], last_day=P.POST[1]), P.PRE, P.POST)
        p = df._jdf.queryExecution().executedPlan().toString()
        assert p.count("Scan parquet") == 1 or fn is impact.impact_local_level
        assert "GreaterThanOrEqual(ts,2024-01-01T00:00)" in p and "LessThan(ts,2024-01-31T00:00)" in p


def test_strict_report_does_not_sort_raw_events(spark, feed, msgs):
    p = etl.slice_report_strict(feed, msgs, P.AS_OF - dt.timedelta(days=1))._jdf.queryExecution().executedPlan().toString()
    # below a sort-based step comes an aggregation by profile, never the scan itself
    above = [block.split("Scan parquet")[0] for block in p.split("SortAggregate")[1:] if "Scan parquet" in block]
    assert above and all("HashAggregate" in x for x in above)
