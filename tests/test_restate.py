"""Late rows restate stored windows and the alerts that look at them."""

import datetime as dt

from pulselens.operators import anomaly
from pulselens.streaming import jobs, restate
from pulselens.streaming.catalog import STREAM_Q
from tests.conftest import SF001
from tests.test_properties import _event_rows


def _run(spark, tmp_path, rows):
    _event_rows(spark, rows).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in/events.parquet")
    restate.restate_stream(jobs.tagged_events(jobs.stream_events(spark, f"{tmp_path}/in")), f"{tmp_path}/base")


def test_late_rows_change_closed_windows_and_their_alerts(spark, tmp_path):
    at = lambda i: (2, 10 + i // 4, 15 * (i % 4))  # noqa: E731  the i-th window of the day
    first = [(u, kind, *at(i)) for i in range(12) for u in range(4 + i % 2) for kind in ("view", "click")]
    _run(spark, tmp_path, first)
    before = {r.ts: r for r in restate.restated_windows(spark, f"{tmp_path}/base").collect()}
    assert len(before) == 10 and all(r.late_rows == 0 for r in before.values())  # the last two are still open
    assert not any(r.is_alert for r in restate.restated_alerts(spark, f"{tmp_path}/base").collect())
    # a window long closed gets sixty more views; the next window's rows are in time
    d, h, m = at(7)
    _run(spark, tmp_path, [(100 + k, "view", d, h, m + 1) for k in range(60)] + [(1, "view", *at(12))])
    after = {r.ts: r for r in restate.restated_windows(spark, f"{tmp_path}/base").collect()}
    changed = dt.datetime(2024, 1, d, h, m)
    assert after[changed].late_rows == 60 and after[changed].views == before[changed].views + 60
    assert {t for t, r in after.items() if r.late_rows} == {changed}
    alerts = {(r.metric, r.ts): r for r in restate.restated_alerts(spark, f"{tmp_path}/base").collect()}
    told = alerts["views", changed]
    assert told.is_alert and not told.first_alert and told.n_judged == 2
    assert alerts["views", dt.datetime(2024, 1, d, h, m) - dt.timedelta(minutes=15)].n_judged == 1
    assert alerts["views", dt.datetime(2024, 1, d, h, m) + dt.timedelta(minutes=15)].n_judged == 2
    # what was judged in parts equals one judgement of all closed windows
    kpi = restate.restated_windows(spark, f"{tmp_path}/base")
    whole = anomaly.live_alerts(anomaly.iqr_bands(anomaly.kpi_long(kpi, restate.METRICS)))
    assert sorted((r.metric, r.ts, r.is_alert, str(r.up)) for r in whole.collect()) == \
        sorted((r.metric, r.ts, r.is_alert, str(r.up)) for r in alerts.values())


def test_a_retried_batch_stores_its_windows_once(spark, tmp_path):
    _run(spark, tmp_path, [(1, "view", 2, 12, 0), (1, "view", 2, 12, 20)])
    _run(spark, tmp_path, [(2, "view", 2, 12, 1), (1, "view", 2, 13, 0)])
    path = f"{tmp_path}/base/windows"
    last = restate._stored(spark, restate.WINDOWS, path, 1).where("batch_id = 1").drop("batch_id")
    rows = sorted(map(str, restate.restated_windows(spark, f"{tmp_path}/base").collect()))
    kept = spark.createDataFrame(last.collect(), last.schema)
    jobs._write_batch(kept, 1, path)
    assert sorted(map(str, restate.restated_windows(spark, f"{tmp_path}/base").collect())) == rows


def test_registered_query_meets_late_rows(spark):
    got = STREAM_Q["stream_restated_kpi"](spark, SF001).collect()
    assert sum(r.late_rows for r in got) > 10
