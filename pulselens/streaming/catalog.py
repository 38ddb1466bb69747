"""Registered streaming queries: each runs its stream to completion
(``availableNow``) and returns the sink read back as a DataFrame."""

from __future__ import annotations


from pulselens.functions.hashing import md5_uniform_sql
from pulselens.plans import params as P
from pulselens.plans.catalog import round_doubles
from pulselens.session import shared_dir
from pulselens.sources import tables
from pulselens.sources.sink import read_slices
from pulselens.streaming import jobs, restate

DELAY_MIN = 10


def _tagged(spark, sf):
    return jobs.tagged_events(jobs.stream_events(spark, sf))


def _kpi(spark, sf):
    base = shared_dir(spark, "kpi15")
    return spark.read.parquet(jobs.run_to_parquet(jobs.kpi_stream(_tagged(spark, sf), f"{DELAY_MIN} minutes"), base))


def _users(spark, sf):
    base = shared_dir(spark, "users15")
    return spark.read.parquet(jobs.run_to_parquet(jobs.distinct_users_stream(_tagged(spark, sf), f"{DELAY_MIN} minutes"), base))


def _alerts(spark, sf):
    path = jobs.alerts_stream(_tagged(spark, sf), shared_dir(spark, "alerts"), f"{DELAY_MIN} minutes", P.IQR_A, P.IQR_N)
    return round_doubles(spark.read.parquet(path).drop("batch_id"))


def _late(spark, sf):
    # a batch a part file, in order of arrival: later ones meet a watermark
    return jobs.late_data_stream(jobs.stream_events(spark, sf, max_files=1), shared_dir(spark, "late"), DELAY_MIN)


def _slices(spark, sf):
    feed, messages = tables.feed_actions(spark, sf), tables.message_actions(spark, sf)
    path = jobs.daily_slices_stream(jobs.stream_events(spark, sf), feed, messages, shared_dir(spark, "slices-stream"), "ts")
    return read_slices(spark, path)


DELIVERIES, LATE_SHARE, LATE_HOURS = 4, 0.25, 72


def _restated(spark, sf):
    """The events in order of arrival, in a few deliveries, each a run of the job on the same base folder."""
    base = shared_dir(spark, "restated")
    events = restate.with_arrival(spark.read.schema(tables.EVENTS_SCHEMA).parquet(f"{sf}/events.parquet"), LATE_SHARE, LATE_HOURS)

    def run():
        tagged = jobs.tagged_events(jobs.stream_events(spark, f"{base}/in"))
        restate.restate_stream(tagged, base, DELAY_MIN, a=P.IQR_A, n=P.IQR_N)

    restate.deliver(events, f"{base}/in/events.parquet", DELIVERIES, run)
    return base


def _restated_windows(spark, sf):
    return restate.restated_windows(spark, _restated(spark, sf), DELAY_MIN)


def _restated_alerts(spark, sf):
    return round_doubles(restate.restated_alerts(spark, _restated(spark, sf)).drop("first_alert", "n_judged"))


STREAM_Q = {
    "stream_kpi_15min": _kpi,
    "stream_distinct_users": _users,
    "stream_alerts": _alerts,
    "stream_late_data": _late,
    "stream_daily_slices": _slices,
    "stream_restated_kpi": _restated_windows,
    "stream_restated_alerts": _restated_alerts,
}


def _oracles():
    from pulselens.plans import oracles as O
    closed = (f"ts + INTERVAL 15 MINUTE <= (SELECT date_trunc('millisecond', max(ts)) FROM events) "
              f"- INTERVAL {DELAY_MIN} MINUTE")
    tagged = """tg AS (
  SELECT user_id, ts, CASE event_type WHEN 'view' THEN 'view' WHEN 'click' THEN 'like' ELSE 'message' END AS kind,
         time_bucket(INTERVAL '15 minutes', ts) AS w
  FROM events WHERE event_type IN ('view', 'click', 'purchase', 'signup'))"""
    kpi = f"""WITH {tagged},
k AS (SELECT w AS ts, w + INTERVAL 15 MINUTE AS ts_end, count_if(kind = 'like') AS likes,
             count_if(kind = 'view') AS views, count_if(kind = 'message') AS sent_messages FROM tg GROUP BY w)
SELECT ts, ts_end, likes, views, round(likes / nullif(views, 0), 2) AS CTR, sent_messages FROM k WHERE {closed}"""
    users = f"""WITH {tagged}
SELECT w AS ts, w + INTERVAL 15 MINUTE AS ts_end,
       count(DISTINCT CASE WHEN kind <> 'message' THEN user_id END) AS users_feed,
       count(DISTINCT CASE WHEN kind = 'message' THEN user_id END) AS users_message
FROM tg GROUP BY w HAVING w + INTERVAL 15 MINUTE <= (SELECT date_trunc('millisecond', max(ts)) FROM events)
  - INTERVAL {DELAY_MIN} MINUTE"""
    lg = "lg AS (" + " UNION ALL ".join(
        f"SELECT ts, '{m}' AS metric, CAST({m} AS DOUBLE) AS value FROM kpi" for m in jobs.STREAM_KPI_METRICS) + ")"
    text = (f"'Metric ' || metric || ':' || {O.NL} || 'Current value ' || printf('%.2f', round(value, 2)) || {O.NL} || "
            f"'Deviation from previous value ' || coalesce({O.pct_text_sql('deviation')}, 'n/a')")
    alerts = f"""WITH {tagged},
kpi AS (SELECT w AS ts, count_if(kind = 'like') AS likes, count_if(kind = 'view') AS views,
               round(count_if(kind = 'like') / nullif(count_if(kind = 'view'), 0), 2) AS CTR,
               count(DISTINCT CASE WHEN kind <> 'message' THEN user_id END) AS users_feed,
               count(DISTINCT CASE WHEN kind = 'message' THEN user_id END) AS users_message,
               count_if(kind = 'message') AS sent_messages
        FROM tg GROUP BY w HAVING {closed.replace('ts + ', 'w + ', 1)}),
{lg},
{O.bands_ctes()},
al AS (SELECT ts, metric, value, q25, q75, up_live AS up, low_live AS low,
              lag(value) OVER (PARTITION BY metric ORDER BY ts) AS prev_value FROM bands),
al2 AS (SELECT *, abs(1.0 - value / nullif(prev_value, 0)) AS deviation,
               coalesce(value < low OR value > up, false) AS is_alert FROM al)
SELECT metric, ts, {O.rnd(['value', 'prev_value', 'deviation', 'q25', 'q75', 'up', 'low'])}, is_alert,
       CASE WHEN is_alert THEN {text} END AS text FROM al2"""
    late = """SELECT CAST(0 AS BIGINT) AS batch_id, count(*) AS rows_read, CAST(0 AS BIGINT) AS late_rows,
       CAST(NULL AS TIMESTAMP) AS watermark, date_trunc('millisecond', max(ts)) AS newest FROM events"""
    u = md5_uniform_sql("event_id", "'late'")
    delivered = f"""ar AS (
  SELECT *, CAST(ts + to_seconds(CAST(CASE WHEN {u} < {LATE_SHARE} THEN floor({u} / {LATE_SHARE} * {LATE_HOURS * 3600}) ELSE 0 END AS INTEGER))
              AS DATE) AS arrived FROM events),
dl AS (SELECT *, (arrived - min(arrived) OVER ()) * {DELIVERIES} // (max(arrived) OVER () - min(arrived) OVER () + 1) AS k FROM ar),
tg AS (SELECT ts, k, CASE event_type WHEN 'view' THEN 'view' WHEN 'click' THEN 'like' ELSE 'message' END AS kind,
              time_bucket(INTERVAL '15 minutes', ts) AS w
       FROM dl WHERE event_type IN ('view', 'click', 'purchase', 'signup')),
mk AS (SELECT k, max(max(ts)) OVER (ORDER BY k) - INTERVAL {DELAY_MIN} MINUTE AS mark FROM tg GROUP BY k),
tl AS (SELECT tg.*, coalesce(w + INTERVAL 15 MINUTE <= (SELECT max(mark) FROM mk WHERE mk.k < tg.k), false) AS late FROM tg),
kpi AS (SELECT w AS ts, w + INTERVAL 15 MINUTE AS ts_end, count_if(kind = 'like') AS likes, count_if(kind = 'view') AS views,
               round(count_if(kind = 'like') / nullif(count_if(kind = 'view'), 0), 2) AS CTR,
               count_if(kind = 'message') AS sent_messages, count_if(late) AS late_rows
        FROM tl GROUP BY w HAVING w + INTERVAL 15 MINUTE <= (SELECT max(mark) FROM mk))"""
    restated = f"WITH {delivered}\nSELECT * FROM kpi"
    lg2 = "lg AS (" + " UNION ALL ".join(
        f"SELECT ts, '{m}' AS metric, CAST({m} AS DOUBLE) AS value FROM kpi" for m in restate.METRICS) + ")"
    judged = f"WITH {delivered},\n{lg2},\n{O.bands_ctes()},\nal AS (" + alerts.split("\nal AS (", 1)[1]
    slices = f"WITH {O.FEED},\n{O.MSG},\n{O.joined_ctes('true')}\n{O.slices_sql()}"
    out = {"stream_kpi_15min": kpi, "stream_distinct_users": users, "stream_alerts": alerts, "stream_late_data": late,
           "stream_daily_slices": slices, "stream_restated_kpi": restated, "stream_restated_alerts": judged}
    return {k: O.spark_round(O.bigint_counts(v)) for k, v in out.items()}


STREAM_ORACLES = _oracles()
