"""DuckDB oracle SQL for the registered queries.

Each string runs on the driver's tables (``events``, ``orders``, ... as
views) and must give the same rows as the Spark query.  The oracles are
written independently of the Spark plans where that is natural (joins and
EXISTS instead of per-user arrays, plain global windows instead of the
two-level prefix sum); statistics use the same closed formulas.
"""

from __future__ import annotations

import datetime as dt

from pulselens.functions.bins import AGE_LABELS, cut_sql
from pulselens.functions.hashing import md5_uniform_sql, poisson1_from_uniform_sql, poisson_power_from_uniform_sql, user_bucket_sql
from pulselens.functions.stats import normal_two_sided_p_sql, t_two_sided_p_sql
from pulselens.plans import params as P

FEED = """feed_actions AS (
  SELECT user_id, event_id % 997 AS post_id,
         CASE event_type WHEN 'view' THEN 'view' ELSE 'like' END AS action,
         ts AS time,
         CAST(user_id % 2 AS INTEGER) AS gender,
         CAST(10 + (user_id * 7) % 60 AS INTEGER) AS age,
         CASE WHEN user_id % 3 = 0 THEN 'iOS' ELSE 'Android' END AS os,
         CASE WHEN user_id % 5 < 2 THEN 'ads' ELSE 'organic' END AS source,
         CAST((user_id * 31) % 4 AS INTEGER) AS exp_group
  FROM events WHERE event_type IN ('view', 'click'))"""

MSG = """message_actions AS (
  SELECT user_id,
         (user_id * 17 + CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) * 13 + 1)
           % (SELECT max(user_id) + 1 FROM events) AS reciever_id,
         ts AS time,
         CASE WHEN user_id % 3 = 0 THEN 'iOS' ELSE 'Android' END AS os
  FROM events WHERE event_type IN ('purchase', 'signup'))"""

ORD = """act AS (SELECT o_custkey AS user_id, o_orderdate AS time FROM orders)"""

NL = "chr(10)"


def ts(d) -> str:
    if isinstance(d, dt.datetime):
        return f"TIMESTAMP '{d:%Y-%m-%d %H:%M:%S}'"
    return f"TIMESTAMP '{d:%Y-%m-%d} 00:00:00'"


def date(d) -> str:
    return f"DATE '{d:%Y-%m-%d}'"


def day_range(start, end_excl, col="time") -> str:
    return f"{col} >= {ts(start)} AND {col} < {ts(end_excl)}"


def period(first, last, col="time") -> str:
    return day_range(first, last + dt.timedelta(days=1), col)


YDAY = P.AS_OF - dt.timedelta(days=1)
WEEK_START = P.AS_OF - dt.timedelta(days=7)


def rnd(cols, digits=P.ROUND) -> str:
    # "+ 0.0" turns a rounded -0.0 into 0.0 (Spark's decimal rounding has no negative zero)
    return ", ".join(f"round({c}, {digits}) + 0.0 AS {c}" for c in cols)


def users_cte(first, last, groups, name="u") -> str:
    g = ", ".join(str(x) for x in groups)
    return f"""{name} AS (
  SELECT exp_group, user_id, count_if(action = 'like') AS likes, count_if(action = 'view') AS views,
         count_if(action = 'like') / nullif(count_if(action = 'view'), 0) AS ctr
  FROM feed_actions WHERE {period(first, last)} AND exp_group IN ({g})
  GROUP BY exp_group, user_id)"""


def welch_sql(src: str, value: str, a, b) -> str:
    """A full SELECT over ``src`` returning the Welch row (rounded)."""
    return (f"SELECT group_a, group_b, n_a, n_b, {rnd(['mean_a', 'mean_b', 'var_a', 'var_b', 't', 'df', 'p_value'])}, "
            f"n_excluded FROM ({welch_core_sql(src, value, a, b)})")


def welch_core_sql(src: str, value: str, a, b) -> str:
    """A full SELECT over ``src`` returning the unrounded Welch row."""
    return f"""
  SELECT {a} AS group_a, {b} AS group_b, n_a, n_b, mean_a, mean_b, var_a, var_b, t, df,
         {t_two_sided_p_sql('t', 'df')} AS p_value, n_excluded
  FROM (
    SELECT *, (mean_a - mean_b) / sqrt(nullif(var_a / n_a + var_b / n_b, 0)) AS t,
           (var_a / n_a + var_b / n_b) * (var_a / n_a + var_b / n_b)
             / ((var_a / n_a) * (var_a / n_a) / nullif(n_a - 1, 0) + (var_b / n_b) * (var_b / n_b) / nullif(n_b - 1, 0)) AS df
    FROM (
      SELECT count(CASE WHEN exp_group = {a} THEN {value} END) AS n_a,
             count(CASE WHEN exp_group = {b} THEN {value} END) AS n_b,
             avg(CASE WHEN exp_group = {a} THEN {value} END) AS mean_a,
             avg(CASE WHEN exp_group = {b} THEN {value} END) AS mean_b,
             var_samp(CASE WHEN exp_group = {a} THEN {value} END) AS var_a,
             var_samp(CASE WHEN exp_group = {b} THEN {value} END) AS var_b,
             count_if({value} IS NULL) AS n_excluded
      FROM {src} WHERE exp_group IN ({a}, {b})))"""


def mw_core_sql(src: str, value: str, a, b) -> str:
    """SELECT with the unrounded Mann-Whitney row over ``src``."""
    z = "((greatest(u_a, u_b) - n_a * n_b / 2.0 - 0.5) / nullif(sigma, 0))"
    return f"""
  SELECT {a} AS group_a, {b} AS group_b, CAST(n_a AS BIGINT) AS n_a, CAST(n_b AS BIGINT) AS n_b, u_a, u_b, z,
         CASE WHEN z <= 0 THEN 1.0 ELSE {normal_two_sided_p_sql('z')} END AS p_value,
         pairs_gt / nullif(CAST(n_a AS DOUBLE) * n_b, 0) AS p_a_gt_b,
         pairs_tie / nullif(CAST(n_a AS DOUBLE) * n_b, 0) AS p_tie,
         1.0 - pairs_gt / nullif(CAST(n_a AS DOUBLE) * n_b, 0) - pairs_tie / nullif(CAST(n_a AS DOUBLE) * n_b, 0) AS p_b_gt_a
  FROM (
    SELECT *, {z} AS z FROM (
      SELECT *, CAST(n_a AS DOUBLE) * n_b - u_a AS u_b,
             sqrt(CAST(n_a AS DOUBLE) * n_b / 12.0 * ((n_a + n_b + 1.0)
                  - tie_term / nullif(CAST(n_a + n_b AS DOUBLE) * (n_a + n_b - 1.0), 0))) AS sigma
      FROM (
        SELECT sum(c_a) AS n_a, sum(c_b) AS n_b,
               sum(CAST(c_a AS DOUBLE) * (c_b_lt + c_b / 2.0)) AS u_a,
               sum(CAST(c_a AS DOUBLE) * c_b_lt) AS pairs_gt,
               sum(CAST(c_a AS DOUBLE) * c_b) AS pairs_tie,
               sum(CAST(c_a + c_b AS DOUBLE) * (c_a + c_b) * (c_a + c_b) - (c_a + c_b)) AS tie_term
        FROM (
          SELECT *, coalesce(sum(c_b) OVER (ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS c_b_lt
          FROM (SELECT {value} AS value, count_if(exp_group = {a}) AS c_a, count_if(exp_group = {b}) AS c_b
                FROM {src} WHERE exp_group IN ({a}, {b}) AND {value} IS NOT NULL GROUP BY {value})))))"""


MW_COLS_D = ["u_a", "u_b", "z", "p_value", "p_a_gt_b", "p_tie", "p_b_gt_a"]


def mw_sql(src, value, a, b) -> str:
    return f"SELECT group_a, group_b, n_a, n_b, {rnd(MW_COLS_D)} FROM ({mw_core_sql(src, value, a, b)})"


def smoothed_cte(src="u", name="sm", alpha=P.ALPHA) -> str:
    return f"""{name} AS (
  SELECT {src}.*, ({src}.likes + {alpha} * g.global_ctr) / ({src}.views + {alpha}) AS smoothed_ctr
  FROM {src} JOIN (SELECT exp_group, sum(likes) / nullif(sum(views), 0) AS global_ctr FROM {src} GROUP BY exp_group) g
  USING (exp_group))"""


def bucket_cte(name="bk", groups=P.AB_GROUPS, first=P.AB_PERIOD[0], last=P.AB_PERIOD[1], method="md5") -> str:
    g = ", ".join(str(x) for x in groups)
    return f"""{name} AS (
  SELECT exp_group, {user_bucket_sql('user_id', P.N_BUCKETS, method)} AS bucket,
         count_if(action = 'like') AS likes, count_if(action = 'view') AS views,
         count_if(action = 'like') / nullif(count_if(action = 'view'), 0) AS bucket_ctr
  FROM feed_actions WHERE {period(first, last)} AND exp_group IN ({g}) GROUP BY 1, 2)"""


def boot_cte(src="u", name="boot", a=P.AB_GROUPS[0], b=P.AB_GROUPS[1], n=P.N_BOOT) -> str:
    w = poisson1_from_uniform_sql(md5_uniform_sql("r.rep", "x.user_id"))
    return f"""{name} AS (
  SELECT rep, likes_a, views_a, likes_b, views_b, likes_a / nullif(views_a, 0) AS ctr_a,
         likes_b / nullif(views_b, 0) AS ctr_b, likes_b / nullif(views_b, 0) - likes_a / nullif(views_a, 0) AS diff
  FROM (
    SELECT CAST(r.rep AS INTEGER) AS rep,
           CAST(sum(CASE WHEN x.exp_group = {a} THEN {w} * x.likes END) AS BIGINT) AS likes_a,
           CAST(sum(CASE WHEN x.exp_group = {a} THEN {w} * x.views END) AS BIGINT) AS views_a,
           CAST(sum(CASE WHEN x.exp_group = {b} THEN {w} * x.likes END) AS BIGINT) AS likes_b,
           CAST(sum(CASE WHEN x.exp_group = {b} THEN {w} * x.views END) AS BIGINT) AS views_b
    FROM (SELECT * FROM {src} WHERE exp_group IN ({a}, {b})) x, range(1, {n + 1}) r(rep)
    GROUP BY r.rep))"""


CI_SQL = """SELECT count(diff) AS n_reps, avg(diff) AS mean_diff, quantile_cont(diff, 0.025) AS ci_low,
       quantile_cont(diff, 0.975) AS ci_high, avg(CASE WHEN diff < 0 THEN 1.0 ELSE 0.0 END) AS share_below_zero,
       avg(CASE WHEN diff > 0 THEN 1.0 ELSE 0.0 END) AS share_above_zero FROM boot"""


def aa_cte(name="aa", same_group: bool = False) -> str:
    a, b = P.AA_GROUPS
    side = (f"SELECT user_id, ctr AS v, unnest([1, 2]) AS s FROM ua WHERE ctr IS NOT NULL AND exp_group = {a}" if same_group else
            f"SELECT user_id, ctr AS v, CASE WHEN exp_group = {a} THEN 1 ELSE 2 END AS s FROM ua WHERE ctr IS NOT NULL")
    k, reps = P.AA_K, P.AA_REPS
    u = md5_uniform_sql("s", "rep", "j")
    # the mean number of draws that give k distinct ones, and a length that falls short with odds below e^-40
    mu = f"(n * ln((n + 0.5) / (n - {k} + 0.5)))"
    length = f"CAST(ceil(greatest(3.5, 1.0 + 80.0 / ((n - {k} + 1.0) / n * {mu})) * {mu}) AS BIGINT)"
    return f"""{users_cte(*P.AA_PERIOD, P.AA_GROUPS, 'ua')},
x AS ({side}),
xi AS (SELECT s, v, row_number() OVER (PARTITION BY s ORDER BY user_id) - 1 AS idx FROM x),
sz AS (SELECT s, CAST(count(*) AS DOUBLE) AS n FROM x GROUP BY s),
reps AS (SELECT unnest(range(1, {reps + 1})) AS rep),
draws AS (
  SELECT s, rep, CAST(floor({u} * n) AS BIGINT) AS idx, j
  FROM (SELECT s, n, rep, unnest(range(1, {length} + 1)) AS j FROM (SELECT * FROM sz WHERE n > {k}), reps)),
chosen AS (
  SELECT s, rep, idx FROM (
    SELECT s, rep, idx, row_number() OVER (PARTITION BY s, rep ORDER BY j) AS rn
    FROM (SELECT s, rep, idx, min(j) AS j FROM draws GROUP BY s, rep, idx)) WHERE rn <= {k}
  UNION ALL SELECT s, rep, idx FROM xi JOIN sz USING (s), reps WHERE n = {k}),
d AS (SELECT s, rep, v FROM chosen JOIN xi USING (s, idx)),
mom AS (
  SELECT CAST(reps.rep AS INTEGER) AS rep, count(CASE WHEN s = 1 THEN v END) AS n_a, count(CASE WHEN s = 2 THEN v END) AS n_b,
         avg(CASE WHEN s = 1 THEN v END) AS mean_a, avg(CASE WHEN s = 2 THEN v END) AS mean_b,
         var_samp(CASE WHEN s = 1 THEN v END) AS var_a, var_samp(CASE WHEN s = 2 THEN v END) AS var_b,
         (SELECT count(*) FROM x WHERE s = 1) AS pool_a, (SELECT count(*) FROM x WHERE s = 2) AS pool_b
  FROM reps LEFT JOIN d ON d.rep = reps.rep GROUP BY reps.rep),
tt AS (
  SELECT *, (mean_a - mean_b) / sqrt(nullif(var_a / n_a + var_b / n_b, 0)) AS t,
         (var_a / n_a + var_b / n_b) * (var_a / n_a + var_b / n_b)
           / ((var_a / n_a) * (var_a / n_a) / nullif(n_a - 1, 0) + (var_b / n_b) * (var_b / n_b) / nullif(n_b - 1, 0)) AS df
  FROM mom),
{name} AS (SELECT rep, n_a, n_b, mean_a, mean_b, t, df, {t_two_sided_p_sql('t', 'df')} AS p_value, pool_a, pool_b FROM tt)"""


# ---- 15-minute KPIs and bands ------------------------------------------------------------------

def kpi_ctes(start, end, strict=False) -> str:
    f15 = f"""f15 AS (
  SELECT time_bucket(INTERVAL '15 minutes', time) AS ts, count(DISTINCT user_id) AS users_feed,
         count_if(action = 'like') AS likes, count_if(action = 'view') AS views
  FROM feed_actions WHERE {day_range(start, end)} GROUP BY 1)"""
    m15 = f"""m15 AS (
  SELECT time_bucket(INTERVAL '15 minutes', time) AS ts, count(DISTINCT user_id) AS users_message,
         count(user_id) AS sent_messages
  FROM message_actions WHERE {day_range(start, end)} GROUP BY 1)"""
    if not strict:
        base = """k0 AS (SELECT f15.ts, likes, views, users_feed, users_message, sent_messages
           FROM f15 JOIN m15 ON f15.ts = m15.ts)"""
    else:
        last = end - dt.timedelta(minutes=15)
        base = f"""spine AS (SELECT unnest(generate_series({ts(start)}, {ts(last)}, INTERVAL '15 minutes')) AS ts),
k0 AS (SELECT spine.ts, coalesce(likes, 0) AS likes, coalesce(views, 0) AS views,
              coalesce(users_feed, 0) AS users_feed, coalesce(users_message, 0) AS users_message,
              coalesce(sent_messages, 0) AS sent_messages
       FROM spine LEFT JOIN f15 ON spine.ts = f15.ts LEFT JOIN m15 ON spine.ts = m15.ts)"""
    kpi = """kpi AS (
  SELECT ts, CAST(ts AS DATE) AS date, strftime(ts, '%H:%M') AS hm, likes, views,
         round(likes / nullif(views, 0), 2) AS CTR, users_feed, users_message, sent_messages FROM k0)"""
    metrics = ["likes", "views", "CTR", "users_feed", "users_message", "sent_messages"]
    lg = "lg AS (" + " UNION ALL ".join(
        f"SELECT ts, '{m}' AS metric, CAST({m} AS DOUBLE) AS value FROM kpi" for m in metrics) + ")"
    return ",\n".join([f15, m15, base, kpi, lg])


def bands_ctes(a=P.IQR_A, n=P.IQR_N) -> str:
    lo, hi = n // 2, (n - 1) // 2
    return f"""b0 AS (
  SELECT ts, metric, value,
         CASE WHEN count(value) OVER w = {n} THEN quantile_cont(value, 0.25) OVER w END AS q25,
         CASE WHEN count(value) OVER w = {n} THEN quantile_cont(value, 0.75) OVER w END AS q75
  FROM lg WINDOW w AS (PARTITION BY metric ORDER BY ts ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)),
b1 AS (SELECT *, q75 - q25 AS iqr, q75 + {a} * (q75 - q25) AS up0, q25 - {a} * (q75 - q25) AS low0 FROM b0),
bands AS (
  SELECT ts, metric, value, q25, q75, iqr,
         avg(up0) OVER wc AS up, avg(low0) OVER wc AS low,
         avg(up0) OVER wl AS up_live, avg(low0) OVER wl AS low_live
  FROM b1 WINDOW wc AS (PARTITION BY metric ORDER BY ts ROWS BETWEEN {lo} PRECEDING AND {hi} FOLLOWING),
                 wl AS (PARTITION BY metric ORDER BY ts ROWS BETWEEN {lo} PRECEDING AND CURRENT ROW))"""


ALERT_START = dt.datetime.combine(P.AS_OF_TS.date() - dt.timedelta(days=1), dt.time())
ALERT_END = P.AS_OF_TS


def pct_text_sql(x: str) -> str:
    return f"printf('%.2f%%', round(({x}) * 100.0, 2))"


# ---- ETL ---------------------------------------------------------------------------------------------

def msg_stats_ctes(where: str) -> str:
    return f"""m AS (SELECT * FROM message_actions WHERE {where}),
s AS (SELECT user_id, CAST(time AS DATE) AS event_date, count(reciever_id) AS messages_sent,
             count(DISTINCT reciever_id) AS users_sent FROM m GROUP BY 1, 2),
r AS (SELECT reciever_id, CAST(time AS DATE) AS event_date, count(user_id) AS messages_received,
             count(DISTINCT user_id) AS users_received FROM m GROUP BY 1, 2),
ms AS (SELECT s.user_id, s.event_date, messages_received, messages_sent, users_received, users_sent
       FROM s JOIN r ON s.user_id = r.reciever_id AND s.event_date = r.event_date),
ms_full AS (SELECT coalesce(s.user_id, r.reciever_id) AS user_id, coalesce(s.event_date, r.event_date) AS event_date,
                   coalesce(messages_received, 0) AS messages_received, coalesce(messages_sent, 0) AS messages_sent,
                   coalesce(users_received, 0) AS users_received, coalesce(users_sent, 0) AS users_sent
            FROM s FULL OUTER JOIN r ON s.user_id = r.reciever_id AND s.event_date = r.event_date)"""


def joined_ctes(where: str) -> str:
    return f"""{msg_stats_ctes(where)},
fu AS (SELECT user_id, gender, age, os, CAST(time AS DATE) AS event_date,
              count_if(action = 'view') AS views, count_if(action = 'like') AS likes
       FROM feed_actions WHERE {where} GROUP BY ALL),
j AS (SELECT fu.user_id, fu.event_date, gender, age, os, views, likes,
             ms.messages_received, ms.messages_sent, ms.users_received, ms.users_sent
      FROM fu LEFT JOIN ms ON fu.user_id = ms.user_id AND fu.event_date = ms.event_date)"""


COUNTS = ["likes", "views", "messages_received", "messages_sent", "users_received", "users_sent"]
DIM_SQL = {"gender": "CAST(gender AS VARCHAR)", "os": "os", "age": cut_sql("age")}


def slices_sql(src="j", dims=("gender", "os", "age")) -> str:
    arms = " UNION ALL ".join(
        f"SELECT '{d}' AS dimension, {DIM_SQL[d]} AS dimension_value, event_date, {', '.join(COUNTS)} FROM {src}"
        for d in dims)
    sums = ", ".join(f"CAST(coalesce(sum({c}), 0) AS BIGINT) AS {c}" for c in COUNTS)
    return f"""SELECT dimension, dimension_value, event_date, {sums}
FROM ({arms}) sl WHERE dimension_value IS NOT NULL GROUP BY dimension, dimension_value, event_date"""


YDAY_WHERE = day_range(YDAY, P.AS_OF)


def strict_ctes(where: str) -> str:
    return f"""{msg_stats_ctes(where)},
fu AS (SELECT user_id, CAST(time AS DATE) AS event_date, count_if(action = 'view') AS views,
              count_if(action = 'like') AS likes,
              max({{'t': time, 'gender': gender, 'age': age, 'os': os}}) AS p
       FROM feed_actions WHERE {where} GROUP BY 1, 2),
s2 AS (SELECT user_id, CAST(time AS DATE) AS event_date, max({{'t': time, 'os': os}}).os AS msg_os FROM m GROUP BY 1, 2),
msf AS (SELECT ms_full.*, s2.msg_os FROM ms_full LEFT JOIN s2 USING (user_id, event_date)),
j AS (SELECT coalesce(fu.user_id, msf.user_id) AS user_id, coalesce(fu.event_date, msf.event_date) AS event_date,
             fu.p.gender AS gender, fu.p.age AS age, coalesce(fu.p.os, msf.msg_os) AS os,
             coalesce(likes, 0) AS likes, coalesce(views, 0) AS views,
             coalesce(messages_received, 0) AS messages_received, coalesce(messages_sent, 0) AS messages_sent,
             coalesce(users_received, 0) AS users_received, coalesce(users_sent, 0) AS users_sent
      FROM fu FULL OUTER JOIN msf ON fu.user_id = msf.user_id AND fu.event_date = msf.event_date)"""


# ---- lifecycle ------------------------------------------------------------------------------------------

LIFE_CTES = f"""{ORD},
uw AS (SELECT DISTINCT user_id, CAST(date_trunc('week', time) AS DATE) AS week FROM act),
fw AS (SELECT user_id, min(week) AS first_week FROM uw GROUP BY user_id),
nm AS (SELECT CAST(date_trunc('week', CAST(max(time) AS DATE) + 1) AS DATE) + 7 AS next_monday FROM act)"""

GONE_SQL = """SELECT a.week + 7 AS this_week, a.week AS previous_week, -count(*) AS num_users, 'gone' AS status
FROM uw a WHERE NOT EXISTS (SELECT 1 FROM uw b WHERE b.user_id = a.user_id AND b.week = a.week + 7)
  AND a.week + 7 <> (SELECT next_monday FROM nm)
GROUP BY 1, 2"""


def current_sql(strict=False) -> str:
    other = "CASE WHEN a.week = fw.first_week THEN 'new' ELSE 'returned' END" if strict else "'new'"
    return f"""SELECT this_week, previous_week, count(*) AS num_users, status FROM (
  SELECT a.week AS this_week, a.week - 7 AS previous_week,
         CASE WHEN EXISTS (SELECT 1 FROM uw b WHERE b.user_id = a.user_id AND b.week = a.week - 7)
              THEN 'retained' ELSE {other} END AS status
  FROM uw a JOIN fw USING (user_id)) GROUP BY 1, 2, 4"""


FLAGS_SQL = f"""WITH {ORD},
uw AS (SELECT DISTINCT user_id, CAST(date_trunc('week', time) AS DATE) AS week FROM act)
SELECT a.user_id, a.week,
       EXISTS (SELECT 1 FROM uw b WHERE b.user_id = a.user_id AND b.week = a.week - 7) AS in_prev_week,
       EXISTS (SELECT 1 FROM uw b WHERE b.user_id = a.user_id AND b.week = a.week + 7) AS in_next_week
FROM uw a"""


def retention_sql(src_where: str, as_of, table="feed_actions", cte=FEED, strings=True) -> str:
    since = as_of - dt.timedelta(days=P.HORIZON)
    sel = ("strftime(start_day, '%Y-%m-%d') AS start_day, strftime(day, '%Y-%m-%d') AS day, users"
           if strings else "start_day, day, users")
    return f"""WITH {cte},
t1 AS (SELECT user_id, min(CAST(time AS DATE)) AS start_day FROM {table} WHERE {src_where} GROUP BY user_id),
t2 AS (SELECT DISTINCT user_id, CAST(time AS DATE) AS day FROM {table} WHERE {src_where}),
c AS (SELECT start_day, day, count(user_id) AS users FROM t1 JOIN t2 USING (user_id)
      WHERE start_day >= {date(since)} AND start_day <= {date(as_of)} GROUP BY start_day, day)
SELECT {sel} FROM c"""


def dims_union(src: str, extra_cols: str) -> str:
    dims = {"gender": "CAST(gender AS VARCHAR)", "age": cut_sql("age"), "os": "os", "source": "source"}
    return " UNION ALL ".join(f"SELECT {extra_cols}, '{k}' AS dimension, {v} AS dimension_value FROM {src}"
                              for k, v in dims.items())


def build() -> dict[str, str]:
    O: dict[str, str] = {}
    F_ = f"WITH {FEED}"
    FM = f"WITH {FEED},\n{MSG}"
    yday = day_range(YDAY, P.AS_OF)
    week = day_range(WEEK_START, P.AS_OF)

    # 2.1 sources and sinks
    O["src_feed_actions"] = f"{F_} SELECT * FROM feed_actions"
    O["src_message_actions"] = f"WITH {MSG} SELECT * FROM message_actions"
    O["src_all_activity"] = (f"{FM} SELECT CAST(time AS DATE) AS date, user_id, os FROM feed_actions "
                             f"UNION ALL SELECT CAST(time AS DATE) AS date, user_id, os FROM message_actions")
    O["slice_report_daily"] = f"{FM},\n{joined_ctes(yday)}\n{slices_sql()}"
    labels = ", ".join(f"'{x}'" for x in AGE_LABELS)
    O["slice_report_filled"] = f"""{FM},\n{joined_ctes(yday)},
sl AS ({slices_sql()}),
grid AS (SELECT 'age' AS dimension, unnest([{labels}]) AS dimension_value, event_date FROM (SELECT DISTINCT event_date FROM sl))
SELECT * FROM sl UNION ALL
SELECT dimension, dimension_value, event_date, {', '.join('CAST(0 AS BIGINT)' for _ in COUNTS)} FROM grid
WHERE NOT EXISTS (SELECT 1 FROM sl WHERE sl.dimension = grid.dimension AND sl.dimension_value = grid.dimension_value
                  AND sl.event_date = grid.event_date)"""
    O["sink_slice_table"] = O["slice_report_daily"]
    O["set_concat_slices"] = O["slice_report_daily"]
    O["slice_report_daily_strict"] = f"{FM},\n{strict_ctes(yday)}\n{slices_sql()}"
    for d in ("gender", "os", "age"):
        O[f"agg_slices_{d}"] = f"{FM},\n{joined_ctes(yday)}\n{slices_sql(dims=(d,))}"

    # 2.2 filters
    O["flt_day_yesterday"] = f"{F_} SELECT * FROM feed_actions WHERE {yday}"
    O["flt_last_n_days"] = f"{F_} SELECT * FROM feed_actions WHERE {week}"
    O["flt_fixed_period"] = f"{F_} SELECT * FROM feed_actions WHERE {period(*P.AB_PERIOD)}"
    O["flt_closed_windows"] = (f"WITH {MSG} SELECT * FROM message_actions WHERE "
                               f"{day_range(ALERT_START, ALERT_END)}")
    O["flt_segment"] = (f"{F_} SELECT * FROM feed_actions WHERE source = 'ads' AND exp_group IN (1, 2) "
                        f"AND action = 'like'")
    since = P.RETENTION_AS_OF - dt.timedelta(days=P.HORIZON)
    O["flt_cohort_horizon"] = (f"{F_} SELECT user_id, min(CAST(time AS DATE)) AS start_day FROM feed_actions "
                               f"WHERE source = 'ads' GROUP BY user_id "
                               f"HAVING min(CAST(time AS DATE)) >= {date(since)} "
                               f"AND min(CAST(time AS DATE)) <= {date(P.RETENTION_AS_OF)}")
    O["flt_exclude_future_week"] = f"WITH {LIFE_CTES}\n{GONE_SQL}"
    O["prj_derived_alias"] = (f"{F_} SELECT user_id, time, time_bucket(INTERVAL '15 minutes', time) AS ts, "
                              f"strftime(time_bucket(INTERVAL '15 minutes', time), '%H:%M') AS hm, "
                              f"CAST(date_trunc('week', time) AS DATE) AS this_week, "
                              f"CAST(date_trunc('week', time) AS DATE) - 7 AS previous_week FROM feed_actions")

    # 2.3 joins
    O["join_first_day_activity"] = f"""{F_},
t1 AS (SELECT user_id, min(CAST(time AS DATE)) AS start_day FROM feed_actions WHERE source = 'ads' GROUP BY user_id),
t2 AS (SELECT DISTINCT user_id, CAST(time AS DATE) AS day FROM feed_actions WHERE source = 'ads')
SELECT user_id, start_day, day FROM t1 JOIN t2 USING (user_id)"""
    O["join_sender_receiver"] = f"WITH {MSG},\n{msg_stats_ctes(yday)}\nSELECT * FROM ms"
    O["join_sender_receiver_strict"] = f"WITH {MSG},\n{msg_stats_ctes(yday)}\nSELECT * FROM ms_full"
    O["join_feed_messages_left"] = f"{FM},\n{joined_ctes(yday)}\nSELECT * FROM j"
    O["join_daily_feed_msgs"] = f"""{FM},
f AS (SELECT CAST(time AS DATE) AS date, count_if(action = 'like') AS likes, count_if(action = 'view') AS views,
             round(count_if(action = 'like') / nullif(count_if(action = 'view'), 0), 2) AS CTR
      FROM feed_actions WHERE {week} GROUP BY 1),
mm AS (SELECT CAST(time AS DATE) AS date, count(user_id) AS messages FROM message_actions WHERE {week} GROUP BY 1)
SELECT f.date, likes, views, CTR, messages FROM f JOIN mm ON f.date = mm.date"""
    kpi = f"{FM},\n{kpi_ctes(ALERT_START, ALERT_END)}"
    O["join_15min_feed_msgs"] = f"{kpi}\nSELECT * FROM kpi"
    O["kpi_15min"] = O["join_15min_feed_msgs"]
    O["sort_time_series"] = f"{kpi}\nSELECT * FROM kpi ORDER BY ts"
    O["member_prev_next_week"] = FLAGS_SQL
    O["win_prev_week_flag"] = FLAGS_SQL

    # 2.4 aggregations
    ab = f"{F_},\n{users_cte(*P.AB_PERIOD, P.AB_GROUPS)}"
    O["agg_user_likes_views"] = f"{ab}\nSELECT * FROM u"
    O["agg_user_day_profile"] = (f"{F_} SELECT user_id, gender, age, os, CAST(time AS DATE) AS event_date, "
                                 f"count_if(action = 'view') AS views, count_if(action = 'like') AS likes "
                                 f"FROM feed_actions WHERE {yday} GROUP BY ALL")
    O["agg_sender_stats"] = f"WITH {MSG},\n{msg_stats_ctes(yday)}\nSELECT * FROM s"
    O["agg_receiver_stats"] = f"WITH {MSG},\n{msg_stats_ctes(yday)}\nSELECT * FROM r"
    O["agg_daily_feed_kpi"] = (f"{F_} SELECT CAST(time AS DATE) AS date, count(DISTINCT user_id) AS DAU, "
                               f"count_if(action = 'like') AS likes, count_if(action = 'view') AS views, "
                               f"count_if(action = 'like') / nullif(count_if(action = 'view'), 0) AS CTR "
                               f"FROM feed_actions GROUP BY 1")
    O["digest_feed_week"] = O["agg_daily_feed_kpi"].replace("FROM feed_actions GROUP BY 1",
                                                            f"FROM feed_actions WHERE {week} GROUP BY 1")
    O["agg_daily_posts_dau"] = (f"{F_} SELECT CAST(time AS DATE) AS date, count(DISTINCT post_id) AS active_posts, "
                                f"count(DISTINCT user_id) AS dau, count_if(action = 'like') AS likes, "
                                f"count_if(action = 'view') AS views, "
                                f"count_if(action = 'like') / nullif(count_if(action = 'view'), 0) AS ctr "
                                f"FROM feed_actions GROUP BY 1")
    app_dau = f"""ad AS (
  SELECT date, count(DISTINCT user_id) AS total_DAU,
         count(DISTINCT CASE WHEN os = 'iOS' THEN user_id END) AS users_ios,
         count(DISTINCT CASE WHEN os = 'Android' THEN user_id END) AS users_android
  FROM (SELECT CAST(time AS DATE) AS date, user_id, os FROM feed_actions WHERE {week}
        UNION ALL SELECT CAST(time AS DATE) AS date, user_id, os FROM message_actions WHERE {week}) x
  GROUP BY date)"""
    O["agg_daily_app_dau"] = f"{FM},\n{app_dau}\nSELECT * FROM ad"
    O["agg_daily_messages"] = (f"WITH {MSG} SELECT CAST(time AS DATE) AS date, count(user_id) AS messages "
                               f"FROM message_actions GROUP BY 1")
    O["agg_group_sizes"] = f"{ab}\nSELECT exp_group, count(*) AS n_users FROM u GROUP BY exp_group"
    O["agg_group_ctr"] = (f"{ab}\nSELECT exp_group, CAST(sum(likes) AS BIGINT) AS likes, "
                          f"CAST(sum(views) AS BIGINT) AS views, sum(likes) / nullif(sum(views), 0) AS global_ctr "
                          f"FROM u GROUP BY exp_group")
    O["agg_bucket_ctr"] = f"{F_},\n{bucket_cte()}\nSELECT * FROM bk"
    O["agg_bucket_ctr_xxh64"] = f"{F_},\n{bucket_cte(method='xxh64_4')}\nSELECT * FROM bk"
    O["agg_weekly_status_counts"] = f"WITH {LIFE_CTES}\n{current_sql()}"
    O["set_union_status"] = f"WITH {LIFE_CTES}\n{GONE_SQL}\nUNION ALL\n{current_sql()}"
    O["weekly_lifecycle"] = O["set_union_status"]
    O["weekly_lifecycle_closed"] = (
        f"WITH {LIFE_CTES},\nlc AS ({GONE_SQL}\nUNION ALL\n{current_sql()})\n"
        f"SELECT * FROM lc WHERE status <> 'gone' OR this_week <> CAST(date_trunc('week', "
        f"(SELECT max(CAST(time AS DATE)) + 1 FROM act)) AS DATE)")
    O["weekly_lifecycle_strict"] = f"WITH {LIFE_CTES}\n{GONE_SQL}\nUNION ALL\n{current_sql(True)}"
    O["agg_retention_counts"] = retention_sql("true", P.ORDERS_RETENTION_AS_OF, "act", ORD, strings=False)
    O["retention_orders"] = retention_sql("true", P.ORDERS_RETENTION_AS_OF, "act", ORD)
    O["retention_ads"] = retention_sql("source = 'ads'", P.RETENTION_AS_OF)
    O["retention_organic"] = retention_sql("source = 'organic'", P.RETENTION_AS_OF)
    O["agg_first_activity"] = (f"WITH {ORD} SELECT user_id, min(CAST(time AS DATE)) AS start_day "
                               f"FROM act GROUP BY user_id")
    O["agg_distinct_user_days"] = f"{F_} SELECT DISTINCT user_id, CAST(time AS DATE) AS day FROM feed_actions"
    O["agg_user_weeks_array"] = (f"WITH {ORD} SELECT user_id, array_to_string(list_sort(list_distinct("
                                 f"list(strftime(CAST(date_trunc('week', time) AS DATE), '%Y-%m-%d')))), ',') AS weeks "
                                 f"FROM act GROUP BY user_id")

    # 2.5 windows
    bands = f"{kpi},\n{bands_ctes()}"
    O["win_rolling_quantiles"] = f"{bands}\nSELECT ts, metric, {rnd(['value', 'q25', 'q75', 'iqr'])} FROM bands"
    O["win_centered_mean"] = f"{bands}\nSELECT ts, metric, {rnd(['value', 'up', 'low'])} FROM bands"
    O["anomaly_iqr"] = (f"{bands}\nSELECT ts, metric, "
                        f"{rnd(['value', 'q25', 'q75', 'iqr', 'up', 'low', 'up_live', 'low_live'])} FROM bands")
    strict_bands = f"{FM},\n{kpi_ctes(ALERT_START, ALERT_END, strict=True)},\n{bands_ctes()}"
    O["anomaly_iqr_strict"] = (f"{strict_bands}\nSELECT ts, metric, "
                               f"{rnd(['value', 'q25', 'q75', 'iqr', 'up', 'low', 'up_live', 'low_live'])} FROM bands")
    long_start = ALERT_END - dt.timedelta(days=P.LONG_HISTORY)
    O["anomaly_iqr_ranges"] = (f"{FM},\n{kpi_ctes(long_start, ALERT_END)},\n{bands_ctes()}\nSELECT ts, metric, "
                               f"{rnd(['value', 'q25', 'q75', 'iqr', 'up', 'low', 'up_live', 'low_live'])} FROM bands")
    O["anomaly_backtest"] = (f"{bands}\nSELECT ts, metric, {rnd(['value', 'up_live', 'low_live'])}, "
                             f"coalesce(value < low_live OR value > up_live, false) AS is_alert FROM bands")
    text = (f"'Metric ' || metric || ':' || {NL} || 'Current value ' || printf('%.2f', round(value, 2)) || {NL} || "
            f"'Deviation from previous value ' || coalesce({pct_text_sql('deviation')}, 'n/a')")
    O["anomaly_alerts_latest"] = f"""{bands},
al AS (SELECT *, lag(value) OVER (PARTITION BY metric ORDER BY ts) AS prev_value,
              max(ts) OVER (PARTITION BY metric) AS last_ts FROM bands),
al2 AS (SELECT *, abs(1.0 - value / nullif(prev_value, 0)) AS deviation,
               coalesce(value < low OR value > up, false) AS is_alert FROM al WHERE ts = last_ts)
SELECT metric, ts, {rnd(['value', 'prev_value', 'deviation', 'q25', 'q75', 'up', 'low'])}, is_alert,
       CASE WHEN is_alert THEN {text} END AS text FROM al2"""
    O["win_last_vs_prev"] = f"""{kpi},
x AS (SELECT *, lag(value) OVER (PARTITION BY metric ORDER BY ts) AS prev_value FROM lg)
SELECT ts, metric, {rnd(['value', 'prev_value'])}, round(abs(1.0 - value / nullif(prev_value, 0)), 6) AS deviation FROM x"""
    dow_start = P.AS_OF_TS - dt.timedelta(days=7)
    O["anomaly_day_over_day"] = f"""{FM},\n{kpi_ctes(dow_start, ALERT_END)},
x AS (SELECT *, lag(ts) OVER w AS pts, lag(value) OVER w AS pv FROM lg
      WINDOW w AS (PARTITION BY metric, strftime(ts, '%H:%M') ORDER BY ts)),
y AS (SELECT ts, metric, value, CASE WHEN pts = ts - INTERVAL 1 DAY THEN pv END AS value_day_before FROM x)
SELECT ts, metric, {rnd(['value', 'value_day_before'])}, round(value / nullif(value_day_before, 0) - 1.0, 6) AS change FROM y"""
    daily_long = f"""{F_},
dk AS (SELECT CAST(time AS DATE) AS date, count(DISTINCT user_id) AS DAU, count_if(action = 'like') AS likes,
              count_if(action = 'view') AS views,
              count_if(action = 'like') / nullif(count_if(action = 'view'), 0) AS CTR FROM feed_actions GROUP BY 1),
lg AS ({' UNION ALL '.join(f"SELECT date, '{m}' AS metric, CAST({m} AS DOUBLE) AS value FROM dk" for m in ['DAU', 'likes', 'views', 'CTR'])}),
x AS (SELECT *, lag(value) OVER w AS pv, lag(date) OVER w AS pd FROM lg WINDOW w AS (PARTITION BY metric ORDER BY date)),
y AS (SELECT date, metric, value, CASE WHEN pd = date - 1 THEN pv END AS prev_value FROM x)"""
    O["win_day_over_day"] = (f"{daily_long}\nSELECT date, metric, {rnd(['value', 'prev_value'])}, "
                             f"round(value / nullif(prev_value, 0) - 1.0, 6) AS pct_change FROM y")
    O["win_ranks_midrank"] = f"""{ab},
c AS (SELECT ctr AS value, count_if(exp_group = 1) AS n_a, count_if(exp_group = 2) AS n_b
      FROM u WHERE ctr IS NOT NULL GROUP BY ctr)
SELECT round(value, 6) AS value, n_a, n_b,
       round(CAST(coalesce(sum(n_a + n_b) OVER (ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
             + (n_a + n_b + 1) / 2.0, 6) AS midrank FROM c"""

    # 2.6 top-k
    O["top3_posts_by_likes"] = (f"{F_} SELECT post_id, count_if(action = 'like') AS likes FROM feed_actions "
                                f"WHERE {period(*P.POST)} GROUP BY post_id ORDER BY likes DESC, post_id LIMIT 3")

    # 2.7 scalar functions
    wk = "CAST(date_trunc('week', time) AS DATE)"
    t15 = "time_bucket(INTERVAL '15 minutes', time)"
    O["fn_scalar_parity"] = f"""{F_}
SELECT user_id, time, CAST(time AS DATE) AS g1_date, strftime(CAST(time AS DATE), '%Y-%m-%d') AS g2_date_text,
       {wk} AS g3_monday, {wk} + 7 AS g4_next_week, {wk} - 7 AS g4_prev_week,
       CAST(time AS DATE) - 1 AS g5_day_before, {t15} AS g6_ts15, strftime({t15}, '%H:%M') AS g7_hm,
       strftime(CAST(time AS DATE), '%d-%m-%Y') AS g8_dmy, round(age / 7.0, 2) AS g9_round,
       CASE WHEN action = 'like' THEN 'like' ELSE 'other' END AS g10_if,
       list_contains([{wk}, {wk} + 7], {wk} + 7) AS g11_has, CAST(len([{wk}, {wk} + 7]) AS INTEGER) AS g12_n_exploded,
       {user_bucket_sql('user_id', P.N_BUCKETS)} AS g13_bucket, CAST(action = 'like' AS INTEGER) AS g14_is_like,
       -CAST(user_id AS BIGINT) AS g15_neg, age BETWEEN 18 AND 25 AS g16_between, exp_group IN (1, 2) AS g16_in,
       {cut_sql('age')} AS g17_age_group, {pct_text_sql('age / 300.0')} AS g18_pct_text,
       abs(age - 40) AS g18_abs, CAST(gender AS BIGINT) AS g19_int
FROM feed_actions"""

    # 2.8 product metrics
    O["retention_by_source"] = f"""{F_},
t1 AS (SELECT source, user_id, min(CAST(time AS DATE)) AS start_day FROM feed_actions GROUP BY 1, 2),
t2 AS (SELECT DISTINCT source, user_id, CAST(time AS DATE) AS day FROM feed_actions),
c AS (SELECT source, start_day, day, count(user_id) AS users FROM t1 JOIN t2 USING (source, user_id)
      WHERE start_day >= {date(since)} AND start_day <= {date(P.RETENTION_AS_OF)} GROUP BY 1, 2, 3),
d AS (SELECT *, CAST(day - start_day AS INTEGER) AS day_n,
             max(CASE WHEN day = start_day THEN users END) OVER (PARTITION BY source, start_day) AS cohort_users FROM c)
SELECT *, users / nullif(cohort_users, 0) AS retention FROM d"""
    O["retention_incremental"] = O["retention_by_source"]
    # the week's users looked up one by one, on the feed
    fw = f"""{FEED},
uw AS (SELECT DISTINCT user_id, CAST(date_trunc('week', time) AS DATE) AS week FROM feed_actions),
fw AS (SELECT user_id, min(week) AS first_week FROM uw GROUP BY user_id)"""
    gone = f"""SELECT week + 7 AS this_week, week AS previous_week, -count(*) AS num_users, 'gone' AS status FROM uw a
WHERE NOT EXISTS (SELECT 1 FROM uw b WHERE b.user_id = a.user_id AND b.week = a.week + 7)
  AND week + 7 <> CAST(date_trunc('week', {date(P.AS_OF)}) AS DATE) + 7 GROUP BY week"""
    O["weekly_lifecycle_incremental"] = f"WITH {fw}\n{gone}\nUNION ALL\n{current_sql()}"
    O["weekly_lifecycle_incremental_strict"] = f"WITH {fw}\n{gone}\nUNION ALL\n{current_sql(True)}"
    pivots = ", ".join(f"max(CASE WHEN day_n = {i} THEN users END) AS d{i}"
                       for i in range((P.RETENTION_UNTIL - P.RETENTION_AS_OF).days + P.HORIZON + 1))
    O["retention_heatmap"] = f"""{F_},
t1 AS (SELECT user_id, min(CAST(time AS DATE)) AS start_day FROM feed_actions WHERE source = 'ads' GROUP BY user_id),
t2 AS (SELECT DISTINCT user_id, CAST(time AS DATE) AS day FROM feed_actions WHERE source = 'ads'),
c0 AS (SELECT start_day, day, count(user_id) AS users FROM t1 JOIN t2 USING (user_id)
       WHERE start_day >= {date(since)} AND start_day <= {date(P.RETENTION_AS_OF)} GROUP BY start_day, day),
c1 AS (SELECT start_day, CAST(day - start_day AS INTEGER) AS day_n, users FROM c0 WHERE day <= {date(P.RETENTION_UNTIL)})
SELECT start_day, {pivots} FROM c1 GROUP BY start_day"""
    O["dau_by_slice"] = f"""{F_}
SELECT date, dimension, dimension_value, count(DISTINCT user_id) AS dau
FROM ({dims_union('feed_actions', 'CAST(time AS DATE) AS date, user_id')}) x
WHERE dimension_value IS NOT NULL GROUP BY ALL"""
    cd = P.CAMPAIGN_DAY
    O["campaign_cohort_followup"] = f"""{F_},
t1 AS (SELECT user_id FROM feed_actions WHERE source = 'ads' GROUP BY user_id HAVING min(CAST(time AS DATE)) = {date(cd)}),
t2 AS (SELECT DISTINCT user_id, CAST(time AS DATE) AS day FROM feed_actions WHERE source = 'ads'),
c AS (SELECT day, count(*) AS users FROM t1 JOIN t2 USING (user_id) GROUP BY day),
d AS (SELECT day, users, CAST(day - {date(cd)} AS INTEGER) AS day_n,
             max(CASE WHEN day = {date(cd)} THEN users END) OVER () AS cohort_users FROM c)
SELECT *, users / nullif(cohort_users, 0) AS share FROM d"""
    dd, dp = P.DROP_DAY, P.DROP_DAY - dt.timedelta(days=1)
    O["drop_contribution"] = f"""{F_},
d AS (SELECT * FROM feed_actions WHERE {day_range(dp, dd + dt.timedelta(days=1))}),
x AS (SELECT date, dimension, dimension_value, count(DISTINCT user_id) AS dau
      FROM ({dims_union('d', 'CAST(time AS DATE) AS date, user_id')}) s
      WHERE dimension_value IS NOT NULL GROUP BY ALL),
p AS (SELECT dimension, dimension_value,
             CAST(coalesce(sum(CASE WHEN date = {date(dp)} THEN dau END), 0) AS BIGINT) AS dau_before,
             CAST(coalesce(sum(CASE WHEN date = {date(dd)} THEN dau END), 0) AS BIGINT) AS dau_on_day
      FROM x GROUP BY ALL)
SELECT *, dau_on_day - dau_before AS delta,
       (dau_on_day - dau_before) / nullif(sum(dau_on_day - dau_before) OVER (PARTITION BY dimension), 0) AS share_of_change
FROM p"""
    O["events_per_user"] = f"""{F_},
k AS (SELECT CAST(time AS DATE) AS date, count(*) AS events, count(DISTINCT user_id) AS dau,
             count_if(action = 'like') AS likes, count_if(action = 'view') AS views FROM feed_actions GROUP BY 1)
SELECT *, events / nullif(dau, 0) AS events_per_user, likes / nullif(dau, 0) AS likes_per_user,
       views / nullif(dau, 0) AS views_per_user FROM k"""
    t0 = dt.datetime.combine(P.TODAY_TS.date(), dt.time())
    O["today_hourly_feed"] = f"""{F_}
SELECT date_trunc('hour', time) AS ts, count(DISTINCT user_id) AS users, count_if(action = 'like') AS likes,
       count_if(action = 'view') AS views,
       count_if(action = 'like') / nullif(count_if(action = 'view'), 0) AS ctr
FROM feed_actions WHERE {day_range(t0, P.TODAY_TS)} GROUP BY 1"""
    O["feed_messenger_overlap"] = f"""{FM},
pu AS (SELECT date, user_id, bool_or(is_feed) AS f, bool_or(is_msg) AS m FROM (
         SELECT CAST(time AS DATE) AS date, user_id, true AS is_feed, false AS is_msg FROM feed_actions
         UNION ALL SELECT CAST(time AS DATE) AS date, user_id, false, true FROM message_actions) GROUP BY 1, 2)
SELECT date, CASE WHEN f AND m THEN 'both' WHEN f THEN 'feed_only' ELSE 'messages_only' END AS segment,
       count(*) AS users FROM pu GROUP BY 1, 2"""
    O["digest_feed_yesterday"] = f"""{F_},
k AS (SELECT CAST(time AS DATE) AS date, count(DISTINCT user_id) AS DAU, count_if(action = 'like') AS likes,
             count_if(action = 'view') AS views,
             round(count_if(action = 'like') / nullif(count_if(action = 'view'), 0), 2) AS CTR
      FROM feed_actions WHERE {yday} GROUP BY 1)
SELECT *, 'Metrics for ' || strftime(date, '%d-%m-%Y') || ':' || {NL} || {NL} || 'DAU = ' || CAST(DAU AS VARCHAR)
          || {NL} || 'likes = ' || CAST(likes AS VARCHAR) || {NL} || 'views = ' || CAST(views AS VARCHAR)
          || {NL} || 'CTR = ' || CAST(CTR AS VARCHAR) AS text FROM k"""
    app_week = f"""{FM},
{app_dau},
f AS (SELECT CAST(time AS DATE) AS date, count_if(action = 'like') AS likes, count_if(action = 'view') AS views,
             round(count_if(action = 'like') / nullif(count_if(action = 'view'), 0), 2) AS CTR
      FROM feed_actions WHERE {week} GROUP BY 1),
mm AS (SELECT CAST(time AS DATE) AS date, count(user_id) AS messages FROM message_actions WHERE {week} GROUP BY 1),
aw AS (SELECT ad.date, total_DAU, users_ios, users_android, likes, views, CTR, messages
       FROM ad JOIN f ON ad.date = f.date JOIN mm ON f.date = mm.date)"""
    O["digest_app_week"] = f"{app_week}\nSELECT * FROM aw"
    app_metrics = ["total_DAU", "users_ios", "users_android", "likes", "views", "CTR"]
    O["digest_app_changes"] = f"""{app_week},
lg AS ({' UNION ALL '.join(f"SELECT date, '{m}' AS metric, CAST({m} AS DOUBLE) AS value FROM aw" for m in app_metrics)}),
x AS (SELECT *, lag(value) OVER w AS pv, lag(date) OVER w AS pd FROM lg WINDOW w AS (PARTITION BY metric ORDER BY date)),
y AS (SELECT date, metric, value, CASE WHEN pd = date - 1 THEN pv END AS prev_value FROM x),
z AS (SELECT *, value / nullif(prev_value, 0) - 1.0 AS pct_change FROM y WHERE date = {date(YDAY)})
SELECT date, metric, {rnd(['value', 'prev_value', 'pct_change'])},
       metric || ' = ' || CASE WHEN metric = 'CTR' THEN printf('%.2f', round(value, 2))
                               ELSE CAST(CAST(value AS BIGINT) AS VARCHAR) END
       || ' (' || coalesce({pct_text_sql('pct_change')}, 'n/a') || ' change vs 1 day before)' AS text
FROM z"""
    places = " ".join(f"WHEN '{m}' THEN {i}" for i, m in enumerate(app_metrics))
    head, tail = O["digest_app_changes"].rsplit("\nSELECT", 1)
    O["digest_app_message"] = f"""{head.rstrip()},
m AS (SELECT{tail})
SELECT date, 'App metrics for ' || strftime(date, '%d-%m-%Y') || ':' || {NL} || {NL} ||
       string_agg(text, {NL} ORDER BY CASE metric {places} END) AS message FROM m GROUP BY date"""
    O["kpi_long_series"] = f"""{F_},
dk AS (SELECT CAST(time AS DATE) AS date, count(DISTINCT user_id) AS DAU, count_if(action = 'like') AS likes,
              count_if(action = 'view') AS views,
              count_if(action = 'like') / nullif(count_if(action = 'view'), 0) AS CTR
       FROM feed_actions WHERE {week} GROUP BY 1)
{' UNION ALL '.join(f"SELECT date, '{m}' AS metric, CAST({m} AS DOUBLE) AS value FROM dk" for m in ['DAU', 'likes', 'views', 'CTR'])}"""

    # 2.9 experiments
    a, b = P.AB_GROUPS
    O["ab_welch_ctr"] = f"{ab}\n{welch_sql('u', 'ctr', a, b)}"
    O["ab_welch_smoothed"] = f"{ab},\n{smoothed_cte()}\n{welch_sql('sm', 'smoothed_ctr', a, b)}"
    lin_parts = []
    ctes = [FEED]
    for (ga, gb) in (P.AB_GROUPS_2, P.AB_GROUPS):
        un, ln = f"u{ga}{gb}", f"l{ga}{gb}"
        ctes.append(users_cte(*P.AB_PERIOD, (ga, gb), un))
        ctes.append(f"""{ln} AS (SELECT {un}.*, likes - (SELECT sum(likes) / nullif(sum(views), 0) FROM {un}
                                   WHERE exp_group = {ga}) * views AS linearized_likes FROM {un})""")
        lin_parts.append(welch_sql(ln, "linearized_likes", ga, gb))
    O["ab_welch_linearized"] = "WITH " + ",\n".join(ctes) + "\n" + "\nUNION ALL\n".join(lin_parts)
    bk = f"{F_},\n{bucket_cte()}"
    O["ab_welch_bucket"] = f"{bk}\n{welch_sql('bk', 'bucket_ctr', a, b)}"
    O["ab_mannwhitney_ctr"] = f"{ab}\n{mw_sql('u', 'ctr', a, b)}"
    O["ab_mannwhitney_smoothed"] = f"{ab},\n{smoothed_cte()}\n{mw_sql('sm', 'smoothed_ctr', a, b)}"
    # the exact distribution by listing all arrangements of the ranks
    O["ab_mannwhitney_daily"] = f"""{F_},
dc AS (SELECT exp_group, CAST(time AS DATE) AS date, count_if(action = 'like') / nullif(count_if(action = 'view'), 0) AS ctr
       FROM feed_actions WHERE {period(*P.AB_PERIOD)} AND exp_group IN ({a}, {b}) GROUP BY 1, 2),
mw AS ({mw_core_sql('dc', 'ctr', a, b)}),
masks AS (SELECT unnest(range(0, (SELECT CAST(1 AS BIGINT) << (n_a + n_b) FROM mw))) AS mask),
bits AS (SELECT unnest(range(0, (SELECT n_a + n_b FROM mw))) AS bit),
us AS (SELECT mask, sum(bit + 1) - any_value(n_a * (n_a + 1) / 2) AS u FROM masks, bits, mw
       WHERE (mask >> bit) & 1 = 1 GROUP BY mask HAVING count(*) = any_value(n_a)),
ex AS (SELECT count_if(us.u <= least(mw.u_a, mw.u_b)) / count(*) AS share FROM us, mw),
x AS (SELECT mw.*, p_tie = 0 AND least(n_a, n_b) BETWEEN 1 AND 8
             AND NOT EXISTS (SELECT 1 FROM dc WHERE ctr IS NOT NULL GROUP BY ctr HAVING count(*) > 1) AS exact FROM mw)
SELECT group_a, group_b, n_a, n_b, {rnd([c for c in MW_COLS_D if c != 'p_value'])}, exact,
       round(CASE WHEN exact THEN least(1.0, 2.0 * share) ELSE p_value END, 6) AS p_value FROM x, ex"""
    bx = f"{F_},\n{bucket_cte(method='xxh64_4')}"
    O["ab_welch_bucket_xxh64"] = f"{bx}\n{welch_sql('bk', 'bucket_ctr', a, b)}"
    O["ab_mannwhitney_bucket"] = f"{bk}\n{mw_sql('bk', 'bucket_ctr', a, b)}"
    sup = "\nUNION ALL\n".join(
        f"SELECT '{v}' AS metric, {rnd(['p_a_gt_b', 'p_tie', 'p_b_gt_a'])} FROM ({mw_core_sql(s, v, a, b)})"
        for s, v in (("u", "ctr"), ("sm", "smoothed_ctr"), ("bk", "bucket_ctr")))
    O["ab_prob_superiority"] = f"{ab},\n{smoothed_cte()},\n{bucket_cte()}\n{sup}"
    O["ab_poisson_bootstrap"] = (f"{ab},\n{boot_cte()}\nSELECT rep, likes_a, views_a, likes_b, views_b, "
                                 f"{rnd(['ctr_a', 'ctr_b', 'diff'])} FROM boot")
    ci_cols = ["mean_diff", "ci_low", "ci_high", "share_below_zero", "share_above_zero"]
    O["ab_bootstrap_diff_ci"] = (f"{ab},\n{boot_cte()}\nSELECT n_reps, {rnd(ci_cols)} FROM ({CI_SQL})")
    O["aa_resample_pvalues"] = (f"{F_},\n{aa_cte()}\nSELECT rep, n_a, n_b, "
                                f"{rnd(['mean_a', 'mean_b', 't', 'df', 'p_value'])}, pool_a, pool_b FROM aa")
    O["aa_same_group"] = O["aa_resample_pvalues"].replace(aa_cte(), aa_cte(same_group=True))
    O["aa_false_positive_rate"] = f"""{F_},\n{aa_cte()}
SELECT n_reps, round(fpr_pct, 6) AS fpr_pct,
       CASE WHEN fpr_pct <= 5.0 THEN 'split ok' ELSE 'split suspicious' END AS verdict
FROM (SELECT count(*) AS n_reps, avg(CASE WHEN p_value <= 0.05 THEN 1.0 ELSE 0.0 END) * 100.0 AS fpr_pct FROM aa)"""
    lin_cte = f"""lin AS (SELECT u.*, likes - (SELECT sum(likes) / nullif(sum(views), 0) FROM u WHERE exp_group = {a})
                 * views AS linearized_likes FROM u)"""
    dist = [("u", "ctr", "ctr", "exp_group"), ("sm", "smoothed_ctr", "smoothed_ctr", "exp_group"),
            ("lin", "linearized_likes", "linearized_likes", "exp_group"), ("bk", "bucket_ctr", "bucket_ctr", "exp_group"),
            ("boot", "bootstrap_ctr", "ctr_a", str(a)), ("boot", "bootstrap_ctr", "ctr_b", str(b)),
            ("boot", "bootstrap_diff", "diff", "'diff'"), ("aa", "aa_p_value", "p_value", "'aa'")]
    values = " UNION ALL ".join(
        f"SELECT '{name}' AS distribution, CAST({grp} AS VARCHAR) AS grp, CAST({col} AS DOUBLE) AS value, "
        f"CAST({P.HIST_BINS[name][0]} AS DOUBLE) AS lo, CAST({P.HIST_BINS[name][1]} AS DOUBLE) AS width FROM {src}"
        for src, name, col, grp in dist)
    O["ab_histogram"] = f"""{ab},\n{smoothed_cte()},\n{bucket_cte()},\n{lin_cte},\n{boot_cte()},\n{aa_cte()},
vals AS ({values})
SELECT distribution, grp, bin, count(*) AS n, round(any_value(lo) + bin * any_value(width), 6) AS bin_lo FROM (
  SELECT *, CAST(floor((value - lo) / width) AS BIGINT) AS bin FROM vals WHERE value IS NOT NULL)
GROUP BY distribution, grp, bin"""

    def rep_welch(src, v, metric):
        return (f"SELECT 'welch' AS test, '{metric}' AS metric, group_a, group_b, n_a, n_b, "
                f"round(t, 6) + 0.0 AS statistic, round(p_value, 6) + 0.0 AS p_value, "
                f"round(mean_b - mean_a, 6) + 0.0 AS estimate FROM ({welch_core_sql(src, v, a, b)})")

    def rep_mw(src, v, metric):
        return (f"SELECT 'mann_whitney' AS test, '{metric}' AS metric, group_a, group_b, n_a, n_b, "
                f"round(u_a, 6) + 0.0 AS statistic, round(p_value, 6) + 0.0 AS p_value, round(p_a_gt_b, 6) + 0.0 AS estimate "
                f"FROM ({mw_core_sql(src, v, a, b)})")

    boot_row = (f"SELECT 'poisson_bootstrap' AS test, 'global_ctr' AS metric, {a} AS group_a, {b} AS group_b, "
                f"CAST(NULL AS BIGINT) AS n_a, CAST(NULL AS BIGINT) AS n_b, round(mean_diff, 6) AS statistic, "
                f"round(least(1.0, 2.0 * least(share_below_zero, share_above_zero)), 6) AS p_value, "
                f"round(mean_diff, 6) AS estimate FROM ({CI_SQL})")
    parts = [rep_welch("u", "ctr", "ctr"), rep_mw("u", "ctr", "ctr"),
             rep_welch("sm", "smoothed_ctr", "smoothed_ctr"), rep_mw("sm", "smoothed_ctr", "smoothed_ctr"),
             rep_welch("bk", "bucket_ctr", "bucket_ctr"), rep_mw("bk", "bucket_ctr", "bucket_ctr"),
             rep_welch("lin", "linearized_likes", "linearized_likes"), boot_row]
    O["ab_report"] = (f"{ab},\n{smoothed_cte()},\n{bucket_cte()},\n{lin_cte},\n{boot_cte()}\n"
                      + "\nUNION ALL\n".join(parts))

    # 2.10 impact
    pre0, pre1 = P.PRE
    post0, post1 = P.POST
    impact_long = f"""{F_},
dk AS (SELECT CAST(time AS DATE) AS date, count(DISTINCT post_id) AS active_posts, count(DISTINCT user_id) AS dau,
              count_if(action = 'like') AS likes, count_if(action = 'view') AS views,
              count_if(action = 'like') / nullif(count_if(action = 'view'), 0) AS ctr FROM feed_actions GROUP BY 1),
lg AS ({' UNION ALL '.join(f"SELECT date, '{m}' AS metric, CAST({m} AS DOUBLE) AS value FROM dk" for m in ['active_posts', 'dau', 'likes', 'views', 'ctr'])})"""
    in_pre = f"date >= {date(pre0)} AND date <= {date(pre1)}"
    in_post = f"date >= {date(post0)} AND date <= {date(post1)}"
    O["impact_prepost"] = f"""{impact_long},
s AS (SELECT metric, count(CASE WHEN {in_pre} THEN value END) AS n_pre, avg(CASE WHEN {in_pre} THEN value END) AS mean_pre,
             stddev_samp(CASE WHEN {in_pre} THEN value END) AS sd_pre,
             count(CASE WHEN {in_post} THEN value END) AS n_post, avg(CASE WHEN {in_post} THEN value END) AS actual,
             sum(CASE WHEN {in_post} THEN value END) AS cum_actual FROM lg GROUP BY metric),
e AS (SELECT *, mean_pre AS predicted, 1.96 * sd_pre * sqrt(1.0 + 1.0 / n_pre) AS half,
             (actual - mean_pre) / nullif(sd_pre * sqrt(1.0 / n_pre + 1.0 / n_post), 0) AS t,
             CAST(n_pre - 1 AS DOUBLE) AS nu FROM s)
SELECT metric, n_pre, n_post, {rnd(['actual', 'predicted'])}, round(mean_pre - half, 6) AS pred_low,
       round(mean_pre + half, 6) AS pred_high, round(actual - predicted, 6) AS abs_effect,
       round((actual - predicted) / nullif(predicted, 0), 6) AS rel_effect, round(cum_actual, 6) AS cum_actual,
       round(predicted * n_post, 6) AS cum_predicted, round({t_two_sided_p_sql('t', 'nu')}, 6) AS p_value FROM e"""
    xday = f"CAST(date - {date(pre0)} AS DOUBLE)"
    O["impact_trend"] = f"""{impact_long},
fit AS (SELECT metric, regr_slope(value, {xday}) AS slope, regr_intercept(value, {xday}) AS intercept
        FROM lg WHERE {in_pre} GROUP BY metric),
pp AS (SELECT lg.*, slope, intercept, intercept + slope * {xday} AS pred FROM lg JOIN fit USING (metric) WHERE {in_post}),
agg AS (SELECT metric, slope, intercept, count(value) AS n_post, avg(value) AS actual, avg(pred) AS predicted,
               sum(value) AS cum_actual, sum(pred) AS cum_predicted FROM pp GROUP BY metric, slope, intercept)
SELECT metric, {rnd(['slope', 'intercept'])}, n_post, {rnd(['actual', 'predicted'])},
       round(actual - predicted, 6) AS abs_effect, round((actual - predicted) / nullif(predicted, 0), 6) AS rel_effect,
       {rnd(['cum_actual', 'cum_predicted'])} FROM agg"""
    O["fn_explode"] = f"""{F_}
SELECT user_id, time, unnest([CAST(date_trunc('week', time) AS DATE), CAST(date_trunc('week', time) AS DATE) + 7]) AS g12_week
FROM feed_actions"""
    O["agg_approx_users"] = f"""{F_}
SELECT CAST(date_trunc('week', time) AS DATE) AS week, count(DISTINCT user_id) AS users, true AS within_3_rsd
FROM feed_actions GROUP BY 1"""
    O["impact_local_level"] = local_level_sql(impact_long, in_pre, in_post)
    O["impact_posterior"] = posterior_sql(impact_long, in_pre, in_post)
    u = md5_uniform_sql("rep", "exp_group", "likes", "views", "digit")
    O["ab_bootstrap_counts"] = f"""{ab},
cell AS (SELECT exp_group, likes, views, count(*) AS n FROM u WHERE exp_group IN ({P.AB_GROUPS[0]}, {P.AB_GROUPS[1]}) GROUP BY 1, 2, 3),
dr AS (SELECT CAST(rep AS INTEGER) AS rep, exp_group, likes, views, digit, {u} AS x
       FROM cell, range(1, {P.N_BOOT + 1}) r(rep), range(0, 11) z(digit) WHERE (n >> digit) & 1 = 1),
wt AS (SELECT *, {poisson_power_from_uniform_sql('x', 'digit')} AS w FROM dr),
sm AS (SELECT rep, CAST(sum(w * likes) FILTER (exp_group = {P.AB_GROUPS[0]}) AS BIGINT) AS likes_a,
              CAST(sum(w * views) FILTER (exp_group = {P.AB_GROUPS[0]}) AS BIGINT) AS views_a,
              CAST(sum(w * likes) FILTER (exp_group = {P.AB_GROUPS[1]}) AS BIGINT) AS likes_b,
              CAST(sum(w * views) FILTER (exp_group = {P.AB_GROUPS[1]}) AS BIGINT) AS views_b FROM wt GROUP BY rep)
SELECT rep, likes_a, views_a, likes_b, views_b, round(likes_a / nullif(views_a, 0), 6) AS ctr_a,
       round(likes_b / nullif(views_b, 0), 6) AS ctr_b,
       round(likes_b / nullif(views_b, 0) - likes_a / nullif(views_a, 0), 6) + 0.0 AS diff FROM sm"""
    O["weekly_lifecycle_sketch"] = (f"SELECT this_week, previous_week, status, num_users, true AS within_4_errors "
                                    f"FROM ({O['weekly_lifecycle']})")
    wanted = ", ".join(f"('{n}', DATE '{a}', DATE '{b}')" for n, a, b in P.PERIODS)
    O["users_by_period_bitmap"] = f"""{F_},
pd(period, a, b) AS (VALUES {wanted})
SELECT period, os, grouping(os) = 1 AS all_slices, count(DISTINCT user_id) AS users
FROM feed_actions JOIN pd ON CAST(time AS DATE) BETWEEN a AND b GROUP BY GROUPING SETS ((period, os), (period))"""
    O["dau_by_slice_bitmap"] = f"""{F_}
SELECT CAST(time AS DATE) AS date, os, source, count(DISTINCT user_id) AS users FROM feed_actions GROUP BY 1, 2, 3"""
    return O


def local_level_sql(long_ctes: str, in_pre: str, in_post: str) -> str:
    """The Kalman filter as a recursion over the days of each series, for every pair of variances of the grid."""
    from pulselens.operators.impact import LEVEL_STEPS, OBS_STEPS
    head = long_ctes.replace("WITH ", "WITH RECURSIVE ", 1)
    return f"""{head},
s AS (SELECT metric, count(*) FILTER ({in_pre}) AS n_pre, count(*) FILTER ({in_post}) AS n_post,
             coalesce(nullif(var_samp(value) FILTER ({in_pre}), 0.0), 1.0) AS scale, avg(value) FILTER ({in_post}) AS actual,
             sum(value) FILTER ({in_post}) AS cum_actual FROM lg WHERE value IS NOT NULL GROUP BY metric),
y AS (SELECT metric, value, row_number() OVER (PARTITION BY metric ORDER BY date) AS t FROM lg
      WHERE value IS NOT NULL AND {in_pre}),
g AS (SELECT metric, i, j, scale * pow(10.0::DOUBLE, -4.0::DOUBLE + i * (4.5::DOUBLE / {OBS_STEPS - 1})) AS r,
             scale * CASE WHEN j = 0 THEN 0.0::DOUBLE
                          ELSE pow(10.0::DOUBLE, -5.0::DOUBLE + (j - 1) * (5.0::DOUBLE / {LEVEL_STEPS - 1})) END AS q
      FROM s, range(0, {OBS_STEPS}) a(i), range(0, {LEVEL_STEPS + 1}) b(j) WHERE n_pre >= 3 AND n_post > 0),
k(metric, i, j, r, q, t, ll, mu, p) AS (
  SELECT g.metric, i, j, r, q, CAST(1 AS BIGINT), 0.0::DOUBLE, y.value, r * 1000.0::DOUBLE FROM g JOIN y ON y.metric = g.metric AND y.t = 1
  UNION ALL
  SELECT k.metric, i, j, r, q, k.t + 1,
         ll - 0.5::DOUBLE * (ln(2.0::DOUBLE * pi() * (p + q + r)) + (y.value - mu) * (y.value - mu) / (p + q + r)),
         mu + (p + q) / (p + q + r) * (y.value - mu), (1.0::DOUBLE - (p + q) / (p + q + r)) * (p + q)
  FROM k JOIN y ON y.metric = k.metric AND y.t = k.t + 1),
best AS (SELECT metric, mu, p, r, q FROM (
  SELECT k.*, row_number() OVER (PARTITION BY k.metric ORDER BY ll DESC, i, j) AS rn FROM k JOIN s ON s.metric = k.metric AND k.t = s.n_pre)
  WHERE rn = 1),
f AS (SELECT s.metric, n_pre, n_post, CASE WHEN mu IS NOT NULL THEN actual END AS actual, mu AS predicted,
             CASE WHEN mu IS NOT NULL THEN cum_actual END AS cum_actual, mu * n_post AS cum_predicted,
             sqrt(n_post * n_post * p + q * n_post * (n_post + 1) * (2 * n_post + 1) / 6.0::DOUBLE + n_post * r) AS sd, r, q
      FROM s LEFT JOIN best USING (metric)),
z AS (SELECT *, (cum_actual - cum_predicted) / nullif(sd, 0) AS z FROM f)
SELECT metric, n_pre, n_post, {rnd(['actual', 'predicted'])},
       round(predicted - 1.959963984540054::DOUBLE * sd / n_post, 6) AS pred_low,
       round(predicted + 1.959963984540054::DOUBLE * sd / n_post, 6) AS pred_high,
       round(actual - predicted, 6) AS abs_effect, round((actual - predicted) / nullif(predicted, 0), 6) AS rel_effect,
       {rnd(['cum_actual', 'cum_predicted'])}, round({normal_two_sided_p_sql('z')}, 6) AS p_value,
       round(sqrt(r), 6) AS sigma_obs, round(sqrt(q), 6) AS sigma_level FROM z"""


def posterior_sql(long_ctes: str, in_pre: str, in_post: str, level: float = 0.95) -> str:
    """The mixture over the grid: the recursion of ``local_level_sql`` up to its ``best``, then weights and bisection."""
    from pulselens.functions.stats import normal_cdf_sql
    from pulselens.operators.impact import HALVINGS
    head = local_level_sql(long_ctes, in_pre, in_post).split("best AS (", 1)[0]
    below = lambda x: (f"list_sum(list_transform(cs, lambda x: x.w * {normal_cdf_sql(f'(({x}) - x.mean) / x.sd')})) / total")
    return head + f"""cp AS (
  SELECT k.metric, ll, k.mu AS mean, i, j, n_pre, n_post,
         sqrt(n_post * n_post * p + q * n_post * (n_post + 1) * (2 * n_post + 1) / 6.0::DOUBLE + n_post * r) / n_post AS sd
  FROM k JOIN s ON s.metric = k.metric AND k.t = s.n_pre),
wt AS (SELECT *, exp(ll - max(ll) OVER (PARTITION BY metric)) AS w FROM cp),
mx AS (SELECT metric, list({{'w': w, 'mean': mean, 'sd': sd}} ORDER BY i, j) AS cs, sum(w) AS total, sum(w * mean) / sum(w) AS predicted,
              min(mean - 10.0::DOUBLE * sd) AS lo, max(mean + 10.0::DOUBLE * sd) AS hi FROM wt GROUP BY metric),
bi(metric, target, n, cs, total, lo, hi) AS (
  SELECT metric, target, 0, cs, total, lo, hi FROM mx, (VALUES ({(1 - level) / 2!r}::DOUBLE), ({1 - (1 - level) / 2!r}::DOUBLE)) v(target)
  UNION ALL
  SELECT metric, target, n + 1, cs, total, CASE WHEN {below('(lo + hi) / 2.0::DOUBLE')} < target THEN (lo + hi) / 2.0::DOUBLE ELSE lo END,
         CASE WHEN {below('(lo + hi) / 2.0::DOUBLE')} < target THEN hi ELSE (lo + hi) / 2.0::DOUBLE END
  FROM bi WHERE n < {HALVINGS}),
qt AS (SELECT metric, min((lo + hi) / 2.0::DOUBLE) AS pred_low, max((lo + hi) / 2.0::DOUBLE) AS pred_high FROM bi WHERE n = {HALVINGS} GROUP BY metric),
f AS (SELECT s.metric, n_pre, n_post, predicted, pred_low, pred_high, CASE WHEN predicted IS NOT NULL THEN actual END AS actual,
             CASE WHEN predicted IS NOT NULL THEN cum_actual END AS cum_actual, {below('actual')} AS b
      FROM s LEFT JOIN mx USING (metric) LEFT JOIN qt USING (metric))
SELECT metric, n_pre, n_post, {rnd(['actual', 'predicted', 'pred_low', 'pred_high'])}, round(actual - predicted, 6) + 0.0 AS abs_effect,
       round(actual - pred_high, 6) + 0.0 AS effect_low, round(actual - pred_low, 6) + 0.0 AS effect_high,
       round((actual - predicted) / nullif(predicted, 0), 6) + 0.0 AS rel_effect, {rnd(['cum_actual'])},
       round(predicted * n_post, 6) AS cum_predicted, round(pred_low * n_post, 6) AS cum_low, round(pred_high * n_post, 6) AS cum_high,
       round(least(b, 1 - b), 6) AS p_tail, round(1 - least(b, 1 - b), 6) AS prob_effect FROM f"""


def _sround(expr: str, digits: str) -> str:
    """Spark's ``round``: HALF_UP on the shortest decimal text of the double.
    DuckDB rounds ``x * 10^d`` in binary (0.285 -> 0.28 where Spark gives
    0.29), so go through VARCHAR -> DECIMAL; values beyond DECIMAL(38,18)
    are returned as they are (rounding cannot change them)."""
    return (f"coalesce(CAST(round(TRY_CAST(CAST(({expr}) AS VARCHAR) AS DECIMAL(38, 18)), {digits}) AS DOUBLE), "
            f"({expr}))")


def spark_round(sql: str) -> str:
    """Rewrite every ``round(expr, d)`` of a SQL text into ``_sround``."""
    out, i, n = [], 0, len(sql)
    while True:
        j = sql.find("round(", i)
        while j > 0 and (sql[j - 1].isalnum() or sql[j - 1] == "_"):
            j = sql.find("round(", j + 1)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        out.append(sql[i:j])
        p = start = j + len("round(")
        depth, parts, quote = 1, [], False
        while p < n:
            ch = sql[p]
            if ch == "'":
                quote = not quote
            elif not quote:
                if ch == "(":
                    depth += 1
                elif ch == ")":
                    depth -= 1
                    if depth == 0:
                        break
                elif ch == "," and depth == 1:
                    parts.append(sql[start:p])
                    start = p + 1
            p += 1
        parts.append(sql[start:p])
        if len(parts) == 2:
            out.append(_sround(spark_round(parts[0]), parts[1].strip()))
        else:
            out.append("round(" + spark_round(",".join(parts)) + ")")
        i = p + 1


def bigint_counts(sql: str) -> str:
    """DuckDB's ``count_if`` is HUGEINT; Spark's is BIGINT."""
    import re
    return re.sub(r"count_if\(([^()]*)\)", r"CAST(count_if(\1) AS BIGINT)", sql)


ORACLES = {k: spark_round(bigint_counts(v)) for k, v in build().items()}
