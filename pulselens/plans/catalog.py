"""The registered queries: one builder per SURVEY section-2 key.

Each builder takes ``(spark, sf_dir)``, reads the driver's whole tables and
returns a lazy DataFrame.  Floating statistics are rounded to ``ROUND``
digits at the end so engines that sum in a different order still compare
equal; the library operators themselves return full precision.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulselens.functions import bins, hashing, timeexpr
from pulselens.operators import anomaly, etl, experiments, filters, impact, lifecycle, metrics, ranking, retention, rollups, userstate
from pulselens.plans import params as P
from pulselens.session import shared_dir
from pulselens.sources import tables


def round_doubles(df: DataFrame, digits: int = P.ROUND) -> DataFrame:
    return df.select([F.round(F.col(f.name), digits).alias(f.name) if isinstance(f.dataType, T.DoubleType)
                      else F.col(f.name) for f in df.schema.fields])


def _feed(spark, sf):
    return tables.feed_actions(spark, sf)


def _msgs(spark, sf):
    return tables.message_actions(spark, sf)


def _orders(spark, sf):
    return tables.order_activity(spark, sf)


def _ab_users(spark, sf, groups=P.AB_GROUPS):
    return metrics.user_ctr(_feed(spark, sf), *P.AB_PERIOD, groups)


Q: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def q(name):
    def deco(fn):
        Q[name] = fn
        return fn
    return deco


# ---- 2.1 sources and sinks ---------------------------------------------------------

@q("src_feed_actions")
def _(spark, sf):
    return _feed(spark, sf)


@q("src_message_actions")
def _(spark, sf):
    return _msgs(spark, sf)


@q("src_all_activity")
def _(spark, sf):
    return tables.all_activity(_feed(spark, sf), _msgs(spark, sf))


@q("sink_slice_table")
def _(spark, sf):
    from pulselens.session import shared_dir
    from pulselens.sources.sink import read_slices, write_slices
    path = shared_dir(spark, "slices")
    day = P.AS_OF - dt.timedelta(days=1)
    rep = etl.slice_report(_feed(spark, sf), _msgs(spark, sf), day)
    write_slices(rep, path)
    return read_slices(spark, path)


# ---- 2.2 filters and projections -------------------------------------------------------

@q("flt_day_yesterday")
def _(spark, sf):
    return filters.on_day(_feed(spark, sf), P.AS_OF, -1)


@q("flt_last_n_days")
def _(spark, sf):
    return filters.last_days(_feed(spark, sf), P.AS_OF, 7)


@q("flt_fixed_period")
def _(spark, sf):
    return filters.fixed_period(_feed(spark, sf), *P.AB_PERIOD)


@q("flt_closed_windows")
def _(spark, sf):
    return filters.closed_windows(_msgs(spark, sf), P.AS_OF_TS)


@q("flt_segment")
def _(spark, sf):
    return filters.segment(_feed(spark, sf), source="ads", exp_group=list(P.AB_GROUPS), action="like")


@q("flt_cohort_horizon")
def _(spark, sf):
    since = P.RETENTION_AS_OF - dt.timedelta(days=P.HORIZON)
    fa = retention.first_activity(_feed(spark, sf).where(F.col("source") == "ads"))
    return fa.where((F.col("start_day") >= F.lit(since)) & (F.col("start_day") <= F.lit(P.RETENTION_AS_OF)))


@q("flt_exclude_future_week")
def _(spark, sf):
    o = _orders(spark, sf)
    return lifecycle.weekly_gone(o, o.select(F.date_add(F.to_date(F.max("time")), 1)).scalar())


@q("prj_derived_alias")
def _(spark, sf):
    f = _feed(spark, sf)
    x = f.withColumn("ts", timeexpr.floor_15min("time"))
    x = x.withColumn("hm", timeexpr.hour_minute("ts"))
    x = x.withColumn("this_week", timeexpr.monday("time"))
    x = x.withColumn("previous_week", F.date_sub("this_week", 7))
    return x.select("user_id", "time", "ts", "hm", "this_week", "previous_week")


# ---- 2.3 joins ----------------------------------------------------------------------------

@q("join_first_day_activity")
def _(spark, sf):
    return retention.first_day_activity(_feed(spark, sf).where(F.col("source") == "ads"))


@q("join_sender_receiver")
def _(spark, sf):
    return etl.sender_receiver(filters.on_day(_msgs(spark, sf), P.AS_OF, -1))


@q("join_sender_receiver_strict")
def _(spark, sf):
    return etl.sender_receiver(filters.on_day(_msgs(spark, sf), P.AS_OF, -1), strict=True)


@q("join_feed_messages_left")
def _(spark, sf):
    return etl.feed_with_messages(filters.on_day(_feed(spark, sf), P.AS_OF, -1),
                                  filters.on_day(_msgs(spark, sf), P.AS_OF, -1))


@q("join_daily_feed_msgs")
def _(spark, sf):
    return metrics.daily_feed_and_messages(_feed(spark, sf), _msgs(spark, sf), P.AS_OF)


@q("join_15min_feed_msgs")
def _(spark, sf):
    return anomaly.kpi_15min(_feed(spark, sf), _msgs(spark, sf), P.AS_OF_TS)


@q("member_prev_next_week")
def _(spark, sf):
    return lifecycle.prev_next_week_membership(_orders(spark, sf))


# ---- 2.4 aggregations -------------------------------------------------------------------

@q("agg_user_likes_views")
def _(spark, sf):
    return _ab_users(spark, sf)


@q("agg_user_day_profile")
def _(spark, sf):
    return etl.user_day_profile(filters.on_day(_feed(spark, sf), P.AS_OF, -1))


@q("agg_sender_stats")
def _(spark, sf):
    return etl.sender_stats(filters.on_day(_msgs(spark, sf), P.AS_OF, -1))


@q("agg_receiver_stats")
def _(spark, sf):
    return etl.receiver_stats(filters.on_day(_msgs(spark, sf), P.AS_OF, -1))


@q("agg_daily_feed_kpi")
def _(spark, sf):
    return metrics.daily_feed_kpi(_feed(spark, sf))


@q("agg_daily_posts_dau")
def _(spark, sf):
    return metrics.daily_posts_dau(_feed(spark, sf))


@q("agg_daily_app_dau")
def _(spark, sf):
    return metrics.daily_app_dau(_feed(spark, sf), _msgs(spark, sf), P.AS_OF)


@q("agg_daily_messages")
def _(spark, sf):
    return metrics.daily_messages(_msgs(spark, sf))


@q("agg_group_sizes")
def _(spark, sf):
    return metrics.group_sizes(_ab_users(spark, sf))


@q("agg_group_ctr")
def _(spark, sf):
    return metrics.group_ctr(_ab_users(spark, sf))


@q("agg_bucket_ctr")
def _(spark, sf):
    return experiments.bucket_ctr(_feed(spark, sf), *P.AB_PERIOD, P.AB_GROUPS, P.N_BUCKETS)


@q("agg_bucket_ctr_xxh64")
def _(spark, sf):
    return experiments.bucket_ctr(_feed(spark, sf), *P.AB_PERIOD, P.AB_GROUPS, P.N_BUCKETS, method="xxh64_4")


def _yesterday_joined(spark, sf):
    return etl.feed_with_messages(filters.on_day(_feed(spark, sf), P.AS_OF, -1),
                                  filters.on_day(_msgs(spark, sf), P.AS_OF, -1))


@q("agg_slices_gender")
def _(spark, sf):
    return etl.one_slice(_yesterday_joined(spark, sf), "gender")


@q("agg_slices_os")
def _(spark, sf):
    return etl.one_slice(_yesterday_joined(spark, sf), "os")


@q("agg_slices_age")
def _(spark, sf):
    return etl.one_slice(_yesterday_joined(spark, sf), "age")


@q("agg_weekly_status_counts")
def _(spark, sf):
    return lifecycle.weekly_status_counts(_orders(spark, sf))


@q("agg_retention_counts")
def _(spark, sf):
    return retention.cohort_counts(_orders(spark, sf), P.ORDERS_RETENTION_AS_OF, P.HORIZON)


@q("agg_first_activity")
def _(spark, sf):
    return retention.first_activity(_orders(spark, sf))


@q("agg_distinct_user_days")
def _(spark, sf):
    return retention.distinct_user_days(_feed(spark, sf))


@q("agg_user_weeks_array")
def _(spark, sf):
    return lifecycle.user_weeks_text(_orders(spark, sf))


@q("agg_approx_users")
def _(spark, sf):
    return metrics.approx_users_check(_feed(spark, sf))


# ---- 2.5 windows -----------------------------------------------------------------------------

def _bands(spark, sf, strict=False):
    f, m = _feed(spark, sf), _msgs(spark, sf)
    kpi = (anomaly.kpi_15min_strict if strict else anomaly.kpi_15min)(f, m, P.AS_OF_TS)
    return anomaly.anomaly_bands(kpi, anomaly.KPI_METRICS, P.IQR_A, P.IQR_N)


@q("win_rolling_quantiles")
def _(spark, sf):
    b = _bands(spark, sf)
    return round_doubles(b.select("ts", "metric", "value", "q25", "q75", "iqr"))


@q("win_centered_mean")
def _(spark, sf):
    b = _bands(spark, sf)
    return round_doubles(b.select("ts", "metric", "value", "up", "low"))


@q("win_day_over_day")
def _(spark, sf):
    wide = metrics.daily_feed_kpi(_feed(spark, sf))
    return round_doubles(metrics.day_over_day(metrics.long_series(wide, "date", ["DAU", "likes", "views", "CTR"])))


@q("win_last_vs_prev")
def _(spark, sf):
    kpi = anomaly.kpi_15min(_feed(spark, sf), _msgs(spark, sf), P.AS_OF_TS)
    lg = anomaly.kpi_long(kpi)
    from pyspark.sql import Window
    w = Window.partitionBy("metric").orderBy("ts")
    prev = F.lag("value").over(w)
    return round_doubles(lg.withColumn("prev_value", prev)
                         .withColumn("deviation", F.abs(F.lit(1.0) - metrics.ratio(F.col("value"), F.col("prev_value")))))


@q("win_ranks_midrank")
def _(spark, sf):
    return round_doubles(ranking.midranks(_ab_users(spark, sf), "ctr", "exp_group", *P.AB_GROUPS))


@q("win_prev_week_flag")
def _(spark, sf):
    return lifecycle.prev_next_week_flags(_orders(spark, sf))


# ---- 2.6 sorts, limits, set operations ---------------------------------------------------------

@q("sort_time_series")
def _(spark, sf):
    return anomaly.kpi_15min(_feed(spark, sf), _msgs(spark, sf), P.AS_OF_TS).orderBy("ts")


@q("top3_posts_by_likes")
def _(spark, sf):
    return metrics.top_posts_by_likes(_feed(spark, sf), *P.POST, 3)


@q("set_union_status")
def _(spark, sf):
    o = _orders(spark, sf)
    as_of = o.select(F.date_add(F.to_date(F.max("time")), 1)).scalar()
    return lifecycle.weekly_gone(o, as_of).unionByName(lifecycle.weekly_status_counts(o))


@q("set_concat_slices")
def _(spark, sf):
    return etl.concat_slices(_yesterday_joined(spark, sf))


# ---- 2.7 scalar functions ---------------------------------------------------------------------------

@q("fn_scalar_parity")
def _(spark, sf):
    f = _feed(spark, sf)
    d = F.to_date("time")
    wk = timeexpr.monday("time")
    arr = F.array(wk, F.date_add(wk, 7))
    return f.select(
        "user_id", "time",
        d.alias("g1_date"),
        timeexpr.ymd(d).alias("g2_date_text"),
        wk.alias("g3_monday"),
        F.date_add(wk, 7).alias("g4_next_week"), F.date_sub(wk, 7).alias("g4_prev_week"),
        F.date_sub(d, 1).alias("g5_day_before"),
        timeexpr.floor_15min("time").alias("g6_ts15"),
        timeexpr.hour_minute(timeexpr.floor_15min("time")).alias("g7_hm"),
        timeexpr.dmy(d).alias("g8_dmy"),
        F.round(F.col("age") / F.lit(7.0), 2).alias("g9_round"),
        F.when(F.col("action") == "like", F.lit("like")).otherwise(F.lit("other")).alias("g10_if"),
        F.array_contains(arr, F.date_add(wk, 7)).alias("g11_has"),
        F.size(arr).alias("g12_n_exploded"),
        hashing.user_bucket(F.col("user_id"), P.N_BUCKETS).alias("g13_bucket"),
        (F.col("action") == "like").cast("int").alias("g14_is_like"),
        (-F.col("user_id").cast("bigint")).alias("g15_neg"),
        F.col("age").between(18, 25).alias("g16_between"),
        F.col("exp_group").isin(1, 2).alias("g16_in"),
        bins.cut(F.col("age")).alias("g17_age_group"),
        bins.pct_text(F.col("age") / F.lit(300.0)).alias("g18_pct_text"),
        F.abs(F.col("age") - F.lit(40)).alias("g18_abs"),
        F.col("gender").cast("bigint").alias("g19_int"),
    )


@q("fn_explode")
def _(spark, sf):
    wk = timeexpr.monday("time")
    return _feed(spark, sf).select("user_id", "time", F.explode(F.array(wk, F.date_add(wk, 7))).alias("g12_week"))


# ---- 2.8 product metrics --------------------------------------------------------------------------

@q("retention_ads")
def _(spark, sf):
    return retention.retention(_feed(spark, sf), "ads", P.RETENTION_AS_OF, P.HORIZON)


@q("retention_organic")
def _(spark, sf):
    return retention.retention(_feed(spark, sf), "organic", P.RETENTION_AS_OF, P.HORIZON)


@q("retention_orders")
def _(spark, sf):
    return retention.retention(_orders(spark, sf), None, P.ORDERS_RETENTION_AS_OF, P.HORIZON)


@q("retention_by_source")
def _(spark, sf):
    return retention.retention_by_source(_feed(spark, sf), P.RETENTION_AS_OF, P.HORIZON)


@q("retention_incremental")
def _(spark, sf):
    base = userstate.merge_all(_feed(spark, sf), shared_dir(spark, "user-state"), P.DAILY_MERGES, ["source"])
    return userstate.retention(userstate.day_counts(spark, base), P.RETENTION_AS_OF, P.HORIZON, ["source"])


@q("weekly_lifecycle_incremental")
def _(spark, sf):
    base = userstate.merge_all(_feed(spark, sf), shared_dir(spark, "user-state"), P.DAILY_MERGES)
    return userstate.weekly_lifecycle(userstate.day_counts(spark, base), P.AS_OF)


@q("weekly_lifecycle_incremental_strict")
def _(spark, sf):
    base = userstate.merge_all(_feed(spark, sf), shared_dir(spark, "user-state"), P.DAILY_MERGES)
    return userstate.weekly_lifecycle(userstate.day_counts(spark, base), P.AS_OF, strict=True)


@q("retention_heatmap")
def _(spark, sf):
    return retention.retention_heatmap(_feed(spark, sf), "ads", P.RETENTION_AS_OF, P.HORIZON, P.RETENTION_UNTIL)


@q("weekly_lifecycle")
def _(spark, sf):
    o = _orders(spark, sf)
    return lifecycle.weekly_lifecycle(o, o.select(F.date_add(F.to_date(F.max("time")), 1)).scalar())


@q("weekly_lifecycle_closed")
def _(spark, sf):
    o = _orders(spark, sf)
    return lifecycle.weekly_lifecycle(o, o.select(F.date_add(F.to_date(F.max("time")), 1)).scalar(), drop_open_week=True)


@q("weekly_lifecycle_strict")
def _(spark, sf):
    o = _orders(spark, sf)
    return lifecycle.weekly_lifecycle(o, o.select(F.date_add(F.to_date(F.max("time")), 1)).scalar(), strict=True)


@q("dau_by_slice")
def _(spark, sf):
    return metrics.dau_by_slice(_feed(spark, sf))


@q("weekly_lifecycle_sketch")
def _(spark, sf):
    o = _orders(spark, sf)
    path = rollups.write_rollup(rollups.weekly_sketches(o), shared_dir(spark, "week-sketches"), "week")
    as_of = o.select(F.date_add(F.to_date(F.max("time")), 1)).scalar()
    return rollups.sketch_lifecycle_check(o, spark.read.parquet(path), as_of)


@q("users_by_period_bitmap")
def _(spark, sf):
    path = rollups.write_rollup(rollups.user_bitmaps(_feed(spark, sf)), shared_dir(spark, "user-bitmaps"))
    return rollups.period_users(spark.read.parquet(path), P.PERIODS)


@q("dau_by_slice_bitmap")
def _(spark, sf):
    path = rollups.write_rollup(rollups.user_bitmaps(_feed(spark, sf), ("os", "source")), shared_dir(spark, "user-bitmaps"))
    return rollups.bitmap_users(spark.read.parquet(path), ["date", "os", "source"])


@q("campaign_cohort_followup")
def _(spark, sf):
    return retention.campaign_cohort_followup(_feed(spark, sf), P.CAMPAIGN_DAY, "ads")


@q("drop_contribution")
def _(spark, sf):
    return metrics.drop_contribution(_feed(spark, sf), P.DROP_DAY)


@q("events_per_user")
def _(spark, sf):
    return metrics.events_per_user(_feed(spark, sf))


@q("today_hourly_feed")
def _(spark, sf):
    return metrics.today_by_bucket(_feed(spark, sf), P.TODAY_TS, "1 hour")


@q("feed_messenger_overlap")
def _(spark, sf):
    return metrics.feed_messenger_overlap(_feed(spark, sf), _msgs(spark, sf))


@q("slice_report_daily")
def _(spark, sf):
    return etl.slice_report(_feed(spark, sf), _msgs(spark, sf), P.AS_OF - dt.timedelta(days=1))


@q("slice_report_filled")
def _(spark, sf):
    return etl.slice_report(_feed(spark, sf), _msgs(spark, sf), P.AS_OF - dt.timedelta(days=1), fill_bins=True)


@q("slice_report_daily_strict")
def _(spark, sf):
    return etl.slice_report_strict(_feed(spark, sf), _msgs(spark, sf), P.AS_OF - dt.timedelta(days=1))


@q("digest_feed_yesterday")
def _(spark, sf):
    return metrics.digest_feed_yesterday(_feed(spark, sf), P.AS_OF)


@q("digest_feed_week")
def _(spark, sf):
    return metrics.digest_feed_week(_feed(spark, sf), P.AS_OF)


@q("digest_app_week")
def _(spark, sf):
    return metrics.digest_app_week(_feed(spark, sf), _msgs(spark, sf), P.AS_OF)


@q("digest_app_changes")
def _(spark, sf):
    return round_doubles(metrics.digest_app_changes(_feed(spark, sf), _msgs(spark, sf), P.AS_OF))


@q("digest_app_message")
def _(spark, sf):
    return metrics.digest_app_message(_feed(spark, sf), _msgs(spark, sf), P.AS_OF)


@q("kpi_long_series")
def _(spark, sf):
    wide = metrics.digest_feed_week(_feed(spark, sf), P.AS_OF)
    return metrics.long_series(wide, "date", ["DAU", "likes", "views", "CTR"])


# ---- 2.9 experiments ---------------------------------------------------------------------------------

@q("ab_welch_ctr")
def _(spark, sf):
    return round_doubles(experiments.welch(_ab_users(spark, sf), "ctr", *P.AB_GROUPS))


@q("ab_welch_smoothed")
def _(spark, sf):
    sm = experiments.smoothed_ctr(_ab_users(spark, sf), P.ALPHA, P.AB_GROUPS)
    return round_doubles(experiments.welch(sm, "smoothed_ctr", *P.AB_GROUPS))


@q("ab_welch_linearized")
def _(spark, sf):
    out = None
    for a, b in (P.AB_GROUPS_2, P.AB_GROUPS):
        lin = experiments.linearized_likes(_ab_users(spark, sf, (a, b)), a)
        r = experiments.welch(lin, "linearized_likes", a, b)
        out = r if out is None else out.unionByName(r)
    return round_doubles(out)


def _buckets(spark, sf):
    return experiments.bucket_ctr(_feed(spark, sf), *P.AB_PERIOD, P.AB_GROUPS, P.N_BUCKETS)


@q("ab_welch_bucket")
def _(spark, sf):
    return round_doubles(experiments.welch(_buckets(spark, sf), "bucket_ctr", *P.AB_GROUPS))


@q("ab_welch_bucket_xxh64")
def _(spark, sf):
    buckets = experiments.bucket_ctr(_feed(spark, sf), *P.AB_PERIOD, P.AB_GROUPS, P.N_BUCKETS, method="xxh64_4")
    return round_doubles(experiments.welch(buckets, "bucket_ctr", *P.AB_GROUPS))


@q("ab_mannwhitney_ctr")
def _(spark, sf):
    return round_doubles(experiments.mann_whitney(_ab_users(spark, sf), "ctr", *P.AB_GROUPS))


@q("ab_mannwhitney_smoothed")
def _(spark, sf):
    sm = experiments.smoothed_ctr(_ab_users(spark, sf), P.ALPHA, P.AB_GROUPS)
    return round_doubles(experiments.mann_whitney(sm, "smoothed_ctr", *P.AB_GROUPS))


@q("ab_mannwhitney_bucket")
def _(spark, sf):
    # at most 2 x N_BUCKETS values: a single ordered partition is enough
    return round_doubles(experiments.mann_whitney(_buckets(spark, sf), "bucket_ctr", *P.AB_GROUPS, n_buckets=1))


@q("ab_mannwhitney_daily")
def _(spark, sf):
    days = experiments.daily_group_ctr(_feed(spark, sf), *P.AB_PERIOD, P.AB_GROUPS)
    # a value for each group and day of the period: one ordered partition
    return round_doubles(experiments.mann_whitney(days, "ctr", *P.AB_GROUPS, n_buckets=1, method="auto"))


@q("ab_prob_superiority")
def _(spark, sf):
    return round_doubles(experiments.ab_superiority(_ab_users(spark, sf), *P.AB_GROUPS, P.ALPHA, P.N_BUCKETS))


@q("ab_poisson_bootstrap")
def _(spark, sf):
    return round_doubles(experiments.poisson_bootstrap(_ab_users(spark, sf), *P.AB_GROUPS, P.N_BOOT))


@q("ab_bootstrap_counts")
def _(spark, sf):
    return round_doubles(experiments.poisson_bootstrap_counts(_ab_users(spark, sf), *P.AB_GROUPS, P.N_BOOT))


@q("ab_bootstrap_diff_ci")
def _(spark, sf):
    boot = experiments.poisson_bootstrap(_ab_users(spark, sf), *P.AB_GROUPS, P.N_BOOT)
    return round_doubles(experiments.bootstrap_diff_ci(boot))


def _aa(spark, sf):
    users = metrics.user_ctr(_feed(spark, sf), *P.AA_PERIOD, P.AA_GROUPS)
    return experiments.aa_resample_pvalues(users, *P.AA_GROUPS, P.AA_REPS, P.AA_K)


@q("aa_resample_pvalues")
def _(spark, sf):
    return round_doubles(_aa(spark, sf))


@q("aa_same_group")
def _(spark, sf):
    users = metrics.user_ctr(_feed(spark, sf), *P.AA_PERIOD, P.AA_GROUPS)
    return round_doubles(experiments.aa_resample_pvalues(users, *P.AA_GROUPS, P.AA_REPS, P.AA_K, same_group=True))


@q("aa_false_positive_rate")
def _(spark, sf):
    return round_doubles(experiments.aa_false_positive_rate(_aa(spark, sf)))


@q("ab_histogram")
def _(spark, sf):
    a, b = P.AB_GROUPS
    users = _ab_users(spark, sf)
    g = F.col("exp_group")
    boot = experiments.poisson_bootstrap(users, a, b, P.N_BOOT)
    d = experiments.distribution
    parts = [
        d(users, "ctr", F.col("ctr"), g),
        d(experiments.smoothed_ctr(users, P.ALPHA, P.AB_GROUPS), "smoothed_ctr", F.col("smoothed_ctr"), g),
        d(experiments.linearized_likes(users, a), "linearized_likes", F.col("linearized_likes"), g),
        d(experiments.bucket_ctr_from_users(users, P.N_BUCKETS), "bucket_ctr", F.col("bucket_ctr"), g),
        d(boot, "bootstrap_ctr", F.col("ctr_a"), F.lit(a)), d(boot, "bootstrap_ctr", F.col("ctr_b"), F.lit(b)),
        d(boot, "bootstrap_diff", F.col("diff"), F.lit("diff")),
        d(_aa(spark, sf), "aa_p_value", F.col("p_value"), F.lit("aa")),
    ]
    values = parts[0]
    for x in parts[1:]:
        values = values.unionByName(x)
    return round_doubles(experiments.histograms(values, P.HIST_BINS))


@q("ab_report")
def _(spark, sf):
    return round_doubles(experiments.ab_report(_feed(spark, sf), *P.AB_PERIOD, *P.AB_GROUPS,
                                               P.ALPHA, P.N_BOOT, P.N_BUCKETS))


# ---- 2.10 impact and anomalies ----------------------------------------------------------------------------

def _impact_days(spark, sf):
    return impact.daily_metric_long(_feed(spark, sf), first_day=P.PRE[0], last_day=P.POST[1])


@q("impact_prepost")
def _(spark, sf):
    return round_doubles(impact.impact_prepost(_impact_days(spark, sf), P.PRE, P.POST))


@q("impact_trend")
def _(spark, sf):
    return round_doubles(impact.impact_trend(_impact_days(spark, sf), P.PRE, P.POST))


@q("impact_local_level")
def _(spark, sf):
    return round_doubles(impact.impact_local_level(_impact_days(spark, sf), P.PRE, P.POST))


@q("impact_posterior")
def _(spark, sf):
    return round_doubles(impact.impact_posterior(_impact_days(spark, sf), P.PRE, P.POST))


@q("kpi_15min")
def _(spark, sf):
    return anomaly.kpi_15min(_feed(spark, sf), _msgs(spark, sf), P.AS_OF_TS)


@q("anomaly_iqr")
def _(spark, sf):
    return round_doubles(_bands(spark, sf))


@q("anomaly_iqr_ranges")
def _(spark, sf):
    kpi = anomaly.kpi_15min(_feed(spark, sf), _msgs(spark, sf), P.AS_OF_TS, history_days=P.LONG_HISTORY)
    return round_doubles(anomaly.iqr_bands_by_range(anomaly.kpi_long(kpi), P.RANGE, P.IQR_A, P.IQR_N))


@q("anomaly_iqr_strict")
def _(spark, sf):
    return round_doubles(_bands(spark, sf, strict=True))


@q("anomaly_alerts_latest")
def _(spark, sf):
    return round_doubles(anomaly.latest_alerts(_bands(spark, sf)))


@q("anomaly_backtest")
def _(spark, sf):
    b = anomaly.backtest(_bands(spark, sf))
    return round_doubles(b.select("ts", "metric", "value", "up_live", "low_live", "is_alert"))


@q("anomaly_day_over_day")
def _(spark, sf):
    f, m = _feed(spark, sf), _msgs(spark, sf)
    kpi = anomaly.kpi_15min(f, m, P.AS_OF_TS, history_days=7)
    return round_doubles(anomaly.same_slot_day_before(anomaly.kpi_long(kpi)))
