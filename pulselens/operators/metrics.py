"""Daily/weekly feed and app KPIs, per-user and per-group aggregates, and the
BI dashboard metrics (D1-D10, D18, F2, P6, P8-P11, P14-P18, C4).

Distinct counts are exact unless ``approx=True``; ratios divide by
``nullif(den, 0)`` (NULL instead of an ANSI error or inf).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulselens.functions.bins import cut, num_text, pct_text
from pulselens.functions.timeexpr import as_date, dmy, time_range
from pulselens.operators.filters import fixed_period, last_days, on_day


def ratio(num, den) -> Column:
    num = F.col(num) if isinstance(num, str) else num
    den = F.col(den) if isinstance(den, str) else den
    return num / F.nullif(den, F.lit(0))


def likes_expr() -> Column:
    return F.count_if(F.col("action") == "like")


def views_expr() -> Column:
    return F.count_if(F.col("action") == "view")


def distinct_users(col: str = "user_id", approx: bool = False, rsd: float = 0.01) -> Column:
    return F.approx_count_distinct(col, rsd) if approx else F.count_distinct(F.col(col))


# ---- per-user / per-group (experiments) -------------------------------------

def user_ctr(feed: DataFrame, first_day, last_day, groups=None) -> DataFrame:
    """Per ``(exp_group, user_id)`` likes, views and ``ctr`` (NULL when no views)."""
    df = fixed_period(feed, first_day, last_day)
    if groups is not None:
        df = df.where(F.col("exp_group").isin(list(groups)))
    return (df.groupBy("exp_group", "user_id")
              .agg(likes_expr().alias("likes"), views_expr().alias("views"))
              .withColumn("ctr", ratio("likes", "views")))


def group_sizes(users: DataFrame) -> DataFrame:
    """Users per experiment group (split check)."""
    return users.groupBy("exp_group").agg(F.count(F.lit(1)).alias("n_users"))


def group_ctr(users: DataFrame) -> DataFrame:
    """Global CTR (ratio of sums) per group."""
    return (users.groupBy("exp_group")
                 .agg(F.sum("likes").alias("likes"), F.sum("views").alias("views"))
                 .withColumn("global_ctr", ratio("likes", "views")))


# ---- daily KPIs ---------------------------------------------------------------

def daily_feed_kpi(feed: DataFrame, round_ctr: int | None = None, approx: bool = False) -> DataFrame:
    """Per day DAU, likes, views, CTR."""
    ctr = ratio("likes", "views")
    return (feed.groupBy(F.to_date("time").alias("date"))
                .agg(distinct_users(approx=approx).alias("DAU"),
                     likes_expr().alias("likes"), views_expr().alias("views"))
                .withColumn("CTR", F.round(ctr, round_ctr) if round_ctr is not None else ctr))


def daily_posts_dau(feed: DataFrame) -> DataFrame:
    """Per day active posts (``active_posts``: distinct posts with any
    action that day, not posts created), DAU, likes, views, ctr.

    Rows are reduced to one per ``(date, user, post)`` first, so that the two
    distinct counts do not each copy the raw events."""
    per = (feed.groupBy(F.to_date("time").alias("date"), "user_id", "post_id")
               .agg(likes_expr().alias("likes"), views_expr().alias("views")))
    return (per.groupBy("date")
               .agg(F.count_distinct("post_id").alias("active_posts"),
                    F.count_distinct("user_id").alias("dau"),
                    F.sum("likes").alias("likes"), F.sum("views").alias("views"))
                .withColumn("ctr", ratio("likes", "views")))


def daily_app_dau(feed: DataFrame, messages: DataFrame, as_of, n_days: int = 7) -> DataFrame:
    """App-wide DAU over both products, and per OS.

    Deduplicates to one row per ``(date, user)`` with OS flags first, so the
    three distinct counts become plain counts (no row expansion per distinct).
    """
    def arm(df):
        return last_days(df, as_of, n_days).select(F.to_date("time").alias("date"), "user_id", "os")

    both = arm(feed).unionByName(arm(messages))
    per_user = both.groupBy("date", "user_id").agg(
        F.bool_or(F.col("os") == "iOS").alias("ios"),
        F.bool_or(F.col("os") == "Android").alias("android"))
    return per_user.groupBy("date").agg(
        F.count(F.lit(1)).alias("total_DAU"),
        F.count_if("ios").alias("users_ios"),
        F.count_if("android").alias("users_android"))


def daily_messages(messages: DataFrame) -> DataFrame:
    """Messages per day."""
    return messages.groupBy(F.to_date("time").alias("date")).agg(F.count("user_id").alias("messages"))


def daily_feed_and_messages(feed: DataFrame, messages: DataFrame, as_of, n_days: int = 7) -> DataFrame:
    """C4: daily likes, views, CTR (rounded) joined with daily messages on date.

    Both sides are one row per day, so the join is between two tiny
    aggregates (AQE broadcasts one of them at run time).
    """
    f = (last_days(feed, as_of, n_days).groupBy(F.to_date("time").alias("date"))
         .agg(likes_expr().alias("likes"), views_expr().alias("views"))
         .withColumn("CTR", F.round(ratio("likes", "views"), 2)))
    m = daily_messages(last_days(messages, as_of, n_days))
    return f.join(m, "date", "inner")


# ---- BI dashboard metrics -------------------------------------------------------

def default_dims() -> dict[str, Column]:
    return {
        "gender": F.col("gender").cast("string"),
        "age": cut(F.col("age")),
        "os": F.col("os"),
        "source": F.col("source"),
    }


def stack_dims(df: DataFrame, dims: dict[str, Column], keep: list[str]) -> DataFrame:
    """Unpivot several dimensions into ``(dimension, dimension_value)`` rows in
    one pass (the input is read once, not once per dimension)."""
    arr = F.array(*[F.struct(F.lit(k).alias("dimension"), v.cast("string").alias("dimension_value"))
                    for k, v in dims.items()])
    return (df.select(*keep, F.explode(arr).alias("_d"))
              .select(*keep, "_d.dimension", "_d.dimension_value"))


def dau_by_slice(feed: DataFrame, dims: dict[str, Column] | None = None) -> DataFrame:
    """DAU per day and slice value for several dimensions at once.

    Events are reduced to one row per ``(date, user, slice values)`` before
    they are copied for each dimension."""
    dims = dims or default_dims()
    base = feed.select(F.to_date("time").alias("date"), "user_id",
                       *[v.alias(f"_v_{k}") for k, v in dims.items()]).distinct()
    st = stack_dims(base, {k: F.col(f"_v_{k}") for k in dims}, ["date", "user_id"])
    return (st.where(F.col("dimension_value").isNotNull())
              .groupBy("date", "dimension", "dimension_value")
              .agg(F.count_distinct("user_id").alias("dau")))


def drop_contribution(feed: DataFrame, drop_day, dims: dict[str, Column] | None = None) -> DataFrame:
    """Per slice value, DAU the day before and on ``drop_day``, the change,
    and its share of the dimension's total change."""
    d = as_date(drop_day)
    prev = d - dt.timedelta(days=1)
    two_days = time_range(feed, prev, d + dt.timedelta(days=1))
    daily = dau_by_slice(two_days, dims)
    w = Window.partitionBy("dimension")
    return (daily.groupBy("dimension", "dimension_value")
                 .agg(F.coalesce(F.sum(F.when(F.col("date") == F.lit(prev), F.col("dau"))), F.lit(0)).alias("dau_before"),
                      F.coalesce(F.sum(F.when(F.col("date") == F.lit(d), F.col("dau"))), F.lit(0)).alias("dau_on_day"))
                 .withColumn("delta", F.col("dau_on_day") - F.col("dau_before"))
                 .withColumn("share_of_change", ratio(F.col("delta"), F.sum("delta").over(w))))


def events_per_user(feed: DataFrame) -> DataFrame:
    """Events, likes and views per active user per day."""
    k = (feed.groupBy(F.to_date("time").alias("date"))
             .agg(F.count(F.lit(1)).alias("events"), F.count_distinct("user_id").alias("dau"),
                  likes_expr().alias("likes"), views_expr().alias("views")))
    return (k.withColumn("events_per_user", ratio("events", "dau"))
             .withColumn("likes_per_user", ratio("likes", "dau"))
             .withColumn("views_per_user", ratio("views", "dau")))


def today_by_bucket(feed: DataFrame, as_of, bucket: str = "1 hour") -> DataFrame:
    """P10: operational dashboard, today's KPIs by time bucket up to ``as_of``."""
    t = as_of if isinstance(as_of, dt.datetime) else dt.datetime.fromisoformat(str(as_of))
    today = time_range(feed, dt.datetime.combine(t.date(), dt.time()), t)
    return (today.groupBy(F.window("time", bucket).start.alias("ts"))
                 .agg(F.count_distinct("user_id").alias("users"),
                      likes_expr().alias("likes"), views_expr().alias("views"))
                 .withColumn("ctr", ratio("likes", "views")))


def feed_messenger_overlap(feed: DataFrame, messages: DataFrame) -> DataFrame:
    """Users per day using the feed only, messages only, or both."""
    f = feed.select(F.to_date("time").alias("date"), "user_id", F.lit(True).alias("is_feed"), F.lit(False).alias("is_msg"))
    m = messages.select(F.to_date("time").alias("date"), "user_id", F.lit(False).alias("is_feed"), F.lit(True).alias("is_msg"))
    per_user = (f.unionByName(m).groupBy("date", "user_id")
                 .agg(F.bool_or("is_feed").alias("f"), F.bool_or("is_msg").alias("m")))
    seg = (F.when(F.col("f") & F.col("m"), F.lit("both"))
            .when(F.col("f"), F.lit("feed_only")).otherwise(F.lit("messages_only")))
    return per_user.groupBy("date", seg.alias("segment")).agg(F.count(F.lit(1)).alias("users"))


def top_posts_by_likes(feed: DataFrame, first_day, last_day, k: int = 3) -> DataFrame:
    """the ``k`` posts with most likes in a period (ties by post id).

    The limit is the feature here (a top-k report); Spark plans it as
    ``TakeOrderedAndProject`` (per-task top-k, then a final top-k)."""
    per_post = (fixed_period(feed, first_day, last_day)
                .groupBy("post_id").agg(likes_expr().alias("likes")))
    return per_post.orderBy(F.col("likes").desc(), F.col("post_id")).limit(k)


def approx_users(feed: DataFrame, rsd: float = 0.01) -> DataFrame:
    """Approximate distinct users per week (``uniq``)."""
    from pulselens.functions.timeexpr import monday
    return feed.groupBy(monday("time").alias("week")).agg(F.approx_count_distinct("user_id", rsd).alias("users_approx"))


def approx_users_check(feed: DataFrame, rsd: float = 0.01) -> DataFrame:
    """D18 against the exact count: per week the distinct users and whether the
    approximate count is within three standard deviations of it."""
    from pulselens.functions.timeexpr import monday
    exact = feed.groupBy(monday("time").alias("week")).agg(F.count_distinct("user_id").alias("users"))
    near = F.abs(F.col("users_approx") - F.col("users")) <= F.lit(3 * rsd) * F.col("users")
    return approx_users(feed, rsd).join(exact, "week").select("week", "users", near.alias("within_3_rsd"))


# ---- digests -------------------------------------------------------------------

def digest_feed_yesterday(feed: DataFrame, as_of) -> DataFrame:
    """One-row KPI digest for ``as_of - 1`` with its message text."""
    k = daily_feed_kpi(on_day(feed, as_of, -1), round_ctr=2)
    text = F.concat(F.lit("Metrics for "), dmy("date"), F.lit(":\n\nDAU = "), F.col("DAU").cast("string"),
                    F.lit("\nlikes = "), F.col("likes").cast("string"),
                    F.lit("\nviews = "), F.col("views").cast("string"),
                    F.lit("\nCTR = "), F.col("CTR").cast("string"))
    return k.withColumn("text", text)


def digest_feed_week(feed: DataFrame, as_of, n_days: int = 7) -> DataFrame:
    """KPI series over the last ``n_days`` days, unrounded CTR."""
    return daily_feed_kpi(last_days(feed, as_of, n_days))


def digest_app_week(feed: DataFrame, messages: DataFrame, as_of, n_days: int = 7) -> DataFrame:
    """App DAU (both products, per OS) with likes, views, CTR, messages.

    Same result as ``daily_app_dau`` joined with ``daily_feed_and_messages``
    on date, computed in one pass: feed and message rows are tagged, reduced
    to one row per ``(date, user)`` (OS flags, likes, views, messages), then
    to one row per date.  Each table is scanned once and no join is needed;
    the inner joins become "the day has feed rows and message rows"."""
    def arm(df, is_feed):
        a = F.col("action") if is_feed else F.lit(None).cast("string")
        return last_days(df, as_of, n_days).select(
            F.to_date("time").alias("date"), "user_id", "os",
            (a == "like").cast("int").alias("l"), (a == "view").cast("int").alias("v"),
            F.lit(1 if is_feed else 0).alias("f"), F.lit(0 if is_feed else 1).alias("m"))

    per_user = (arm(feed, True).unionByName(arm(messages, False))
                .groupBy("date", "user_id")
                .agg(F.bool_or(F.col("os") == "iOS").alias("ios"), F.bool_or(F.col("os") == "Android").alias("android"),
                     F.sum("l").alias("likes"), F.sum("v").alias("views"), F.sum("f").alias("n_feed"),
                     F.sum("m").alias("n_msg"), F.count(F.when(F.col("m") == 1, F.col("user_id"))).alias("messages")))
    known = F.col("user_id").isNotNull()
    per_day = per_user.groupBy("date").agg(
        F.count("user_id").alias("total_DAU"),
        F.count_if(known & F.col("ios")).alias("users_ios"),
        F.count_if(known & F.col("android")).alias("users_android"),
        F.coalesce(F.sum("likes"), F.lit(0)).cast("bigint").alias("likes"),
        F.coalesce(F.sum("views"), F.lit(0)).cast("bigint").alias("views"),
        F.sum("n_feed").alias("n_feed"), F.sum("n_msg").alias("n_msg"),
        F.sum("messages").alias("messages"))
    return (per_day.where((F.col("n_feed") > 0) & (F.col("n_msg") > 0))
                   .select("date", "total_DAU", "users_ios", "users_android", "likes", "views",
                           F.round(ratio("likes", "views"), 2).alias("CTR"), "messages"))


APP_METRICS = ["total_DAU", "users_ios", "users_android", "likes", "views", "CTR"]


def long_series(wide: DataFrame, key: str, metrics: list[str]) -> DataFrame:
    """Wide KPI frame -> ``(key, metric, value)`` (values as double)."""
    return (wide.select(key, *[F.col(m).cast("double").alias(m) for m in metrics])
                .unpivot([key], metrics, "metric", "value"))


def day_over_day(long_df: DataFrame, date_col: str = "date") -> DataFrame:
    """Per metric, value / value of the previous calendar day - 1.

    ``lag`` is ordered by date and only used when it is exactly one day
    earlier, so a missing day gives NULL instead of a wrong neighbour."""
    w = Window.partitionBy("metric").orderBy(date_col)
    prev_v = F.lag("value").over(w)
    prev_d = F.lag(date_col).over(w)
    ok = prev_d == F.date_sub(F.col(date_col), 1)
    return (long_df.withColumn("prev_value", F.when(ok, prev_v))
                   .withColumn("pct_change", ratio(F.col("value"), F.col("prev_value")) - F.lit(1.0)))


def digest_app_changes(feed: DataFrame, messages: DataFrame, as_of, n_days: int = 7) -> DataFrame:
    """For the report day (``as_of - 1``) each app metric, the previous
    day's value, the relative change and a text line."""
    wide = digest_app_week(feed, messages, as_of, n_days)
    ch = day_over_day(long_series(wide, "date", APP_METRICS))
    report_day = as_date(as_of) - dt.timedelta(days=1)
    value_text = F.when(F.col("metric") == "CTR", num_text(F.col("value"))) \
                  .otherwise(F.col("value").cast("bigint").cast("string"))
    text = F.concat(F.col("metric"), F.lit(" = "), value_text, F.lit(" ("),
                    F.coalesce(pct_text(F.col("pct_change")), F.lit("n/a")), F.lit(" change vs 1 day before)"))
    return (ch.where(F.col("date") == F.lit(report_day))
              .withColumn("text", text)
              .select("date", "metric", "value", "prev_value", "pct_change", "text"))


def digest_app_message(feed: DataFrame, messages: DataFrame, as_of, n_days: int = 7) -> DataFrame:
    """The report day's lines of all app metrics, in their order, as one dated message."""
    lines = digest_app_changes(feed, messages, as_of, n_days)
    order = F.array_position(F.array(*[F.lit(m) for m in APP_METRICS]), F.col("metric"))
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order.alias("i"), "text"))), lambda x: x["text"]), "\n")
    return (lines.groupBy("date").agg(body.alias("_body"))
                 .select("date", F.concat(F.lit("App metrics for "), F.date_format("date", "dd-MM-yyyy"), F.lit(":\n\n"),
                                          F.col("_body")).alias("message")))
