"""Cohort retention.

The reference joins "first day per user" with "distinct (user, day)", two
aggregations of the same table on different keys.  Here one aggregation per
user yields both the first day and the (bounded) set of active days, with
map-side partial aggregation, so the raw events are shuffled once, by user;
the cohort counts are then a tiny second aggregation.  A user's day set is
bounded by the number of days in the data, not by its event count, so a hot
user does not blow up a task.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulselens.functions.timeexpr import as_date, ymd
from pulselens.operators.metrics import ratio


def first_activity(feed: DataFrame, keys=("user_id",)) -> DataFrame:
    """First active day per user."""
    return feed.groupBy(*keys).agg(F.min(F.to_date("time")).alias("start_day"))


def distinct_user_days(feed: DataFrame) -> DataFrame:
    """``SELECT DISTINCT user_id, day``."""
    return feed.select("user_id", F.to_date("time").alias("day")).distinct()


def user_days(feed: DataFrame, keys=("user_id",)) -> DataFrame:
    """Per user: first day and the set of active days, in one aggregation."""
    day = F.to_date("time")
    return feed.groupBy(*keys).agg(F.min(day).alias("start_day"), F.collect_set(day).alias("days"))


def first_day_activity(feed: DataFrame, keys=("user_id",)) -> DataFrame:
    """Each user's active days next to the user's first day
    (the equi-join ``first_day JOIN distinct(user, day) USING user_id``)."""
    ud = user_days(feed, keys)
    return ud.select(*keys, "start_day", F.explode("days").alias("day"))


def cohort_counts(feed: DataFrame, as_of, horizon: int = 20, keys=()) -> DataFrame:
    """Users per ``(start_day, day)`` for cohorts that started in
    ``[as_of - horizon, as_of]`` (``start_day >= today() - 20``; the filter
    runs on the per-user aggregate, before the explode)."""
    keys = tuple(keys)
    ud = user_days(feed, keys + ("user_id",))
    until = as_date(as_of)
    since = until - dt.timedelta(days=horizon)
    return (ud.where((F.col("start_day") >= F.lit(since)) & (F.col("start_day") <= F.lit(until)))
              .select(*keys, "start_day", F.explode("days").alias("day"))
              .groupBy(*keys, "start_day", "day")
              .agg(F.count(F.lit(1)).alias("users")))


def retention(feed: DataFrame, source: str | None, as_of, horizon: int = 20) -> DataFrame:
    """Day-N retention of one traffic source; dates as strings.

    The source filter comes first, so the start day is the first day within
    that source (as in the reference)."""
    df = feed if source is None else feed.where(F.col("source") == F.lit(source))
    c = cohort_counts(df, as_of, horizon)
    return c.select(ymd("start_day").alias("start_day"), ymd("day").alias("day"), "users")


def retention_by_source(feed: DataFrame, as_of, horizon: int = 20) -> DataFrame:
    """Both sources in one pass, with cohort size and retention share."""
    return with_cohort_share(cohort_counts(feed, as_of, horizon, keys=("source",)), ["source"])


def with_cohort_share(counts: DataFrame, keys) -> DataFrame:
    """Cohort counts with the day's number, the cohort's size and the share of it that is active."""
    w = Window.partitionBy(*keys, "start_day")
    cohort = F.max(F.when(F.col("day") == F.col("start_day"), F.col("users"))).over(w)
    return (counts.withColumn("day_n", F.datediff("day", "start_day"))
                  .withColumn("cohort_users", cohort)
                  .withColumn("retention", ratio(F.col("users"), F.col("cohort_users"))))


def retention_heatmap(feed: DataFrame, source: str | None, as_of, horizon: int = 20,
                      until=None) -> DataFrame:
    """Cohort x day-offset matrix of activity up to the day ``until``
    (default ``as_of``), columns ``d0..d{until - (as_of - horizon)}``.

    The same bound limits the days and the columns, so every activity day has
    its column; the pivot values are an explicit list, so Spark does not run
    an extra job to discover them."""
    df = feed if source is None else feed.where(F.col("source") == F.lit(source))
    until = as_date(as_of if until is None else until)
    df = df.where(F.col("time") < F.lit(dt.datetime.combine(until + dt.timedelta(days=1), dt.time())).cast("timestamp_ntz"))
    max_day = max(0, (until - as_date(as_of)).days + horizon)
    c = cohort_counts(df, as_of, horizon).withColumn("day_n", F.datediff("day", "start_day"))
    return (c.groupBy("start_day")
             .pivot("day_n", list(range(max_day + 1)))
             .agg(F.first("users"))
             .select("start_day", *[F.col(str(i)).alias(f"d{i}") for i in range(max_day + 1)]))


def campaign_cohort_followup(feed: DataFrame, campaign_day, source: str | None = None) -> DataFrame:
    """Users whose first day is ``campaign_day``: share active on each later day."""
    df = feed if source is None else feed.where(F.col("source") == F.lit(source))
    d = as_date(campaign_day)
    ud = user_days(df).where(F.col("start_day") == F.lit(d))
    per_day = ud.select(F.explode("days").alias("day")).groupBy("day").agg(F.count(F.lit(1)).alias("users"))
    # everyone started on day d, so its count is the cohort; the window is over one row per day
    cohort = F.max(F.when(F.col("day") == F.lit(d), F.col("users"))).over(Window.partitionBy())
    return (per_day.withColumn("day_n", F.datediff("day", F.lit(d)))
                   .withColumn("cohort_users", cohort)
                   .withColumn("share", ratio(F.col("users"), F.col("cohort_users"))))
