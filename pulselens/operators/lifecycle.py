"""Weekly new / retained / gone audience.

Each user's set of active weeks is built by one aggregation per user (the
set is bounded by the number of weeks, partial aggregation runs map-side).
Week-membership tests are ``array_contains`` on that set, so there is no
self-join of the event table.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulselens.functions.timeexpr import as_date, monday


def user_weeks(act: DataFrame) -> DataFrame:
    """Per user the sorted array of active Mondays and the first one."""
    return (act.groupBy("user_id")
               .agg(F.array_sort(F.collect_set(monday("time"))).alias("weeks"))
               .withColumn("first_week", F.array_min("weeks")))


def user_weeks_text(act: DataFrame) -> DataFrame:
    """D17 in comparable form: the week list as one ``yyyy-MM-dd,...`` string."""
    uw = user_weeks(act)
    return uw.select("user_id", F.array_join(
        F.transform("weeks", lambda d: F.date_format(d, "yyyy-MM-dd")), ",").alias("weeks"))


def _current_arm(uw: DataFrame, strict: bool) -> DataFrame:
    x = uw.select("user_id", "weeks", "first_week", F.explode("weeks").alias("this_week"))
    prev = F.date_sub("this_week", 7)
    was_active = F.array_contains("weeks", prev)
    if strict:
        status = (F.when(was_active, F.lit("retained"))
                   .when(F.col("this_week") == F.col("first_week"), F.lit("new"))
                   .otherwise(F.lit("returned")))
    else:
        status = F.when(was_active, F.lit("retained")).otherwise(F.lit("new"))
    return x.select("user_id", "this_week", prev.alias("previous_week"), status.alias("status"))


def _gone_arm(uw: DataFrame, as_of, drop_open_week: bool = False) -> DataFrame:
    x = uw.select("user_id", "weeks", F.explode("weeks").alias("previous_week"))
    nxt = F.date_add("previous_week", 7)
    gone = x.where(~F.array_contains("weeks", nxt)).select(
        "user_id", nxt.alias("this_week"), "previous_week", F.lit("gone").alias("status"))
    return exclude_future_week(gone, as_of, drop_open_week)


def exclude_future_week(gone: DataFrame, as_of, drop_open_week: bool = False) -> DataFrame:
    """Drop the week after the current one (nobody can be active there yet).

    ``drop_open_week=True`` also drops ``gone`` for the current week, which
    is still running (the reference keeps it: users who have not come back
    *yet* are counted as gone)."""
    if isinstance(as_of, Column):          # e.g. a scalar subquery over the data
        this_monday = monday(as_of)
    else:
        d = as_date(as_of)
        this_monday = F.lit(d - dt.timedelta(days=d.weekday()))
    out = gone.where(F.col("this_week") != F.date_add(this_monday, 7))
    if drop_open_week:
        out = out.where(F.col("this_week") != this_monday)
    return out


def status_counts(rows: DataFrame, negate: bool = False) -> DataFrame:
    """Distinct users per ``(this_week, previous_week, status)``.

    Rows are unique per ``(user, week)`` already, so a count is a distinct count."""
    n = F.count(F.lit(1))
    return (rows.groupBy("this_week", "previous_week", "status")
                .agg((-n if negate else n).cast("bigint").alias("num_users"))
                .select("this_week", "previous_week", "num_users", "status"))


def weekly_status_counts(act: DataFrame, strict: bool = False) -> DataFrame:
    return status_counts(_current_arm(user_weeks(act), strict))


def weekly_gone(act: DataFrame, as_of, drop_open_week: bool = False) -> DataFrame:
    return status_counts(_gone_arm(user_weeks(act), as_of, drop_open_week), negate=True)


def weekly_lifecycle(act: DataFrame, as_of, strict: bool = False, drop_open_week: bool = False) -> DataFrame:
    """P4 (parity) / P5 (``strict=True``: ``new`` only in the first ever week,
    otherwise ``returned``).  ``gone`` counts are negative, as charted."""
    uw = user_weeks(act)
    return (status_counts(_gone_arm(uw, as_of, drop_open_week), negate=True)
            .unionByName(status_counts(_current_arm(uw, strict))))


def _distinct_weeks(act: DataFrame) -> DataFrame:
    return act.select("user_id", monday("time").alias("week")).distinct()


def prev_next_week_membership(act: DataFrame) -> DataFrame:
    """For each active (user, week): was the user active the week before /
    after?  The equi-join of ``(user, week)`` with ``(user, week +/- 7)``: rows
    are reduced to distinct weeks first (map-side partial), and as a user's
    neighbouring weeks stand next to one another in order, both membership
    tests are a look at the neighbour; no second scan or shuffle."""
    return prev_next_week_flags(act)


def prev_next_week_flags(act: DataFrame) -> DataFrame:
    """The same flags by ``lag``/``lead`` over the user's weeks."""
    w = Window.partitionBy("user_id").orderBy("week")
    uw = _distinct_weeks(act)
    return uw.select("user_id", "week",
                     F.coalesce(F.lag("week").over(w) == F.date_sub("week", 7), F.lit(False)).alias("in_prev_week"),
                     F.coalesce(F.lead("week").over(w) == F.date_add("week", 7), F.lit(False)).alias("in_next_week"))
