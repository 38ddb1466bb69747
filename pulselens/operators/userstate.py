"""Per-user state that a day's events are merged into, so that retention and lifecycle need no rescan of history.

Under a base folder stand

* ``state/…``: one row per user (and value of ``keys``, e.g. the source): first and last active day, and for the users of the
  merged days those days and the active day before them;
* ``counts/…``: users per cohort, active day and status, ``(*keys, start_day, day, status, users)``, for the merged days alone;
* ``log``: one row per merge, appended last.  A merge counts once its row is there, so one that fails half-way leaves nothing
  that is read, and running it again is safe.  One merge at a time may write.

A merge reads the newest state and the events of its own days (half-open range on the event time, so partitions are pruned),
and shuffles both by user once.  Merging days again that were merged before restates them: it starts from the state before
them, and later merges no longer count until they are run again.

The status of an active day looks at the week (from Monday): ``again`` if the user was already active that week, else
``retained`` if active the week before, ``new`` if it is the first week ever, ``returned`` otherwise.  Every user's first active
day of a week carries the week's status, so a week's users are the rows that are not ``again``.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulselens.functions.timeexpr import as_date, monday
from pulselens.operators.filters import fixed_period
from pulselens.operators.retention import with_cohort_share
from pulselens.sources.sink import delete_path, path_exists

LOG = "seq long, first_day date, last_day date, part string"


def merges(spark: SparkSession, base: str) -> list:
    """The merges that count, oldest first: a merge replaces those before it that reach its first day.  One row a merge."""
    if not path_exists(spark, f"{base}/log"):
        return []
    held: list = []
    for row in sorted(spark.read.schema(LOG).parquet(f"{base}/log").collect(), key=lambda r: r.seq):
        while held and held[-1].last_day >= row.first_day:
            held.pop()
        held.append(row)
    return held


def _key_fields(feed: DataFrame, keys) -> list[T.StructField]:
    return [T.StructField(k, feed.schema[k].dataType) for k in ("user_id", *keys)]


def merge(feed: DataFrame, base: str, first_day, last_day=None, keys=()) -> None:
    """Merge the events of ``first_day`` to ``last_day`` (default: that one day) into the state under ``base``.

    Rows without user or time add nothing.  The days must follow those merged so far or be among them (a gap would lose
    days unseen); the first merge may be a backfill of any length, and costs what a full run costs."""
    spark, keys = feed.sparkSession, list(keys)
    first, last = as_date(first_day), as_date(first_day if last_day is None else last_day)
    if last < first:
        raise ValueError("last_day is before first_day")
    held = merges(spark, base)
    seq = max((r.seq for r in spark.read.schema(LOG).parquet(f"{base}/log").collect()), default=-1) + 1 if held else 0
    before = [r for r in held if r.last_day < first]
    if held:
        due = before[-1].last_day + dt.timedelta(days=1) if before else held[0].first_day
        if first != due:
            raise ValueError(f"{first} neither follows the days merged so far nor begins a merge made before (next: {due})")
    ids = _key_fields(feed, keys)
    names = [f.name for f in ids]
    rows = (fixed_period(feed, first, last).where(F.col("user_id").isNotNull())
            .select(*names, F.lit(None).cast("date").alias("start_day"), F.lit(None).cast("date").alias("last_day"),
                    F.to_date("time").alias("day")))
    if before:
        old = f"{base}/state/{before[-1].part}"
        if not path_exists(spark, old):
            raise ValueError(f"the state of {before[-1].last_day} has been removed; merge again from an earlier day")
        state = spark.read.schema(_state_schema(ids)).parquet(old)
        rows = rows.unionByName(state.select(*names, "start_day", "last_day", F.lit(None).cast("date").alias("day")))
    one = rows.groupBy(*names).agg(F.min("start_day").alias("_start"), F.max("last_day").alias("prior_day"),
                                   F.array_sort(F.collect_set("day")).alias("days"))
    state = one.select(*names, F.coalesce("_start", F.get("days", F.lit(0))).alias("start_day"),
                       F.coalesce(F.array_max("days"), "prior_day").alias("last_day"),
                       F.when(F.size("days") > 0, F.col("prior_day")).alias("prior_day"),
                       F.when(F.size("days") > 0, F.col("days")).alias("days"))
    part = f"{last:%Y%m%d}-{uuid.uuid4().hex[:12]}"
    state.write.parquet(f"{base}/state/{part}")
    active = spark.read.schema(_state_schema(ids)).parquet(f"{base}/state/{part}").where(F.col("days").isNotNull())
    _count(active, keys).write.parquet(f"{base}/counts/{part}")
    spark.createDataFrame([(seq, first, last, part)], LOG).coalesce(1).write.mode("append").parquet(f"{base}/log")


def _state_schema(ids: list[T.StructField]) -> T.StructType:
    day = T.DateType()
    return T.StructType([*ids, T.StructField("start_day", day), T.StructField("last_day", day), T.StructField("prior_day", day),
                         T.StructField("days", T.ArrayType(day))])


def _count(active: DataFrame, keys: list[str]) -> DataFrame:
    x = active.select(*keys, "start_day", "prior_day", "days", F.posexplode("days").alias("_i", "day"))
    before = F.when(F.col("_i") == 0, F.col("prior_day")).otherwise(F.get("days", F.col("_i") - 1))
    week, was = monday("day"), monday(before)
    status = (F.when(was == week, F.lit("again")).when(was == F.date_sub(week, 7), F.lit("retained"))
               .when(before.isNull(), F.lit("new")).otherwise(F.lit("returned")))
    return x.groupBy(*keys, "start_day", "day", status.alias("status")).agg(F.count(F.lit(1)).alias("users"))


def day_counts(spark: SparkSession, base: str) -> DataFrame:
    """The counts of all merged days."""
    held = merges(spark, base)
    if not held:
        raise ValueError(f"no merge under {base}")
    return spark.read.parquet(*[f"{base}/counts/{r.part}" for r in held])


def retention(counts: DataFrame, as_of, horizon: int = 20, keys=()) -> DataFrame:
    """P1/P2 from the counts: the rows of ``retention.retention_by_source`` for each value of ``keys``."""
    keys, until = list(keys), as_date(as_of)
    since = until - dt.timedelta(days=horizon)
    c = (counts.where((F.col("start_day") >= F.lit(since)) & (F.col("start_day") <= F.lit(until)))
               .groupBy(*keys, "start_day", "day").agg(F.sum("users").alias("users")))
    return with_cohort_share(c, keys)


def weekly_lifecycle(counts: DataFrame, as_of, strict: bool = False) -> DataFrame:
    """P4/P5 from the counts of a state without ``keys``: the rows of ``lifecycle.weekly_lifecycle``.

    The users gone in a week are those of the week before less those retained, so nobody is looked up; the join is between
    two rows a week."""
    now = monday(as_of) if isinstance(as_of, Column) else monday(F.lit(as_date(as_of)))
    status = F.col("status") if strict else F.when(F.col("status") == "returned", F.lit("new")).otherwise(F.col("status"))
    per = (counts.where("status <> 'again'").groupBy(monday("day").alias("this_week"), status.alias("status"))
                 .agg(F.sum("users").alias("num_users")))
    weeks = per.groupBy("this_week").agg(F.sum("num_users").alias("_all"),
                                         F.coalesce(F.sum(F.when(F.col("status") == "retained", F.col("num_users"))), F.lit(0)).alias("_kept"))
    kept = weeks.select("this_week", "_kept")
    gone = (weeks.select(F.date_add("this_week", 7).alias("this_week"), "_all").join(kept, "this_week", "left")
                 .select("this_week", (F.coalesce("_kept", F.lit(0)) - F.col("_all")).alias("num_users"), F.lit("gone").alias("status"))
                 .where((F.col("num_users") < 0) & (F.col("this_week") != F.date_add(now, 7))))
    return (per.select("this_week", "num_users", "status").unionByName(gone)
               .select("this_week", F.date_sub("this_week", 7).alias("previous_week"), "num_users", "status"))


def expire(spark: SparkSession, base: str, keep: int = 7) -> None:
    """Remove the states of all merges but the newest ``keep`` that count; days before those can no longer be restated.
    The counts stay."""
    if keep < 1:
        raise ValueError("keep must be at least 1")
    kept = {r.part for r in merges(spark, base)[-keep:]}
    for row in spark.read.schema(LOG).parquet(f"{base}/log").collect():
        if row.part not in kept:
            delete_path(spark, f"{base}/state/{row.part}")


def merge_all(feed: DataFrame, base: str, daily: int, keys=()) -> str:
    """Bring a new base up to date: one backfill, then the last ``daily`` days one by one, as a scheduler would add them."""
    first, last = feed.agg(F.min(F.to_date("time")), F.max(F.to_date("time"))).first()
    if first is None:
        first = last = dt.date(1970, 1, 1)
    cut = max(first, last - dt.timedelta(days=daily))
    merge(feed, base, first, cut, keys)
    for k in range(1, (last - cut).days + 1):
        merge(feed, base, cut + dt.timedelta(days=k), keys=keys)
    return base
