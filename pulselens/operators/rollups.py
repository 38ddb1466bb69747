"""Stored per-day and per-week user sets that merge, so that a new period needs no rescan of events.

Bitmaps are exact: a row holds which of 32,768 neighbouring user ids were active (a bucket of ``bitmap_bucket_number``), and
the distinct users of any period or set of slices are the bits of the OR of its rows.  Theta sketches are approximate and of
fixed size, and also answer intersections and differences: users retained from one week to the next, new and gone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulselens.functions.timeexpr import as_date, monday

#: Size of the theta sketches: 2**12 entries, a relative standard error of 1 / sqrt(2**12).
LG_ENTRIES = 12


# ---- exact distinct users from bitmaps -----------------------------------------------------------

def user_bitmaps(feed: DataFrame, dims=("os",)) -> DataFrame:
    """``(date, *dims, bucket, bits)``: the users of every day and slice as bitmaps; at most 4 KB for 32,768
    neighbouring ids, whatever the number of events.  Rows without user add nothing."""
    user = F.col("user_id").cast("bigint")
    return (feed.where(user.isNotNull())
                .groupBy(F.to_date("time").alias("date"), *dims, F.bitmap_bucket_number(user).alias("bucket"))
                .agg(F.bitmap_construct_agg(F.bitmap_bit_position(user)).alias("bits")))


def bitmap_users(bitmaps: DataFrame, by) -> DataFrame:
    """Exact distinct users for every value of ``by`` (columns of the bitmap table, or expressions over its date)."""
    keys = [F.col(c) if isinstance(c, str) else c for c in by]
    names = [f"_k{i}" for i in range(len(keys))]
    merged = (bitmaps.groupBy(*[k.alias(n) for k, n in zip(keys, names)], "bucket")
                     .agg(F.bitmap_count(F.bitmap_or_agg("bits")).alias("users")))
    named = [c if isinstance(c, str) else f"key{i}" for i, c in enumerate(by)]
    return merged.groupBy(*names).agg(F.sum("users").alias("users")).select(
        *[F.col(n).alias(c) for n, c in zip(names, named)], "users")


def period_users(bitmaps: DataFrame, periods: list[tuple[str, object, object]], dims=("os",)) -> DataFrame:
    """``(period, *dims, users)``: exact distinct users of named periods of days (both ends included; they may overlap),
    for each slice and, with null slices, for all of them together."""
    wanted = F.array(*[F.struct(F.lit(n).alias("period"), F.lit(as_date(a)).alias("a"), F.lit(as_date(b)).alias("b")) for n, a, b in periods])
    first, last = min(as_date(a) for _, a, _ in periods), max(as_date(b) for _, _, b in periods)
    held = bitmaps.where((F.col("date") >= F.lit(first)) & (F.col("date") <= F.lit(last))).select("*", F.explode(wanted).alias("p"))
    held = held.where((F.col("date") >= F.col("p.a")) & (F.col("date") <= F.col("p.b"))).withColumn("period", F.col("p.period"))
    day = held.groupBy("period", *dims, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    sets = day.select("period", *dims, "bucket", "bits", F.lit(False).alias("all")).unionByName(
        day.groupBy("period", "bucket").agg(F.bitmap_or_agg("bits").alias("bits")).select(
            "period", *[F.lit(None).cast(day.schema[d].dataType).alias(d) for d in dims], "bucket", "bits", F.lit(True).alias("all")))
    return (sets.groupBy("period", *dims, "all").agg(F.sum(F.bitmap_count("bits")).alias("users"))
                .select("period", *dims, F.col("all").alias("all_slices"), "users"))


def write_rollup(rollup: DataFrame, path: str, key: str = "date") -> str:
    """Store a rollup by day or week; a later run replaces the days or weeks it holds, and no others."""
    (rollup.repartition(key).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(key).parquet(path))
    return path


# ---- weekly sketches ----------------------------------------------------------------------------

def weekly_sketches(act: DataFrame) -> DataFrame:
    """``(week, sketch)``: one theta sketch of the users of every week (its Monday)."""
    return act.groupBy(monday("time").alias("week")).agg(F.theta_sketch_agg("user_id", LG_ENTRIES).alias("sketch"))


def sketch_lifecycle(sketches: DataFrame, as_of) -> DataFrame:
    """P4 from stored sketches alone: estimates of users retained (active this week and the one before), new (this week, not
    the one before) and gone (the week before, not this one), ``(this_week, previous_week, status, num_users)``.

    The week after that of ``as_of`` has nobody yet and is left out; counts of gone users are negative, as charted.
    Weeks without any user have no row of their own, but their predecessor's users are gone in them.
    """
    now = monday(as_of) if isinstance(as_of, Column) else monday(F.lit(as_date(as_of)))
    here = sketches.select(F.col("week").alias("this_week"), "sketch")
    before = sketches.select(F.date_add("week", 7).alias("this_week"), F.col("sketch").alias("earlier"))
    both = here.join(before, "this_week", "full").where(F.col("this_week") <= now)
    est = lambda c: F.theta_sketch_estimate(c)
    arms = F.array(
        F.struct(F.lit("new").alias("status"), F.when(F.col("sketch").isNotNull(), F.coalesce(
            est(F.theta_difference("sketch", "earlier")), est("sketch"))).alias("num_users")),
        F.struct(F.lit("retained").alias("status"), est(F.theta_intersection("sketch", "earlier")).alias("num_users")),
        F.struct(F.lit("gone").alias("status"), F.when(F.col("earlier").isNotNull(), -F.coalesce(
            est(F.theta_difference("earlier", "sketch")), est("earlier"))).alias("num_users")))
    return (both.select("this_week", F.date_sub("this_week", 7).alias("previous_week"), F.explode(arms).alias("x"))
                .select("this_week", "previous_week", "x.status", "x.num_users").where("num_users <> 0"))


def sketch_period_users(sketches: DataFrame, first_week, last_week) -> DataFrame:
    """Distinct users of a run of weeks, from the union of their sketches: one row."""
    held = sketches.where((F.col("week") >= F.lit(as_date(first_week))) & (F.col("week") <= F.lit(as_date(last_week))))
    return held.agg(F.theta_sketch_estimate(F.theta_union_agg("sketch", LG_ENTRIES)).alias("users"))


def sketch_lifecycle_check(act: DataFrame, sketches: DataFrame, as_of) -> DataFrame:
    """The exact counts with whether each estimate is within four standard errors.

    The error of a difference or intersection follows from the sketches it comes from: a theta sketch of n users knows each
    with probability min(1, 2**LG_ENTRIES / n), so a part of m of them has a standard error of sqrt(m (1 - p) / p) at most.
    """
    from pulselens.operators.lifecycle import weekly_lifecycle
    keys = ["this_week", "previous_week", "status"]
    size = sketches.select(F.col("week").alias("_w"), F.theta_sketch_estimate("sketch").cast("double").alias("_n"))
    exact = weekly_lifecycle(act, as_of).withColumnRenamed("num_users", "exact")
    x = exact.join(sketch_lifecycle(sketches, as_of), keys, "full")
    x = x.join(size.withColumnsRenamed({"_w": "this_week", "_n": "_a"}), "this_week", "left").join(
        size.withColumnsRenamed({"_w": "previous_week", "_n": "_b"}), "previous_week", "left")
    p = F.least(F.lit(1.0), F.lit(float(2 ** LG_ENTRIES)) / F.greatest(F.coalesce("_a", F.lit(1.0)), F.coalesce("_b", F.lit(1.0))))
    m = F.abs(F.coalesce("exact", F.lit(0)))
    # a part of few users is seen by few of the sampled hashes: one more keeps the bound above zero
    near = F.abs(F.coalesce("num_users", F.lit(0)) - F.coalesce("exact", F.lit(0))) <= 4 * F.sqrt((m + 1) * (1 - p) / p) + 0.5
    return x.select(*keys, F.coalesce("exact", F.lit(0)).alias("num_users"), near.alias("within_4_errors"))
