"""15-minute KPIs and IQR anomaly alerts.

The KPI table is tiny (one row per 15-minute window), and all metrics are
handled in one job: the wide table is unpivoted to ``(ts, metric, value)``
and every window function is partitioned by ``metric`` (by
``(segment, metric)`` for many series), never a Python loop per metric.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pulselens.functions.bins import num_text, pct_text
from pulselens.functions.timeexpr import as_datetime, floor_15min, hour_minute, ts_lit
from pulselens.operators.filters import closed_windows, window_floor
from pulselens.operators.metrics import likes_expr, ratio, views_expr

KPI_METRICS = ["likes", "views", "CTR", "users_feed", "users_message", "sent_messages"]


def feed_15min(feed: DataFrame) -> DataFrame:
    return (feed.groupBy(floor_15min("time").alias("ts"))
                .agg(F.count_distinct("user_id").alias("users_feed"),
                     likes_expr().alias("likes"), views_expr().alias("views")))


def messages_15min(messages: DataFrame) -> DataFrame:
    return (messages.groupBy(floor_15min("time").alias("ts"))
                    .agg(F.count_distinct("user_id").alias("users_message"),
                         F.count("user_id").alias("sent_messages")))


def _kpi_columns(df: DataFrame) -> DataFrame:
    return df.select("ts", F.to_date("ts").alias("date"), hour_minute("ts").alias("hm"),
                     "likes", "views", F.round(ratio("likes", "views"), 2).alias("CTR"),
                     "users_feed", "users_message", "sent_messages")


def kpi_15min(feed: DataFrame, messages: DataFrame, as_of, history_days: int = 1) -> DataFrame:
    """Z1 (parity): 15-minute KPIs of closed windows, feed and messages
    inner-joined on the window start (windows silent on one side vanish)."""
    f = feed_15min(closed_windows(feed, as_of, history_days))
    m = messages_15min(closed_windows(messages, as_of, history_days))
    return _kpi_columns(f.join(m, "ts", "inner"))


def window_spine(spark: SparkSession, start: dt.datetime, end: dt.datetime, minutes: int = 15) -> DataFrame:
    """Every window start in ``[start, end)``: one generated row per window
    (size fixed by the time range, independent of the data volume)."""
    step = F.expr(f"INTERVAL {minutes} MINUTES")
    last = end - dt.timedelta(minutes=minutes)
    return spark.range(1).select(F.explode(F.sequence(ts_lit(start), ts_lit(last), step)).alias("ts"))


def kpi_15min_strict(feed: DataFrame, messages: DataFrame, as_of, history_days: int = 1) -> DataFrame:
    """Z3 input: the same KPIs on a gap-free spine of windows; a silent window
    has zero counts and a NULL CTR."""
    t = as_datetime(as_of)
    start = dt.datetime.combine(t.date() - dt.timedelta(days=history_days), dt.time())
    end = window_floor(t)
    spine = window_spine(feed.sparkSession, start, end)
    f = feed_15min(closed_windows(feed, as_of, history_days))
    m = messages_15min(closed_windows(messages, as_of, history_days))
    j = spine.join(f, "ts", "left").join(m, "ts", "left")
    filled = j.select("ts", *[F.coalesce(F.col(c), F.lit(0)).alias(c)
                             for c in ["likes", "views", "users_feed", "users_message", "sent_messages"]])
    return _kpi_columns(filled)


def kpi_long(kpi: DataFrame, metrics=KPI_METRICS, keys=("ts",)) -> DataFrame:
    """P18 for the alert table: ``(ts, metric, value)``."""
    keys = list(keys)
    return (kpi.select(*keys, *[F.col(m).cast("double").alias(m) for m in metrics])
               .unpivot(keys, list(metrics), "metric", "value"))


def iqr_bands(long_df: DataFrame, a: float = 5.0, n: int = 5, order: str = "ts",
              partition=("metric",)) -> DataFrame:
    """Per series, quartiles of the previous ``n`` values (NULL until
    ``n`` non-NULL values exist), the band ``q75 + a*iqr`` / ``q25 - a*iqr``,
    smoothed by a centered ``n``-row mean (``up``/``low``, for charts) and by
    a trailing mean over the same past rows (``up_live``/``low_live``, what
    the live check at the newest row sees; use it for backtests)."""
    part = list(partition)
    w = Window.partitionBy(*part).orderBy(order)
    prev = w.rowsBetween(-n, -1)
    full = F.count("value").over(prev) == F.lit(n)
    q25 = F.when(full, F.percentile("value", 0.25).over(prev))
    q75 = F.when(full, F.percentile("value", 0.75).over(prev))
    x = (long_df.withColumn("q25", q25).withColumn("q75", q75)
                .withColumn("iqr", F.col("q75") - F.col("q25"))
                .withColumn("_up", F.col("q75") + F.lit(a) * F.col("iqr"))
                .withColumn("_low", F.col("q25") - F.lit(a) * F.col("iqr")))
    lo, hi = -(n // 2), (n - 1) // 2
    centered = w.rowsBetween(lo, hi)
    trailing = w.rowsBetween(lo, 0)
    return (x.withColumn("up", F.avg("_up").over(centered))
             .withColumn("low", F.avg("_low").over(centered))
             .withColumn("up_live", F.avg("_up").over(trailing))
             .withColumn("low_live", F.avg("_low").over(trailing))
             .drop("_up", "_low"))


def iqr_bands_by_range(long_df: DataFrame, width: str | Column, a: float = 5.0, n: int = 5, order: str = "ts",
                       partition=("metric",)) -> DataFrame:
    """Z2/E1/E2 for long series: the rows of ``iqr_bands``, with each series split into ranges of ``order``.

    ``width`` is a length of time (such as ``"7 days"``, for a time ``order``) or an expression that numbers the ranges and
    never decreases along ``order``.  A window function then runs for each range, so no task holds a whole series: each range
    also gets the rows that its windows reach into on either side (``n + n // 2`` before, ``(n - 1) // 2`` after), whichever
    ranges those are in.  They come from the first and last rows of all ranges, a table of at most ``2n`` rows a range.
    Rows are unique in ``order`` within a series and not null in it; gaps of any length are allowed.
    """
    part, cols = list(partition), long_df.columns
    before, after = n + n // 2, max(1, (n - 1) // 2)
    number = F.window(F.col(order).cast("timestamp"), width).start.cast("long") if isinstance(width, str) else width
    x = long_df.withColumn("_range", number)
    keys = [*part, "_range"]
    up, down = Window.partitionBy(*keys).orderBy(order), Window.partitionBy(*keys).orderBy(F.desc(order))
    edges = (x.withColumn("_i", F.row_number().over(up)).withColumn("_j", F.row_number().over(down))
              .where((F.col("_i") <= F.lit(after)) | (F.col("_j") <= F.lit(before))))
    # the last `before` rows ahead of a range's first row are all in the edge table, whether one range holds them or many
    row = F.struct(*cols)
    series = Window.partitionBy(*part).orderBy(order)
    edges = (edges.withColumn("_before", F.when(F.col("_i") == 1, F.collect_list(row).over(series.rowsBetween(-before, -1))))
                  .withColumn("_after", F.when(F.col("_j") == 1, F.collect_list(row).over(series.rowsBetween(1, after)))))
    near = F.explode(F.concat(F.coalesce("_before", F.array()), F.coalesce("_after", F.array())))
    halo = edges.where("_i = 1 or _j = 1").select("_range", near.alias("_r")).select("_r.*", "_range", F.lit(True).alias("_halo"))
    both = x.select(*cols, "_range", F.lit(False).alias("_halo")).unionByName(halo)
    return iqr_bands(both, a, n, order, keys).where(~F.col("_halo")).drop("_range", "_halo")


def _outside(v, lo, hi):
    return F.coalesce((F.col(v) < F.col(lo)) | (F.col(v) > F.col(hi)), F.lit(False))


def anomaly_bands(kpi: DataFrame, metrics=KPI_METRICS, a: float = 5.0, n: int = 5) -> DataFrame:
    """Z2 on a wide KPI table."""
    return iqr_bands(kpi_long(kpi, metrics), a, n)


def _alert_rows(x: DataFrame, part: list[str], order: str, low: str, up: str, extra=()) -> DataFrame:
    """The change vs the previous window (``prev_value``), the alert flag (strict comparison; a NULL band never alerts)
    and the alert text when it fires."""
    x = x.withColumn("deviation", F.abs(F.lit(1.0) - ratio(F.col("value"), F.col("prev_value"))))
    alert = _outside("value", low, up)
    text = F.concat(F.lit("Metric "), F.col("metric"), F.lit(":\nCurrent value "), num_text(F.col("value")),
                    F.lit("\nDeviation from previous value "), F.coalesce(pct_text(F.col("deviation")), F.lit("n/a")))
    return (x.withColumn("is_alert", alert)
             .withColumn("text", F.when(alert, text))
             .select(*part, order, "value", "prev_value", "deviation", "q25", "q75", F.col(up).alias("up"),
                     F.col(low).alias("low"), "is_alert", "text", *extra))


def live_alerts(bands: DataFrame, partition=("metric",), order: str = "ts", extra=()) -> DataFrame:
    """Every window of every series as it was judged when it was the newest one (trailing band); ``extra`` columns are
    kept."""
    part = list(partition)
    w = Window.partitionBy(*part).orderBy(order)
    return _alert_rows(bands.withColumn("prev_value", F.lag("value").over(w)), part, order, "low_live", "up_live", extra)


def latest_alerts(bands: DataFrame, partition=("metric",), order: str = "ts") -> DataFrame:
    """The newest window of every series with its band, the change vs
    the previous window (E4), the alert flag and the alert text when it fires."""
    part = list(partition)
    w = Window.partitionBy(*part).orderBy(order)
    x = (bands.withColumn("prev_value", F.lag("value").over(w))
              .withColumn("_last", F.max(order).over(Window.partitionBy(*part))))
    return _alert_rows(x.where(F.col(order) == F.col("_last")).drop("_last"), part, order, "low", "up")


def backtest(bands: DataFrame) -> DataFrame:
    """The live decision at every historic window (trailing band only)."""
    return bands.withColumn("is_alert", _outside("value", "low_live", "up_live"))


def same_slot_day_before(long_df: DataFrame) -> DataFrame:
    """Each window against the same 15-minute slot one day earlier
    (NULL when that slot is missing)."""
    w = Window.partitionBy("metric", hour_minute("ts")).orderBy("ts")
    prev_ts = F.lag("ts").over(w)
    prev_v = F.lag("value").over(w)
    ok = prev_ts == F.col("ts") - F.expr("INTERVAL 1 DAY")
    return (long_df.withColumn("value_day_before", F.when(ok, prev_v))
                   .withColumn("change", ratio(F.col("value"), F.col("value_day_before")) - F.lit(1.0)))
