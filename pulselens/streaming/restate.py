"""Late data restated: windows that change after they closed are stored again, and the alerts they touch are judged again.

The job keeps one row per window and micro-batch that changed it (``windows``, partitioned by batch id), with the window's
full totals from a stateful aggregation in update mode.  State is kept for ``keep`` behind the newest event, far longer than
the delay after which a window counts as closed, so rows that come after that still reach it.  A retried batch overwrites
its own partition.  The newest version of a window is its value; the first one that closed it is what was reported.

Alerts are versioned the same way.  A batch judges the windows it closed, the closed windows it changed, and the windows
after those whose bands look back at them; it reads only as many earlier windows as a band looks back.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pulselens.functions.hashing import md5_uniform
from pulselens.operators import anomaly
from pulselens.operators.metrics import ratio
from pulselens.streaming import jobs

METRICS = ["likes", "views", "CTR", "sent_messages"]
WINDOWS = ("ts timestamp_ntz, ts_end timestamp_ntz, likes long, views long, sent_messages long, n_rows long, late_rows long, "
           "newest timestamp_ntz, batch_id long")
ALERTS = ("metric string, ts timestamp_ntz, value double, prev_value double, deviation double, q25 double, q75 double, "
          "up double, low double, is_alert boolean, text string, batch_id long")


def _stored(spark: SparkSession, schema: str, path: str, upto: int) -> DataFrame:
    return spark.read.schema(schema).parquet(path).where(F.col("batch_id") <= upto)


def _newest(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The version of each key that the last batch wrote."""
    rest = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch_id").alias("_v")).select(*keys, "_v.*")


def window_totals(tagged: DataFrame, keep: str) -> DataFrame:
    """Totals of each 15-minute window of the tagged rows of a stream (see ``jobs.tagged_events``)."""
    k = F.col(jobs.KIND)
    agg = tagged.withWatermark("et", keep).groupBy(F.window("et", "15 minutes").alias("w")).agg(
        F.count_if(k == "like").alias("likes"), F.count_if(k == "view").alias("views"),
        F.count_if(k == "message").alias("sent_messages"), F.count(F.lit(1)).alias("n_rows"), F.max("et").alias("newest"))
    return agg.select(*jobs._window_columns("w"), "likes", "views", "sent_messages", "n_rows",
                      F.col("newest").cast("timestamp_ntz").alias("newest"))


def _mark(spark: SparkSession, path: str, upto: int, delay: dt.timedelta):
    """The newest event of all batches up to ``upto`` less the delay: windows that end by then are closed."""
    if upto < 0:
        return None
    newest = _stored(spark, WINDOWS, path, upto).agg(F.max("newest")).first()[0]
    return None if newest is None else newest - delay


def _closed(mark) -> Column:
    return F.coalesce(F.col("ts_end") <= F.lit(mark).cast("timestamp_ntz"), F.lit(False))


def _judge(spark: SparkSession, base: str, batch_id: int, before, after, a: float, n: int) -> None:
    """Write the alerts of the closed windows that this batch closed or changed, and of those that look back at them."""
    look_back = n + n // 2 + 1
    now = _newest(_stored(spark, WINDOWS, f"{base}/windows", batch_id), ["ts"]).where(_closed(after))
    new = _closed(before).eqNullSafe(F.lit(False)) | (F.col("batch_id") == batch_id)
    first = now.where(new).agg(F.min("ts")).first()[0]
    if first is None:
        return
    since = (now.where(F.col("ts") < F.lit(first).cast("timestamp_ntz")).orderBy(F.desc("ts")).limit(look_back)
             .agg(F.min("ts")).first()[0]) or first
    part = now.where(F.col("ts") >= F.lit(since).cast("timestamp_ntz")).withColumn("_new", new.cast("int"))
    part = part.withColumn("CTR", F.round(ratio("likes", "views"), 2))
    long = anomaly.kpi_long(part, METRICS, ("ts", "_new"))
    near = Window.partitionBy("metric").orderBy("ts").rowsBetween(-(look_back - 1), 0)
    touched = long.withColumn("_new", F.max("_new").over(near)).where("_new = 1").select("metric", "ts")
    judged = anomaly.live_alerts(anomaly.iqr_bands(long.drop("_new"), a, n)).join(touched, ["metric", "ts"], "left_semi")
    jobs._write_batch(judged, batch_id, f"{base}/alerts")


def restate_stream(tagged: DataFrame, base: str, delay_minutes: int = 10, keep: str = "60 days", a: float = 5.0, n: int = 5) -> None:
    """Process the input that is available: store the windows it changes and judge the alerts they touch, under ``base``."""
    delay = dt.timedelta(minutes=delay_minutes)

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        spark, path = batch.sparkSession, f"{base}/windows"
        before = _mark(spark, path, batch_id - 1, delay)
        late = F.when(_closed(before), F.col("n_rows") - F.coalesce("_rows", F.lit(0))).otherwise(F.lit(0))
        if batch_id:
            was = _newest(_stored(spark, WINDOWS, path, batch_id - 1), ["ts"]).select(
                "ts", F.col("n_rows").alias("_rows"), F.col("late_rows").alias("_late"))
            rows = batch.join(was, "ts", "left")
        else:
            rows = batch.withColumn("_rows", F.lit(0).cast("long")).withColumn("_late", F.lit(0).cast("long"))
        rows = rows.withColumn("late_rows", late + F.coalesce("_late", F.lit(0))).drop("_rows", "_late")
        jobs._write_batch(rows, batch_id, path)
        after = _mark(spark, path, batch_id, delay)
        if after is not None:
            _judge(spark, base, batch_id, before, after, a, n)

    jobs._run(window_totals(tagged, keep), base, on_batch, mode="update")


def restated_windows(spark: SparkSession, base: str, delay_minutes: int = 10) -> DataFrame:
    """Closed windows with their newest totals, and how many of their rows came after they had closed."""
    path = f"{base}/windows"
    now = _newest(spark.read.schema(WINDOWS).parquet(path), ["ts"])
    mark = spark.read.schema(WINDOWS).parquet(path).agg(F.max("newest") - F.expr(f"INTERVAL {delay_minutes} MINUTES")).scalar()
    return now.where(F.col("ts_end") <= mark).select(
        "ts", "ts_end", "likes", "views", F.round(ratio("likes", "views"), 2).alias("CTR"), "sent_messages", "late_rows")


def restated_alerts(spark: SparkSession, base: str) -> DataFrame:
    """Each window's alert row as last judged, whether it was an alert when first judged, and how often it was judged."""
    rows = spark.read.schema(ALERTS).parquet(f"{base}/alerts")
    told = rows.groupBy("metric", "ts").agg(F.min_by("is_alert", "batch_id").alias("first_alert"), F.count("*").alias("n_judged"))
    return _newest(rows, ["metric", "ts"]).drop("batch_id").join(told, ["metric", "ts"])


# ---- a table delivered in order of arrival ----------------------------------------------------

def with_arrival(events: DataFrame, share: float = 0.05, hours: int = 72) -> DataFrame:
    """A table without an arrival time gets one: ``share`` of its rows (by a hash of the event id) come up to ``hours``
    late, the others at once."""
    u = md5_uniform(F.col("event_id"), F.lit("late"))
    wait = F.when(u < share, F.floor(u / share * (hours * 3600))).otherwise(F.lit(0)).cast("int")
    return events.withColumn("arrival", F.col("ts") + F.make_dt_interval(secs=wait))


def deliver(events: DataFrame, path: str, deliveries: int, run) -> None:
    """Append the table to ``path`` in ``deliveries`` equal spans of its arrival days, and call ``run()`` after each."""
    day = F.to_date("arrival")
    first, last = events.agg(F.min(day), F.max(day)).first()
    if first is None:
        events.drop("arrival").write.mode("append").parquet(path)
        run()
        return
    span = (last - first).days + 1
    number = F.datediff(day, F.lit(first)) * deliveries
    for k in range(deliveries):
        events.where((number >= k * span) & (number < (k + 1) * span)).drop("arrival").write.mode("append").parquet(path)
        run()
