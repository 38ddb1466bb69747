"""Structured Streaming jobs.

The reference re-queries two days every 15 minutes.  Here the same KPIs are
maintained incrementally: event time is cast to ``timestamp`` (watermarks
need it), windows are tumbling 15-minute windows, output mode is ``append``
(a window is written once, when the watermark passes its end), and the jobs
run with ``availableNow`` so a scheduler can start them like a batch job.

Every job takes a base folder, which the driver and all executors share, and
keeps its checkpoint and its results there: the next run with the same folder
reads only input it has not seen, and a restarted driver or a lost executor
resumes from the last committed batch.  State is kept in RocksDB, not on the
executors' heaps.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulselens.operators import anomaly, etl
from pulselens.sources import tables
from pulselens.sources.sink import delete_path, write_slices

KIND = "kind"
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stream_events(spark: SparkSession, sf_dir: str, max_files: int | None = None,
                  name: str = "events") -> DataFrame:
    """File-source stream over the ``events`` Parquet data of ``sf_dir``: a
    folder ``events.parquet/`` of part files, or a single ``events.parquet``
    file (then the parent folder is watched with a file-name filter)."""
    target = f"{sf_dir.rstrip('/')}/{name}.parquet"
    r = spark.readStream.schema(tables.EVENTS_SCHEMA)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    if _is_dir(spark, target):
        return r.parquet(target)
    return r.option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)


def _is_dir(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.getFileStatus(p).isDirectory())          # a missing path is an error


def event_time(c: str = "ts") -> Column:
    """``timestamp_ntz`` -> ``timestamp`` (UTC session zone) for watermarks."""
    return F.col(c).cast("timestamp")


def tagged_activity(feed: DataFrame, messages: DataFrame) -> DataFrame:
    """Rows of a feed and a message stream, tagged (``like``/``view``/``message``)
    so that a single aggregation covers both products (no stream-stream join)."""
    f = feed.select("user_id", event_time("time").alias("et"), F.col("action").alias(KIND))
    return f.unionByName(messages.select("user_id", event_time("time").alias("et"), F.lit("message").alias(KIND)))


def tagged_events(events: DataFrame) -> DataFrame:
    """The same rows from one stream that holds both products, in one pass over it."""
    t = F.col("event_type")
    kind = (F.when(t == "view", F.lit("view")).when(t == "click", F.lit("like"))
             .when(t.isin("purchase", "signup"), F.lit("message")))
    return events.select("user_id", event_time().alias("et"), kind.alias(KIND)).where(F.col(KIND).isNotNull())


def _window_columns(w: str) -> list[Column]:
    return [F.col(f"{w}.start").cast("timestamp_ntz").alias("ts"), F.col(f"{w}.end").cast("timestamp_ntz").alias("ts_end")]


def _ctr() -> Column:
    return F.round(F.col("likes") / F.nullif(F.col("views"), F.lit(0)), 2).alias("CTR")


def kpi_stream(tagged: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Tumbling 15-minute likes, views, CTR and messages."""
    k = F.col(KIND)
    agg = tagged.withWatermark("et", delay).groupBy(F.window("et", "15 minutes").alias("w")).agg(
        F.count_if(k == "like").alias("likes"), F.count_if(k == "view").alias("views"),
        F.count_if(k == "message").alias("sent_messages"))
    return agg.select(*_window_columns("w"), "likes", "views", _ctr(), "sent_messages")


def _per_user(tagged: DataFrame, delay: str) -> DataFrame:
    k = F.col(KIND)
    return tagged.withWatermark("et", delay).groupBy(F.window("et", "15 minutes").alias("window"), "user_id").agg(
        F.count_if(k == "like").alias("_l"), F.count_if(k == "view").alias("_v"), F.count_if(k == "message").alias("_m"))


def distinct_users_stream(tagged: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Exact distinct users per window and product.  Distinct counts are
    not supported on streams, so rows are first aggregated per
    ``(window, user)`` and then counted per window (two chained stateful
    aggregations; the window column carries the event time)."""
    per_win = _per_user(tagged, delay).groupBy("window").agg(
        F.count_if(F.col("_l") + F.col("_v") > 0).alias("users_feed"), F.count_if(F.col("_m") > 0).alias("users_message"))
    return per_win.select(*_window_columns("window"), "users_feed", "users_message")


def alert_kpi_stream(tagged: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """S3 input: all six KPIs of a window from the same chained aggregation."""
    per_win = _per_user(tagged, delay).groupBy("window").agg(
        F.sum("_l").alias("likes"), F.sum("_v").alias("views"), F.sum("_m").alias("sent_messages"),
        F.count_if(F.col("_l") + F.col("_v") > 0).alias("users_feed"), F.count_if(F.col("_m") > 0).alias("users_message"))
    return per_win.select(*_window_columns("window"), "likes", "views", _ctr(), "users_feed", "users_message", "sent_messages")


def _run(df: DataFrame, base: str, on_batch=None, mode: str = "append"):
    """Process the input that is available and not yet done, under ``base``; returns the ended query."""
    df.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    w = df.writeStream.outputMode(mode).option("checkpointLocation", f"{base}/_checkpoint").trigger(availableNow=True)
    q = w.foreachBatch(on_batch).start() if on_batch else w.format("parquet").start(f"{base}/data")
    q.awaitTermination()
    return q


def run_to_parquet(df: DataFrame, base: str) -> str:
    """Run a streaming DataFrame to a Parquet sink until the available input
    is processed; returns the sink's path."""
    _run(df, base)
    return f"{base}/data"


STREAM_KPI_METRICS = ["likes", "views", "CTR", "users_feed", "users_message", "sent_messages"]


def _write_batch(df: DataFrame, batch_id: int, path: str) -> None:
    """A retried batch id overwrites its own partition, so a re-run never doubles rows."""
    (df.withColumn("batch_id", F.lit(batch_id).cast("long")).write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path))


TAIL = ("ts timestamp_ntz, ts_end timestamp_ntz, likes long, views long, CTR double, users_feed long, users_message long, "
        "sent_messages long")


def alert_batch_writer(hist_path: str, alert_path: str, a: float = 5.0, n: int = 5):
    """The ``foreachBatch`` body of S3: every window the batch closes is judged
    once, by the band a live check at that window sees.

    A band looks back at most ``n + n // 2`` windows, and windows close in order of time, so each batch leaves the last
    windows seen so far as its tail (``<hist_path>_tail/<batch id>``) and the next one reads that alone.  A batch that is run again reads
    the tail of the one before again and overwrites its own rows; the tail before that is no longer needed and goes.
    """
    keep, tail = n + n // 2, f"{hist_path}_tail"

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = batch.select(*[F.col(f.name).cast(f.dataType) for f in T.StructType.fromDDL(TAIL)]).withColumn("_new", F.lit(True))
        if batch_id:
            seen = spark.read.schema(TAIL).parquet(f"{tail}/{batch_id - 1}").withColumn("_new", F.lit(False))
            rows = rows.unionByName(seen)
        rows = rows.persist()
        try:
            if not rows.where("_new").isEmpty():
                _write_batch(rows.where("_new").drop("_new"), batch_id, hist_path)
                long = anomaly.kpi_long(rows, STREAM_KPI_METRICS, ("ts", "_new"))
                judged = anomaly.live_alerts(anomaly.iqr_bands(long, a, n), extra=("_new",))
                _write_batch(judged.where("_new").drop("_new"), batch_id, alert_path)
            rows.drop("_new").orderBy(F.desc("ts")).limit(keep).coalesce(1).write.mode("overwrite").parquet(f"{tail}/{batch_id}")
        finally:
            rows.unpersist()
        if batch_id > 1:
            delete_path(spark, f"{tail}/{batch_id - 2}")
    return on_batch


def alerts_stream(tagged: DataFrame, base: str, delay: str = "10 minutes", a: float = 5.0, n: int = 5) -> str:
    """S3: per micro-batch, newly closed KPI windows are judged against the windows before them and stored with their
    verdicts (``history`` and ``alerts``, partitioned by batch id); returns the path of the alert rows.  What a batch reads
    besides its own rows is the tail of the batch before, ``n + n // 2`` windows at most, however long the job has run."""
    _run(alert_kpi_stream(tagged, delay), base, alert_batch_writer(f"{base}/history", f"{base}/alerts", a, n))
    return f"{base}/alerts"


LATE_SCHEMA = "batch_id long, rows_read long, late_rows long, watermark timestamp_ntz, newest timestamp_ntz"


def late_data_stream(events: DataFrame, base: str, delay_minutes: int = 10) -> DataFrame:
    """For each micro-batch how many of its rows came too late for the
    watermark it met, i.e. whose 15-minute window had closed by then.

    The watermark follows Spark's rule (newest event of all earlier batches
    less the delay); each batch's count and newest event are stored under
    ``base``, so the report covers all runs, however many there were."""
    path = f"{base}/late"

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        newest = None
        if batch_id:
            newest = (spark.read.schema(LATE_SCHEMA).parquet(path).where(F.col("batch_id") < batch_id)
                      .agg(F.max("newest")).first()[0])
        mark = None if newest is None else newest - dt.timedelta(minutes=delay_minutes)
        wm = F.lit(mark).cast("timestamp_ntz")
        closed = F.window(event_time(), "15 minutes").end.cast("timestamp_ntz") <= wm
        _write_batch(batch.withColumn("_closed", closed).agg(
            F.count(F.lit(1)).alias("rows_read"), F.count_if("_closed").alias("late_rows"), F.lit(mark).cast("timestamp_ntz").alias("watermark"),
            F.date_trunc("millisecond", F.max("ts")).cast("timestamp_ntz").alias("newest")), batch_id, path)

    _run(events, base, on_batch)
    return events.sparkSession.read.schema(LATE_SCHEMA).parquet(path)


def _day_runs(days: list[dt.date]) -> list[tuple[dt.date, dt.date]]:
    """Runs of consecutive days."""
    out: list[tuple[dt.date, dt.date]] = []
    for d in sorted(days):
        if out and d - out[-1][1] == dt.timedelta(days=1):
            out[-1] = (out[-1][0], d)
        else:
            out.append((d, d))
    return out


def daily_slices_stream(changes: DataFrame, feed: DataFrame, messages: DataFrame, base: str, time_col: str = "time") -> str:
    """Incremental daily slice table.  Each micro-batch of ``changes`` finds
    the days it touched, recomputes exactly those days from the tables ``feed``
    and ``messages`` (a day may span batches) and overwrites their partitions."""
    table = f"{base}/table"

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        days = [r.d for r in batch.select(F.to_date(time_col).alias("d")).where("d is not null").distinct().collect()]
        for first, last in _day_runs(days):
            write_slices(etl.slice_report(feed, messages, first, last), table)

    _run(changes, base, on_batch)
    return table
