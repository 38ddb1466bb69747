"""Bands of series split into ranges, and alert batches that read a bounded tail."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from pulselens.operators import anomaly
from pulselens.streaming import jobs

T0 = dt.datetime(2024, 1, 1)


def series(spark, seed, n, gap=1):
    r = random.Random(seed)
    rows, t = [], 0
    for _ in range(n):
        t += r.choice([1, 1, 1, gap])
        for m in ("a", "b"):
            if m == "a" or r.random() < 0.7:
                rows.append((T0 + dt.timedelta(minutes=15 * t), m, r.choice([None, 1.0, 2.0, 5.0, float(r.randint(0, 50))])))
    return spark.createDataFrame(rows, "ts timestamp_ntz, metric string, value double")


def rows_of(df):
    return sorted((tuple(r) for r in df.select("metric", "ts", "value", "q25", "q75", "iqr", "up", "low", "up_live", "low_live").collect()),
                  key=str)


@pytest.mark.parametrize("n", [1, 2, 3, 5, 8])
@pytest.mark.parametrize("width,gap", [("1 hour", 1), ("1 hour", 40), ("2 days", 3)])
def test_ranges_give_the_rows_of_the_plain_windows(spark, n, width, gap):
    x = series(spark, n, 60, gap)
    assert rows_of(anomaly.iqr_bands_by_range(x, width, 2.0, n)) == rows_of(anomaly.iqr_bands(x, 2.0, n))


def test_no_task_holds_a_whole_series(spark):
    x = spark.range(20_000).select((F.lit(T0) + F.make_dt_interval(mins=F.col("id").cast("int") * 15)).cast("timestamp_ntz").alias("ts"),
                                   F.lit("m").alias("metric"), (F.col("id") % 97).cast("double").alias("value"))
    out = anomaly.iqr_bands_by_range(x, F.floor(F.datediff("ts", F.lit(T0.date())) / 10))
    assert out.count() == 20_000
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    wide = [ln for ln in plan.splitlines() if "Window" in ln and "windowspecdefinition(metric" in ln and "_range" not in ln]
    assert all("collect_list" in ln for ln in wide)          # only the table of edges is one task a series


def batch(spark, first, n):
    rows = [(T0 + dt.timedelta(minutes=15 * i), T0 + dt.timedelta(minutes=15 * i + 15), 10 + i % 3 + (200 if i % 17 == 16 else 0), 20 + i % 5,
             None if i % 7 == 0 else 0.5, 7, 3, 4) for i in range(first, first + n)]
    return spark.createDataFrame(rows, jobs.TAIL)


def test_batches_of_any_size_judge_like_the_whole_series(spark, tmp_path):
    hist, alerts = f"{tmp_path}/h", f"{tmp_path}/a"
    write = jobs.alert_batch_writer(hist, alerts)
    at = 0
    for k, size in enumerate([3, 0, 1, 20, 2, 2, 0, 9]):
        write(batch(spark, at, size), k)
        if k in (3, 5):
            write(batch(spark, at, size), k)                  # again, as after a failure
        at += size
        assert spark.read.schema(jobs.TAIL).parquet(f"{hist}_tail/{k}").count() == min(at, 7)
    whole = anomaly.live_alerts(anomaly.iqr_bands(anomaly.kpi_long(batch(spark, 0, at), jobs.STREAM_KPI_METRICS)))
    got = spark.read.parquet(alerts).drop("batch_id")
    assert sorted(map(str, got.select(whole.columns).collect())) == sorted(map(str, whole.collect()))
    assert any(r.is_alert for r in whole.collect())
    assert sorted(p.name for p in (tmp_path / "h_tail").iterdir() if not p.name.startswith(".")) == ["6", "7"]


def test_a_batch_does_not_read_the_history(spark, tmp_path):
    hist = f"{tmp_path}/h"
    write = jobs.alert_batch_writer(hist, f"{tmp_path}/a")
    write(batch(spark, 0, 10), 0)
    (tmp_path / "h" / "batch_id=0").rename(tmp_path / "elsewhere")
    write(batch(spark, 10, 2), 1)
    assert spark.read.parquet(f"{tmp_path}/a").where("batch_id = 1 and q25 is not null").count() > 0
