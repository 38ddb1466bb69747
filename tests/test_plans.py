"""Plan-shape assertions: pushdown, pruning, no Cartesian products, no
unpartitioned window over user-level rows."""

import datetime as dt

import pytest

from pulselens.operators import experiments, filters, retention
from pulselens.plans.catalog import Q
from pulselens.sources import tables

from conftest import SF001


def plan(df) -> str:
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "100000")
    return df._jdf.queryExecution().executedPlan().toString()


def test_day_filter_reaches_parquet_scan(spark):
    f = filters.on_day(tables.feed_actions(spark, SF001), dt.date(2024, 1, 31), -1)
    p = plan(f)
    assert "PushedFilters: [IsNotNull(ts), In(event_type, [click,view]), GreaterThanOrEqual(ts,2024-01-30T00:00), LessThan(ts,2024-01-31T00:00)]" in p


def test_retention_reads_only_needed_columns(spark):
    df = retention.retention(tables.feed_actions(spark, SF001), "ads", dt.date(2024, 1, 21))
    p = plan(df)
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string>" in p
    assert "props" not in p.split("ReadSchema")[1].split("\n")[0]


def test_retention_single_user_shuffle(spark):
    """One shuffle of per-user partial aggregates (by user_id) + a tiny one."""
    df = retention.retention(tables.feed_actions(spark, SF001), "ads", dt.date(2024, 1, 21))
    p = plan(df)
    assert p.count("Exchange hashpartitioning") == 2
    assert "Exchange hashpartitioning(user_id" in p


def test_mann_whitney_no_global_user_window(spark):
    users = Q["agg_user_likes_views"](spark, SF001)
    p = plan(experiments.mann_whitney(users, "ctr", 1, 2))
    # the per-value running sum is partitioned by the bucket; the only
    # unpartitioned window runs over the (bounded) bucket totals
    assert "Window [" in p and "[_bkt#" in p


@pytest.mark.parametrize("key", sorted(k for k in Q if not k.startswith("sink")))
def test_no_cartesian_products(spark, key):
    p = plan(Q[key](spark, SF001))
    assert "CartesianProduct" not in p
    assert "BroadcastNestedLoopJoin" not in p


def test_partitioned_table_prunes_days(spark, tmp_path):
    """On a table partitioned by event_date the day filter becomes a
    partition filter, and results equal the unpartitioned scan."""
    path = str(tmp_path / "feed")
    feed = tables.feed_actions(spark, SF001)
    tables.write_event_table(feed, path)
    part = tables.read_feed_table(spark, path)
    f = filters.on_day(part, dt.date(2024, 1, 31), -1)
    p = plan(f)
    assert "PartitionFilters: [isnotnull(event_date" in p and "(event_date#" in p
    a = sorted(tuple(r) for r in f.drop("event_date").collect())
    b = sorted(tuple(r) for r in filters.on_day(feed, dt.date(2024, 1, 31), -1).collect())
    assert a == b
