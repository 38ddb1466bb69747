"""Typed scans of the two product tables (feed and messages).

A production deployment points ``feed_actions``/``message_actions`` at its own
Parquet tables (partitioned by ``event_date``).  The driver's test data has an
``events`` table instead; ``feed_from_events``/``messages_from_events`` derive
the two product tables from it with pure projections, so filters on ``time``
still reach the Parquet scan as pushed filters on ``ts``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FEED_SCHEMA = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("post_id", T.LongType()),
    T.StructField("action", T.StringType()),
    T.StructField("time", T.TimestampNTZType()),
    T.StructField("gender", T.IntegerType()),
    T.StructField("age", T.IntegerType()),
    T.StructField("os", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("exp_group", T.IntegerType()),
])

MESSAGE_SCHEMA = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("reciever_id", T.LongType()),
    T.StructField("time", T.TimestampNTZType()),
    T.StructField("os", T.StringType()),
])

SLICE_SCHEMA = T.StructType([
    T.StructField("dimension", T.StringType()),
    T.StructField("dimension_value", T.StringType()),
    T.StructField("event_date", T.DateType()),
    T.StructField("likes", T.LongType()),
    T.StructField("views", T.LongType()),
    T.StructField("messages_received", T.LongType()),
    T.StructField("messages_sent", T.LongType()),
    T.StructField("users_received", T.LongType()),
    T.StructField("users_sent", T.LongType()),
])

EVENTS_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])

ORDERS_SCHEMA = T.StructType([
    T.StructField("o_orderkey", T.LongType()),
    T.StructField("o_custkey", T.LongType()),
    T.StructField("o_orderstatus", T.StringType()),
    T.StructField("o_totalprice", T.DoubleType()),
    T.StructField("o_orderdate", T.TimestampNTZType()),
    T.StructField("o_orderpriority", T.StringType()),
])


def read_table(spark: SparkSession, sf_dir: str, name: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def load_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "events", EVENTS_SCHEMA)


def _os_of(user: Column) -> Column:
    return F.when(user % 3 == 0, F.lit("iOS")).otherwise(F.lit("Android"))


def feed_from_events(events: DataFrame) -> DataFrame:
    """Feed actions from ``events``: views stay views, clicks become likes.

    Profile columns are functions of ``user_id`` (fixture mapping, FIXTURES.md 2.1).
    """
    u = F.col("user_id")
    return (events
            .where(F.col("event_type").isin("view", "click"))
            .select(
                u.alias("user_id"),
                (F.col("event_id") % 997).alias("post_id"),
                F.when(F.col("event_type") == "view", F.lit("view")).otherwise(F.lit("like")).alias("action"),
                F.col("ts").alias("time"),
                (u % 2).cast("int").alias("gender"),
                (F.lit(10) + (u * 7) % 60).cast("int").alias("age"),
                _os_of(u).alias("os"),
                F.when(u % 5 < 2, F.lit("ads")).otherwise(F.lit("organic")).alias("source"),
                ((u * 31) % 4).cast("int").alias("exp_group"),
            ))


def messages_from_events(events: DataFrame) -> DataFrame:
    """Message actions from ``events`` (purchases and signups are messages).

    The receiver is a deterministic function of the sender and the number in
    ``props``, modulo ``max(user_id)+1`` taken as a scalar subquery (no driver
    round trip).
    """
    n_users = events.select((F.max("user_id") + 1).alias("n")).scalar()
    k = F.regexp_extract(F.col("props"), r"([0-9]+)", 1).cast("bigint")
    u = F.col("user_id")
    return (events
            .where(F.col("event_type").isin("purchase", "signup"))
            .select(
                u.alias("user_id"),
                ((u * 17 + k * 13 + 1) % n_users).alias("reciever_id"),
                F.col("ts").alias("time"),
                _os_of(u).alias("os"),
            ))


def feed_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed feed scan for the driver's test layout."""
    return feed_from_events(load_events(spark, sf_dir))


def message_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages_from_events(load_events(spark, sf_dir))


def order_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sparse activity (one row per order) with the same ``user_id, time`` shape."""
    return (read_table(spark, sf_dir, "orders", ORDERS_SCHEMA)
            .select(F.col("o_custkey").alias("user_id"), F.col("o_orderdate").alias("time")))


def read_feed_table(spark: SparkSession, path: str) -> DataFrame:
    """A production ``feed_actions`` table: Parquet partitioned by ``event_date``."""
    schema = T.StructType(FEED_SCHEMA.fields + [T.StructField("event_date", T.DateType())])
    return spark.read.schema(schema).parquet(path)


def read_message_table(spark: SparkSession, path: str) -> DataFrame:
    """A production ``message_actions`` table: Parquet partitioned by ``event_date``."""
    schema = T.StructType(MESSAGE_SCHEMA.fields + [T.StructField("event_date", T.DateType())])
    return spark.read.schema(schema).parquet(path)


def write_event_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Store an event table partitioned by day (dynamic overwrite: a rewrite
    replaces only the days present).

    Rows are rebalanced by day: adaptive execution splits a day by its size in
    bytes and joins small days, so a large day has many writers, whatever its
    users, and files are of even size.  Each file is sorted by user, which
    keeps per-user aggregations reading compact runs."""
    (df.withColumn("event_date", F.to_date("time"))
       .hint("rebalance", "event_date")
       .sortWithinPartitions("event_date", "user_id")
       .write.mode(mode).option("partitionOverwriteMode", "dynamic")
       .partitionBy("event_date").parquet(path))


def all_activity(feed: DataFrame, messages: DataFrame) -> DataFrame:
    """``UNION ALL`` of feed and message activity as ``(date, user_id, os)``."""
    cols = [F.to_date("time").alias("date"), "user_id", "os"]
    return feed.select(*cols).unionByName(messages.select(*cols))
