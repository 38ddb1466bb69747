"""Date/time expressions.  Ranges are half-open on the raw ``time`` column so
Parquet/partition pruning applies (no function is wrapped around the column)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def as_date(d) -> dt.date:
    if isinstance(d, dt.datetime):
        return d.date()
    if isinstance(d, dt.date):
        return d
    return dt.date.fromisoformat(str(d)[:10])


def as_datetime(ts) -> dt.datetime:
    if isinstance(ts, dt.datetime):
        return ts
    if isinstance(ts, dt.date):
        return dt.datetime(ts.year, ts.month, ts.day)
    return dt.datetime.fromisoformat(str(ts))


def ts_lit(value, like: T.DataType | None = None) -> Column:
    """A timestamp literal typed like the column it is compared with."""
    v = as_datetime(value)
    target = "timestamp_ntz" if like is None or isinstance(like, T.TimestampNTZType) else "timestamp"
    if isinstance(like, T.DateType):
        return F.lit(v.date())
    return F.lit(v.strftime("%Y-%m-%d %H:%M:%S.%f")).cast(target)


def col_type(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def time_range(df: DataFrame, start, end, col: str = "time", partition_col: str = "event_date") -> DataFrame:
    """Rows with ``start <= col < end`` (datetimes or dates).

    When the table carries a date partition column (``event_date``), the
    equivalent day range is added on it too, so whole partitions are pruned
    at planning time, not only Parquet row groups."""
    t = col_type(df, col)
    out = df.where((F.col(col) >= ts_lit(start, t)) & (F.col(col) < ts_lit(end, t)))
    if partition_col in df.columns and isinstance(col_type(df, partition_col), T.DateType):
        first = as_datetime(start).date()
        last = (as_datetime(end) - dt.timedelta(microseconds=1)).date()
        out = out.where((F.col(partition_col) >= F.lit(first)) & (F.col(partition_col) <= F.lit(last)))
    return out


def monday(c) -> Column:
    """``toMonday``: the Monday of the week (ISO weeks, Monday first)."""
    return F.date_trunc("week", F.to_date(c)).cast("date")


def floor_15min(c) -> Column:
    """``toStartOfFifteenMinutes``: start of the 15-minute window."""
    return F.window(c, "15 minutes").start


def hour_minute(c) -> Column:
    """``formatDateTime(ts, '%R')``."""
    return F.date_format(c, "HH:mm")


def dmy(c) -> Column:
    """``strftime('%d-%m-%Y')``."""
    return F.date_format(c, "dd-MM-yyyy")


def ymd(c) -> Column:
    """``toString(date)``."""
    return F.date_format(c, "yyyy-MM-dd")
