"""Row filters (B1-B7).  All time filters are half-open ranges on the raw
timestamp column, so they reach the Parquet scan as pushed filters and prune
``event_date`` partitions; no function is applied to the column."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulselens.functions.timeexpr import as_date, as_datetime, time_range


def on_day(df: DataFrame, as_of, offset: int = -1, col: str = "time") -> DataFrame:
    """Rows of the day ``as_of + offset`` (``toDate(time) = today() - 1``)."""
    d = as_date(as_of) + dt.timedelta(days=offset)
    return time_range(df, d, d + dt.timedelta(days=1), col)


def last_days(df: DataFrame, as_of, n: int = 7, col: str = "time") -> DataFrame:
    """Rows of the ``n`` whole days before ``as_of`` (``BETWEEN today()-n AND today()-1``)."""
    end = as_date(as_of)
    return time_range(df, end - dt.timedelta(days=n), end, col)


def fixed_period(df: DataFrame, first_day, last_day, col: str = "time") -> DataFrame:
    """Closed date range ``[first_day, last_day]``, e.g. an experiment window."""
    return time_range(df, as_date(first_day), as_date(last_day) + dt.timedelta(days=1), col)


def closed_windows(df: DataFrame, as_of, history_days: int = 1, minutes: int = 15,
                   col: str = "time") -> DataFrame:
    """From midnight ``history_days`` before ``as_of`` up to the start of the
    current (still open) ``minutes`` window, so only complete windows remain."""
    t = as_datetime(as_of)
    start = dt.datetime.combine(t.date() - dt.timedelta(days=history_days), dt.time())
    end = window_floor(t, minutes)
    return time_range(df, start, end, col)


def window_floor(t: dt.datetime, minutes: int = 15) -> dt.datetime:
    m = (t.hour * 60 + t.minute) // minutes * minutes
    return dt.datetime.combine(t.date(), dt.time()) + dt.timedelta(minutes=m)


def segment(df: DataFrame, **conds) -> DataFrame:
    """Equality / ``IN`` filters: ``segment(df, source='ads', exp_group=[1, 2])``."""
    for name, val in conds.items():
        if isinstance(val, (list, tuple, set)):
            df = df.where(F.col(name).isin(list(val)))
        else:
            df = df.where(F.col(name) == F.lit(val))
    return df
