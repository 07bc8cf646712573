"""Incremental and look-back predicates (pushed to the Parquet scan)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hypeline.constants import POST_LOOKBACK_HOURS


def _lit(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def _as_date(v) -> Column:
    if isinstance(v, str):
        v = _dt.date.fromisoformat(v)
    return _lit(v)


def since(df: DataFrame, column: str, run_dt, lookback_days: int = 0, day: str | None = None) -> DataFrame:
    """``CAST(column AS DATE) >= run_dt - lookback_days``.

    Under ANSI a malformed date string raises instead of silently dropping.

    ``day`` names a partition column that holds the same date, or NULL where
    ``column`` is no date (or the table has no partitions): the scan then reads
    the partitions from the bound on and the NULL one, whose rows are cast
    as strictly as before.
    """
    bound = _as_date(run_dt)
    if lookback_days:
        bound = F.date_sub(bound, lookback_days)
    if day is not None:
        df = df.where(F.col(day).isNull() | (F.col(day) >= bound))
    return df.where(F.col(column).cast("date") >= bound)


def where_date(df: DataFrame, column: str, d) -> DataFrame:
    """Keep one calendar day."""
    return df.where(F.col(column).cast("date") == _as_date(d))


def rolling_lookback(df: DataFrame, ts: str, as_of, hours: int = POST_LOOKBACK_HOURS, until=None) -> DataFrame:
    """Rows created at ``as_of - hours`` or later.

    The reference walks newest-first and stops at the first row older than
    the cutoff, so the cutoff instant itself is kept, and so is a row newer
    than ``as_of`` (a batch stamp may be taken before the fetch ends).
    ``until`` adds an upper bound, itself kept, where history is replayed.
    """
    rows = df.where(F.col(ts) >= _lit(as_of) - F.expr(f"INTERVAL {int(hours)} HOURS"))
    return rows if until is None else rows.where(F.col(ts) <= _lit(until))
