"""Key mapping and period-window predicates."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripmart.schemas import KeyMap


def key_or_unknown(spec: KeyMap) -> Column:
    """Allowed code -> itself, anything else (incl. NULL) -> the unknown key, as INT.

    ``allowed=None`` means "any non-null code" (null -> unknown).
    """
    c = F.col(spec.column)
    if spec.allowed is None:
        return F.coalesce(c, F.lit(spec.unknown)).cast("int")
    return F.when(c.isin(*spec.allowed), c).otherwise(F.lit(spec.unknown)).cast("int")


def month_bounds(year: int, month: int) -> tuple[dt.datetime, dt.datetime]:
    """Half-open [first of month, first of next month); December rolls into next year."""
    start = dt.datetime(year, month, 1)
    end = dt.datetime(year + 1, 1, 1) if month == 12 else dt.datetime(year, month + 1, 1)
    return start, end


def month_window(col: str | Column, year: int, month: int) -> Column:
    """``start <= col < end`` with TIMESTAMP_NTZ literals (pushed down to the parquet scan)."""
    c = F.col(col) if isinstance(col, str) else col
    start, end = month_bounds(year, month)
    lo = F.lit(start.isoformat(sep=" ")).cast("timestamp_ntz")
    hi = F.lit(end.isoformat(sep=" ")).cast("timestamp_ntz")
    return (c >= lo) & (c < hi)


def own_period_window(col: str | Column, year_col: str, month_col: str) -> Column:
    """Month window where each row carries its own period (e.g. bronze ``year=/month=`` dirs).

    Used when many monthly files are processed in one job: every row is checked against
    the month of the file it came from.
    """
    c = F.col(col) if isinstance(col, str) else col
    # An impossible period (e.g. a stray month=13 directory) yields NULL -> row rejected,
    # instead of failing the whole job.
    start = F.try_make_timestamp_ntz(
        F.col(year_col), F.col(month_col), F.lit(1), F.lit(0), F.lit(0), F.lit(0)
    )
    end = start + F.expr("INTERVAL 1 MONTH")
    return (c >= start) & (c < end)
