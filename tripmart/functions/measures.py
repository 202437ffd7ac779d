"""Measure expressions: durations, exact averages, zero-safe ratios and growth."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def duration_seconds(start: str | Column, end: str | Column) -> Column:
    """Whole-second epoch difference (each side floored), BIGINT.

    On TIMESTAMP_NTZ inputs ``unix_timestamp`` is zone-independent, so DST never shifts it.
    """
    return (F.unix_timestamp(_c(end)) - F.unix_timestamp(_c(start))).cast("long")


def avg_exact(col: str | Column) -> Column:
    """Average as DOUBLE computed from an exact sum: ``double(sum(col)) / count(col)``.

    For DECIMAL money columns the sum is exact, so the result does not depend on the
    order in which partitions are combined.
    """
    c = _c(col)
    return F.try_divide(F.sum(c).cast("double"), F.count(c))


def mean_2dp(col: str | Column) -> Column:
    """Unweighted mean of values that carry 2 decimals (e.g. already-rounded averages).

    Summed as DECIMAL so the result is independent of partition order; DOUBLE out.
    """
    return F.avg(_c(col).cast("decimal(20,2)")).cast("double")


def ratio_pct(num: str | Column, den: str | Column, scale: int = 2) -> Column:
    """``round(double(num) / nullif(den, 0) * 100, scale)``; NULL when den is 0 or NULL."""
    return F.round(F.try_divide(_c(num).cast("double"), _c(den)) * F.lit(100.0), scale)


def growth_pct(cur: str | Column, prev: str | Column, scale: int = 2) -> Column:
    """Period-over-period growth in percent, zero/NULL-safe on the previous value."""
    return F.round(
        F.try_divide((_c(cur) - _c(prev)).cast("double"), _c(prev)) * F.lit(100.0), scale
    )


def pct(part: str | Column, whole: str | Column, scale: int = 2) -> Column:
    """Share in percent; 0.0 when ``whole`` is 0 (empty input)."""
    return F.coalesce(
        F.round(F.try_divide(_c(part).cast("double"), _c(whole)) * F.lit(100.0), scale),
        F.lit(0.0),
    )
