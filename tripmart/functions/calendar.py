"""Calendar expressions: yyyyMMdd keys, ISO weekday, English names, labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def date_key(col: str | Column) -> Column:
    """yyyyMMdd of a date/timestamp as INT (arithmetic form, no string round trip)."""
    c = _c(col)
    return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("int")


def iso_weekday(col: str | Column) -> Column:
    """ISO day of week, Monday = 1 ... Sunday = 7."""
    return (F.weekday(_c(col)) + 1).cast("int")


def is_weekend(col: str | Column) -> Column:
    return F.weekday(_c(col)) >= 5


def day_name(col: str | Column) -> Column:
    return F.date_format(_c(col), "EEEE")


def month_name(col: str | Column) -> Column:
    return F.date_format(_c(col), "MMMM")


def month_index(year: str | Column, month: str | Column) -> Column:
    """Months since year 0: consecutive calendar months differ by exactly 1."""
    return _c(year) * 12 + _c(month)


def period_label(month_name_col: str | Column, year: str | Column) -> Column:
    """'January 2024'. NULL when either part is NULL."""
    return F.concat(_c(month_name_col), F.lit(" "), _c(year).cast("string"))


def day_label(month_name_col: str | Column, day_of_month: str | Column) -> Column:
    """'Jan 7'. NULL when either part is NULL."""
    return F.concat(
        F.substring(_c(month_name_col), 1, 3), F.lit(" "), _c(day_of_month).cast("string")
    )
