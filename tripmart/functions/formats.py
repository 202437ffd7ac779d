"""Display formats for report tables (report layer only; never used in measures)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def fmt_count(col: str | Column, missing: str = "-") -> Column:
    """1234567 -> '1,234,567'."""
    return F.coalesce(F.format_number(_c(col).cast("double"), 0), F.lit(missing))


def fmt_usd(col: str | Column, missing: str = "-") -> Column:
    """1234.5 -> '$1,234.50'."""
    return F.coalesce(
        F.concat(F.lit("$"), F.format_number(_c(col).cast("double"), 2)), F.lit(missing)
    )


def fmt_pct(col: str | Column, missing: str = "-") -> Column:
    """12.34 -> '12.34%'."""
    return F.coalesce(F.format_string("%.2f%%", _c(col).cast("double")), F.lit(missing))


def fmt_growth(col: str | Column, baseline: str = "Baseline") -> Column:
    """Signed growth with one decimal: 3.21 -> '+3.2%'; NULL -> 'Baseline'."""
    c = _c(col).cast("double")
    return F.when(c.isNull() | F.isnan(c), F.lit(baseline)).otherwise(
        F.format_string("%+.1f%%", c)
    )
