"""Column-level building blocks (all built-in Spark expressions, codegen-friendly)."""

from tripmart.functions.calendar import (
    date_key,
    day_label,
    day_name,
    is_weekend,
    iso_weekday,
    month_index,
    month_name,
    period_label,
)
from tripmart.functions.keys import key_or_unknown, month_window, own_period_window
from tripmart.functions.measures import (
    avg_exact,
    duration_seconds,
    growth_pct,
    mean_2dp,
    pct,
    ratio_pct,
)

__all__ = [
    "avg_exact",
    "date_key",
    "day_label",
    "day_name",
    "duration_seconds",
    "growth_pct",
    "is_weekend",
    "iso_weekday",
    "key_or_unknown",
    "mean_2dp",
    "month_index",
    "month_name",
    "month_window",
    "own_period_window",
    "pct",
    "period_label",
    "ratio_pct",
]
