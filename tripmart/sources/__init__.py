"""Readers, landing audit and period bookkeeping."""

from tripmart.sources.manifest import (
    file_manifest,
    pending_periods,
    period_spine,
    period_spine_of,
)
from tripmart.sources.raw import (
    period_dir,
    read_period_leaf,
    read_raw_trips,
    read_zone_lookup_csv,
    trip_file_name,
    trip_file_name_col,
    write_bronze,
    write_zone_lookup_csv,
)

__all__ = [
    "file_manifest",
    "pending_periods",
    "period_dir",
    "period_spine",
    "period_spine_of",
    "read_period_leaf",
    "read_raw_trips",
    "read_zone_lookup_csv",
    "trip_file_name",
    "trip_file_name_col",
    "write_bronze",
    "write_zone_lookup_csv",
]
