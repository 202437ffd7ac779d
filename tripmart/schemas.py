"""Specs and table schemas.

The operators in ``tripmart.operators`` are generic and driven by small spec objects
(``ConformSpec``, ``KeyMap``, ``Rule``). The trip-record instances of those specs live
here, together with the target table schemas.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# ---------------------------------------------------------------------------------------
# Generic spec types
# ---------------------------------------------------------------------------------------


@dataclass(frozen=True)
class ConformSpec:
    """Rename map, null-imputation defaults and target types for a raw feed."""

    rename: dict[str, str]
    types: dict[str, T.DataType]
    defaults: dict[str, object] = field(default_factory=dict)


@dataclass(frozen=True)
class KeyMap:
    """Map a code column onto a dimension key: allowed codes pass, anything else -> unknown."""

    column: str
    allowed: tuple[int, ...] | None
    unknown: int = 0


# ---------------------------------------------------------------------------------------
# These must equal the trip feed's published layout and the warehouse
# definitions exactly (column names, types, defaults, seed rows, code domains, limits).
# ---------------------------------------------------------------------------------------

TRIP_RENAME = {
    "VendorID": "vendor_id",
    "tpep_pickup_datetime": "pickup_datetime",
    "tpep_dropoff_datetime": "dropoff_datetime",
    "passenger_count": "passenger_count",
    "trip_distance": "trip_distance",
    "RatecodeID": "rate_code_id",
    "store_and_fwd_flag": "store_and_fwd_flag",
    "PULocationID": "pu_location_id",
    "DOLocationID": "do_location_id",
    "payment_type": "payment_type",
    "fare_amount": "fare_amount",
    "extra": "extra",
    "mta_tax": "mta_tax",
    "tip_amount": "tip_amount",
    "tolls_amount": "tolls_amount",
    "improvement_surcharge": "improvement_surcharge",
    "total_amount": "total_amount",
    "congestion_surcharge": "congestion_surcharge",
    "Airport_fee": "airport_fee",
}

MONEY = T.DecimalType(10, 2)

# Trip timestamps are wall-clock values without a zone: TIMESTAMP_NTZ keeps them stable
# under any session time zone (no DST shifts in durations or date keys).
TRIP_TYPES: dict[str, T.DataType] = {
    "pickup_datetime": T.TimestampNTZType(),
    "dropoff_datetime": T.TimestampNTZType(),
    "passenger_count": T.IntegerType(),
    "trip_distance": T.DoubleType(),
    "rate_code_id": T.IntegerType(),
    "store_and_fwd_flag": T.StringType(),
    "pu_location_id": T.IntegerType(),
    "do_location_id": T.IntegerType(),
    "payment_type": T.IntegerType(),
    "fare_amount": MONEY,
    "extra": MONEY,
    "mta_tax": MONEY,
    "tip_amount": MONEY,
    "tolls_amount": MONEY,
    "improvement_surcharge": MONEY,
    "total_amount": MONEY,
    "congestion_surcharge": T.DoubleType(),
    "airport_fee": T.DoubleType(),
    "vendor_id": T.IntegerType(),
}

TRIP_DEFAULTS = {
    "passenger_count": 0,
    "rate_code_id": 99,
    "store_and_fwd_flag": "N",
    "congestion_surcharge": 0.0,
    "airport_fee": 0.0,
}

TRIP_SPEC = ConformSpec(rename=TRIP_RENAME, types=TRIP_TYPES, defaults=TRIP_DEFAULTS)

# Business key of one trip, used for deduplication and the fact uniqueness contract.
TRIP_KEYS = (
    "vendor_id",
    "pickup_datetime",
    "dropoff_datetime",
    "pu_location_id",
    "do_location_id",
    "total_amount",
)

# Valid trip distance: 0 <= distance < 500 miles.
MIN_DISTANCE = 0.0
MAX_DISTANCE = 500.0

DATASET_NAME = "yellow_tripdata"

# Quality gate: at least 1000 accepted rows and a rejection rate of at most 5.0 percent.
GATE_MIN_ROWS = 1000
GATE_MAX_REJECT_PCT = 5.0

# Code domains of the seeded dimensions; anything else maps to key 0.
VENDOR_KEYS = KeyMap("vendor_id", (1, 2))
RATE_CODE_KEYS = KeyMap("rate_code_id", (1, 2, 3, 4, 5, 6))
PAYMENT_TYPE_KEYS = KeyMap("payment_type", (1, 2, 3, 4, 5, 6))

# Seed rows (key, natural id, name); key 0 is the unknown member.
RATE_CODE_SEED = [
    (0, 99, "Unknown / Unassigned"),
    (1, 1, "Standar rate"),
    (2, 2, "JFK"),
    (3, 3, "Newark"),
    (4, 4, "Nassau or Westchester"),
    (5, 5, "Negotiated fare"),
    (6, 6, "Group ride"),
]
PAYMENT_TYPE_SEED = [
    (0, 0, "Unknown / Flex Fare"),
    (1, 1, "Credit card"),
    (2, 2, "Cash"),
    (3, 3, "No charge"),
    (4, 4, "Dispute"),
    (5, 5, "Unknown"),
    (6, 6, "Voided trip"),
]
VENDOR_SEED = [
    (0, 0, "Unknown Vendor"),
    (1, 1, "Creative Mobile Technologies, LLC"),
    (2, 2, "VeriFone Inc."),
]

# Zone lookup: raw header -> conformed name; missing text attributes become "Unknown".
ZONE_RENAME = {
    "LocationID": "location_id",
    "Borough": "borough",
    "Zone": "zone",
    "service_zone": "service_zone",
}
UNKNOWN_TEXT = "Unknown"

# Default calendar range of the date dimension.
CALENDAR_START = "2020-01-01"
CALENDAR_END = "2030-12-31"

# varchar limits declared by the warehouse tables: (table, column, max length).
VARCHAR_LIMITS = [
    ("dim_date", "day_name", 10),
    ("dim_date", "month_name", 10),
    ("dim_location", "borough", 50),
    ("dim_location", "zone", 100),
    ("dim_location", "service_zone", 50),
    ("dim_rate_code", "rate_code_name", 50),
    ("dim_payment_type", "payment_type_name", 50),
    ("dim_vendor", "vendor_name", 100),
    ("fact_trip", "store_and_fwd_flag", 1),
    ("fact_trip", "pipeline_run_id", 100),
]

# ---------------------------------------------------------------------------------------
# Target schemas
# ---------------------------------------------------------------------------------------

RAW_ZONE_SCHEMA = T.StructType(
    [
        T.StructField("LocationID", T.StringType()),
        T.StructField("Borough", T.StringType()),
        T.StructField("Zone", T.StringType()),
        T.StructField("service_zone", T.StringType()),
    ]
)

DIM_DATE_SCHEMA = T.StructType(
    [
        T.StructField("date_key", T.IntegerType()),
        T.StructField("full_date", T.DateType()),
        T.StructField("day_of_week", T.IntegerType()),
        T.StructField("day_name", T.StringType()),
        T.StructField("day_of_month", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("month_name", T.StringType()),
        T.StructField("quarter", T.IntegerType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("is_weekend", T.BooleanType()),
    ]
)

DIM_LOCATION_SCHEMA = T.StructType(
    [
        T.StructField("location_key", T.IntegerType()),
        T.StructField("location_id", T.IntegerType()),
        T.StructField("borough", T.StringType()),
        T.StructField("zone", T.StringType()),
        T.StructField("service_zone", T.StringType()),
    ]
)

FACT_COLUMNS = [
    ("pickup_date_key", T.IntegerType()),
    ("dropoff_date_key", T.IntegerType()),
    ("pickup_location_key", T.IntegerType()),
    ("dropoff_location_key", T.IntegerType()),
    ("rate_code_key", T.IntegerType()),
    ("payment_type_key", T.IntegerType()),
    ("vendor_key", T.IntegerType()),
    ("store_and_fwd_flag", T.StringType()),
    ("pickup_datetime", T.TimestampNTZType()),
    ("dropoff_datetime", T.TimestampNTZType()),
    ("passenger_count", T.IntegerType()),
    ("trip_distance", T.DoubleType()),
    ("trip_duration_seconds", T.LongType()),
    ("fare_amount", MONEY),
    ("extra", MONEY),
    ("mta_tax", MONEY),
    ("tip_amount", MONEY),
    ("tolls_amount", MONEY),
    ("improvement_surcharge", MONEY),
    ("congestion_surcharge", T.DoubleType()),
    ("airport_fee", T.DoubleType()),
    ("total_amount", MONEY),
    ("source_year", T.ShortType()),
    ("source_month", T.ShortType()),
    ("pipeline_run_id", T.StringType()),
    ("inserted_at_utc", T.TimestampType()),
]
# The warehouse table: the key, then the columns above.
FACT_SCHEMA = T.StructType([T.StructField(n, t) for n, t in [("trip_key", T.StringType()), *FACT_COLUMNS]])

# Foreign keys of the fact: (fact column, dimension table, dimension key).
FACT_FOREIGN_KEYS = [
    ("pickup_date_key", "dim_date", "date_key"),
    ("dropoff_date_key", "dim_date", "date_key"),
    ("pickup_location_key", "dim_location", "location_key"),
    ("dropoff_location_key", "dim_location", "location_key"),
    ("rate_code_key", "dim_rate_code", "rate_code_key"),
    ("payment_type_key", "dim_payment_type", "payment_type_key"),
    ("vendor_key", "dim_vendor", "vendor_key"),
]

# Primary keys of the dimensions.
DIM_KEYS = {
    "dim_date": "date_key",
    "dim_location": "location_key",
    "dim_rate_code": "rate_code_key",
    "dim_payment_type": "payment_type_key",
    "dim_vendor": "vendor_key",
}

QUALITY_REPORT_SCHEMA = T.StructType(
    [
        T.StructField("dataset", T.StringType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("total_input_rows", T.LongType()),
        T.StructField("accepted_rows", T.LongType()),
        T.StructField("rejected_rows", T.LongType()),
        T.StructField("acceptance_rate_pct", T.DoubleType()),
        T.StructField("processed_at_utc", T.StringType()),
    ]
)

MANIFEST_SCHEMA = T.StructType(
    [
        T.StructField("dataset", T.StringType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("source_path", T.StringType()),
        T.StructField("file_size_bytes", T.LongType()),
        T.StructField("sha256_checksum", T.StringType()),
        T.StructField("modified_at", T.TimestampType()),
        T.StructField("status", T.StringType()),
    ]
)
