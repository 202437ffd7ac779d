"""Reference SQL (DuckDB dialect) for every catalogued query.

The SQL restates each operator's semantics independently of the Spark code so the two can
be compared on the driver's tables. A shared prelude of CTEs mirrors the pipeline:
raw_trips -> conformed -> valid -> accepted -> silver -> fact, plus the dimensions.

``R(x, k)`` rounds like Spark's ``round`` on DOUBLE: half-up on the value's shortest
decimal representation (DuckDB's native ``round`` works on the binary value, so 1.005
would become 1.0 there and 1.01 in Spark).
"""

from __future__ import annotations

from tripmart.sources.adapter import RAW_TRIPS_SQL, RAW_ZONE_SQL

# Fixed values, stated here once more so that a wrong one in the library shows.
DATASET_NAME = "yellow_tripdata"
TRIP_KEYS = ("vendor_id", "pickup_datetime", "dropoff_datetime", "pu_location_id", "do_location_id", "total_amount")
RATE_CODE_SEED = [
    (0, 99, "Unknown / Unassigned"), (1, 1, "Standar rate"), (2, 2, "JFK"), (3, 3, "Newark"),
    (4, 4, "Nassau or Westchester"), (5, 5, "Negotiated fare"), (6, 6, "Group ride"),
]
PAYMENT_TYPE_SEED = [
    (0, 0, "Unknown / Flex Fare"), (1, 1, "Credit card"), (2, 2, "Cash"), (3, 3, "No charge"),
    (4, 4, "Dispute"), (5, 5, "Unknown"), (6, 6, "Voided trip"),
]
VENDOR_SEED = [(0, 0, "Unknown Vendor"), (1, 1, "Creative Mobile Technologies, LLC"), (2, 2, "VeriFone Inc.")]
FACT_FOREIGN_KEYS = [
    ("pickup_date_key", "dim_date", "date_key"), ("dropoff_date_key", "dim_date", "date_key"),
    ("pickup_location_key", "dim_location", "location_key"), ("dropoff_location_key", "dim_location", "location_key"),
    ("rate_code_key", "dim_rate_code", "rate_code_key"), ("payment_type_key", "dim_payment_type", "payment_type_key"),
    ("vendor_key", "dim_vendor", "vendor_key"),
]
DIM_KEYS = {
    "dim_date": "date_key", "dim_location": "location_key", "dim_rate_code": "rate_code_key",
    "dim_payment_type": "payment_type_key", "dim_vendor": "vendor_key",
}
VARCHAR_LIMITS = [
    ("dim_date", "day_name", 10), ("dim_date", "month_name", 10), ("dim_location", "borough", 50),
    ("dim_location", "zone", 100), ("dim_location", "service_zone", 50), ("dim_rate_code", "rate_code_name", 50),
    ("dim_payment_type", "payment_type_name", 50), ("dim_vendor", "vendor_name", 100),
    ("fact_trip", "store_and_fwd_flag", 1), ("fact_trip", "pipeline_run_id", 100),
]

MONEY_COLS = [
    "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
    "improvement_surcharge", "total_amount",
]
# Conformed non-key columns in frame order: the dedupe survivor is the smallest row by these.
DEDUPE_ORDER = [
    "passenger_count", "trip_distance", "rate_code_id", "store_and_fwd_flag", "payment_type",
    "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge",
    "congestion_surcharge", "airport_fee",
]


def R(expr: str, k: int = 2) -> str:
    return f"CAST(ROUND(CAST(CAST(({expr}) AS VARCHAR) AS DECIMAL(38,20)), {k}) AS DOUBLE)"


def M6(col: str) -> str:
    """Mean of 2-decimal values, exact, 6 decimals (Spark avg over DECIMAL(20,2))."""
    return R(f"CAST(SUM(CAST({col} AS DECIMAL(20,2))) AS DOUBLE) / COUNT({col})", 6)


def money_as_double(cols=MONEY_COLS) -> str:
    return "* REPLACE (" + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in cols) + ")"


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(repr(v) if isinstance(v, str) else str(v) for v in r) + ")" for r in rows)


def _seed(name: str, rows, prefix: str) -> str:
    return (
        f"{name} AS (SELECT CAST(k AS INTEGER) AS {prefix}_key, CAST(i AS INTEGER) AS {prefix}_id, "
        f"CAST(n AS VARCHAR) AS {prefix}_name FROM (VALUES {_values(rows)}) t(k, i, n))"
    )


CONFORMED_SQL = """conformed AS (
    SELECT
        TRY_CAST(VendorID AS INTEGER) AS vendor_id,
        TRY_CAST(tpep_pickup_datetime AS TIMESTAMP) AS pickup_datetime,
        TRY_CAST(tpep_dropoff_datetime AS TIMESTAMP) AS dropoff_datetime,
        COALESCE(TRY_CAST(passenger_count AS INTEGER), 0) AS passenger_count,
        TRY_CAST(trip_distance AS DOUBLE) AS trip_distance,
        COALESCE(TRY_CAST(RatecodeID AS INTEGER), 99) AS rate_code_id,
        COALESCE(TRY_CAST(store_and_fwd_flag AS VARCHAR), 'N') AS store_and_fwd_flag,
        TRY_CAST(PULocationID AS INTEGER) AS pu_location_id,
        TRY_CAST(DOLocationID AS INTEGER) AS do_location_id,
        TRY_CAST(payment_type AS INTEGER) AS payment_type,
        TRY_CAST(fare_amount AS DECIMAL(10,2)) AS fare_amount,
        TRY_CAST(extra AS DECIMAL(10,2)) AS extra,
        TRY_CAST(mta_tax AS DECIMAL(10,2)) AS mta_tax,
        TRY_CAST(tip_amount AS DECIMAL(10,2)) AS tip_amount,
        TRY_CAST(tolls_amount AS DECIMAL(10,2)) AS tolls_amount,
        TRY_CAST(improvement_surcharge AS DECIMAL(10,2)) AS improvement_surcharge,
        TRY_CAST(total_amount AS DECIMAL(10,2)) AS total_amount,
        COALESCE(TRY_CAST(congestion_surcharge AS DOUBLE), 0.0) AS congestion_surcharge,
        COALESCE(TRY_CAST(Airport_fee AS DOUBLE), 0.0) AS airport_fee,
        year,
        month
    FROM raw_trips
)"""


def _conformed(raw: str) -> str:
    return CONFORMED_SQL.replace("FROM raw_trips", f"FROM {raw}")


def prelude(calendar: tuple[str, str] | None, run_id: str, processed_at: str, raw: str = "raw_trips") -> list[str]:
    """The pipeline's CTEs from the frame ``raw``, with the calendar of the given days or of
    the whole years that the trips span."""
    keys = ", ".join(["year", "month", *TRIP_KEYS])
    order = ", ".join(f"{c} NULLS FIRST" for c in DEDUPE_ORDER)
    if calendar is None:
        days = (
            "SELECT CAST(date_trunc('year', MIN(LEAST(tpep_pickup_datetime, tpep_dropoff_datetime))) AS DATE) AS lo, "
            "make_date(year(MAX(GREATEST(tpep_pickup_datetime, tpep_dropoff_datetime))), 12, 31) AS hi FROM raw_trips"
        )
    else:
        days = f"SELECT DATE '{calendar[0]}' AS lo, DATE '{calendar[1]}' AS hi"
    return [
        RAW_TRIPS_SQL.strip(),
        RAW_ZONE_SQL.strip(),
        _conformed(raw),
        """valid AS (
    SELECT * FROM conformed
    WHERE pickup_datetime >= make_timestamp(year, month, 1, 0, 0, 0)
      AND pickup_datetime < make_timestamp(year, month, 1, 0, 0, 0) + INTERVAL 1 MONTH
      AND dropoff_datetime > pickup_datetime
      AND trip_distance >= 0 AND trip_distance < 500
)""",
        f"""accepted AS (
    SELECT * EXCLUDE (_rn) FROM (
        SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS _rn FROM valid
    ) WHERE _rn = 1
)""",
        f"""silver AS (
    SELECT * EXCLUDE (year, month),
        printf('{DATASET_NAME}_%04d-%02d.parquet', year, month) AS source_file,
        CAST(year AS SMALLINT) AS source_year,
        CAST(month AS SMALLINT) AS source_month,
        '{processed_at}' AS processed_at_utc,
        '{run_id}' AS pipeline_run_id
    FROM accepted
)""",
        """fact AS (
    SELECT
        CAST(year(pickup_datetime) * 10000 + month(pickup_datetime) * 100 + day(pickup_datetime) AS INTEGER) AS pickup_date_key,
        CAST(year(dropoff_datetime) * 10000 + month(dropoff_datetime) * 100 + day(dropoff_datetime) AS INTEGER) AS dropoff_date_key,
        CAST(COALESCE(pu_location_id, 0) AS INTEGER) AS pickup_location_key,
        CAST(COALESCE(do_location_id, 0) AS INTEGER) AS dropoff_location_key,
        CAST(CASE WHEN rate_code_id IN (1, 2, 3, 4, 5, 6) THEN rate_code_id ELSE 0 END AS INTEGER) AS rate_code_key,
        CAST(CASE WHEN payment_type IN (1, 2, 3, 4, 5, 6) THEN payment_type ELSE 0 END AS INTEGER) AS payment_type_key,
        CAST(CASE WHEN vendor_id IN (1, 2) THEN vendor_id ELSE 0 END AS INTEGER) AS vendor_key,
        store_and_fwd_flag, pickup_datetime, dropoff_datetime, passenger_count, trip_distance,
        CAST(floor(epoch(dropoff_datetime)) AS BIGINT) - CAST(floor(epoch(pickup_datetime)) AS BIGINT) AS trip_duration_seconds,
        fare_amount, extra, mta_tax, tip_amount, tolls_amount, improvement_surcharge,
        congestion_surcharge, airport_fee, total_amount,
        source_year, source_month, pipeline_run_id
    FROM silver
)""",
        f"""dim_date AS (
    SELECT
        CAST(year(d) * 10000 + month(d) * 100 + day(d) AS INTEGER) AS date_key,
        d AS full_date,
        CAST(isodow(d) AS INTEGER) AS day_of_week,
        dayname(d) AS day_name,
        CAST(day(d) AS INTEGER) AS day_of_month,
        CAST(month(d) AS INTEGER) AS month,
        monthname(d) AS month_name,
        CAST(quarter(d) AS INTEGER) AS quarter,
        CAST(year(d) AS INTEGER) AS year,
        isodow(d) >= 6 AS is_weekend
    FROM (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d FROM ({days}))
)""",
        """zones AS (
    SELECT
        TRY_CAST(LocationID AS INTEGER) AS location_id,
        COALESCE(Borough, 'Unknown') AS borough,
        COALESCE(Zone, 'Unknown') AS zone,
        COALESCE(service_zone, 'Unknown') AS service_zone
    FROM raw_zone
)""",
        """dim_location AS (
    SELECT location_key, location_id, borough, zone, service_zone FROM (
        SELECT location_id AS location_key, location_id, borough, zone, service_zone,
            row_number() OVER (PARTITION BY location_id ORDER BY location_id NULLS FIRST,
                borough NULLS FIRST, zone NULLS FIRST, service_zone NULLS FIRST) AS _rn
        FROM zones
    ) WHERE _rn = 1
)""",
        _seed("dim_rate_code", RATE_CODE_SEED, "rate_code"),
        _seed("dim_payment_type", PAYMENT_TYPE_SEED, "payment_type"),
        _seed("dim_vendor", VENDOR_SEED, "vendor"),
    ]


def with_ctes(pre: list[str], body: str, extra: list[str] | None = None) -> str:
    return "WITH " + ",\n".join(pre + (extra or [])) + "\n" + body
