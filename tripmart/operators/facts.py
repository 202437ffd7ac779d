"""Trip fact: fixed 26-column projection with unknown-key protection.

The fact is a pure projection of the accepted trips (no join, no shuffle): date keys are
computed from timestamps, code dimensions are keyed by domain checks, missing locations
fall back to key 0. ``key_by_lookup`` is the join-based alternative that also maps ids
absent from the dimension to 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.functions.calendar import date_key
from tripmart.functions.keys import key_or_unknown
from tripmart.functions.measures import duration_seconds
from tripmart.operators.dedupe import dedupe
from tripmart.schemas import (
    FACT_COLUMNS,
    PAYMENT_TYPE_KEYS,
    RATE_CODE_KEYS,
    TRIP_KEYS,
    VENDOR_KEYS,
    KeyMap,
)

PICKUP_LOCATION_KEYS = KeyMap("pu_location_id", None)
DROPOFF_LOCATION_KEYS = KeyMap("do_location_id", None)


def build_fact(silver: DataFrame, with_trip_key: bool = False) -> DataFrame:
    """Project accepted, lineage-enriched trips onto the fact schema.

    ``with_trip_key`` prepends ``trip_key``, the 128-bit MD5 of period and business key as
    text: stable across reruns (unlike ``monotonically_increasing_id``), computed without a
    global sort, and wide enough that chance collisions stay away at any number of trips.
    """
    exprs = {
        "pickup_date_key": date_key("pickup_datetime"),
        "dropoff_date_key": date_key("dropoff_datetime"),
        "pickup_location_key": key_or_unknown(PICKUP_LOCATION_KEYS),
        "dropoff_location_key": key_or_unknown(DROPOFF_LOCATION_KEYS),
        "rate_code_key": key_or_unknown(RATE_CODE_KEYS),
        "payment_type_key": key_or_unknown(PAYMENT_TYPE_KEYS),
        "vendor_key": key_or_unknown(VENDOR_KEYS),
        "trip_duration_seconds": duration_seconds("pickup_datetime", "dropoff_datetime"),
        "inserted_at_utc": F.current_timestamp(),
    }
    cols = []
    if with_trip_key:
        parts = [F.coalesce(F.col(k).cast("string"), F.lit("-")) for k in ("source_year", "source_month", *TRIP_KEYS)]
        cols.append(F.md5(F.concat_ws("|", *parts)).alias("trip_key"))
    for name, dtype in FACT_COLUMNS:
        expr = exprs.get(name, F.col(name))
        cols.append(expr.cast(dtype).alias(name))
    return silver.select(*cols)


def key_by_lookup(
    df: DataFrame,
    id_col: str,
    dim: DataFrame,
    dim_id_col: str,
    dim_key_col: str,
    out_col: str,
    unknown: int = 0,
) -> DataFrame:
    """Resolve ``id_col`` through ``dim`` (left join on the id); unmatched or NULL -> unknown.

    The dimension side is deduplicated on its id first so the join can never fan out.
    """
    keys = dedupe(
        dim.select(F.col(dim_id_col).alias("_lk_id"), F.col(dim_key_col).alias("_lk_key")), ["_lk_id"]
    )
    joined = df.join(keys, F.col(id_col) == F.col("_lk_id"), "left")
    return joined.withColumn(
        out_col, F.coalesce(F.col("_lk_key"), F.lit(unknown)).cast("int")
    ).drop("_lk_id", "_lk_key")
