"""Exploratory profile of raw records: numeric summary, nulls, distincts, anomalies.

Every profile is a single aggregate pass (or a filtered group count) over the input;
wide aggregates are reshaped to long (one row per column) on the executors.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.functions.keys import month_window

# Numeric raw columns summarised by the exploration notebook.
NUMERIC_RAW_COLUMNS = [
    "passenger_count",
    "trip_distance",
    "fare_amount",
    "extra",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "improvement_surcharge",
    "total_amount",
    "congestion_surcharge",
    "airport_fee",
]


def _resolve(df: DataFrame, name: str) -> str:
    """Column name in ``df`` matching ``name`` case-insensitively."""
    for c in df.columns:
        if c.lower() == name.lower():
            return c
    raise KeyError(name)


def profile_numeric(df: DataFrame, cols: Sequence[str] = NUMERIC_RAW_COLUMNS, scale: int = 6) -> DataFrame:
    """count, mean, sample stddev, min, max per column (typed, long format).

    Mean and stddev are rounded to ``scale`` decimals (their last bits depend on the order
    in which partial aggregates are merged).
    """
    names = [_resolve(df, c) for c in cols]
    aggs = []
    for i, c in enumerate(names):
        x = F.col(c).cast("double")
        aggs += [
            F.count(x).alias(f"c{i}"),
            F.avg(x).alias(f"m{i}"),
            F.stddev_samp(x).alias(f"s{i}"),
            F.min(x).alias(f"lo{i}"),
            F.max(x).alias(f"hi{i}"),
        ]
    wide = df.agg(*aggs)
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col(f"c{i}").alias("count"),
            F.round(F.col(f"m{i}"), scale).alias("mean"),
            F.round(F.col(f"s{i}"), scale).alias("stddev"),
            F.col(f"lo{i}").alias("min"),
            F.col(f"hi{i}").alias("max"),
        )
        for i, c in enumerate(names)
    ]
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def profile_null_counts(df: DataFrame) -> DataFrame:
    """NULL count of every column, long format (column_name, null_count)."""
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return wide.unpivot([], df.columns, "column_name", "null_count")


def profile_distinct(df: DataFrame, col: str) -> DataFrame:
    """Distinct values of one column."""
    return df.select(_resolve(df, col)).distinct()


def profile_negative_by_payment(df: DataFrame, amount: str = "total_amount",
                                payment: str = "payment_type") -> DataFrame:
    """Rows with a negative amount, counted per payment type."""
    return (
        df.filter(F.col(_resolve(df, amount)) < 0)
        .groupBy(_resolve(df, payment))
        .agg(F.count(F.lit(1)).alias("negative_rows"))
    )


def profile_out_of_window(df: DataFrame, year: int, month: int,
                          pickup: str = "tpep_pickup_datetime") -> DataFrame:
    """Rows whose pickup lies outside the given month (NULL pickups are not counted)."""
    p = F.col(_resolve(df, pickup))
    outside = p.isNotNull() & ~month_window(p, year, month)
    return df.agg(F.count_if(outside).alias("rows_outside_window")).select(
        F.lit(year).alias("year"), F.lit(month).alias("month"), "rows_outside_window"
    )


def profile_bad_duration(df: DataFrame, pickup: str = "tpep_pickup_datetime",
                         dropoff: str = "tpep_dropoff_datetime") -> DataFrame:
    """Rows whose dropoff is not after pickup (zero or negative duration)."""
    bad = F.col(_resolve(df, dropoff)) <= F.col(_resolve(df, pickup))
    return df.agg(F.count_if(bad).alias("rows_non_positive_duration"))


def unknown_zones(df: DataFrame, id_col: str, zones: DataFrame, zone_id: str = "location_id") -> DataFrame:
    """Ids in ``df`` with no lookup entry (NULL ids never match), with their row counts.

    The trips are first reduced to one row per id (partial aggregation), so the anti join
    only sees distinct ids, whatever the lookup's size.
    """
    c = _resolve(df, id_col)
    per_id = df.groupBy(c).agg(F.count(F.lit(1)).alias("unmatched_rows"))
    ids = zones.select(F.col(zone_id).cast("int").alias("_zid")).distinct()
    return per_id.join(ids, per_id[c] == ids["_zid"], "left_anti").select(
        F.col(c).alias("location_id"), "unmatched_rows"
    )
