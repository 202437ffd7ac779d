"""Dimensions: calendar, location, seeded code dimensions, unknown member, SCD1 upsert.

The seeded dimensions are literal rows and safe to broadcast. The calendar has as many rows
as its range has days and the location one per zone id: joins leave those to the planner,
which goes by their size.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.functions.calendar import (
    date_key,
    day_name,
    is_weekend,
    iso_weekday,
    month_name,
)
from tripmart.operators.dedupe import dedupe
from tripmart.schemas import (
    CALENDAR_END,
    CALENDAR_START,
    DIM_DATE_SCHEMA,
    PAYMENT_TYPE_SEED,
    RATE_CODE_SEED,
    UNKNOWN_TEXT,
    VENDOR_SEED,
)


def date_dim(
    spark: SparkSession,
    start: str = CALENDAR_START,
    end: str = CALENDAR_END,
    with_unknown: bool = False,
) -> DataFrame:
    """Calendar rows for every day in [start, end] (inclusive), generated on the executors."""
    dates = spark.range(1).select(
        F.explode(
            F.sequence(F.to_date(F.lit(start)), F.to_date(F.lit(end)), F.expr("INTERVAL 1 DAY"))
        ).alias("full_date")
    )
    dim = _calendar_columns(dates)
    if with_unknown:
        unknown = spark.createDataFrame(
            [(0, dt.date(1900, 1, 1), 0, UNKNOWN_TEXT, 0, 0, UNKNOWN_TEXT, 0, 0, False)],
            DIM_DATE_SCHEMA,
        )
        dim = unknown.unionByName(dim)
    return dim


def date_dim_spanning(df: DataFrame, ts_cols: list[str]) -> DataFrame:
    """Calendar covering whole years of every date in ``ts_cols`` of ``df``.

    The bounds come from one global min/max aggregate and stay in Spark; the row count is
    bounded by the days in the span, not by the size of ``df``.
    """
    lo = F.least(*[F.col(c) for c in ts_cols])
    hi = F.greatest(*[F.col(c) for c in ts_cols])
    bounds = df.agg(
        F.trunc(F.to_date(F.min(lo)), "year").alias("lo"),
        F.make_date(F.year(F.max(hi)), F.lit(12), F.lit(31)).alias("hi"),
    )
    dates = bounds.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("full_date"))
    return _calendar_columns(dates)


def _calendar_columns(dates: DataFrame) -> DataFrame:
    return dates.select(
        date_key("full_date").alias("date_key"),
        "full_date",
        iso_weekday("full_date").alias("day_of_week"),
        day_name("full_date").alias("day_name"),
        F.dayofmonth("full_date").cast("int").alias("day_of_month"),
        F.month("full_date").cast("int").alias("month"),
        month_name("full_date").alias("month_name"),
        F.quarter("full_date").cast("int").alias("quarter"),
        F.year("full_date").cast("int").alias("year"),
        is_weekend("full_date").alias("is_weekend"),
    )


def seed_usage(dim: DataFrame, fact: DataFrame, key: str) -> DataFrame:
    """A seeded dimension with the number of fact rows referencing each key (0 if none).

    The fact is reduced to one row per key first (partial aggregation), then joined to the
    handful of seed rows.
    """
    used = fact.groupBy(key).agg(F.count(F.lit(1)).alias("trips"))
    return dim.join(used, key, "left").select(
        *dim.columns, F.coalesce(F.col("trips"), F.lit(0)).cast("long").alias("trips")
    )


def location_dim(zones: DataFrame, with_unknown: bool = False) -> DataFrame:
    """Location dimension from the conformed zone lookup; natural key = location id.

    One row per id (deterministic survivor); ``with_unknown`` adds the key-0 member.
    """
    dim = zones.select(
        F.col("location_id").cast("int").alias("location_key"),
        F.col("location_id").cast("int").alias("location_id"),
        F.col("borough").cast("string").alias("borough"),
        F.col("zone").cast("string").alias("zone"),
        F.col("service_zone").cast("string").alias("service_zone"),
    )
    dim = dedupe(dim, ["location_id"])
    if with_unknown:
        unknown = zones.sparkSession.createDataFrame(
            [(0, 0, UNKNOWN_TEXT, UNKNOWN_TEXT, UNKNOWN_TEXT)],
            "location_key int, location_id int, borough string, zone string, service_zone string",
        )
        dim = scd1_upsert(unknown, dim, "location_key")
    return dim


def _seed(spark: SparkSession, rows, prefix: str) -> DataFrame:
    schema = T.StructType(
        [
            T.StructField(f"{prefix}_key", T.IntegerType()),
            T.StructField(f"{prefix}_id", T.IntegerType()),
            T.StructField(f"{prefix}_name", T.StringType()),
        ]
    )
    return spark.createDataFrame(rows, schema)


def rate_code_dim(spark: SparkSession) -> DataFrame:
    return _seed(spark, RATE_CODE_SEED, "rate_code")


def payment_type_dim(spark: SparkSession) -> DataFrame:
    return _seed(spark, PAYMENT_TYPE_SEED, "payment_type")


def vendor_dim(spark: SparkSession) -> DataFrame:
    return _seed(spark, VENDOR_SEED, "vendor")


def scd1_upsert(current: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """Type-1 maintenance: incoming rows replace current rows with the same key; current
    rows with no incoming match are kept. Re-running with the same input is idempotent."""
    incoming = incoming.select(*current.columns)
    kept = current.join(incoming.select(key), key, "left_anti")
    return incoming.unionByName(kept)
