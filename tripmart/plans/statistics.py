"""Catalog statistics of the registered warehouse, and SQL on it planned by their cost.

Row counts and column statistics (distinct values, range, nulls) of the key and filter columns
let the optimizer order the joins of a star query by size: the dimension that keeps the fewest
trips meets the fact first, wherever the SQL names it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

#: Columns of each warehouse table by which it is joined or filtered.
STATISTICS_COLUMNS = {
    "fact_trip": (
        "pickup_date_key", "dropoff_date_key", "pickup_location_key", "dropoff_location_key",
        "vendor_key", "rate_code_key", "payment_type_key",
    ),
    "dim_date": ("date_key", "year", "quarter", "month"),
    "dim_location": ("location_key", "borough", "zone"),
    "dim_rate_code": ("rate_code_key", "rate_code_name"),
    "dim_payment_type": ("payment_type_key", "payment_type_name"),
    "dim_vendor": ("vendor_key", "vendor_name"),
}

COST_CONF = {
    "spark.sql.cbo.enabled": "true",
    "spark.sql.cbo.planStats.enabled": "true",
    "spark.sql.cbo.joinReorder.enabled": "true",
}


def analyze_tables(
    spark: SparkSession, database: str, columns: Mapping[str, Sequence[str]] = STATISTICS_COLUMNS
) -> list[str]:
    """Compute the statistics of those tables of ``database`` that exist, each in one scan of the
    named columns alone. Call it after a backfill: a single month hardly changes the order of
    joins. Returns the tables analyzed."""
    done = []
    for name, wanted in columns.items():
        table = f"{database}.{name}"
        if spark.catalog.tableExists(table):
            spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR COLUMNS {', '.join(wanted)}")
            done.append(table)
    return done


def cost_session(spark: SparkSession) -> SparkSession:
    """A session on the same tables that plans by cost; the caller's keeps its settings."""
    other = spark.newSession()
    for key in ("spark.sql.session.timeZone", "spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled"):
        other.conf.set(key, spark.conf.get(key))
    for key, value in COST_CONF.items():
        other.conf.set(key, value)
    return other


def star_sql(spark: SparkSession, database: str, year: int, quarter: int) -> DataFrame:
    """Trips and revenue of a quarter by borough, vendor and payment type, in SQL on the registered
    tables. The calendar, which keeps the fewest trips, is named last."""
    return spark.sql(
        f"""SELECT l.borough, v.vendor_name, p.payment_type_name, COUNT(*) AS total_trips,
                   CAST(SUM(f.total_amount) AS DOUBLE) AS total_revenue_usd
            FROM {database}.fact_trip f
            JOIN {database}.dim_location l ON f.pickup_location_key = l.location_key
            JOIN {database}.dim_vendor v ON f.vendor_key = v.vendor_key
            JOIN {database}.dim_payment_type p ON f.payment_type_key = p.payment_type_key
            JOIN {database}.dim_date d ON f.pickup_date_key = d.date_key
            WHERE d.year = {int(year)} AND d.quarter = {int(quarter)}
            GROUP BY l.borough, v.vendor_name, p.payment_type_name"""
    )
