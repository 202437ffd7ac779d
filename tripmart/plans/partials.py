"""Monthly partial states of the dashboard's measures.

A run reduces a month of the fact to one row per day, pickup zone and payment type, with sums
and counts, and swaps these rows in with the month. Marts merge the states of all months
instead of scanning the fact again; sums are exact decimals, so both give the same values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.operators.swap import SwappedTable

KEYS = ("pickup_date_key", "pickup_location_key", "payment_type_key")
SUMS = ("total_amount", "fare_amount", "tip_amount")

PARTIAL_SCHEMA = T.StructType(
    [T.StructField(k, T.IntegerType()) for k in KEYS]
    + [T.StructField("trips", T.LongType())]
    + [T.StructField(f"{c}_sum", T.DecimalType(20, 2)) for c in SUMS]
    + [T.StructField(f"{c}_n", T.LongType()) for c in SUMS]
    + [T.StructField("source_year", T.ShortType()), T.StructField("source_month", T.ShortType())]
)


def partials_table(root: str, name: str | None = None) -> SwappedTable:
    return SwappedTable(root, PARTIAL_SCHEMA, ("source_year", "source_month"), name)


def monthly_partials(fact: DataFrame) -> DataFrame:
    """The states of the fact's months, in ``PARTIAL_SCHEMA``."""
    states = fact.groupBy(*KEYS, "source_year", "source_month").agg(
        F.count(F.lit(1)).alias("trips"),
        *(F.sum(c).cast("decimal(20,2)").alias(f"{c}_sum") for c in SUMS),
        *(F.count(c).alias(f"{c}_n") for c in SUMS),
    )
    return states.select(*PARTIAL_SCHEMA.fieldNames())


def merged(states: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """The states brought to a coarser key: ``by, trips`` and the sums and counts."""
    own = ["trips", *(f"{c}_sum" for c in SUMS), *(f"{c}_n" for c in SUMS)]
    return states.groupBy(*by).agg(*(F.sum(c).alias(c) for c in own))
