"""Silver and gold stages as lazy plans, plus the star bundle the marts read.

``silver_trips`` = conform -> validate -> per-period dedupe -> lineage.
``Star`` holds the fact and the five dimensions; marts take a ``Star``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.operators.conform import (
    CAST_FAILED,
    add_lineage,
    conform_with_rejects,
    conform_zone_lookup,
)
from tripmart.operators.dedupe import dedupe
from tripmart.operators.dims import (
    location_dim,
    payment_type_dim,
    rate_code_dim,
    vendor_dim,
)
from tripmart.operators.quality import trip_rules, valid_filter, with_reject_reasons
from tripmart.schemas import TRIP_KEYS, TRIP_SPEC
from tripmart.sources.raw import trip_file_name_col


@dataclass
class Star:
    fact: DataFrame
    dim_date: DataFrame
    dim_location: DataFrame
    dim_rate_code: DataFrame
    dim_payment_type: DataFrame
    dim_vendor: DataFrame

    def dims(self) -> dict[str, DataFrame]:
        return {
            "dim_date": self.dim_date,
            "dim_location": self.dim_location,
            "dim_rate_code": self.dim_rate_code,
            "dim_payment_type": self.dim_payment_type,
            "dim_vendor": self.dim_vendor,
        }


def valid_trips(raw: DataFrame, year: int | None = None, month: int | None = None) -> DataFrame:
    """Conformed trips that pass every rule (window, time order, distance) and whose values
    could all be cast. ``raw`` may be conformed already, with its rejects."""
    trips = raw if CAST_FAILED in raw.columns else conform_with_rejects(raw, TRIP_SPEC)
    rules = trip_rules(year, month)
    return trips.filter(valid_filter(rules) & (F.size(CAST_FAILED) == 0)).drop(CAST_FAILED)


def silver_trips(
    raw: DataFrame,
    run_id: str,
    processed_at: str | None = None,
    year: int | None = None,
    month: int | None = None,
    source_file: str | Column | None = None,
) -> DataFrame:
    """Accepted trips with lineage. ``raw`` carries ``year``/``month`` period columns.

    De-duplication is per period (period + business key), as each monthly file is cleaned
    on its own. ``source_file`` defaults to the layout name of the row's period file.
    """
    valid = valid_trips(raw, year, month)
    accepted = dedupe(valid, ["year", "month", *TRIP_KEYS])
    if source_file is None:
        source_file = trip_file_name_col(F.col("year"), F.col("month"))
    return add_lineage(accepted, run_id, processed_at, source_file=source_file)


#: Columns that the quarantine has beside those of silver.
REASONS, VERDICT = "reject_reasons", "verdict"


def judged_trips(
    raw: DataFrame,
    run_id: str,
    processed_at: str | None = None,
    year: int | None = None,
    month: int | None = None,
    source_file: str | Column | None = None,
    gather: bool = False,
) -> DataFrame:
    """All trips under a ``verdict``: ``accepted`` ones as :func:`silver_trips` has them, and each
    ``rejected`` row with its ``reject_reasons`` (names of the failed rules) and its uncastable
    columns.

    Only accepted rows are shuffled, to be de-duplicated per period; rejected ones stay in the
    tasks that read them, however many they are. With ``gather`` the accepted ones are then
    brought together by period for a write; the rejected ones already are, as read from a table
    of periods.
    """
    trips = raw if CAST_FAILED in raw.columns else conform_with_rejects(raw, TRIP_SPEC)
    tagged = with_reject_reasons(trips, trip_rules(year, month, cast_failed=CAST_FAILED))
    if source_file is None:
        source_file = trip_file_name_col(F.col("year"), F.col("month"))

    def under(rows: DataFrame, verdict: str) -> DataFrame:
        return add_lineage(rows.withColumn(VERDICT, F.lit(verdict)), run_id, processed_at, source_file=source_file)

    accepted = under(dedupe(tagged.filter(F.size(REASONS) == 0), ["year", "month", *TRIP_KEYS]), "accepted")
    if gather:
        accepted = accepted.hint("rebalance", "source_year", "source_month")
    return accepted.unionByName(under(tagged.filter(F.size(REASONS) > 0), "rejected"))


def dims_for(
    spark: SparkSession, raw_zones: DataFrame, dim_date: DataFrame, with_unknown: bool = False
) -> dict[str, DataFrame]:
    return {
        "dim_date": dim_date,
        "dim_location": location_dim(conform_zone_lookup(raw_zones), with_unknown=with_unknown),
        "dim_rate_code": rate_code_dim(spark),
        "dim_payment_type": payment_type_dim(spark),
        "dim_vendor": vendor_dim(spark),
    }
