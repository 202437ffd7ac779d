"""The quality report from metrics observed within the silver write.

``DataFrame.observe`` counts the rows that enter and those that are accepted while they go by,
per month, so the report needs no second look at what was written. The count-based report
(``runs``) stays the gate's, since it can't be misled by a task that ran twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tripmart.operators.load import replace_partitions
from tripmart.operators.quality import quality_report_from_counts
from tripmart.plans.runs import PERIOD, Paths, read_conformed
from tripmart.plans.star import silver_trips
from tripmart.sources.raw import landed

_COUNTS = "year int, month int, rows long"


def _per_month(periods: list[tuple[int, int]], year: str, month: str) -> list[Column]:
    code = F.col(year).cast("int") * 100 + F.col(month)
    return [F.count_if(code == y * 100 + m).alias(f"{y}-{m}") for y, m in periods]


def _rows(seen: dict[str, int]) -> list[tuple[int, int, int]]:
    return [(*map(int, name.split("-")), n) for name, n in seen.items()]


def load_silver_observed(
    spark: SparkSession, paths: Paths, run_id: str, processed_at: str | None = None,
    periods: list[tuple[int, int]] | None = None,
) -> DataFrame:
    """Write the silver months that landed (or those of ``periods``); returns the quality report,
    a row per month, from two observations of that one write. One number per month and
    observation reaches the driver."""
    files = landed(spark, paths.bronze)
    there = [] if files is None else sorted(tuple(r) for r in files.select("year", "month").distinct().collect())
    found = [p for p in there if periods is None or p in set(periods)]
    schema = spark.createDataFrame([], _COUNTS)
    if not found:
        return quality_report_from_counts(schema, schema, processed_at=processed_at)
    entered, accepted = Observation("entered"), Observation("accepted")
    trips = read_conformed(spark, paths.bronze, found).observe(entered, *_per_month(found, "year", "month"))
    silver = silver_trips(trips, run_id, processed_at, source_file=F.col("_source_file")).drop("_source_file")
    replace_partitions(silver.observe(accepted, *_per_month(found, *PERIOD)), paths.silver, PERIOD)
    counts = (spark.createDataFrame(_rows(o.get), _COUNTS) for o in (entered, accepted))
    return quality_report_from_counts(*counts, processed_at=processed_at)
