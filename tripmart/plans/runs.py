"""The period pipeline: bronze -> silver -> quality report -> gate -> gold.

``run_period`` processes one month (partition-pruned reads, dynamic partition overwrite),
``backfill`` processes any number of months in a single set of Spark jobs: every row is
validated against its own file's month and only periods that pass the gate are loaded
into the fact.

Counts for the report are taken from the data actually read and written (row counts of
the bronze and silver partitions), so task retries and lost executors cannot inflate them.
A month that never landed is skipped: nothing is written and its gate row says so.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.operators.conform import CAST_FAILED, conform_groups, conform_zone_lookup
from tripmart.operators.contracts import assert_contracts, contract_findings
from tripmart.operators.dims import (
    date_dim,
    location_dim,
    payment_type_dim,
    rate_code_dim,
    vendor_dim,
)
from tripmart.operators.facts import build_fact
from tripmart.operators.load import (
    clear_period,
    enforce_schema,
    replace_period,
    read_quality_report,
    read_written,
    replace_partitions,
    write_dimension,
    write_quality_report,
)
from tripmart.operators.quality import assert_gate, quality_gate, quality_report_from_counts
from tripmart.operators.swap import SwappedTable, merge_scd1, read_swapped, swap
from tripmart.plans.partials import monthly_partials
from tripmart.plans.star import REASONS, VERDICT, Star, judged_trips, silver_trips
from tripmart.schemas import (
    CALENDAR_END,
    CALENDAR_START,
    DATASET_NAME,
    DIM_LOCATION_SCHEMA,
    FACT_SCHEMA,
    GATE_MAX_REJECT_PCT,
    GATE_MIN_ROWS,
    TRIP_SPEC,
)
from tripmart.session import configure
from tripmart.sources.raw import read_raw_groups, read_zone_lookup_csv

PERIOD = ["source_year", "source_month"]


@dataclass(frozen=True)
class Paths:
    """Folders of the pipeline. Optional: ``judged``, where accepted and rejected trips are
    written side by side (then the silver table is its accepted part); ``fact_table`` and
    ``location_table``, which are swapped by location instead of overwritten in place; and
    ``partials``, the monthly states that each load of a month replaces."""

    bronze: str
    silver: str
    quality: str
    gold_fact: str
    gold_dims: str
    zone_lookup_csv: str | None = None
    judged: str | None = None
    fact_table: SwappedTable | None = None
    location_table: SwappedTable | None = None
    partials: SwappedTable | None = None

    def sink(self, verdict: str) -> str:
        """Folder of the trips with a verdict (``accepted``: the silver table)."""
        return f"{self.judged}/{VERDICT}={verdict}" if self.judged else self.silver


def fact_table(root: str, name: str | None = None) -> SwappedTable:
    """A fact whose months are swapped by location."""
    return SwappedTable(root, FACT_SCHEMA, tuple(PERIOD), name)


def location_table(root: str, name: str | None = None) -> SwappedTable:
    """A location dimension that goes from version to version."""
    return SwappedTable(root, DIM_LOCATION_SCHEMA, (), name)


def new_run_id(prefix: str = "run") -> str:
    """A fresh run id, generated once on the driver and stamped on every row of the run."""
    return f"{prefix}-{uuid.uuid4()}"


def register_tables(spark: SparkSession, paths: Paths, database: str = "warehouse") -> list[str]:
    """Create the warehouse namespace and external tables over the written folders, so
    schema-qualified SQL runs through ``spark.sql``. Idempotent: call again after each load
    to pick up new partitions (``RECOVER PARTITIONS`` lists the period directories)."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    tables = {
        "fact_trip": (paths.gold_fact, True),
        "silver_trips": (paths.sink("accepted"), True),
        **{d: (f"{paths.gold_dims}/{d}", False) for d in
           ("dim_date", "dim_location", "dim_rate_code", "dim_payment_type", "dim_vendor")},
    }
    created = []
    for name, (path, partitioned) in tables.items():
        try:
            spark.read.parquet(path).schema
        except AnalysisException as e:
            if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            continue  # never written
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} USING parquet LOCATION '{path}'")
        if partitioned:
            spark.sql(f"ALTER TABLE {database}.{name} RECOVER PARTITIONS")
        created.append(f"{database}.{name}")
    return created


def register_views(spark: SparkSession, paths: Paths) -> list[str]:
    """Expose the warehouse tables to SQL as session views (the reference's schema and
    CREATE TABLE statements re-aimed: the tables are the written parquet folders)."""
    star = read_star(spark, paths)
    views = {"fact_trip": star.fact, **star.dims(), "silver_trips": spark.read.parquet(paths.sink("accepted")),
             "quality_report": read_quality_report(spark, paths.quality)}
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return list(views)


GATE_SCHEMA = (
    "dataset string, year int, month int, accepted_rows long, rejection_rate_pct double, "
    "passed boolean, gate_reason string"
)


def read_conformed(spark: SparkSession, root: str, periods: list[tuple[int, int]] | None = None) -> DataFrame | None:
    """The landed months (or those of ``periods``) conformed, with their period, source file
    and uncastable columns; None if none of them landed."""
    groups = [g.withColumn("_source_file", F.col("_metadata.file_path")) for g in read_raw_groups(spark, root, periods)]
    return conform_groups(groups, TRIP_SPEC) if groups else None


def _missing(spark: SparkSession, periods: list[tuple[int, int]]) -> DataFrame:
    """Gate rows of months that never landed."""
    rows = [(DATASET_NAME, y, m, 0, None, False, "source_missing") for y, m in periods]
    return spark.createDataFrame(rows, GATE_SCHEMA)


def _period_counts(df: DataFrame, year_col: str, month_col: str) -> list[tuple[int, int, int]]:
    """Rows per period as a short driver-side list (one entry per month; reads no columns)."""
    rows = df.groupBy(year_col, month_col).agg(F.count(F.lit(1)).alias("rows")).collect()
    return [(int(r[0]), int(r[1]), int(r[2])) for r in rows if r[0] is not None and r[1] is not None]


def in_periods(periods: list[tuple[int, int]], year_col: str = "source_year",
               month_col: str = "source_month") -> Column:
    """Predicate on the partition columns selecting the given months (partition pruning)."""
    codes = sorted({y * 100 + m for y, m in periods})
    return (F.col(year_col) * 100 + F.col(month_col)).isin(codes) if codes else F.lit(False)


def _clear_without(spark, schema, root, periods, accepted) -> None:
    """Empty the periods that this run found no accepted rows for."""
    done = {(y, m) for y, m, _ in accepted}
    for y, m in periods:
        if (y, m) not in done:
            clear_period(spark, schema, root, y, m)


def _load_silver_and_report(spark, paths, trips, run_id, processed_at, year=None, month=None):
    """Write silver for the periods in ``trips``, then the report from row counts."""
    # One month: after the dedupe shuffle every task holds rows of that month only, so each
    # writes one file. Many months: rebalance, so tasks don't each write into every month.
    own = {"source_file": F.col("_source_file")}
    if paths.judged:
        rows = judged_trips(trips, run_id, processed_at, year, month, gather=year is None, **own).drop("_source_file")
        replace_partitions(rows, paths.judged, [VERDICT, *PERIOD], rebalance=False)
    else:
        rows = silver_trips(trips, run_id, processed_at, year, month, **own).drop("_source_file")
        replace_partitions(rows, paths.silver, PERIOD, rebalance=year is None)
    silver, root = rows.drop(VERDICT, REASONS, CAST_FAILED), paths.sink("accepted")
    inputs = _period_counts(trips, "year", "month")
    periods = [(y, m) for y, m, _ in inputs]
    # Count only rows this run wrote (its processed_at stamp): a month that now produces no
    # rows is not rewritten by a dynamic overwrite and still holds an earlier run's rows. The
    # schema is given, as a first run may have written no file.
    mine = in_periods(periods) & (F.col("processed_at_utc") == F.lit(processed_at))
    accepted = _period_counts(read_written(spark, root, silver.schema).filter(mine), *PERIOD)
    # Months of this run with no accepted rows lose the rows of an earlier run.
    _clear_without(spark, silver.schema, root, periods, accepted)
    if paths.judged:  # and those without rejected rows lose the earlier run's
        root, schema = paths.sink("rejected"), rows.drop(VERDICT).schema
        rejected = _period_counts(read_written(spark, root, schema).filter(mine), *PERIOD)
        _clear_without(spark, schema, root, periods, rejected)
    # Fresh read (file listing taken after all silver writes of this run).
    written = read_written(spark, paths.sink("accepted"), silver.schema).filter(in_periods(periods))
    schema = "year int, month int, rows long"
    report = quality_report_from_counts(
        spark.createDataFrame(inputs, schema), spark.createDataFrame(accepted, schema),
        processed_at=processed_at,
    )
    write_quality_report(report, paths.quality)
    return written, periods, accepted


def read_rejected(spark: SparkSession, paths: Paths) -> DataFrame:
    """The rejected trips of all loaded months with their reasons, from the quarantine."""
    return spark.read.parquet(paths.sink("rejected"))


def _fact(written: DataFrame) -> DataFrame:
    return enforce_schema(build_fact(written, with_trip_key=True), FACT_SCHEMA)


def read_fact(spark: SparkSession, paths: Paths) -> DataFrame:
    """The loaded fact; no rows where nothing was ever loaded."""
    if paths.fact_table:
        return read_swapped(spark, paths.fact_table)
    return read_written(spark, paths.gold_fact, FACT_SCHEMA)


def _load_partials(spark: SparkSession, paths: Paths, periods: list[tuple[int, int]], run_id: str) -> None:
    """Replace the months' states, computed from the rows that were just loaded."""
    if paths.partials and periods:
        swap(monthly_partials(read_fact(spark, paths).filter(in_periods(periods))), paths.partials, periods, run_id)


def _check(spark: SparkSession, paths: Paths, fact: DataFrame, contracts: Sequence[str]) -> None:
    """Stop the load if the rows about to be loaded break one of the contracts."""
    if contracts:
        assert_contracts(contract_findings(fact, read_star(spark, paths).dims(), contracts))


def run_period(
    spark: SparkSession,
    paths: Paths,
    year: int,
    month: int,
    run_id: str,
    enforce_gate: bool = True,
    min_rows: int = GATE_MIN_ROWS,
    max_reject_pct: float = GATE_MAX_REJECT_PCT,
    contracts: Sequence[str] = (),
) -> DataFrame:
    """Process one month end to end; returns the period's gate row.

    Reads only that month's bronze partition; silver, report and fact partitions of the
    month are replaced, nothing else is touched. A month without landed files is skipped:
    nothing is written and the row's reason is ``source_missing``. The gate reads this run's
    report; a failed gate, or no report, raises before gold, and so do rows that break one of
    ``contracts`` (names of ``operators.contracts``, checked against the loaded dimensions).
    """
    configure(spark)
    processed_at = dt.datetime.now(dt.UTC).isoformat()
    trips = read_conformed(spark, paths.bronze, [(year, month)])
    if trips is None:
        return _missing(spark, [(year, month)])
    written, _, accepted = _load_silver_and_report(spark, paths, trips, run_id, processed_at, year, month)
    report = read_quality_report(spark, paths.quality, year, month, processed_at)
    gate = quality_gate(report, min_rows, max_reject_pct)
    if enforce_gate:
        assert_gate(gate, [(year, month)])
    fact = _fact(written)
    _check(spark, paths, fact, contracts)
    if paths.fact_table:
        swap(fact, paths.fact_table, [(year, month)], run_id, cluster_by=["pickup_date_key"])
    else:
        rows = sum(n for *_, n in accepted)
        replace_period(fact, paths.gold_fact, year, month, rows, cluster_by=["pickup_date_key"])
    _load_partials(spark, paths, [(year, month)], run_id)
    return gate


def backfill(
    spark: SparkSession,
    paths: Paths,
    run_id: str,
    periods: list[tuple[int, int]] | None = None,
    min_rows: int = GATE_MIN_ROWS,
    max_reject_pct: float = GATE_MAX_REJECT_PCT,
    enforce_gate: bool = True,
    contracts: Sequence[str] = (),
) -> DataFrame:
    """Process many months at once; returns the gate table (one row per period).

    One pass over bronze (each row checked against its own file's month, de-duplicated
    per period), then the report from row counts, the gate, and the fact for the periods
    that passed. Periods failing the gate get silver data and a report but no fact
    partition (unless ``enforce_gate=False``, which loads every period and only records
    the verdict). Asked-for periods that never landed are skipped as ``source_missing``.
    Rows that break one of ``contracts`` stop the load of all of them.
    """
    configure(spark)
    processed_at = dt.datetime.now(dt.UTC).isoformat()
    trips = read_conformed(spark, paths.bronze, periods)
    if trips is None:
        return _missing(spark, periods or [])
    written, found, accepted = _load_silver_and_report(spark, paths, trips, run_id, processed_at)
    report = read_quality_report(spark, paths.quality, processed_at=processed_at)
    gate = quality_gate(report, min_rows, max_reject_pct)
    loaded = found
    if enforce_gate:
        # one gate row per period reaches the driver
        loaded = [(r.year, r.month) for r in gate.filter("passed").select("year", "month").collect()]
    fact = _fact(written.filter(in_periods(loaded)))
    if loaded:
        _check(spark, paths, fact, contracts)
    if paths.fact_table:
        swap(fact, paths.fact_table, loaded, run_id, cluster_by=["pickup_date_key"])
    else:
        if any((y, m) in set(loaded) for y, m, _ in accepted):
            replace_partitions(fact, paths.gold_fact, PERIOD, cluster_by=["pickup_date_key"], rebalance=False)
        _clear_without(spark, FACT_SCHEMA, paths.gold_fact, loaded, accepted)
    _load_partials(spark, paths, loaded, run_id)
    absent = sorted(set(periods or []) - set(found))
    return gate.unionByName(_missing(spark, absent)) if absent else gate


def load_dimensions(
    spark: SparkSession,
    paths: Paths,
    calendar: tuple[str, str] = (CALENDAR_START, CALENDAR_END),
    with_unknown: bool = True,
) -> None:
    """Rebuild the calendar (SCD0), the seeded code dimensions and the location dimension (SCD1:
    overwritten, or merged into the stored one where ``paths.location_table`` is set)."""
    write_dimension(date_dim(spark, *calendar, with_unknown=with_unknown), f"{paths.gold_dims}/dim_date")
    for name, dim in (("dim_rate_code", rate_code_dim(spark)), ("dim_payment_type", payment_type_dim(spark)),
                      ("dim_vendor", vendor_dim(spark))):
        write_dimension(dim, f"{paths.gold_dims}/{name}")
    if paths.zone_lookup_csv:
        zones = conform_zone_lookup(read_zone_lookup_csv(spark, paths.zone_lookup_csv))
        locations = location_dim(zones, with_unknown=with_unknown)
        if paths.location_table:
            merge_scd1(spark, paths.location_table, locations, "location_key", new_run_id("dims"))
        else:  # as many rows as there are zone ids, which nothing bounds
            write_dimension(locations, f"{paths.gold_dims}/dim_location", one_file=False)


def read_star(spark: SparkSession, paths: Paths):
    """The loaded warehouse as a ``Star``: fact and dimensions read from their tables
    (seeded code dimensions are literal rows)."""
    return Star(
        fact=read_fact(spark, paths),
        dim_date=spark.read.parquet(f"{paths.gold_dims}/dim_date"),
        dim_location=read_swapped(spark, paths.location_table) if paths.location_table
        else spark.read.parquet(f"{paths.gold_dims}/dim_location"),
        dim_rate_code=rate_code_dim(spark),
        dim_payment_type=payment_type_dim(spark),
        dim_vendor=vendor_dim(spark),
    )
