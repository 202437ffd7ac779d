"""Query catalogue: one lazy Spark plan per operator, each with its reference SQL.

Every query reads the driver's tables (through the adapter in ``tripmart.sources.adapter``)
in full and returns a DataFrame. Row-level outputs expose money columns as DOUBLE so both
engines hand back the same Python values. Queries whose result depends on file system
state or engine-specific hashes have no SQL and are listed in ``ROWS_ONLY``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.operators import contracts, profile
from tripmart.operators.conform import (
    CAST_FAILED,
    cast_failures,
    conform,
    conform_groups,
    conform_with_rejects,
    conform_zone_lookup,
    schema_drift_report,
)
from tripmart.operators.dedupe import dedupe
from tripmart.operators.dims import date_dim, date_dim_spanning, location_dim, scd1_upsert, seed_usage
from tripmart.operators.facts import build_fact, key_by_lookup
from tripmart.operators.identity import assign_identities, key_table
from tripmart.operators.load import (
    enforce_schema,
    partition_counts,
    read_quality_report,
    replace_partitions,
    write_dimension,
)
from tripmart.operators.quality import (
    quality_gate,
    quality_report,
    reject_reason_counts,
    trip_rules,
)
from tripmart.operators.swap import SwappedTable, merge_scd1, read_swapped, register_swapped, swap
from tripmart.plans import marts, reports
from tripmart.plans.oracle import (
    DIM_KEYS as SQL_DIM_KEYS,
    FACT_FOREIGN_KEYS as SQL_FOREIGN_KEYS,
    M6,
    MONEY_COLS,
    R,
    TRIP_KEYS as SQL_TRIP_KEYS,
    VARCHAR_LIMITS as SQL_LIMITS,
    money_as_double,
    prelude,
    with_ctes,
)
from tripmart.plans.observed import load_silver_observed
from tripmart.plans.partials import partials_table
from tripmart.plans.runs import (
    Paths,
    backfill,
    fact_table,
    load_dimensions,
    location_table,
    read_fact,
    read_rejected,
    register_tables,
    run_period,
)
from tripmart.plans.star import Star, dims_for, silver_trips, valid_trips
from tripmart.plans.statistics import analyze_tables, cost_session, star_sql
from tripmart.functions.keys import key_or_unknown
from tripmart.schemas import (
    DIM_KEYS,
    FACT_SCHEMA,
    PAYMENT_TYPE_KEYS,
    RATE_CODE_KEYS,
    TRIP_KEYS,
    TRIP_SPEC,
    VENDOR_KEYS,
)
from tripmart.session import configure, scratch_dir
from tripmart.sources import adapter
from tripmart.sources.manifest import (
    completed_periods,
    file_manifest,
    pending_periods,
    period_spine,
    period_spine_of,
    read_manifest,
    update_manifest,
    write_manifest,
)
from tripmart.sources.raw import (
    read_period_leaf,
    read_raw_groups,
    read_raw_trips,
    read_zone_lookup_csv,
    write_bronze,
    write_zone_lookup_csv,
)

# Parameters of the catalogued runs (the months asked for, a calendar narrower than the
# data, a fixed run id and processing time so results are reproducible, a sample period for
# the single-month operators, gate limits that the test tables' months fall on both sides of).
CALENDAR = ("1995-01-01", "2001-12-31")
NARROW = ("1996-07-01", "1997-06-30")
GATE = {"min_rows": 320, "max_reject_pct": 61.0}
RUN_ID = "run-catalog"
PROCESSED_AT = "2024-01-01T00:00:00+00:00"
PERIOD = (1997, 2)

PRE = prelude(None, RUN_ID, PROCESSED_AT)
PRE_NARROW = prelude(NARROW, RUN_ID, PROCESSED_AT)


def _sql(body: str, *extra: str, pre: list[str] = PRE) -> str:
    return with_ctes(pre, body, list(extra))


# ---------------------------------------------------------------------------------------
# Shared Spark context per (session, tables)
# ---------------------------------------------------------------------------------------


def _kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` from a scratch table, for frames that are read several times: its joins run once."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path, compression="zstd")
    return df.sparkSession.read.schema(df.schema).parquet(path)


@dataclass
class Ctx:
    spark: SparkSession
    sf: str
    kept: DataFrame | None = None

    def with_kept_raw(self) -> Ctx:
        """The same with the raw trips in a scratch table."""
        return replace(self, kept=_kept(self.raw, "raw"))

    @property
    def raw(self) -> DataFrame:
        return self.kept if self.kept is not None else adapter.raw_trips(self.spark, self.sf)

    @property
    def raw_zones(self) -> DataFrame:
        return adapter.raw_zone_lookup(self.spark, self.sf)

    @property
    def conformed(self) -> DataFrame:
        return conform(self.raw, TRIP_SPEC)

    @property
    def silver(self) -> DataFrame:
        return silver_trips(self.raw, RUN_ID, PROCESSED_AT)

    @property
    def dim_date(self) -> DataFrame:
        return date_dim_spanning(self.raw, ["tpep_pickup_datetime", "tpep_dropoff_datetime"])

    @property
    def star(self) -> Star:
        return Star(fact=build_fact(self.silver), **dims_for(self.spark, self.raw_zones, self.dim_date))

    @property
    def narrow_star(self) -> Star:
        """A calendar that doesn't cover the trips: a left join keeps them, an inner one doesn't."""
        calendar = date_dim(self.spark, *NARROW)
        return Star(fact=build_fact(self.silver), **dims_for(self.spark, self.raw_zones, calendar))

    @property
    def gap_star(self) -> Star:
        """No trips in any May, so the month before June isn't the month before in the data."""
        star = self.star
        star.fact = star.fact.filter("source_month <> 5")
        return star

    @property
    def dirty(self) -> DataFrame:
        """Raw trips with faults of each kind: uncastable money, rows in another month's file
        and trips that end before they begin."""
        swap = F.col("VendorID") == 4
        return self.raw.withColumns({
            "total_amount": F.when(F.col("VendorID") == 6, "n/a").otherwise(F.col("total_amount").cast("string")),
            "month": F.when(F.col("VendorID") == 5, F.col("month") % 12 + 1).otherwise(F.col("month")),
            "tpep_dropoff_datetime": F.when(swap, F.col("tpep_pickup_datetime")).otherwise(F.col("tpep_dropoff_datetime")),
        })

    def paths(self) -> Paths:
        root = scratch_dir(self.spark, "warehouse")
        return Paths(*(f"{root}/{d}" for d in ("bronze", "silver", "quality", "fact", "dims")))

    @property
    def zones(self) -> DataFrame:
        return conform_zone_lookup(self.raw_zones)


def _ctx(spark: SparkSession, sf: str) -> Ctx:
    configure(spark)
    return Ctx(spark, sf)


def _doubles(df: DataFrame) -> DataFrame:
    dec = {f.name: F.col(f.name).cast("double") for f in df.schema.fields
           if isinstance(f.dataType, T.DecimalType)}
    return df.withColumns(dec) if dec else df


def _no_insert_ts(df: DataFrame) -> DataFrame:
    return df.drop("inserted_at_utc")


# ---------------------------------------------------------------------------------------
# Sources and conforming
# ---------------------------------------------------------------------------------------


def q_scan_raw_trips(spark, sf):
    """Land the months as files and scan them."""
    root = scratch_dir(spark, "bronze")
    write_bronze(_ctx(spark, sf).raw, root)
    return _doubles(read_raw_trips(spark, root))


def q_scan_drifting_months(spark, sf):
    """Months whose files differ: before 1996 the passenger count is a double, from 1997 on
    money is text and a column more is there. All are conformed to one frame, losing none."""
    raw, root = _ctx(spark, sf).with_kept_raw().raw, scratch_dir(spark, "bronze")
    old = raw.filter("year < 1996").withColumn("passenger_count", F.col("passenger_count").cast("double"))
    new = raw.filter("year >= 1997").withColumn("total_amount", F.col("total_amount").cast("string"))
    for frame in (old, raw.filter("year = 1996"), new.withColumn("cbd_congestion_fee", F.lit(0.75))):
        write_bronze(frame, root)
    found = conform_groups(read_raw_groups(spark, root), TRIP_SPEC)
    return _doubles(found.withColumn("cast_failures", F.size(CAST_FAILED)).drop(CAST_FAILED))


def q_conform_trips(spark, sf):
    return _doubles(_ctx(spark, sf).conformed)


def q_cast_failures(spark, sf):
    return cast_failures(_ctx(spark, sf).raw, TRIP_SPEC)


def q_cast_failures_dirty(spark, sf):
    return cast_failures(_ctx(spark, sf).dirty, TRIP_SPEC)


def q_lineage_columns(spark, sf):
    return _doubles(_ctx(spark, sf).silver)


def q_conform_zone_lookup(spark, sf):
    """Round trip through the CSV source: write the lookup as a headed CSV, read it back
    with the all-string schema, conform."""
    c = _ctx(spark, sf)
    path = scratch_dir(spark, "zone-csv")
    write_zone_lookup_csv(c.raw_zones, path)
    return conform_zone_lookup(read_zone_lookup_csv(spark, path))


def q_dim_location(spark, sf):
    return location_dim(_ctx(spark, sf).zones)


def q_dim_location_scd1_upsert(spark, sf):
    """Current dimension carries the unknown member; a fresh lookup load overwrites every
    matching key and keeps the rest."""
    c = _ctx(spark, sf)
    current = location_dim(c.zones, with_unknown=True)
    incoming = location_dim(c.zones)
    return scd1_upsert(current, incoming, "location_key")


def q_dim_location_scd1_changed(spark, sf):
    """Every second zone comes in again under another name: its row is replaced."""
    c = _ctx(spark, sf)
    current = location_dim(c.zones, with_unknown=True)
    incoming = location_dim(c.zones).filter("location_id % 2 = 0").withColumn("zone", F.concat("zone", F.lit(" (new)")))
    return scd1_upsert(current, incoming, "location_key")


def q_schema_drift_report(spark, sf):
    return schema_drift_report(spark, _ctx(spark, sf).raw, TRIP_SPEC)


# ---------------------------------------------------------------------------------------
# Validation, dedupe, quality
# ---------------------------------------------------------------------------------------


def q_filter_month_window(spark, sf):
    c = _ctx(spark, sf)
    (rule,) = [r for r in trip_rules(*PERIOD) if r.name == "pickup_in_period"]
    return _doubles(c.conformed.filter(rule.predicate))


def q_filter_valid_trips(spark, sf):
    return _doubles(valid_trips(_ctx(spark, sf).raw))


def q_reject_reasons(spark, sf):
    return reject_reason_counts(_ctx(spark, sf).conformed, trip_rules())


def q_reject_reasons_dirty(spark, sf):
    rows = conform_with_rejects(_ctx(spark, sf).dirty, TRIP_SPEC)
    return reject_reason_counts(rows, trip_rules(cast_failed=CAST_FAILED))


def q_filter_valid_trips_dirty(spark, sf):
    """Uncastable values, other months' rows and reversed trips don't get through."""
    return _doubles(valid_trips(_ctx(spark, sf).dirty))


def q_dedupe_trips(spark, sf):
    valid = valid_trips(_ctx(spark, sf).raw)
    return _doubles(dedupe(valid, ["year", "month", *TRIP_KEYS]))


def q_dedupe_lineitem(spark, sf):
    """Subset dedupe where duplicates differ outside the key: the survivor must be the
    first row in the total order of the remaining columns."""
    _ctx(spark, sf)
    return dedupe(adapter.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


def q_quality_report(spark, sf):
    c = _ctx(spark, sf)
    return quality_report(c.conformed, trip_rules(), TRIP_KEYS, processed_at=PROCESSED_AT)


def q_quality_gate(spark, sf):
    return quality_gate(q_quality_report(spark, sf))


def q_quality_gate_limits(spark, sf):
    """The same report under limits that some months pass and others fail for either reason."""
    return quality_gate(q_quality_report(spark, sf), **GATE)


def q_pipeline_backfill(spark, sf):
    """The whole pipeline: months land as files, are checked, reported, gated, and the passing
    ones loaded. One row per month: its report, its verdict and its rows in the fact."""
    c = _ctx(spark, sf)
    paths = c.paths()
    write_bronze(c.raw, paths.bronze)
    gate = backfill(spark, paths, RUN_ID, **GATE)
    report = read_quality_report(spark, paths.quality).drop("processed_at_utc", "dataset", "accepted_rows")
    loaded = partition_counts(spark, paths.gold_fact).select(
        F.col("source_year").cast("int").alias("year"), F.col("source_month").cast("int").alias("month"),
        F.col("rows").alias("fact_rows"))
    return gate.drop("dataset").join(report, ["year", "month"]).join(loaded, ["year", "month"], "left").withColumn(
        "fact_rows", F.coalesce("fact_rows", F.lit(0)))


def q_pipeline_rerun(spark, sf):
    """Load a quarter, land one of its months anew with other rows and run that month again,
    and run a month that never landed: the quarter's fact rows and the skipped run's row."""
    c = _ctx(spark, sf)
    paths, (y, m) = c.paths(), PERIOD
    write_bronze(c.raw.filter(F.col("year") == y).filter(F.col("month").isin(m - 1, m, m + 1)), paths.bronze)
    backfill(spark, paths, RUN_ID, enforce_gate=False)
    changed = c.raw.filter((F.col("year") == y) & (F.col("month") == m) & (F.col("VendorID") <= 3))
    write_bronze(changed.withColumn("total_amount", (F.col("total_amount") * 2).cast("decimal(10,2)")), paths.bronze)
    run_period(spark, paths, y, m, RUN_ID, enforce_gate=False)
    skipped = run_period(spark, paths, y + 50, m, RUN_ID)
    fact = spark.read.parquet(paths.gold_fact).groupBy("source_year", "source_month").agg(
        F.count("*").alias("rows"), F.countDistinct("trip_key").alias("trip_keys"),
        F.sum("total_amount").cast("double").alias("total_revenue_usd"))
    return fact.select(F.col("source_year").cast("int").alias("year"), F.col("source_month").cast("int").alias("month"),
                       "rows", "trip_keys", "total_revenue_usd", F.lit("loaded").alias("status")).unionByName(
        skipped.select("year", "month", F.lit(0).cast("long").alias("rows"), F.lit(0).cast("long").alias("trip_keys"),
                       F.lit(None).cast("double").alias("total_revenue_usd"), F.col("gate_reason").alias("status")))


# ---------------------------------------------------------------------------------------
# Dimensions and fact
# ---------------------------------------------------------------------------------------


def q_dim_date(spark, sf):
    """Calendar over the whole years the trips' pickup and dropoff dates span."""
    return date_dim_spanning(_ctx(spark, sf).raw, ["tpep_pickup_datetime", "tpep_dropoff_datetime"])


def _seed_with_usage(spark, sf, dim_attr: str, key: str):
    star = _ctx(spark, sf).star
    return seed_usage(getattr(star, dim_attr), star.fact, key)


def q_dim_seed_rate_code(spark, sf):
    return _seed_with_usage(spark, sf, "dim_rate_code", "rate_code_key")


def q_dim_seed_payment_type(spark, sf):
    return _seed_with_usage(spark, sf, "dim_payment_type", "payment_type_key")


def q_dim_seed_vendor(spark, sf):
    return _seed_with_usage(spark, sf, "dim_vendor", "vendor_key")


def q_key_or_unknown(spark, sf):
    """Code -> dimension key mapping over all accepted trips, with trip counts."""
    mapped = _ctx(spark, sf).silver.select(
        "vendor_id", key_or_unknown(VENDOR_KEYS).alias("vendor_key"),
        "rate_code_id", key_or_unknown(RATE_CODE_KEYS).alias("rate_code_key"),
        "payment_type", key_or_unknown(PAYMENT_TYPE_KEYS).alias("payment_type_key"),
    )
    return mapped.groupBy(*mapped.columns).agg(F.count(F.lit(1)).alias("trips"))


def q_key_by_lookup(spark, sf):
    """Pickup ids resolved through the location dimension (dangling and NULL ids -> 0)."""
    c = _ctx(spark, sf)
    per_id = c.silver.groupBy("pu_location_id").agg(F.count(F.lit(1)).alias("trips"))
    keyed = key_by_lookup(per_id, "pu_location_id", location_dim(c.zones), "location_id",
                          "location_key", "pickup_location_key")
    return keyed.select("pu_location_id", "pickup_location_key", "trips")


def q_fact_trips(spark, sf):
    return _doubles(_no_insert_ts(_ctx(spark, sf).star.fact))


def q_fact_trip_key(spark, sf):
    """Every accepted trip under its key."""
    return _doubles(_no_insert_ts(build_fact(_ctx(spark, sf).silver, with_trip_key=True)))


# ---------------------------------------------------------------------------------------
# Periods, landing audit, loads
# ---------------------------------------------------------------------------------------


def q_period_spine(spark, sf):
    return period_spine_of(_ctx(spark, sf).raw, "tpep_pickup_datetime")


def q_pending_periods(spark, sf):
    """Calendar months that have source data and have not passed the quality gate yet."""
    c = _ctx(spark, sf)
    requested = period_spine(spark, *CALENDAR).select("year", "month")
    available = c.raw.select("year", "month")
    done = q_quality_gate(spark, sf).filter("passed").select("year", "month")
    return pending_periods(requested, available, done)


def q_pending_periods_done(spark, sf):
    """Months count as done when the stored manifest says so and the loaded table has them:
    here the manifest is of all months but the Junes, whose file failed, and each fourth
    month isn't loaded."""
    c = _ctx(spark, sf)
    root = scratch_dir(spark, "bronze")
    write_bronze(c.raw, root)
    status = F.when(F.col("month") == 6, "FAILED").otherwise(F.col("status"))
    stored = scratch_dir(spark, "manifest")
    write_manifest(file_manifest(spark, root).withColumn("status", status), stored)
    loaded = c.silver.select(F.col("source_year").cast("int").alias("year"), F.col("source_month").cast("int").alias("month"))
    done = completed_periods(read_manifest(spark, stored), loaded.filter("month % 4 <> 0"))
    available = read_manifest(spark, stored).select("year", "month")
    return pending_periods(period_spine(spark, *CALENDAR).select("year", "month"), available, done)


def q_file_manifest(spark, sf):
    """Landed files audited, one row per month (how many files a month has is the writer's)."""
    c = _ctx(spark, sf)
    root = scratch_dir(spark, "bronze")
    write_bronze(c.raw, root)
    return file_manifest(spark, root).groupBy("dataset", "year", "month").agg(
        (F.count("*") > 0).alias("has_files"),
        F.bool_and(F.col("file_size_bytes") > 0).alias("sizes_ok"),
        F.bool_and(F.col("sha256_checksum").rlike("^[0-9a-f]{64}$")).alias("checksums_ok"),
        (F.countDistinct("sha256_checksum") == F.countDistinct("source_path")).alias("checksums_differ"),
        F.min("status").alias("status"),
    )


def q_replace_partition_changed(spark, sf):
    """As above with other rows: the period's are gone, the new ones are there."""
    fact = _ctx(spark, sf).star.fact
    path = scratch_dir(spark, "fact")
    replace_partitions(fact, path)
    y, m = PERIOD
    rerun = fact.filter((F.col("source_year") == y) & (F.col("source_month") == m) & (F.col("total_amount") > 20000))
    replace_partitions(rerun.withColumn("tip_amount", (F.col("tip_amount") + 1).cast("decimal(10,2)")), path, cluster_by=["pickup_date_key"])
    return spark.read.parquet(path).groupBy("source_year", "source_month").agg(
        F.count("*").alias("rows"), F.sum("tip_amount").cast("double").alias("tips"))


def q_replace_partition(spark, sf):
    """Load the fact, then re-run one period into the same table: every period keeps the
    row count of a single load (the re-run replaced its partition, nothing else moved)."""
    c = _ctx(spark, sf)
    fact = c.star.fact
    path = scratch_dir(spark, "fact")
    replace_partitions(fact, path)
    y, m = PERIOD
    rerun = fact.filter((F.col("source_year") == y) & (F.col("source_month") == m))
    replace_partitions(rerun, path, cluster_by=["pickup_date_key"])
    return partition_counts(spark, path)


# ---------------------------------------------------------------------------------------
# Marts and reports
# ---------------------------------------------------------------------------------------


def _mart(fn):
    return lambda spark, sf: fn(_ctx(spark, sf).star)


def _narrow(fn):
    return lambda spark, sf: fn(_ctx(spark, sf).narrow_star)


def _gap(fn):
    return lambda spark, sf: fn(_ctx(spark, sf).gap_star)


def q_unknown_dropoff_zones_gap(spark, sf):
    """A lookup without every fifth zone: the trips that end there are reported."""
    c = _ctx(spark, sf)
    return profile.unknown_zones(c.raw, "DOLocationID", c.zones.filter("location_id % 5 <> 0"))


def q_report_kpi(spark, sf):
    return reports.report_kpi(marts.mart_mom(_ctx(spark, sf).star))


def q_report_latest_growth(spark, sf):
    return reports.report_latest_growth(marts.mart_mom(_ctx(spark, sf).star))


def q_report_zones(spark, sf):
    return reports.report_zones(marts.mart_zones(_ctx(spark, sf).star))


def q_report_payment(spark, sf):
    return reports.report_payment(marts.mart_payment(_ctx(spark, sf).star))


def q_report_zones_period(spark, sf):
    """Dashboard view of one selected month: the fact is pruned to that period's partition."""
    return reports.report_zones(marts.mart_zones(_ctx(spark, sf).star, period=PERIOD))


def q_report_zones_weighted(spark, sf):
    return reports.report_zones(marts.mart_zones(_ctx(spark, sf).star), weighted=True)


def q_report_payment_weighted(spark, sf):
    return reports.report_payment(marts.mart_payment(_ctx(spark, sf).star), weighted=True)


def q_report_borough_share(spark, sf):
    return reports.report_borough_share(q_report_zones(spark, sf))


def q_report_top10_zones(spark, sf):
    return reports.report_top_zones(q_report_zones(spark, sf), 10)


def q_report_formatted(spark, sf):
    return reports.report_formatted(q_report_payment(spark, sf))


# ---------------------------------------------------------------------------------------
# Profile
# ---------------------------------------------------------------------------------------


def q_profile_numeric(spark, sf):
    return profile.profile_numeric(_ctx(spark, sf).raw)


def q_profile_null_counts(spark, sf):
    return profile.profile_null_counts(_ctx(spark, sf).raw)


def q_profile_distinct_rate_code(spark, sf):
    return profile.profile_distinct(_ctx(spark, sf).raw, "RatecodeID")


def q_profile_distinct_flag(spark, sf):
    return profile.profile_distinct(_ctx(spark, sf).raw, "store_and_fwd_flag")


def q_profile_distinct_surcharge(spark, sf):
    return profile.profile_distinct(_ctx(spark, sf).raw, "congestion_surcharge")


def q_profile_negative_by_payment(spark, sf):
    """Input: raw trips with refunds (return flag R, i.e. no airport fee) as negatives."""
    raw = _ctx(spark, sf).raw
    signed = raw.withColumn(
        "total_amount",
        F.when(F.col("Airport_fee").isNull(), -F.col("total_amount")).otherwise(F.col("total_amount")),
    )
    return profile.profile_negative_by_payment(signed)


def q_profile_out_of_window(spark, sf):
    return profile.profile_out_of_window(_ctx(spark, sf).raw, *PERIOD)


def q_profile_bad_duration(spark, sf):
    return profile.profile_bad_duration(_ctx(spark, sf).raw)


def q_unknown_pickup_zones(spark, sf):
    c = _ctx(spark, sf)
    return profile.unknown_zones(c.raw, "PULocationID", c.zones)


def q_unknown_dropoff_zones(spark, sf):
    c = _ctx(spark, sf)
    return profile.unknown_zones(c.raw, "DOLocationID", c.zones)


# ---------------------------------------------------------------------------------------
# Contracts
# ---------------------------------------------------------------------------------------


def q_contract_not_null(spark, sf):
    return contracts.contract_not_null(_ctx(spark, sf).star.fact)


def q_contract_foreign_keys(spark, sf):
    star = _ctx(spark, sf).star
    return contracts.contract_foreign_keys(star.fact, star.dims())


def q_contract_unique_dims(spark, sf):
    """Primary keys of the five dimensions and of the fact (its rerun-stable trip key)."""
    c = _ctx(spark, sf)
    star = c.star
    fact = build_fact(c.silver, with_trip_key=True)
    return contracts.contract_unique_keys({**star.dims(), "fact_trip": fact}, {**DIM_KEYS, "fact_trip": "trip_key"})


def q_contract_unique_trips(spark, sf):
    return contracts.unique_business_keys(_ctx(spark, sf).silver, ["source_year", "source_month", *TRIP_KEYS])


def q_contract_lengths(spark, sf):
    star = _ctx(spark, sf).star
    return contracts.contract_lengths({**star.dims(), "fact_trip": star.fact})


def q_contract_unknown_row(spark, sf):
    star = _ctx(spark, sf).star
    return contracts.contract_unknown_row(star.dims(), fact=star.fact)


# ---------------------------------------------------------------------------------------
# Loads: leaf reads, swapped periods, quarantine, contracts, stored dimension and keys
# ---------------------------------------------------------------------------------------


def q_scan_period_leaf(spark, sf):
    """One month's leaf of the landed files, with its period columns."""
    root = scratch_dir(spark, "bronze")
    write_bronze(_ctx(spark, sf).raw, root)
    return _doubles(read_period_leaf(spark, root, *PERIOD))


def _loaded(c: Ctx, table: SwappedTable, fact: DataFrame) -> None:
    periods = [tuple(r) for r in fact.select("source_year", "source_month").distinct().collect()]
    swap(fact, table, periods, RUN_ID, cluster_by=["pickup_date_key"], rebalance=True)


def q_replace_partition_swapped(spark, sf):
    """Load the fact into a registered table, then swap one month for other rows and the next one
    for none: what SQL on the table sees. One more run fails before its swap and changes nothing."""
    c = _ctx(spark, sf)
    fact = _kept(enforce_schema(build_fact(c.silver, with_trip_key=True), FACT_SCHEMA), "fact")
    root = scratch_dir(spark, "swapped")
    table = fact_table(root, f"fact_{root.rpartition('-')[2]}")
    register_swapped(spark, table)
    _loaded(c, table, fact)
    y, m = PERIOD
    rerun = fact.filter((F.col("source_year") == y) & (F.col("source_month") == m) & (F.col("total_amount") > 20000))
    swap(rerun.withColumn("tip_amount", F.col("tip_amount") + 1), table, [(y, m), (y, m + 1)], RUN_ID)
    try:
        swap(rerun.withColumn("vendor_key", F.raise_error(F.lit("lost")).cast("int")), table, [(y, m)], RUN_ID)
    except PySparkException:
        pass
    return spark.sql(
        f"SELECT source_year, source_month, COUNT(*) AS rows, CAST(SUM(tip_amount) AS DOUBLE) AS tips "
        f"FROM {table.name} GROUP BY source_year, source_month"
    )


def q_rejected_trips(spark, sf):
    """Months with faults of each kind go through the pipeline: the rejected rows, from the
    quarantine, with the names of the rules they failed and the columns that weren't castable."""
    c = _ctx(spark, sf)
    paths = replace(c.paths(), judged=scratch_dir(spark, "judged"))
    write_bronze(c.dirty, paths.bronze)
    backfill(spark, paths, RUN_ID, enforce_gate=False)
    rows = read_rejected(spark, paths)
    return _doubles(rows.select(
        *_CONFORMED_COLS, F.col("source_year").cast("int").alias("year"), F.col("source_month").cast("int").alias("month"),
        F.array_join("reject_reasons", ",").alias("reasons"), F.array_join(CAST_FAILED, ",").alias("uncastable")))


def q_contracts_block_load(spark, sf):
    """A load whose location dimension lacks some zones is stopped by the foreign keys: what each
    foreign key found, and the rows that got into the fact."""
    c = _ctx(spark, sf)
    paths = replace(c.paths(), zone_lookup_csv=scratch_dir(spark, "zones"))
    write_bronze(c.raw, paths.bronze)
    write_zone_lookup_csv(c.raw_zones.filter("LocationID % 5 <> 0"), paths.zone_lookup_csv)
    load_dimensions(spark, paths, CALENDAR, with_unknown=False)
    try:
        backfill(spark, paths, RUN_ID, enforce_gate=False, contracts=["foreign_key"])
        broken = []
    except contracts.ContractBreach as e:
        broken = e.findings
    stopped = spark.createDataFrame(broken, "contract string, subject string, findings long")
    return stopped.withColumn("fact_rows", F.lit(read_fact(spark, paths).count()).cast("long"))


def q_dim_location_loaded(spark, sf):
    """Two loads of the stored location dimension: all zones, then every second one under another
    name; the second reads and replaces what the first wrote, and a third changes nothing."""
    c = _ctx(spark, sf)
    table = location_table(scratch_dir(spark, "dim_location"))
    merge_scd1(spark, table, location_dim(c.zones, with_unknown=True), "location_key", RUN_ID)
    changed = location_dim(c.zones).filter("location_id % 2 = 0").withColumn("zone", F.concat("zone", F.lit(" (new)")))
    merge_scd1(spark, table, changed, "location_key", RUN_ID)
    return merge_scd1(spark, table, changed, "location_key", RUN_ID)


def q_fact_identity(spark, sf):
    """Numbers of the trips' keys: a first load of some vendors' trips, then one of all trips, in
    which the first ones keep theirs."""
    c = _ctx(spark, sf)
    keys = key_table(scratch_dir(spark, "keys"))
    for trips in (c.raw.filter("VendorID <= 3"), c.raw):
        fact = _kept(build_fact(silver_trips(trips, RUN_ID, PROCESSED_AT), with_trip_key=True), "fact")
        periods = [tuple(r) for r in fact.select("source_year", "source_month").distinct().collect()]
        found = assign_identities(spark, fact, keys, periods, RUN_ID)
    return found.select("trip_key", "trip_identity")


def q_quality_report_observed(spark, sf):
    """The report from metrics observed within the silver write."""
    c = _ctx(spark, sf)
    paths = c.paths()
    write_bronze(c.raw, paths.bronze)
    return load_silver_observed(spark, paths, RUN_ID, PROCESSED_AT)


def q_mart_zones_from_partials(spark, sf):
    """The zone mart from monthly states, after a quarter was loaded and one of its months run
    again with other rows."""
    c = _ctx(spark, sf).with_kept_raw()
    paths, (y, m) = replace(c.paths(), partials=partials_table(scratch_dir(spark, "partials"))), PERIOD
    write_bronze(c.raw.filter(F.col("year") == y).filter(F.col("month").isin(m - 1, m, m + 1)), paths.bronze)
    backfill(spark, paths, RUN_ID, enforce_gate=False)
    changed = c.raw.filter((F.col("year") == y) & (F.col("month") == m) & (F.col("VendorID") <= 3))
    write_bronze(changed.withColumn("total_amount", (F.col("total_amount") * 2).cast("decimal(10,2)")), paths.bronze)
    run_period(spark, paths, y, m, RUN_ID, enforce_gate=False)
    return marts.mart_zones_from_partials(c.star, read_swapped(spark, paths.partials))


def q_mart_daily_quarter(spark, sf):
    """The days of one quarter from the loaded fact, whose other months aren't read."""
    c = _ctx(spark, sf)
    paths = c.paths()
    replace_partitions(build_fact(c.silver), paths.gold_fact)
    write_dimension(c.dim_date, f"{paths.gold_dims}/dim_date")
    star = c.star
    star.fact, star.dim_date = spark.read.parquet(paths.gold_fact), spark.read.parquet(f"{paths.gold_dims}/dim_date")
    return marts.mart_daily_quarter(star, PERIOD[0], (PERIOD[1] + 2) // 3)


def q_star_sql(spark, sf):
    """A quarter in SQL on the registered, analyzed tables, its joins ordered by cost."""
    c = _ctx(spark, sf)
    paths, star = c.paths(), c.star
    replace_partitions(star.fact, paths.gold_fact)
    for name, dim in star.dims().items():
        write_dimension(dim, f"{paths.gold_dims}/{name}")
    database = f"star_{paths.gold_fact.split('/')[-2].rpartition('-')[2]}"
    register_tables(spark, paths, database)
    analyze_tables(spark, database)
    return star_sql(cost_session(spark), database, PERIOD[0], (PERIOD[1] + 2) // 3)


def q_file_manifest_incremental(spark, sf):
    """All months are audited and stored, then one lands anew: which months' files the second audit
    hashed, and whether the stored manifest has every landed file once."""
    c = _ctx(spark, sf)
    root, stored = scratch_dir(spark, "bronze"), scratch_dir(spark, "manifest")
    write_bronze(c.raw, root)
    update_manifest(spark, root, stored)
    y, m = PERIOD
    write_bronze(c.raw.filter((F.col("year") == y) & (F.col("month") == m) & (F.col("VendorID") <= 3)), root)
    again = update_manifest(spark, root, stored).select("year", "month").distinct().withColumn("_again", F.lit(True))
    files = file_manifest(spark, root).select("year", "month", "source_path", "sha256_checksum")
    kept = read_manifest(spark, stored).select("year", "month", F.col("source_path").alias("_path"), F.col("sha256_checksum").alias("_sum"))
    met = files.join(kept, ["year", "month"], "full").groupBy("year", "month").agg(
        F.countDistinct("source_path").alias("_n"), F.countDistinct("_path").alias("_k"),
        F.count_if((F.col("source_path") == F.col("_path")) & (F.col("sha256_checksum") == F.col("_sum"))).alias("_same"))
    return met.join(again, ["year", "month"], "left").select(
        "year", "month", F.coalesce("_again", F.lit(False)).alias("hashed_again"),
        ((F.col("_n") == F.col("_k")) & (F.col("_n") == F.col("_same"))).alias("up_to_date"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "quality_report_observed": q_quality_report_observed,
    "mart_zones_from_partials": q_mart_zones_from_partials,
    "mart_daily_quarter": q_mart_daily_quarter,
    "star_sql": q_star_sql,
    "file_manifest_incremental": q_file_manifest_incremental,
    "scan_period_leaf": q_scan_period_leaf,
    "replace_partition_swapped": q_replace_partition_swapped,
    "rejected_trips": q_rejected_trips,
    "contracts_block_load": q_contracts_block_load,
    "dim_location_loaded": q_dim_location_loaded,
    "fact_identity": q_fact_identity,
    "scan_raw_trips": q_scan_raw_trips,
    "scan_drifting_months": q_scan_drifting_months,
    "conform_trips": q_conform_trips,
    "cast_failures": q_cast_failures,
    "cast_failures_dirty": q_cast_failures_dirty,
    "lineage_columns": q_lineage_columns,
    "conform_zone_lookup": q_conform_zone_lookup,
    "dim_location": q_dim_location,
    "dim_location_scd1_upsert": q_dim_location_scd1_upsert,
    "dim_location_scd1_changed": q_dim_location_scd1_changed,
    "schema_drift_report": q_schema_drift_report,
    "filter_month_window": q_filter_month_window,
    "filter_valid_trips": q_filter_valid_trips,
    "filter_valid_trips_dirty": q_filter_valid_trips_dirty,
    "reject_reasons": q_reject_reasons,
    "reject_reasons_dirty": q_reject_reasons_dirty,
    "dedupe_trips": q_dedupe_trips,
    "dedupe_lineitem": q_dedupe_lineitem,
    "quality_report": q_quality_report,
    "quality_gate": q_quality_gate,
    "quality_gate_limits": q_quality_gate_limits,
    "pipeline_backfill": q_pipeline_backfill,
    "pipeline_rerun": q_pipeline_rerun,
    "dim_date": q_dim_date,
    "dim_seed_rate_code": q_dim_seed_rate_code,
    "dim_seed_payment_type": q_dim_seed_payment_type,
    "dim_seed_vendor": q_dim_seed_vendor,
    "key_or_unknown": q_key_or_unknown,
    "key_by_lookup": q_key_by_lookup,
    "fact_trips": q_fact_trips,
    "fact_trip_key": q_fact_trip_key,
    "period_spine": q_period_spine,
    "pending_periods": q_pending_periods,
    "pending_periods_done": q_pending_periods_done,
    "file_manifest": q_file_manifest,
    "replace_partition": q_replace_partition,
    "replace_partition_changed": q_replace_partition_changed,
    "monthly_kpi": _mart(marts.monthly_kpi),
    "monthly_recap_narrow_calendar": _narrow(marts.monthly_recap),
    "mart_daily_narrow_calendar": _narrow(marts.mart_daily),
    "mart_mom_gap": _gap(marts.mart_mom),
    "mart_mom_calendar_gap": _gap(lambda s: marts.mart_mom(s, calendar=True)),
    "monthly_recap": _mart(marts.monthly_recap),
    "top_pickup_zones": _mart(marts.top_pickup_zones),
    "tip_by_payment": _mart(marts.tip_by_payment),
    "mart_mom": _mart(marts.mart_mom),
    "mart_mom_calendar": _mart(lambda s: marts.mart_mom(s, calendar=True)),
    "mart_daily": _mart(marts.mart_daily),
    "mart_zones": _mart(marts.mart_zones),
    "mart_payment": _mart(marts.mart_payment),
    "role_playing_dates": _mart(marts.role_playing_dates),
    "route_pairs": _mart(marts.route_pairs),
    "kpi_by_vendor": _mart(marts.kpi_by_vendor),
    "kpi_by_rate_code": _mart(marts.kpi_by_rate_code),
    "report_kpi": q_report_kpi,
    "report_latest_growth": q_report_latest_growth,
    "report_zones": q_report_zones,
    "report_payment": q_report_payment,
    "report_zones_period": q_report_zones_period,
    "report_zones_weighted": q_report_zones_weighted,
    "report_payment_weighted": q_report_payment_weighted,
    "report_borough_share": q_report_borough_share,
    "report_top10_zones": q_report_top10_zones,
    "report_formatted": q_report_formatted,
    "profile_numeric": q_profile_numeric,
    "profile_null_counts": q_profile_null_counts,
    "profile_distinct_rate_code": q_profile_distinct_rate_code,
    "profile_distinct_flag": q_profile_distinct_flag,
    "profile_distinct_surcharge": q_profile_distinct_surcharge,
    "profile_negative_by_payment": q_profile_negative_by_payment,
    "profile_out_of_window": q_profile_out_of_window,
    "profile_bad_duration": q_profile_bad_duration,
    "unknown_pickup_zones": q_unknown_pickup_zones,
    "unknown_dropoff_zones": q_unknown_dropoff_zones,
    "unknown_dropoff_zones_gap": q_unknown_dropoff_zones_gap,
    "contract_not_null": q_contract_not_null,
    "contract_foreign_keys": q_contract_foreign_keys,
    "contract_unique_dims": q_contract_unique_dims,
    "contract_unique_trips": q_contract_unique_trips,
    "contract_lengths": q_contract_lengths,
    "contract_unknown_row": q_contract_unknown_row,
}

# Queries without SQL.
ROWS_ONLY: set[str] = set()


# ---------------------------------------------------------------------------------------
# Reference SQL per query (DuckDB), built on the shared prelude
# ---------------------------------------------------------------------------------------

_MIN = "CAST(trip_duration_seconds AS DOUBLE) / CAST(60.0 AS DOUBLE)"
_CONFORMED_COLS = [
    "vendor_id", "pickup_datetime", "dropoff_datetime", "passenger_count", "trip_distance",
    "rate_code_id", "store_and_fwd_flag", "pu_location_id", "do_location_id", "payment_type",
    "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge",
    "total_amount", "congestion_surcharge", "airport_fee",
]
_RAW_COLS = [
    "VendorID", "tpep_pickup_datetime", "tpep_dropoff_datetime", "passenger_count",
    "trip_distance", "RatecodeID", "store_and_fwd_flag", "PULocationID", "DOLocationID",
    "payment_type", "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
    "improvement_surcharge", "total_amount", "congestion_surcharge", "Airport_fee", "year", "month",
]
_CAST_TARGET = {
    "vendor_id": ("VendorID", "INTEGER"), "pickup_datetime": ("tpep_pickup_datetime", "TIMESTAMP"),
    "dropoff_datetime": ("tpep_dropoff_datetime", "TIMESTAMP"),
    "passenger_count": ("passenger_count", "INTEGER"), "trip_distance": ("trip_distance", "DOUBLE"),
    "rate_code_id": ("RatecodeID", "INTEGER"), "store_and_fwd_flag": ("store_and_fwd_flag", "VARCHAR"),
    "pu_location_id": ("PULocationID", "INTEGER"), "do_location_id": ("DOLocationID", "INTEGER"),
    "payment_type": ("payment_type", "INTEGER"), "fare_amount": ("fare_amount", "DECIMAL(10,2)"),
    "extra": ("extra", "DECIMAL(10,2)"), "mta_tax": ("mta_tax", "DECIMAL(10,2)"),
    "tip_amount": ("tip_amount", "DECIMAL(10,2)"), "tolls_amount": ("tolls_amount", "DECIMAL(10,2)"),
    "improvement_surcharge": ("improvement_surcharge", "DECIMAL(10,2)"),
    "total_amount": ("total_amount", "DECIMAL(10,2)"),
    "congestion_surcharge": ("congestion_surcharge", "DOUBLE"), "airport_fee": ("Airport_fee", "DOUBLE"),
}
_WINDOW_9702 = (
    "pickup_datetime >= TIMESTAMP '1997-02-01 00:00:00' AND pickup_datetime < TIMESTAMP '1997-03-01 00:00:00'"
)
_RULES = {
    "pickup_in_period": "pickup_datetime >= make_timestamp(year, month, 1, 0, 0, 0) AND "
                        "pickup_datetime < make_timestamp(year, month, 1, 0, 0, 0) + INTERVAL 1 MONTH",
    "dropoff_after_pickup": "dropoff_datetime > pickup_datetime",
    "distance_in_range": "trip_distance >= 0 AND trip_distance < 500",
}
_LABEL = "month_name || ' ' || CAST(year AS VARCHAR)"


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def _rollup_cte(fact: str = "fact") -> str:
    return f"""mom_rollup AS (
    SELECT d.year, d.month, d.month_name, COUNT(*) AS total_trips, SUM(f.total_amount) AS rev,
        {R("AVG(f.trip_distance)")} AS avg_distance_miles,
        {R(f"AVG(CAST(f.trip_duration_seconds AS DOUBLE) / CAST(60.0 AS DOUBLE))")} AS avg_duration_minutes,
        {R("CAST(SUM(f.tip_amount) AS DOUBLE) / COUNT(f.tip_amount)")} AS avg_tip_usd
    FROM {fact} f LEFT JOIN dim_date d ON f.pickup_date_key = d.date_key
    GROUP BY d.year, d.month, d.month_name
)"""


def _mom_ctes(calendar: bool, fact: str = "fact") -> list[str]:
    if calendar:
        lagged = """mom_lagged AS (
    SELECT *,
        CASE WHEN year IS NOT NULL THEN max(total_trips) OVER w END AS prev_trips,
        CASE WHEN year IS NOT NULL THEN max(rev) OVER w END AS prev_rev
    FROM mom_rollup
    WINDOW w AS (ORDER BY year * 12 + month ASC NULLS LAST RANGE BETWEEN 1 PRECEDING AND 1 PRECEDING)
)"""
    else:
        lagged = """mom_lagged AS (
    SELECT *, LAG(total_trips) OVER w AS prev_trips, LAG(rev) OVER w AS prev_rev
    FROM mom_rollup
    WINDOW w AS (ORDER BY year ASC NULLS LAST, month ASC NULLS LAST)
)"""
    mom = f"""mom AS (
    SELECT year, month, month_name, total_trips, CAST(rev AS DOUBLE) AS total_revenue_usd,
        avg_distance_miles, avg_duration_minutes, avg_tip_usd,
        prev_trips AS prev_month_trips, CAST(prev_rev AS DOUBLE) AS prev_month_revenue,
        {R("CAST(total_trips - prev_trips AS DOUBLE) / NULLIF(prev_trips, 0) * 100.0")} AS mom_trip_growth_pct,
        {R("CAST(rev - prev_rev AS DOUBLE) / NULLIF(prev_rev, 0) * 100.0")} AS mom_revenue_growth_pct,
        {_LABEL} AS period_label
    FROM mom_lagged
)"""
    return [_rollup_cte(fact), lagged, mom]


_ZONES_CTE = f"""zones_mart AS (
    SELECT d.year, d.month, d.month_name, l.borough, l.zone, COUNT(*) AS total_trips,
        CAST(SUM(f.total_amount) AS DOUBLE) AS total_revenue_usd,
        {R("CAST(SUM(f.fare_amount) AS DOUBLE) / COUNT(f.fare_amount)")} AS avg_fare_usd,
        d.month_name || ' ' || CAST(d.year AS VARCHAR) AS period_label
    FROM fact f
    JOIN dim_date d ON f.pickup_date_key = d.date_key
    LEFT JOIN dim_location l ON f.pickup_location_key = l.location_key
    GROUP BY d.year, d.month, d.month_name, l.borough, l.zone
)"""

_PAYMENT_CTE = f"""payment_mart AS (
    SELECT d.year, d.month, d.month_name, p.payment_type_name, COUNT(*) AS transaction_count,
        CAST(SUM(f.total_amount) AS DOUBLE) AS total_volume_usd,
        {R("CAST(SUM(f.tip_amount) AS DOUBLE) / COUNT(f.tip_amount)")} AS avg_tip_usd,
        {R("CAST(SUM(f.tip_amount) AS DOUBLE) / NULLIF(SUM(f.fare_amount), 0) * 100.0")} AS effective_tip_rate_pct,
        d.month_name || ' ' || CAST(d.year AS VARCHAR) AS period_label
    FROM fact f
    JOIN dim_date d ON f.pickup_date_key = d.date_key
    LEFT JOIN dim_payment_type p ON f.payment_type_key = p.payment_type_key
    GROUP BY d.year, d.month, d.month_name, p.payment_type_name
)"""

_ZONE_REPORT_CTE = f"""zone_report AS (
    SELECT borough, zone, CAST(SUM(total_trips) AS BIGINT) AS total_trips,
        CAST(SUM(CAST(total_revenue_usd AS DECIMAL(20,2))) AS DOUBLE) AS total_revenue_usd,
        {M6("avg_fare_usd")} AS avg_fare_usd
    FROM zones_mart WHERE borough IS NOT NULL AND zone IS NOT NULL
    GROUP BY borough, zone
)"""

_PAYMENT_REPORT_CTE = f"""payment_report AS (
    SELECT payment_type_name, CAST(SUM(transaction_count) AS BIGINT) AS transaction_count,
        CAST(SUM(CAST(total_volume_usd AS DECIMAL(20,2))) AS DOUBLE) AS total_volume_usd,
        {M6("avg_tip_usd")} AS avg_tip_usd,
        {M6("effective_tip_rate_pct")} AS effective_tip_rate_pct
    FROM payment_mart WHERE payment_type_name IS NOT NULL
    GROUP BY payment_type_name
)"""

_REPORT_CTE = f"""report AS (
    SELECT '{{ds}}' AS dataset, CAST(c.year AS INTEGER) AS year, CAST(c.month AS INTEGER) AS month,
        CAST(c.total AS BIGINT) AS total_input_rows, CAST(COALESCE(a.acc, 0) AS BIGINT) AS accepted_rows,
        CAST(c.total - COALESCE(a.acc, 0) AS BIGINT) AS rejected_rows,
        COALESCE({R("CAST(COALESCE(a.acc, 0) AS DOUBLE) / c.total * 100.0")}, 0.0) AS acceptance_rate_pct,
        '{PROCESSED_AT}' AS processed_at_utc
    FROM (SELECT year, month, COUNT(*) AS total FROM conformed GROUP BY year, month) c
    LEFT JOIN (SELECT year, month, COUNT(*) AS acc FROM accepted GROUP BY year, month) a
      ON c.year = a.year AND c.month = a.month
)"""


def _gate_cte(least: int = 1000, most: float = 5.0) -> str:
    return f"""gate AS (
    SELECT dataset, year, month, CAST(COALESCE(accepted_rows, 0) AS BIGINT) AS accepted_rows,
        {R("100.0 - COALESCE(acceptance_rate_pct, 0.0)")} AS rejection_rate_pct,
        (COALESCE(accepted_rows, 0) >= {least} AND 100.0 - COALESCE(acceptance_rate_pct, 0.0) <= {most}) AS passed,
        CASE WHEN COALESCE(accepted_rows, 0) < {least} THEN 'too_few_rows'
             WHEN 100.0 - COALESCE(acceptance_rate_pct, 0.0) > {most} THEN 'rejection_rate_too_high'
             ELSE 'ok' END AS gate_reason
    FROM report
)"""


def _profile_numeric_sql() -> str:
    parts = []
    for c in profile.NUMERIC_RAW_COLUMNS:
        name = "Airport_fee" if c == "airport_fee" else c
        x = f"CAST({name} AS DOUBLE)"
        parts.append(
            f"SELECT '{name}' AS column_name, COUNT({x}) AS count, {R(f'AVG({x})', 6)} AS mean, "
            f"{R(f'STDDEV_SAMP({x})', 6)} AS stddev, MIN({x}) AS min, MAX({x}) AS max FROM raw_trips"
        )
    return _union(parts)


def _null_counts_sql(table: str, cols: list[str]) -> str:
    return _union([
        f"SELECT '{c}' AS column_name, CAST(count_if({c} IS NULL) AS BIGINT) AS null_count FROM {table}"
        for c in cols
    ])


_FACT_COLS = [
    "pickup_date_key", "dropoff_date_key", "pickup_location_key", "dropoff_location_key",
    "rate_code_key", "payment_type_key", "vendor_key", "store_and_fwd_flag", "pickup_datetime",
    "dropoff_datetime", "passenger_count", "trip_distance", "trip_duration_seconds", "fare_amount",
    "extra", "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge",
    "congestion_surcharge", "airport_fee", "total_amount", "source_year", "source_month",
    "pipeline_run_id",
]


def _fk_sql() -> str:
    return _union([
        f"SELECT '{c}' AS fk_column, '{t}' AS dim_table, '{k}' AS dim_key, "
        f"CAST(COUNT(*) AS BIGINT) AS dangling_rows FROM fact f "
        f"WHERE NOT EXISTS (SELECT 1 FROM {t} d WHERE d.{k} = f.{c})"
        for c, t, k in SQL_FOREIGN_KEYS
    ])


def _unique_dims_sql() -> str:
    # The fact's trip key is a hash of (period, business key): it is unique exactly when
    # that tuple is (barring a hash collision, which is what the contract would reveal).
    fact_key = "source_year, source_month, " + ", ".join(SQL_TRIP_KEYS)
    return _union([
        f"SELECT '{t}' AS table_name, CAST(count_if(n > 1) AS BIGINT) AS duplicate_keys, "
        f"CAST(COALESCE(SUM(CASE WHEN n > 1 THEN n END), 0) AS BIGINT) AS duplicate_rows "
        f"FROM (SELECT COUNT(*) AS n FROM {src} GROUP BY {k})"
        for t, src, k in [*[(t, t, k) for t, k in SQL_DIM_KEYS.items()], ("fact_trip", "silver", fact_key)]
    ])


def _lengths_sql() -> str:
    table_of = {"fact_trip": "fact"}
    parts = []
    for t, c, n in SQL_LIMITS:
        parts.append(
            f"SELECT '{t}' AS table_name, '{c}' AS column_name, CAST(MAX(length({c})) AS INTEGER) AS max_length, "
            f"{n} AS max_allowed, COALESCE(MAX(length({c})) <= {n}, TRUE) AS within_limit "
            f"FROM {table_of.get(t, t)}"
        )
    return _union(parts)


def _unknown_row_sql() -> str:
    fk_cols: dict[str, list[str]] = {}
    for c, t, _ in SQL_FOREIGN_KEYS:
        fk_cols.setdefault(t, []).append(c)
    parts = []
    for t, k in SQL_DIM_KEYS.items():
        hit = " OR ".join(f"{c} = 0" for c in fk_cols[t])
        parts.append(
            f"SELECT '{t}' AS table_name, CAST(count_if({k} = 0) AS BIGINT) AS unknown_rows, "
            f"count_if({k} = 0) = 1 AS has_single_unknown, "
            f"(SELECT CAST(count_if({hit}) AS BIGINT) FROM fact) AS fact_rows_on_unknown FROM {t}"
        )
    return _union(parts)


def _oracles() -> dict[str, str]:
    money = money_as_double()
    conform_failures = _union([
        f"SELECT '{tgt}' AS column_name, CAST(count_if({src} IS NOT NULL AND TRY_CAST({src} AS {typ}) IS NULL) AS BIGINT) AS failures FROM raw_trips"
        for tgt, (src, typ) in _CAST_TARGET.items()
    ])
    o = {
        "scan_raw_trips": _sql(f"SELECT {money} FROM raw_trips"),
        "conform_trips": _sql(f"SELECT {money} FROM conformed"),
        "cast_failures": _sql(conform_failures),
        "lineage_columns": _sql(f"SELECT {money} FROM silver"),
        "conform_zone_lookup": _sql("SELECT * FROM zones"),
        "dim_location": _sql("SELECT * FROM dim_location"),
        "dim_location_scd1_upsert": _sql(
            "SELECT * FROM dim_location UNION ALL "
            "SELECT 0, 0, 'Unknown', 'Unknown', 'Unknown' WHERE NOT EXISTS "
            "(SELECT 1 FROM dim_location WHERE location_key = 0)"
        ),
        "filter_month_window": _sql(f"SELECT {money} FROM conformed WHERE {_WINDOW_9702}"),
        "filter_valid_trips": _sql(f"SELECT {money} FROM valid"),
        "reject_reasons": _sql(_union([
            f"SELECT '{n}' AS reason, CAST(count_if(NOT COALESCE({p}, FALSE)) AS BIGINT) AS rejected_rows FROM conformed"
            for n, p in _RULES.items()
        ])),
        "dedupe_trips": _sql(f"SELECT {money} FROM accepted"),
        "dedupe_lineitem": _sql(
            "SELECT * EXCLUDE (_rn) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber "
            "ORDER BY l_partkey NULLS FIRST, l_suppkey NULLS FIRST, l_quantity NULLS FIRST, "
            "l_extendedprice NULLS FIRST, l_discount NULLS FIRST, l_tax NULLS FIRST, l_returnflag NULLS FIRST, "
            "l_linestatus NULLS FIRST, l_shipdate NULLS FIRST) AS _rn FROM lineitem) WHERE _rn = 1"
        ),
        "quality_report": _sql("SELECT * FROM report", _REPORT_CTE.replace("{ds}", "yellow_tripdata")),
        "quality_gate": _sql("SELECT * FROM gate", _REPORT_CTE.replace("{ds}", "yellow_tripdata"), _gate_cte()),
        "dim_date": _sql(
            "SELECT CAST(year(d) * 10000 + month(d) * 100 + day(d) AS INTEGER) AS date_key, d AS full_date, "
            "CAST(isodow(d) AS INTEGER) AS day_of_week, dayname(d) AS day_name, CAST(day(d) AS INTEGER) AS day_of_month, "
            "CAST(month(d) AS INTEGER) AS month, monthname(d) AS month_name, CAST(quarter(d) AS INTEGER) AS quarter, "
            "CAST(year(d) AS INTEGER) AS year, isodow(d) >= 6 AS is_weekend "
            "FROM (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d FROM ("
            "SELECT CAST(date_trunc('year', MIN(LEAST(tpep_pickup_datetime, tpep_dropoff_datetime))) AS DATE) AS lo, "
            "make_date(year(MAX(GREATEST(tpep_pickup_datetime, tpep_dropoff_datetime))), 12, 31) AS hi FROM raw_trips))"
        ),
        "dim_seed_rate_code": _sql(
            "SELECT d.*, CAST(COALESCE(u.trips, 0) AS BIGINT) AS trips FROM dim_rate_code d LEFT JOIN "
            "(SELECT rate_code_key, COUNT(*) AS trips FROM fact GROUP BY rate_code_key) u USING (rate_code_key)"
        ),
        "dim_seed_payment_type": _sql(
            "SELECT d.*, CAST(COALESCE(u.trips, 0) AS BIGINT) AS trips FROM dim_payment_type d LEFT JOIN "
            "(SELECT payment_type_key, COUNT(*) AS trips FROM fact GROUP BY payment_type_key) u USING (payment_type_key)"
        ),
        "dim_seed_vendor": _sql(
            "SELECT d.*, CAST(COALESCE(u.trips, 0) AS BIGINT) AS trips FROM dim_vendor d LEFT JOIN "
            "(SELECT vendor_key, COUNT(*) AS trips FROM fact GROUP BY vendor_key) u USING (vendor_key)"
        ),
        "key_or_unknown": _sql(
            "SELECT vendor_id, CAST(CASE WHEN vendor_id IN (1, 2) THEN vendor_id ELSE 0 END AS INTEGER) AS vendor_key, "
            "rate_code_id, CAST(CASE WHEN rate_code_id IN (1, 2, 3, 4, 5, 6) THEN rate_code_id ELSE 0 END AS INTEGER) AS rate_code_key, "
            "payment_type, CAST(CASE WHEN payment_type IN (1, 2, 3, 4, 5, 6) THEN payment_type ELSE 0 END AS INTEGER) AS payment_type_key, "
            "COUNT(*) AS trips FROM silver GROUP BY ALL"
        ),
        "key_by_lookup": _sql(
            "SELECT s.pu_location_id, CAST(COALESCE(l.location_key, 0) AS INTEGER) AS pickup_location_key, "
            "COUNT(*) AS trips FROM silver s LEFT JOIN dim_location l ON s.pu_location_id = l.location_id "
            "GROUP BY ALL"
        ),
        "fact_trips": _sql(f"SELECT {money} FROM fact"),
        "period_spine": _sql(
            "SELECT CAST(year(p) AS INTEGER) AS year, CAST(month(p) AS INTEGER) AS month, CAST(p AS DATE) AS period_start "
            "FROM (SELECT unnest(generate_series(date_trunc('month', MIN(tpep_pickup_datetime)), "
            "date_trunc('month', MAX(tpep_pickup_datetime)), INTERVAL 1 MONTH)) AS p FROM raw_trips)"
        ),
        "pending_periods": _sql(
            f"SELECT CAST(year(p) AS INTEGER) AS year, CAST(month(p) AS INTEGER) AS month "
            f"FROM (SELECT unnest(generate_series(DATE '{CALENDAR[0]}', DATE '{CALENDAR[1]}', INTERVAL 1 MONTH)) AS p) s "
            f"WHERE EXISTS (SELECT 1 FROM raw_trips r WHERE r.year = year(s.p) AND r.month = month(s.p)) "
            f"AND NOT EXISTS (SELECT 1 FROM gate g WHERE g.passed AND g.year = year(s.p) AND g.month = month(s.p))",
            _REPORT_CTE.replace("{ds}", "yellow_tripdata"), _gate_cte(),
        ),
        "replace_partition": _sql(
            "SELECT source_year, source_month, COUNT(*) AS rows FROM fact GROUP BY source_year, source_month"
        ),
        "monthly_kpi": _sql(
            "SELECT d.year, d.month_name, COUNT(*) AS total_trips, CAST(SUM(f.total_amount) AS DOUBLE) AS total_revenue_usd, "
            f"AVG(f.trip_distance) AS avg_distance_miles, AVG({_MIN}) AS avg_duration_minutes "
            "FROM fact f LEFT JOIN dim_date d ON f.pickup_date_key = d.date_key GROUP BY d.year, d.month_name"
        ),
        "monthly_recap": _sql(
            "SELECT year, month_name, total_trips, total_revenue_usd, avg_distance_miles, avg_duration_minutes FROM ("
            "SELECT d.year, d.month_name, f.source_year, f.source_month, COUNT(*) AS total_trips, "
            "CAST(SUM(f.total_amount) AS DOUBLE) AS total_revenue_usd, "
            f"{R('AVG(f.trip_distance)')} AS avg_distance_miles, {R(f'AVG({_MIN})')} AS avg_duration_minutes "
            "FROM fact f LEFT JOIN dim_date d ON f.pickup_date_key = d.date_key "
            "GROUP BY d.year, d.month_name, f.source_year, f.source_month)"
        ),
        "top_pickup_zones": _sql(
            "SELECT l.borough, l.zone, COUNT(*) AS pickup_count, CAST(SUM(f.total_amount) AS DOUBLE) AS total_revenue_usd "
            "FROM fact f LEFT JOIN dim_location l ON f.pickup_location_key = l.location_key "
            "GROUP BY l.borough, l.zone ORDER BY pickup_count DESC, l.borough ASC NULLS LAST, l.zone ASC NULLS LAST LIMIT 5"
        ),
        "tip_by_payment": _sql(
            "SELECT p.payment_type_name, COUNT(*) AS total_transactions, "
            "CAST(SUM(f.tip_amount) AS DOUBLE) / COUNT(f.tip_amount) AS avg_tip_usd, "
            "CAST(SUM(f.total_amount) AS DOUBLE) / COUNT(f.total_amount) AS avg_total_usd "
            "FROM fact f LEFT JOIN dim_payment_type p ON f.payment_type_key = p.payment_type_key "
            "GROUP BY p.payment_type_name"
        ),
        "mart_mom": _sql("SELECT * FROM mom", *_mom_ctes(False)),
        "mart_mom_calendar": _sql("SELECT * FROM mom", *_mom_ctes(True)),
        "mart_daily": _sql(
            "SELECT d.year, d.month, d.day_of_month, d.full_date, d.month_name, COUNT(*) AS total_trips, "
            "CAST(SUM(f.total_amount) AS DOUBLE) AS total_revenue_usd, "
            f"{R(f'AVG({_MIN})')} AS avg_duration_minutes, {R('AVG(f.trip_distance)')} AS avg_distance_miles, "
            "d.month_name || ' ' || CAST(d.year AS VARCHAR) AS period_label, "
            "substr(d.month_name, 1, 3) || ' ' || CAST(d.day_of_month AS VARCHAR) AS day_label "
            "FROM fact f JOIN dim_date d ON f.pickup_date_key = d.date_key "
            "GROUP BY d.year, d.month, d.day_of_month, d.full_date, d.month_name"
        ),
        "mart_zones": _sql("SELECT * FROM zones_mart", _ZONES_CTE),
        "mart_payment": _sql("SELECT * FROM payment_mart", _PAYMENT_CTE),
        "role_playing_dates": _sql(
            "SELECT p.year AS pickup_year, p.month AS pickup_month, q.year AS dropoff_year, q.month AS dropoff_month, "
            "COUNT(*) AS total_trips, CAST(SUM(f.total_amount) AS DOUBLE) AS total_revenue_usd, "
            f"{R(f'AVG({_MIN})')} AS avg_duration_minutes "
            "FROM fact f LEFT JOIN dim_date p ON f.pickup_date_key = p.date_key "
            "LEFT JOIN dim_date q ON f.dropoff_date_key = q.date_key GROUP BY 1, 2, 3, 4"
        ),
        "route_pairs": _sql(
            "SELECT a.borough AS pickup_borough, a.zone AS pickup_zone, b.borough AS dropoff_borough, "
            "b.zone AS dropoff_zone, COUNT(*) AS total_trips, CAST(SUM(f.total_amount) AS DOUBLE) AS total_revenue_usd "
            "FROM fact f LEFT JOIN dim_location a ON f.pickup_location_key = a.location_key "
            "LEFT JOIN dim_location b ON f.dropoff_location_key = b.location_key GROUP BY 1, 2, 3, 4"
        ),
        "kpi_by_vendor": _sql(
            "SELECT v.vendor_name, COUNT(*) AS total_trips, CAST(SUM(f.total_amount) AS DOUBLE) AS total_revenue_usd, "
            f"{R('AVG(f.trip_distance)')} AS avg_distance_miles "
            "FROM fact f LEFT JOIN dim_vendor v ON f.vendor_key = v.vendor_key GROUP BY v.vendor_name"
        ),
        "kpi_by_rate_code": _sql(
            "SELECT r.rate_code_name, COUNT(*) AS total_trips, CAST(SUM(f.total_amount) AS DOUBLE) AS total_revenue_usd, "
            f"{R('AVG(f.trip_distance)')} AS avg_distance_miles "
            "FROM fact f LEFT JOIN dim_rate_code r ON f.rate_code_key = r.rate_code_key GROUP BY r.rate_code_name"
        ),
        "report_kpi": _sql(
            "SELECT CAST(COALESCE(SUM(total_trips), 0) AS BIGINT) AS total_trips, "
            "COALESCE(CAST(SUM(CAST(total_revenue_usd AS DECIMAL(20,2))) AS DOUBLE), 0.0) AS total_revenue_usd, "
            f"COALESCE({M6('avg_distance_miles')}, 0.0) AS avg_distance_miles, "
            f"COALESCE({M6('avg_duration_minutes')}, 0.0) AS avg_duration_minutes, COUNT(*) AS periods FROM mom",
            *_mom_ctes(False),
        ),
        "report_latest_growth": _sql(
            "SELECT year, month, period_label, mom_trip_growth_pct, mom_revenue_growth_pct, "
            "CASE WHEN mom_revenue_growth_pct IS NULL THEN 'Baseline' ELSE printf('%+.1f%%', "
            f"{R('mom_revenue_growth_pct', 1)}) END AS revenue_growth_label, "
            "CASE WHEN mom_trip_growth_pct IS NULL THEN 'Baseline' ELSE printf('%+.1f%%', "
            f"{R('mom_trip_growth_pct', 1)}) END AS trip_growth_label "
            "FROM mom ORDER BY year DESC NULLS FIRST, month DESC NULLS FIRST LIMIT 1",
            *_mom_ctes(False),
        ),
        "report_zones": _sql("SELECT * FROM zone_report", _ZONES_CTE, _ZONE_REPORT_CTE),
        "report_payment": _sql("SELECT * FROM payment_report", _PAYMENT_CTE, _PAYMENT_REPORT_CTE),
        "report_zones_period": _sql(
            "SELECT borough, zone, CAST(SUM(total_trips) AS BIGINT) AS total_trips, "
            "CAST(SUM(CAST(total_revenue_usd AS DECIMAL(20,2))) AS DOUBLE) AS total_revenue_usd, "
            f"{M6('avg_fare_usd')} AS avg_fare_usd "
            "FROM zones_mart WHERE borough IS NOT NULL AND zone IS NOT NULL AND year = 1997 AND month = 2 "
            "GROUP BY borough, zone",
            _ZONES_CTE,
        ),
        "report_zones_weighted": _sql(
            "SELECT borough, zone, CAST(SUM(total_trips) AS BIGINT) AS total_trips, "
            "CAST(SUM(CAST(total_revenue_usd AS DECIMAL(20,2))) AS DOUBLE) AS total_revenue_usd, "
            "CAST(SUM(CAST(avg_fare_usd AS DECIMAL(20,2)) * total_trips) AS DOUBLE) / "
            "SUM(CASE WHEN avg_fare_usd IS NOT NULL THEN total_trips END) AS avg_fare_usd "
            "FROM zones_mart WHERE borough IS NOT NULL AND zone IS NOT NULL GROUP BY borough, zone",
            _ZONES_CTE,
        ),
        "report_payment_weighted": _sql(
            "SELECT payment_type_name, CAST(SUM(transaction_count) AS BIGINT) AS transaction_count, "
            "CAST(SUM(CAST(total_volume_usd AS DECIMAL(20,2))) AS DOUBLE) AS total_volume_usd, "
            "CAST(SUM(CAST(avg_tip_usd AS DECIMAL(20,2)) * transaction_count) AS DOUBLE) / "
            "SUM(CASE WHEN avg_tip_usd IS NOT NULL THEN transaction_count END) AS avg_tip_usd, "
            "CAST(SUM(CAST(effective_tip_rate_pct AS DECIMAL(20,2)) * transaction_count) AS DOUBLE) / "
            "SUM(CASE WHEN effective_tip_rate_pct IS NOT NULL THEN transaction_count END) AS effective_tip_rate_pct "
            "FROM payment_mart WHERE payment_type_name IS NOT NULL GROUP BY payment_type_name",
            _PAYMENT_CTE,
        ),
        "report_borough_share": _sql(
            "SELECT borough, CAST(rev AS DOUBLE) AS total_revenue_usd, "
            f"{R('CAST(rev AS DOUBLE) / CAST(SUM(rev) OVER () AS DOUBLE) * 100.0')} AS revenue_share_pct "
            "FROM (SELECT borough, SUM(CAST(total_revenue_usd AS DECIMAL(20,2))) AS rev FROM zone_report GROUP BY borough)",
            _ZONES_CTE, _ZONE_REPORT_CTE,
        ),
        "report_top10_zones": _sql(
            "SELECT * FROM zone_report ORDER BY total_trips DESC, borough, zone LIMIT 10",
            _ZONES_CTE, _ZONE_REPORT_CTE,
        ),
        "profile_numeric": _sql(_profile_numeric_sql()),
        "profile_null_counts": _sql(_null_counts_sql("raw_trips", _RAW_COLS)),
        "profile_distinct_rate_code": _sql("SELECT DISTINCT RatecodeID FROM raw_trips"),
        "profile_distinct_flag": _sql("SELECT DISTINCT store_and_fwd_flag FROM raw_trips"),
        "profile_distinct_surcharge": _sql("SELECT DISTINCT congestion_surcharge FROM raw_trips"),
        "profile_negative_by_payment": _sql(
            "SELECT payment_type, COUNT(*) AS negative_rows FROM ("
            "SELECT payment_type, CASE WHEN Airport_fee IS NULL THEN -total_amount ELSE total_amount END AS amt "
            "FROM raw_trips) WHERE amt < 0 GROUP BY payment_type"
        ),
        "profile_out_of_window": _sql(
            "SELECT 1997 AS year, 2 AS month, CAST(count_if(tpep_pickup_datetime IS NOT NULL AND NOT ("
            "tpep_pickup_datetime >= TIMESTAMP '1997-02-01 00:00:00' AND tpep_pickup_datetime < TIMESTAMP '1997-03-01 00:00:00'"
            ")) AS BIGINT) AS rows_outside_window FROM raw_trips"
        ),
        "profile_bad_duration": _sql(
            "SELECT CAST(count_if(tpep_dropoff_datetime <= tpep_pickup_datetime) AS BIGINT) AS rows_non_positive_duration FROM raw_trips"
        ),
        "unknown_pickup_zones": _sql(
            "SELECT PULocationID AS location_id, COUNT(*) AS unmatched_rows FROM raw_trips r "
            "WHERE NOT EXISTS (SELECT 1 FROM zones z WHERE z.location_id = r.PULocationID) GROUP BY PULocationID"
        ),
        "unknown_dropoff_zones": _sql(
            "SELECT DOLocationID AS location_id, COUNT(*) AS unmatched_rows FROM raw_trips r "
            "WHERE NOT EXISTS (SELECT 1 FROM zones z WHERE z.location_id = r.DOLocationID) GROUP BY DOLocationID"
        ),
        "contract_not_null": _sql(
            _null_counts_sql("fact", _FACT_COLS)
            + "\nUNION ALL\nSELECT 'inserted_at_utc' AS column_name, CAST(0 AS BIGINT) AS null_count"
        ),
        "contract_foreign_keys": _sql(_fk_sql()),
        "contract_unique_dims": _sql(_unique_dims_sql()),
        "contract_unique_trips": _sql(
            "SELECT CAST(count_if(n > 1) AS BIGINT) AS duplicate_keys, "
            "CAST(COALESCE(SUM(CASE WHEN n > 1 THEN n END), 0) AS BIGINT) AS duplicate_rows FROM ("
            "SELECT COUNT(*) AS n FROM silver GROUP BY source_year, source_month, "
            + ", ".join(SQL_TRIP_KEYS) + ")"
        ),
        "contract_lengths": _sql(_lengths_sql()),
        "contract_unknown_row": _sql(_unknown_row_sql()),
    }
    return o | _more_oracles(money)


# The raw trips with the faults of ``Ctx.dirty``.
_DIRTY = """(SELECT * REPLACE (
    CASE WHEN VendorID = 6 THEN 'n/a' ELSE CAST(total_amount AS VARCHAR) END AS total_amount,
    CAST(CASE WHEN VendorID = 5 THEN month % 12 + 1 ELSE month END AS INTEGER) AS month,
    CASE WHEN VendorID = 4 THEN tpep_pickup_datetime ELSE tpep_dropoff_datetime END AS tpep_dropoff_datetime
) FROM raw_trips)"""


def _trip_key_text() -> str:
    return "concat_ws('|', " + ", ".join(
        f"coalesce(CAST({k} AS VARCHAR), '-')" for k in ("source_year", "source_month", *SQL_TRIP_KEYS)) + ")"


def _with_keys(pre: list[str]) -> list[str]:
    """The prelude with each accepted trip's key beside it, for the fact."""
    at = next(k for k, c in enumerate(pre) if c.startswith("fact AS"))
    return [*pre[:at], f"keyed AS (SELECT *, md5({_trip_key_text()}) AS trip_key FROM silver)", *pre[at:]]


def _count_format(x: str, decimals: int) -> str:
    return f"format('{{:,.{decimals}f}}', CAST({x} AS DOUBLE))"


def _more_oracles(money: str) -> dict[str, str]:
    report = _REPORT_CTE.replace("{ds}", "yellow_tripdata")
    dirty = prelude(None, RUN_ID, PROCESSED_AT, _DIRTY)
    rules = {**_RULES, "values_cast": "NOT bad"}
    limits = _gate_cte(GATE["min_rows"], GATE["max_reject_pct"])
    y, m = PERIOD
    quarter = f"source_year = {y} AND source_month IN ({m - 1}, {m}, {m + 1})"
    rerun = prelude(None, RUN_ID, PROCESSED_AT, f"(SELECT * REPLACE (CAST(total_amount * 2 AS DECIMAL(10,2)) AS total_amount) "
                    f"FROM raw_trips WHERE year = {y} AND month = {m} AND VendorID <= 3)")
    first_fact = with_ctes(PRE, f"SELECT * FROM fact WHERE {quarter} AND source_month <> {m}")
    second_fact = with_ctes(rerun, "SELECT * FROM fact")
    named = {src: tgt for tgt, (src, _) in _CAST_TARGET.items()}
    some = prelude(None, RUN_ID, PROCESSED_AT, "(SELECT * FROM raw_trips WHERE VendorID <= 3)")
    few, every = (with_ctes(_with_keys(pre), "SELECT DISTINCT trip_key FROM keyed") for pre in (some, PRE))
    return {
        "scan_drifting_months": _sql(
            f"SELECT {money}, CASE WHEN year >= 1997 THEN CAST(0.75 AS DOUBLE) END AS cbd_congestion_fee, "
            "CAST(0 AS INTEGER) AS cast_failures FROM conformed"
        ),
        "cast_failures_dirty": _sql(_union([
            f"SELECT '{tgt}' AS column_name, CAST(count_if({src} IS NOT NULL AND TRY_CAST({src} AS {typ}) IS NULL) AS BIGINT) AS failures FROM {_DIRTY}"
            for tgt, (src, typ) in _CAST_TARGET.items()
        ])),
        "dim_location_scd1_changed": _sql(
            "SELECT * REPLACE (CASE WHEN location_id % 2 = 0 THEN zone || ' (new)' ELSE zone END AS zone) FROM dim_location "
            "UNION ALL SELECT 0, 0, 'Unknown', 'Unknown', 'Unknown'"
        ),
        "schema_drift_report": _sql(_union([
            f"SELECT '{c}' AS expected_column, '{c}' AS source_column, '{named[c]}' AS target_column, 'mapped' AS status, "
            f"COUNT({c}) AS non_null_rows FROM raw_trips" for c in _RAW_COLS if c in named
        ] + [
            f"SELECT NULL AS expected_column, '{c}' AS source_column, NULL AS target_column, 'extra' AS status, "
            f"COUNT({c}) AS non_null_rows FROM raw_trips" for c in _RAW_COLS if c not in named
        ])),
        "filter_valid_trips_dirty": _sql(f"SELECT {money} FROM valid WHERE total_amount IS NOT NULL", pre=dirty),
        "reject_reasons_dirty": _sql(_union([
            f"SELECT '{n}' AS reason, CAST(count_if(NOT COALESCE({p}, FALSE)) AS BIGINT) AS rejected_rows "
            "FROM (SELECT *, total_amount IS NULL AS bad FROM conformed)"
            for n, p in rules.items()
        ]), pre=dirty),
        "quality_gate_limits": _sql("SELECT * FROM gate", report, limits),
        "pipeline_backfill": _sql(
            "SELECT g.year, g.month, g.accepted_rows, g.rejection_rate_pct, g.passed, g.gate_reason, r.total_input_rows, "
            "r.rejected_rows, r.acceptance_rate_pct, CASE WHEN g.passed THEN g.accepted_rows ELSE 0 END AS fact_rows "
            "FROM gate g JOIN report r ON g.year = r.year AND g.month = r.month", report, limits,
        ),
        "pipeline_rerun": (
            "SELECT CAST(source_year AS INTEGER) AS year, CAST(source_month AS INTEGER) AS month, COUNT(*) AS rows, "
            "COUNT(*) AS trip_keys, CAST(SUM(total_amount) AS DOUBLE) AS total_revenue_usd, 'loaded' AS status "
            f"FROM (SELECT * FROM ({first_fact}) UNION ALL SELECT * FROM ({second_fact})) GROUP BY 1, 2 "
            f"UNION ALL SELECT {y + 50}, {m}, 0, 0, NULL, 'source_missing'"
        ),
        "fact_trip_key": with_ctes(
            [c.replace("FROM silver", "FROM keyed").replace("    SELECT\n        CAST(year(pickup", "    SELECT trip_key,\n        CAST(year(pickup")
             if c.startswith("fact AS") else c for c in _with_keys(PRE)], f"SELECT {money} FROM fact", []),
        "pending_periods_done": _sql(
            f"SELECT CAST(year(p) AS INTEGER) AS year, CAST(month(p) AS INTEGER) AS month "
            f"FROM (SELECT unnest(generate_series(DATE '{CALENDAR[0]}', DATE '{CALENDAR[1]}', INTERVAL 1 MONTH)) AS p) s "
            f"WHERE EXISTS (SELECT 1 FROM raw_trips r WHERE r.year = year(s.p) AND r.month = month(s.p)) "
            f"AND (month(p) = 6 OR month(p) % 4 = 0 OR NOT EXISTS "
            f"(SELECT 1 FROM silver a WHERE a.source_year = year(s.p) AND a.source_month = month(s.p)))"
        ),
        "file_manifest": _sql(
            "SELECT DISTINCT 'yellow_tripdata' AS dataset, year, month, TRUE AS has_files, TRUE AS sizes_ok, "
            "TRUE AS checksums_ok, TRUE AS checksums_differ, 'SUCCESS' AS status FROM raw_trips"
        ),
        "replace_partition_changed": _sql(
            f"SELECT source_year, source_month, COUNT(*) AS rows, CAST(SUM(tip_amount + CASE WHEN {quarter} AND source_month = {m} "
            f"THEN 1 ELSE 0 END) AS DOUBLE) AS tips FROM fact WHERE NOT ({quarter} AND source_month = {m}) OR total_amount > 20000 "
            "GROUP BY source_year, source_month"
        ),
        "mart_zones_from_partials": _sql(
            "SELECT * FROM zones_mart",
            _ZONES_CTE.replace("FROM fact f", f"FROM (SELECT * FROM ({first_fact}) UNION ALL SELECT * FROM ({second_fact})) f"),
        ),
        "star_sql": _sql(
            "SELECT l.borough, v.vendor_name, p.payment_type_name, COUNT(*) AS total_trips, "
            "CAST(SUM(f.total_amount) AS DOUBLE) AS total_revenue_usd FROM fact f "
            "JOIN dim_location l ON f.pickup_location_key = l.location_key JOIN dim_vendor v ON f.vendor_key = v.vendor_key "
            "JOIN dim_payment_type p ON f.payment_type_key = p.payment_type_key JOIN dim_date d ON f.pickup_date_key = d.date_key "
            f"WHERE d.year = {y} AND d.quarter = {(m + 2) // 3} GROUP BY l.borough, v.vendor_name, p.payment_type_name"
        ),
        "mart_daily_quarter": _sql(
            "SELECT d.year, d.month, d.day_of_month, d.full_date, d.month_name, COUNT(*) AS total_trips, "
            "CAST(SUM(f.total_amount) AS DOUBLE) AS total_revenue_usd, "
            f"{R(f'AVG({_MIN})')} AS avg_duration_minutes, {R('AVG(f.trip_distance)')} AS avg_distance_miles, "
            "d.month_name || ' ' || CAST(d.year AS VARCHAR) AS period_label, "
            "substr(d.month_name, 1, 3) || ' ' || CAST(d.day_of_month AS VARCHAR) AS day_label "
            f"FROM fact f JOIN dim_date d ON f.pickup_date_key = d.date_key WHERE d.year = {y} AND d.quarter = {(m + 2) // 3} "
            "GROUP BY d.year, d.month, d.day_of_month, d.full_date, d.month_name"
        ),
        "file_manifest_incremental": _sql(
            f"SELECT DISTINCT year, month, year = {y} AND month = {m} AS hashed_again, TRUE AS up_to_date FROM raw_trips"
        ),
        "quality_report_observed": _sql("SELECT * FROM report", report),
        "scan_period_leaf": _sql(f"SELECT * FROM raw_trips WHERE year = {y} AND month = {m}"),
        "replace_partition_swapped": _sql(
            f"SELECT source_year, source_month, COUNT(*) AS rows, CAST(SUM(tip_amount + CASE WHEN {quarter} AND source_month = {m} "
            f"THEN 1 ELSE 0 END) AS DOUBLE) AS tips FROM fact WHERE (NOT ({quarter} AND source_month = {m}) OR total_amount > 20000) "
            f"AND NOT ({quarter} AND source_month = {m + 1}) GROUP BY source_year, source_month"
        ),
        "rejected_trips": _sql(
            f"SELECT * EXCLUDE (bad) REPLACE ({', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in MONEY_COLS)}), "
            "concat_ws(',', " + ", ".join(f"CASE WHEN NOT COALESCE({p}, FALSE) THEN '{n}' END" for n, p in rules.items()) + ") AS reasons, "
            "CASE WHEN bad THEN 'total_amount' ELSE '' END AS uncastable FROM (SELECT *, total_amount IS NULL AS bad FROM conformed) "
            "WHERE NOT (" + " AND ".join(f"COALESCE({p}, FALSE)" for p in rules.values()) + ")", pre=dirty,
        ),
        "contracts_block_load": _sql(
            "SELECT 'foreign_key' AS contract, fk_column AS subject, dangling_rows AS findings, CAST(0 AS BIGINT) AS fact_rows FROM ("
            + _fk_sql().replace("FROM dim_location d WHERE", "FROM dim_location d WHERE d.location_id % 5 <> 0 AND")
            + ") WHERE dangling_rows > 0"
        ),
        "dim_location_loaded": _sql(
            "SELECT * REPLACE (CASE WHEN location_id % 2 = 0 THEN zone || ' (new)' ELSE zone END AS zone) FROM dim_location "
            "UNION ALL SELECT 0, 0, 'Unknown', 'Unknown', 'Unknown'"
        ),
        "fact_identity": (
            f"WITH few AS ({few}), every AS ({every}) "
            "SELECT trip_key, row_number() OVER (ORDER BY trip_key) AS trip_identity FROM few "
            "UNION ALL SELECT trip_key, (SELECT COUNT(*) FROM few) + row_number() OVER (ORDER BY trip_key) "
            "FROM every WHERE trip_key NOT IN (SELECT trip_key FROM few)"
        ),
        "monthly_recap_narrow_calendar": _sql(
            "SELECT year, month_name, total_trips, total_revenue_usd, avg_distance_miles, avg_duration_minutes FROM ("
            "SELECT d.year, d.month_name, f.source_year, f.source_month, COUNT(*) AS total_trips, "
            "CAST(SUM(f.total_amount) AS DOUBLE) AS total_revenue_usd, "
            f"{R('AVG(f.trip_distance)')} AS avg_distance_miles, {R(f'AVG({_MIN})')} AS avg_duration_minutes "
            "FROM fact f LEFT JOIN dim_date d ON f.pickup_date_key = d.date_key "
            "GROUP BY d.year, d.month_name, f.source_year, f.source_month)", pre=PRE_NARROW,
        ),
        "mart_daily_narrow_calendar": _sql(
            "SELECT d.year, d.month, d.day_of_month, d.full_date, d.month_name, COUNT(*) AS total_trips, "
            "CAST(SUM(f.total_amount) AS DOUBLE) AS total_revenue_usd, "
            f"{R(f'AVG({_MIN})')} AS avg_duration_minutes, {R('AVG(f.trip_distance)')} AS avg_distance_miles, "
            "d.month_name || ' ' || CAST(d.year AS VARCHAR) AS period_label, "
            "substr(d.month_name, 1, 3) || ' ' || CAST(d.day_of_month AS VARCHAR) AS day_label "
            "FROM fact f JOIN dim_date d ON f.pickup_date_key = d.date_key "
            "GROUP BY d.year, d.month, d.day_of_month, d.full_date, d.month_name", pre=PRE_NARROW,
        ),
        "mart_mom_gap": _sql("SELECT * FROM mom", *_mom_ctes(False, "(SELECT * FROM fact WHERE source_month <> 5)")),
        "mart_mom_calendar_gap": _sql("SELECT * FROM mom", *_mom_ctes(True, "(SELECT * FROM fact WHERE source_month <> 5)")),
        "unknown_dropoff_zones_gap": _sql(
            "SELECT DOLocationID AS location_id, COUNT(*) AS unmatched_rows FROM raw_trips r "
            "WHERE NOT EXISTS (SELECT 1 FROM zones z WHERE z.location_id = r.DOLocationID AND z.location_id % 5 <> 0) "
            "GROUP BY DOLocationID"
        ),
        "report_formatted": _sql(
            f"SELECT payment_type_name, {_count_format('transaction_count', 0)} AS transaction_count, "
            f"'$' || {_count_format(R('total_volume_usd'), 2)} AS total_volume_usd, "
            f"COALESCE('$' || {_count_format(R('avg_tip_usd'), 2)}, '-') AS avg_tip_usd, "
            f"COALESCE(printf('%.2f%%', {R('effective_tip_rate_pct')}), '-') AS effective_tip_rate_pct FROM payment_report",
            _PAYMENT_CTE, _PAYMENT_REPORT_CTE,
        ),
    }


ORACLE_SQL: dict[str, str] = _oracles()
