"""Benchmark: the monthly pipeline and its queries at one scale factor.

Stages (each timed):
  land_bronze      driver tables -> raw monthly trip files (year=/month= partitions) + zone CSV
  backfill         bronze -> quality report -> silver -> gated fact, all periods in one run
  dimensions       calendar + location dimension tables
  <query>          marts, reports, profile and contracts over the written warehouse tables
  month_scale_*    (extra fields, not in "value") one month holding 5x the sf's trips, landed
                   then run with run_period, i.e. the reference's per-month unit of work

Prints ONE JSON line: {"metric", "value" (total seconds), "unit", "queries", "sf", ...}.
Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from tripmart import configure, scratch_dir  # noqa: E402
from tripmart.operators import contracts, profile  # noqa: E402
from tripmart.operators.quality import quality_report, trip_rules  # noqa: E402
from tripmart.operators.conform import conform  # noqa: E402
from tripmart.plans import marts, reports  # noqa: E402
from tripmart.plans.runs import Paths, backfill, load_dimensions, read_star, run_period  # noqa: E402
from tripmart.schemas import TRIP_KEYS, TRIP_SPEC  # noqa: E402
from tripmart.sources import adapter  # noqa: E402
from tripmart.sources.raw import read_raw_trips, write_bronze, write_zone_lookup_csv  # noqa: E402

CALENDAR = ("1995-01-01", "2001-12-31")


def _session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tripmart-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(max(8, 2 * int(cpus))))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tripmart-bench-", dir="/tmp"))
    return configure(spark)


def _one_month(spark: SparkSession, sf_dir: str, copies: int, spread: int):
    """Bench fixture shaped like one real monthly file: the adapter's trips replicated
    ``copies`` times into January 2024 (day from the original day of year, minutes shifted
    per copy so copies are distinct trips; durations and all other fields unchanged)."""
    from pyspark.sql import functions as F

    raw = adapter.raw_trips(spark, sf_dir, spread=spread)
    base = raw.select(
        "*",
        (F.unix_timestamp("tpep_dropoff_datetime") - F.unix_timestamp("tpep_pickup_datetime")).alias("_dur"),
        (F.dayofyear("tpep_pickup_datetime") % 31).alias("_day"),
        F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("_k"),
    )
    start = F.make_timestamp_ntz(F.lit(2024), F.lit(1), F.col("_day") + 1, F.lit(0), F.lit(0), F.lit(0)) + \
        F.make_interval(mins=(F.col("_k") * 97 + F.abs(F.hash("total_amount")) % 600).cast("int"))
    keep = [c for c in raw.columns if c not in ("tpep_pickup_datetime", "tpep_dropoff_datetime", "year", "month")]
    return base.select(
        *keep,
        start.alias("tpep_pickup_datetime"),
        (start + F.make_interval(secs=F.col("_dur"))).alias("tpep_dropoff_datetime"),
        F.lit(2024).alias("year"),
        F.lit(1).alias("month"),
    )


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = _session(cpus)
    root = scratch_dir(spark, "bench")
    paths = Paths(
        bronze=f"{root}/bronze/trips",
        silver=f"{root}/silver/trips",
        quality=f"{root}/silver/_quality",
        gold_fact=f"{root}/gold/fact_trip",
        gold_dims=f"{root}/gold",
        zone_lookup_csv=f"{root}/bronze/zone_lookup",
    )
    times: dict[str, float] = {}
    t0 = time.perf_counter()
    spark.range(1_000_000).selectExpr("sum(id)", "count(distinct id % 1000)").collect()  # JVM/JIT warm-up
    warmup = round(time.perf_counter() - t0, 3)

    def timed(name, fn):
        t0 = time.perf_counter()
        fn()
        times[name] = round(time.perf_counter() - t0, 3)

    spread = int(cpus)  # the test tables' lineitem is a single row group (one input split)
    timed("land_bronze", lambda: (write_bronze(adapter.raw_trips(spark, sf_dir, spread=spread), paths.bronze),
                                  write_zone_lookup_csv(adapter.raw_zone_lookup(spark, sf_dir), paths.zone_lookup_csv)))
    raw_rows = spark.read.parquet(paths.bronze).count()
    timed("backfill", lambda: backfill(spark, paths, "bench-run", enforce_gate=False).collect())
    timed("dimensions", lambda: load_dimensions(spark, paths, CALENDAR))

    star = read_star(spark, paths)
    bronze = read_raw_trips(spark, paths.bronze)
    queries = {
        "quality_report": lambda: quality_report(conform(bronze, TRIP_SPEC), trip_rules(), TRIP_KEYS).collect(),
        "monthly_kpi": lambda: marts.monthly_kpi(star).collect(),
        "monthly_recap": lambda: marts.monthly_recap(star).collect(),
        "top_pickup_zones": lambda: marts.top_pickup_zones(star).collect(),
        "tip_by_payment": lambda: marts.tip_by_payment(star).collect(),
        "mart_mom": lambda: marts.mart_mom(star).collect(),
        "mart_mom_calendar": lambda: marts.mart_mom(star, calendar=True).collect(),
        "mart_daily": lambda: marts.mart_daily(star).collect(),
        "mart_zones": lambda: marts.mart_zones(star).collect(),
        "mart_payment": lambda: marts.mart_payment(star).collect(),
        "route_pairs": lambda: marts.route_pairs(star).collect(),
        "role_playing_dates": lambda: marts.role_playing_dates(star).collect(),
        "report_zones": lambda: reports.report_zones(marts.mart_zones(star)).collect(),
        "report_zones_one_period": lambda: reports.report_zones(marts.mart_zones(star, period=(1997, 2))).collect(),
        "report_kpi": lambda: reports.report_kpi(marts.mart_mom(star)).collect(),
        "report_payment": lambda: reports.report_payment(marts.mart_payment(star)).collect(),
        "profile_numeric": lambda: profile.profile_numeric(bronze).collect(),
        "profile_null_counts": lambda: profile.profile_null_counts(bronze).collect(),
        "contract_not_null": lambda: contracts.contract_not_null(star.fact).collect(),
        "contract_foreign_keys": lambda: contracts.contract_foreign_keys(star.fact, star.dims()).collect(),
        "contract_unique_trips": lambda: contracts.unique_business_keys(
            spark.read.parquet(paths.silver), ["source_year", "source_month", *TRIP_KEYS]).collect(),
    }
    for name, fn in queries.items():
        timed(name, fn)
    # The unit of work of a scheduled monthly run: one month, bronze to gold, idempotent.
    timed("run_period_one_month", lambda: run_period(spark, paths, 1997, 2, "bench-month", enforce_gate=False))

    total = round(sum(times.values()), 3)

    # Month scale: one period with ~5x the sf's trips, the shape of a real monthly file
    # (the reference reports ~4 min 20 s per month of ~3M trips, ingest to warehouse load).
    month_paths = Paths(
        bronze=f"{root}/m/bronze", silver=f"{root}/m/silver", quality=f"{root}/m/_quality",
        gold_fact=f"{root}/m/fact", gold_dims=f"{root}/m/dims",
    )
    t0 = time.perf_counter()
    write_bronze(_one_month(spark, sf_dir, 5, spread), month_paths.bronze)
    month_land = time.perf_counter() - t0
    month_rows = spark.read.parquet(month_paths.bronze).count()
    t0 = time.perf_counter()
    run_period(spark, month_paths, 2024, 1, "bench-month-scale", enforce_gate=False)
    month_run = time.perf_counter() - t0
    pipeline = times["land_bronze"] + times["backfill"] + times["dimensions"]
    sf = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "pipeline_and_queries_total",
        "value": total,
        "unit": "sec",
        "queries": times,
        "sf": float(sf.group(1)) if sf else sf_dir,
        "raw_rows": raw_rows,
        "pipeline_sec": round(pipeline, 3),
        "pipeline_rows_per_sec": round(raw_rows / pipeline, 1) if pipeline else None,
        "cpus": int(cpus),
        "warmup_sec_excluded": warmup,
        "month_scale_raw_rows": month_rows,
        "month_scale_land_sec": round(month_land, 3),
        "month_scale_run_period_sec": round(month_run, 3),
        "month_scale_rows_per_sec": round(month_rows / month_run, 1),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
