import datetime as dt

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from tripmart.operators.load import partition_counts, read_quality_report
from tripmart.plans.runs import Paths, backfill, load_dimensions, read_star, run_period
from tripmart.sources import adapter
from tripmart.sources.manifest import file_manifest, pending_periods, period_spine
from tripmart.sources.raw import read_raw_trips, write_bronze, write_zone_lookup_csv
from tripmart.streaming import processed_periods, run_incremental


def _paths(root):
    return Paths(
        bronze=f"{root}/bronze", silver=f"{root}/silver", quality=f"{root}/quality",
        gold_fact=f"{root}/fact", gold_dims=f"{root}/dims", zone_lookup_csv=f"{root}/zones",
    )


def test_backfill_matches_reference_counts(spark, tmp_root):
    p = _paths(tmp_root)
    write_bronze(adapter.raw_trips(spark, SF_SMALL), p.bronze)
    assert spark.read.parquet(p.bronze).count() == 6533
    gate = backfill(spark, p, "run-1", enforce_gate=False)
    assert gate.filter("passed").count() == 0  # ~40% acceptance: every month fails the gate
    assert spark.read.parquet(p.silver).count() == 2608
    assert spark.read.parquet(p.gold_fact).count() == 2608
    rep = read_quality_report(spark, p.quality, 1997, 2).first()
    assert (rep.total_input_rows, rep.accepted_rows) == (86, 46)
    # files: few per period, not tasks x periods
    assert len(spark.read.parquet(p.gold_fact).inputFiles()) <= 2 * gate.count()


def test_backfill_gate_blocks_gold(spark, tmp_root):
    p = _paths(tmp_root)
    write_bronze(adapter.raw_trips(spark, SF_SMALL), p.bronze)
    backfill(spark, p, "run-1")
    assert spark.read.parquet(p.silver).count() == 2608
    with pytest.raises(Exception):
        spark.read.parquet(p.gold_fact).count()  # nothing loaded


def _valid_month(spark, n, year=2024, month=1, bad=0):
    base = spark.range(n).select(
        F.lit(1).alias("VendorID"),
        (F.lit(dt.datetime(year, month, 1)).cast("timestamp_ntz") + F.make_interval(mins=F.col("id").cast("int"))).alias("tpep_pickup_datetime"),
        (F.lit(dt.datetime(year, month, 1, 0, 30)).cast("timestamp_ntz") + F.make_interval(mins=F.col("id").cast("int"))).alias("tpep_dropoff_datetime"),
        F.lit(1).cast("long").alias("passenger_count"),
        F.when(F.col("id") < bad, F.lit(-1.0)).otherwise(F.lit(2.0)).alias("trip_distance"),
        F.lit(1).cast("long").alias("RatecodeID"),
        F.lit("N").alias("store_and_fwd_flag"),
        F.lit(1).alias("PULocationID"),
        F.lit(2).alias("DOLocationID"),
        F.lit(1).cast("long").alias("payment_type"),
        F.lit(10.0).alias("fare_amount"), F.lit(0.0).alias("extra"), F.lit(0.5).alias("mta_tax"),
        F.lit(1.0).alias("tip_amount"), F.lit(0.0).alias("tolls_amount"),
        F.lit(0.3).alias("improvement_surcharge"), (F.lit(11.8) + F.col("id") / 100).alias("total_amount"),
        F.lit(2.5).alias("congestion_surcharge"), F.lit(0.0).alias("Airport_fee"),
        F.lit(year).alias("year"), F.lit(month).alias("month"),
    )
    return base


def test_run_period_idempotent_and_isolated(spark, tmp_root):
    p = _paths(tmp_root)
    write_bronze(_valid_month(spark, 1200, 2024, 1).unionByName(_valid_month(spark, 1100, 2024, 2, bad=100)), p.bronze)
    g1 = run_period(spark, p, 2024, 1, "r1").first()
    assert g1.passed
    with pytest.raises(ValueError, match="2024-02"):
        run_period(spark, p, 2024, 2, "r1")  # 9.09% rejected
    counts = {(r.source_year, r.source_month): r.rows for r in partition_counts(spark, p.gold_fact).collect()}
    assert counts == {(2024, 1): 1200}
    run_period(spark, p, 2024, 2, "r1", enforce_gate=False)
    run_period(spark, p, 2024, 1, "r2")  # re-run replaces only January
    counts = {(r.source_year, r.source_month): r.rows for r in partition_counts(spark, p.gold_fact).collect()}
    assert counts == {(2024, 1): 1200, (2024, 2): 1000}
    runs = {r.source_month: r.pipeline_run_id for r in
            spark.read.parquet(p.gold_fact).select("source_month", "pipeline_run_id").distinct().collect()}
    assert runs == {1: "r2", 2: "r1"}
    src = spark.read.parquet(p.silver).select("source_file").distinct().first().source_file
    assert "year=2024" in src and src.endswith(".parquet")


def test_dimensions_and_star_readback(spark, tmp_root):
    p = _paths(tmp_root)
    write_zone_lookup_csv(adapter.raw_zone_lookup(spark, SF_SMALL), p.zone_lookup_csv)
    load_dimensions(spark, p, ("2024-01-01", "2024-12-31"))
    write_bronze(_valid_month(spark, 1200), p.bronze)
    run_period(spark, p, 2024, 1, "r1")
    star = read_star(spark, p)
    assert star.dim_date.count() == 367  # 366 days + unknown member
    assert star.dim_location.filter("location_key = 0").count() == 1
    assert star.fact.count() == 1200


def test_manifest_and_pending_periods(spark, tmp_root):
    p = _paths(tmp_root)
    write_bronze(_valid_month(spark, 50, 2024, 1).unionByName(_valid_month(spark, 50, 2024, 3)), p.bronze)
    man = file_manifest(spark, p.bronze).collect()
    assert {(r.year, r.month) for r in man} == {(2024, 1), (2024, 3)}
    assert all(len(r.sha256_checksum) == 64 and r.file_size_bytes > 0 for r in man)
    import hashlib
    r0 = man[0]
    with open(r0.source_path.replace("file:", ""), "rb") as fh:
        assert hashlib.sha256(fh.read()).hexdigest() == r0.sha256_checksum
    requested = period_spine(spark, "2024-01-01", "2024-04-30").select("year", "month")
    available = read_raw_trips(spark, p.bronze).select("year", "month")
    done = spark.createDataFrame([(2024, 1)], "year int, month int")
    pend = [(r.year, r.month) for r in pending_periods(requested, available, done).collect()]
    assert pend == [(2024, 3)]


def test_incremental_stream_processes_only_new_months(spark, tmp_root):
    p = _paths(tmp_root)
    ckpt = f"{tmp_root}/stream-ckpt"
    write_bronze(_valid_month(spark, 1200, 2024, 1), p.bronze)
    run_incremental(spark, p, "inc", ckpt)
    assert {(r.year, r.month) for r in processed_periods(spark, p).collect()} == {(2024, 1)}
    first_run = spark.read.parquet(p.gold_fact).select("pipeline_run_id").distinct().first()[0]
    # a new month lands; the next run picks up only that month
    _valid_month(spark, 1300, 2024, 2).write.mode("append").partitionBy("year", "month").parquet(p.bronze)
    run_incremental(spark, p, "inc", ckpt)
    runs = {r.source_month: r.pipeline_run_id for r in
            spark.read.parquet(p.gold_fact).select("source_month", "pipeline_run_id").distinct().collect()}
    assert runs[1] == first_run and runs[2] != first_run
    assert spark.read.parquet(p.gold_fact).count() == 2500


def test_leaf_read_keeps_period_columns_and_views(spark, tmp_root):
    from tripmart.plans.runs import new_run_id, register_views
    from tripmart.sources.raw import read_period_leaf

    p = _paths(tmp_root)
    write_bronze(_valid_month(spark, 1200, 2024, 1).unionByName(_valid_month(spark, 20, 2024, 2)), p.bronze)
    leaf = read_period_leaf(spark, p.bronze, 2024, 2)
    assert {(r.year, r.month) for r in leaf.select("year", "month").distinct().collect()} == {(2024, 2)}
    assert leaf.count() == 20
    rid = new_run_id()
    assert rid.startswith("run-") and rid != new_run_id()
    write_zone_lookup_csv(adapter.raw_zone_lookup(spark, SF_SMALL), p.zone_lookup_csv)
    load_dimensions(spark, p, ("2024-01-01", "2024-12-31"))
    run_period(spark, p, 2024, 1, rid)
    register_views(spark, p)
    got = spark.sql(
        "SELECT d.month_name, COUNT(*) AS n FROM fact_trip f JOIN dim_date d "
        "ON f.pickup_date_key = d.date_key GROUP BY d.month_name"
    ).collect()
    assert [(r.month_name, r.n) for r in got] == [("January", 1200)]
    from tripmart.plans.runs import register_tables

    db = "wh_" + tmp_root.rsplit("-", 1)[-1].replace("/", "_")
    assert f"{db}.fact_trip" in register_tables(spark, p, db)
    q = (f"SELECT p.payment_type_name, COUNT(*) AS n FROM {db}.fact_trip f "
         f"LEFT JOIN {db}.dim_payment_type p ON f.payment_type_key = p.payment_type_key "
         "GROUP BY p.payment_type_name")
    assert [(r.payment_type_name, r.n) for r in spark.sql(q).collect()] == [("Credit card", 1200)]
    run_period(spark, p, 2024, 2, rid, enforce_gate=False)  # a new month lands
    register_tables(spark, p, db)  # picks up the new partition
    assert spark.sql(f"SELECT COUNT(*) AS n FROM {db}.fact_trip").first().n == 1220


def test_period_marts_prune_fact_partitions(spark, tmp_root):
    from helpers import explain

    from tripmart.plans import marts, reports

    p = _paths(tmp_root)
    write_bronze(adapter.raw_trips(spark, SF_SMALL), p.bronze)
    write_zone_lookup_csv(adapter.raw_zone_lookup(spark, SF_SMALL), p.zone_lookup_csv)
    backfill(spark, p, "run-1", enforce_gate=False)
    load_dimensions(spark, p, ("1995-01-01", "2001-12-31"))
    star = read_star(spark, p)
    period = (1997, 2)
    for fn in (marts.mart_zones, marts.mart_payment, marts.mart_daily, marts.monthly_kpi):
        pruned = fn(star, period=period)
        plan = explain(pruned)
        assert "PartitionFilters: [isnotnull(source_year" in plan and "(source_month" in plan
        if "month" in pruned.columns:
            full = reports.slice_period(fn(star), period)
            assert sorted(map(tuple, pruned.collect())) == sorted(map(tuple, full.collect()))
    assert marts.monthly_kpi(star, period=period).first().total_trips == 46


def test_hot_period_is_split_across_writers(spark, tmp_root):
    from tripmart.operators.load import replace_partitions

    hot = _valid_month(spark, 60000, 2024, 1)  # 60000 of 62000 rows in one month
    rest = _valid_month(spark, 1000, 2024, 2).unionByName(_valid_month(spark, 1000, 2024, 3))
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    old = spark.conf.get(key)
    spark.conf.set(key, "256k")
    try:
        replace_partitions(hot.unionByName(rest), f"{tmp_root}/t", by=["year", "month"])
    finally:
        spark.conf.set(key, old)
    df = spark.read.parquet(f"{tmp_root}/t")
    hot_files = [f for f in df.inputFiles() if "month=1/" in f]
    assert len(hot_files) > 1  # AQE split the hot month over several writer tasks
    assert df.count() == 62000


def test_quality_reports_latest_run_wins(spark, tmp_root):
    from tripmart.operators.load import write_quality_report

    schema = ("dataset string, year int, month int, total_input_rows long, accepted_rows long, "
              "rejected_rows long, acceptance_rate_pct double, processed_at_utc string")
    root = f"{tmp_root}/q"
    write_quality_report(spark.createDataFrame(
        [("d", 2024, 1, 10, 5, 5, 50.0, "2024-02-01T00:00:00+00:00"),
         ("d", 2024, 2, 10, 9, 1, 90.0, "2024-03-01T00:00:00+00:00")], schema), root)
    write_quality_report(spark.createDataFrame(
        [("d", 2024, 1, 10, 10, 0, 100.0, "2024-02-02T00:00:00+00:00")], schema), root)
    got = {(r.year, r.month): r.accepted_rows for r in read_quality_report(spark, root).collect()}
    assert got == {(2024, 1): 10, (2024, 2): 9}
    assert read_quality_report(spark, root, 2024, 2).first().acceptance_rate_pct == 90.0


def test_rerun_with_no_accepted_rows_empties_the_month(spark, tmp_root):
    p = _paths(tmp_root)
    write_bronze(_valid_month(spark, 1200, 2024, 1).unionByName(_valid_month(spark, 30, 2024, 2)), p.bronze)
    run_period(spark, p, 2024, 1, "r1")
    backfill(spark, p, "r1", periods=[(2024, 2)], enforce_gate=False)
    # January is re-landed with only invalid trips (negative distance)
    _valid_month(spark, 50, 2024, 1, bad=50).write.mode("overwrite").parquet(f"{p.bronze}/year=2024/month=1")
    run_period(spark, p, 2024, 1, "r2", enforce_gate=False)
    counts = {(r.source_year, r.source_month): r.rows for r in partition_counts(spark, p.gold_fact).collect()}
    assert counts.get((2024, 1), 0) == 0 and counts[(2024, 2)] == 30
    assert spark.read.parquet(p.silver).filter("source_month = 1").count() == 0
    # the same through a multi-month backfill: February re-landed empty of valid trips
    _valid_month(spark, 20, 2024, 2, bad=20).write.mode("overwrite").parquet(f"{p.bronze}/year=2024/month=2")
    backfill(spark, p, "r3", enforce_gate=False)
    assert spark.read.parquet(p.gold_fact).count() == 0
    assert spark.read.parquet(p.silver).count() == 0


def test_incremental_stream_records_failing_month_without_loading(spark, tmp_root):
    p = _paths(tmp_root)
    write_bronze(_valid_month(spark, 1200, 2024, 1).unionByName(_valid_month(spark, 1100, 2024, 2, bad=100)), p.bronze)
    run_incremental(spark, p, "inc", f"{tmp_root}/ckpt")  # gate enforced by default
    assert {(r.year, r.month) for r in processed_periods(spark, p).collect()} == {(2024, 1)}
    reports = {(r.year, r.month): r.accepted_rows for r in read_quality_report(spark, p.quality).collect()}
    assert reports == {(2024, 1): 1200, (2024, 2): 1000}  # both months reported, one loaded


def _facts(spark, p):
    return {(r.source_year, r.source_month): r.rows for r in partition_counts(spark, p.gold_fact).collect()}


def test_month_without_source_is_skipped_and_keeps_its_facts(spark, tmp_root):
    import shutil

    p = _paths(tmp_root)
    write_bronze(_valid_month(spark, 1500, 2024, 1), p.bronze)
    run_period(spark, p, 2024, 1, "r1")
    shutil.rmtree(f"{p.bronze}/year=2024/month=1")
    gate = run_period(spark, p, 2024, 1, "r2").first()
    assert (gate.passed, gate.gate_reason) == (False, "source_missing")
    assert _facts(spark, p) == {(2024, 1): 1500}
    write_bronze(_valid_month(spark, 1200, 2024, 2), p.bronze)
    rows = {(r.year, r.month): r.gate_reason for r in backfill(spark, p, "r3", periods=[(2024, 2), (2024, 7)]).collect()}
    assert rows == {(2024, 2): "ok", (2024, 7): "source_missing"}
    assert _facts(spark, p) == {(2024, 1): 1500, (2024, 2): 1200}
    nothing = Paths(*(f"{tmp_root}/none/{k}" for k in "abcde"))
    assert run_period(spark, nothing, 2024, 1, "r1").first().gate_reason == "source_missing"


def test_first_backfill_without_an_accepted_row(spark, tmp_root):
    p = _paths(tmp_root)
    write_bronze(_valid_month(spark, 50, 2024, 1, bad=50), p.bronze)
    gate = backfill(spark, p, "r1").first()
    assert (gate.accepted_rows, gate.passed) == (0, False)


def test_gate_needs_a_report_of_each_expected_period(spark):
    from tripmart.operators.quality import assert_gate
    from tripmart.plans.runs import GATE_SCHEMA

    gate = spark.createDataFrame([("d", 2024, 1, 2000, 0.0, True, "ok")], GATE_SCHEMA)
    assert_gate(gate, [(2024, 1)])
    with pytest.raises(ValueError, match="2024-02: no quality report"):
        assert_gate(gate, [(2024, 1), (2024, 2)])


def test_failing_rewrite_leaves_the_old_rows(spark, tmp_root):
    from tripmart.operators.load import replace_period

    rows = _valid_month(spark, 100).withColumnsRenamed({"year": "source_year", "month": "source_month"})
    replace_period(rows, f"{tmp_root}/t", 2024, 1, 100)
    broken = rows.withColumn("fare_amount", F.when(F.col("total_amount") < 12, F.raise_error(F.lit("no"))).otherwise(1.0))
    with pytest.raises(Exception, match="no"):
        replace_period(broken, f"{tmp_root}/t", 2024, 1, 100)
    assert spark.read.parquet(f"{tmp_root}/t").count() == 100
    replace_period(rows.limit(0), f"{tmp_root}/t", 2024, 1, 0)
    assert spark.read.parquet(f"{tmp_root}/t").count() == 0


def test_uncastable_money_is_rejected(spark, tmp_root):
    p = _paths(tmp_root)
    huge = F.when(F.col("tpep_pickup_datetime") < F.lit("2024-01-01 02:00:00").cast("timestamp_ntz"), 1e12)
    write_bronze(_valid_month(spark, 1500).withColumn("total_amount", huge.otherwise(F.col("total_amount"))), p.bronze)
    gate = run_period(spark, p, 2024, 1, "r1", max_reject_pct=10.0).first()
    assert gate.accepted_rows == 1380
    fact = spark.read.parquet(p.gold_fact)
    assert fact.filter("total_amount IS NULL").count() == 0
    assert fact.select("trip_key").distinct().count() == 1380


def test_months_of_other_schemas_run_together_and_alone(spark, tmp_root):
    p = _paths(tmp_root)
    old = _valid_month(spark, 1200, 2023, 1).withColumn("passenger_count", F.lit(1.0))
    new = _valid_month(spark, 1300, 2024, 1).withColumn("cbd_fee", F.lit(0.75))
    write_bronze(old, p.bronze)
    write_bronze(new, p.bronze)
    run_period(spark, p, 2024, 1, "r1")
    backfill(spark, p, "r2")
    assert _facts(spark, p) == {(2023, 1): 1200, (2024, 1): 1300}
    silver = spark.read.option("mergeSchema", "true").parquet(p.silver)
    assert silver.filter("cbd_fee = 0.75").count() == 1300 and silver.filter("passenger_count = 1").count() == 2500


def _land(spark, df, root, name):
    """One file under the given name in its month's folder, as a downloader leaves it."""
    import glob
    import os
    import shutil

    aside = f"{root}-aside-{name}"
    df.drop("year", "month").coalesce(1).write.parquet(aside)
    folder = f"{root}/year=2024/month=1"
    os.makedirs(folder, exist_ok=True)
    shutil.copy(glob.glob(f"{aside}/part-*.parquet")[0], f"{folder}/{name}")


def test_corrected_landing_supersedes_the_month(spark, tmp_root):
    p = _paths(tmp_root)
    _land(spark, _valid_month(spark, 1500), p.bronze, "yellow_tripdata_2024-01.parquet")
    run_incremental(spark, p, "inc", f"{tmp_root}/ckpt")
    assert _facts(spark, p) == {(2024, 1): 1500}
    corrected = _valid_month(spark, 1500).withColumn("total_amount", F.col("total_amount") + 1)
    _land(spark, corrected, p.bronze, "yellow_tripdata_2024-01.20240305T101500.parquet")
    run_incremental(spark, p, "inc", f"{tmp_root}/ckpt")
    assert _facts(spark, p) == {(2024, 1): 1500}
    assert float(spark.read.parquet(p.gold_fact).agg(F.min("total_amount")).first()[0]) == 12.8


def test_manifest_is_stored_and_decides_what_is_done(spark, tmp_root):
    import hashlib

    from tripmart.sources import manifest as m

    p = _paths(tmp_root)
    write_bronze(_valid_month(spark, 50, 2024, 1), p.bronze)
    big = f"{p.bronze}/year=2024/month=2"
    import os

    os.makedirs(big)
    with open(f"{big}/x.parquet", "wb") as f:
        f.write(os.urandom(3 * m.CHUNK_BYTES + 17))
    found = m.file_manifest(spark, p.bronze)
    sums = {r.month: r.sha256_checksum for r in found.collect()}
    with open(f"{big}/x.parquet", "rb") as f:
        assert sums[2] == hashlib.sha256(f.read()).hexdigest()
    m.write_manifest(found, f"{tmp_root}/manifest")
    m.write_manifest(found.filter("month = 2").withColumn("status", F.lit("FAILED")), f"{tmp_root}/manifest")
    stored = m.read_manifest(spark, f"{tmp_root}/manifest")
    assert {r.month: r.status for r in stored.collect()} == {1: "SUCCESS", 2: "FAILED"}
    loaded = spark.createDataFrame([(2024, 1), (2024, 1), (2024, 2)], "year int, month int")
    assert [tuple(r) for r in m.completed_periods(stored, loaded).collect()] == [(2024, 1)]
    assert m.completed_periods(stored, loaded.filter("month = 2")).count() == 0
