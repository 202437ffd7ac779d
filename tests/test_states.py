"""Monthly states, observed report, run-time pruning and the incremental manifest."""

import dataclasses

from helpers import explain
from pyspark.sql import functions as F
from test_runs import _paths, _valid_month

from tripmart.operators.load import read_quality_report
from tripmart.operators.swap import read_swapped
from tripmart.plans import marts
from tripmart.plans.observed import load_silver_observed
from tripmart.plans.partials import monthly_partials, partials_table
from tripmart.plans.runs import backfill, load_dimensions, read_star, run_period
from tripmart.sources.manifest import read_manifest, update_manifest
from tripmart.sources.raw import write_bronze, write_zone_lookup_csv


def _months(spark):
    return _valid_month(spark, 60, 2024, 1).unionByName(_valid_month(spark, 40, 2024, 2, bad=10))


def _zones(spark, p):
    zones = spark.createDataFrame([(1, "B", "Z", "S")], "LocationID int, Borough string, Zone string, service_zone string")
    write_zone_lookup_csv(zones, p.zone_lookup_csv)
    load_dimensions(spark, p, ("2024-01-01", "2024-12-31"))


def test_states_equal_the_fact(spark, tmp_root):
    p = dataclasses.replace(_paths(tmp_root), partials=partials_table(f"{tmp_root}/partials"))
    _zones(spark, p)
    write_bronze(_months(spark), p.bronze)
    backfill(spark, p, "r1", enforce_gate=False)

    def both():
        star = read_star(spark, p)
        a, b = marts.mart_zones(star), marts.mart_zones_from_partials(star, read_swapped(spark, p.partials))
        return (sorted(map(repr, x.select(*a.columns).collect())) for x in (a, b))

    one, two = both()
    assert one == two and len(one) == 2
    write_bronze(_valid_month(spark, 7, 2024, 1), p.bronze)
    run_period(spark, p, 2024, 1, "r2", enforce_gate=False)
    one, two = both()
    assert one == two and read_swapped(spark, p.partials).agg(F.sum("trips")).first()[0] == 37
    write_bronze(_valid_month(spark, 3, 2024, 1, bad=3), p.bronze)
    run_period(spark, p, 2024, 1, "r3", enforce_gate=False)  # the month becomes empty
    one, two = both()
    assert one == two and len(one) == 1
    assert monthly_partials(read_star(spark, p).fact.limit(0)).count() == 0


def test_observed_report_equals_the_recount(spark, tmp_root):
    p = _paths(tmp_root)
    twice = _months(spark)
    write_bronze(twice.unionByName(twice.filter("year = 2024 AND month = 1")), p.bronze)  # copies are folded
    seen = {(r.year, r.month): r for r in load_silver_observed(spark, p, "r1", "t").collect()}
    backfill(spark, p, "r2", enforce_gate=False)
    for r in read_quality_report(spark, p.quality).collect():
        o = seen[r.year, r.month]
        assert (o.total_input_rows, o.accepted_rows, o.rejected_rows, o.acceptance_rate_pct) == (
            r.total_input_rows, r.accepted_rows, r.rejected_rows, r.acceptance_rate_pct)
    assert seen[2024, 1].total_input_rows == 120 and seen[2024, 1].accepted_rows == 60
    assert load_silver_observed(spark, _paths(f"{tmp_root}/none"), "r1", "t").collect() == []


def test_quarter_prunes_at_run_time(spark, tmp_root):
    p = _paths(tmp_root)
    _zones(spark, p)
    write_bronze(_months(spark).unionByName(_valid_month(spark, 30, 2024, 5)), p.bronze)
    backfill(spark, p, "r1", enforce_gate=False)
    star = read_star(spark, p)
    quarter = marts.mart_daily_quarter(star, 2024, 1)
    assert "dynamicpruning" in explain(quarter).lower()
    days = marts.mart_daily(star).filter("month <= 3")
    assert sorted(map(repr, quarter.collect())) == sorted(map(repr, days.select(*quarter.columns).collect()))


def test_manifest_hashes_only_what_is_new(spark, tmp_root):
    p, stored = _paths(tmp_root), f"{tmp_root}/manifest"
    write_bronze(_months(spark), p.bronze)
    first = {r.source_path for r in update_manifest(spark, p.bronze, stored).collect()}
    assert len(first) == read_manifest(spark, stored).count() and first
    assert update_manifest(spark, p.bronze, stored).collect() == []
    write_bronze(_valid_month(spark, 9, 2024, 2), p.bronze)  # other files in place of the month's
    fresh = update_manifest(spark, p.bronze, stored).collect()
    assert {(r.year, r.month) for r in fresh} == {(2024, 2)}
    now = {r.source_path for r in read_manifest(spark, stored).collect()}
    assert now == {x for x in first if "month=1/" in x} | {r.source_path for r in fresh}
    assert read_manifest(spark, f"{tmp_root}/none").collect() == []
