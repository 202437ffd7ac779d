import dataclasses

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T
from test_runs import _paths, _valid_month

from tripmart.operators.contracts import ContractBreach
from tripmart.operators.dims import location_dim
from tripmart.operators.identity import assign_identities, key_table, numbered
from tripmart.operators.swap import (
    SwappedTable,
    merge_scd1,
    read_swapped,
    register_swapped,
    superseded,
    swap,
    swap_log,
)
from tripmart.plans.runs import (
    backfill,
    fact_table,
    load_dimensions,
    location_table,
    read_fact,
    read_rejected,
    read_star,
    run_period,
)
from tripmart.plans.star import judged_trips
from tripmart.sources.raw import write_bronze

SCHEMA = T.StructType().add("x", "long").add("y", "short").add("m", "short")


def _table(root, name=None):
    return SwappedTable(f"{root}/t", SCHEMA, ("y", "m"), name)


def _rows(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def _state(spark, table):
    return sorted(tuple(r) for r in read_swapped(spark, table).collect())


def test_swap_and_empty(spark, tmp_root):
    t = _table(tmp_root)
    assert _state(spark, t) == []
    assert swap(_rows(spark, (1, 24, 1), (2, 24, 1), (3, 24, 2)), t, [(24, 1), (24, 2), (24, 3)], "r1") == {
        (24, 1): 2, (24, 2): 1, (24, 3): 0}
    old = read_swapped(spark, t)  # a reader that began before the next swap
    swap(_rows(spark, (9, 24, 1)), t, [(24, 1), (24, 2)], "r2")
    assert _state(spark, t) == [(9, 24, 1)]
    assert sorted(tuple(r) for r in old.collect()) == [(1, 24, 1), (2, 24, 1), (3, 24, 2)]
    assert swap_log(spark, t).count() == 5 and superseded(spark, t).count() == 2
    assert [tuple(r) for r in read_swapped(spark, t, [(24, 2)]).collect()] == []
    swap(_rows(spark), t, [(24, 1)], "r3")
    assert _state(spark, t) == []


def test_failed_write_changes_nothing(spark, tmp_root):
    t = _table(tmp_root, "swap_failed")
    register_swapped(spark, t)
    swap(_rows(spark, (1, 24, 1)), t, [(24, 1)], "r1")
    bad = spark.range(4, numPartitions=2).select(
        F.when(F.col("id") == 3, F.raise_error(F.lit("lost")).cast("long")).otherwise(F.col("id")).alias("x"),
        F.lit(24).cast("short").alias("y"), F.lit(1).cast("short").alias("m"),
    )
    with pytest.raises(PySparkException):
        swap(bad, t, [(24, 1)], "r2")
    with pytest.raises(ValueError, match="rows of"):
        swap(_rows(spark, (5, 24, 1), (6, 24, 7)), t, [(24, 1)], "r3")  # a month not named
    with pytest.raises(ValueError, match="columns missing"):
        swap(_rows(spark, (5, 24, 1)).drop("x"), t, [(24, 1)], "r4")
    assert _state(spark, t) == [(1, 24, 1)] == [tuple(r) for r in spark.table(t.name).collect()]


def test_catalog_follows_and_recovers(spark, tmp_root):
    t = _table(tmp_root, "swap_catalog")
    register_swapped(spark, t)
    swap(_rows(spark, (1, 24, 1), (3, 24, 2)), t, [(24, 1), (24, 2)], "r1")
    swap(_rows(spark, (2, 24, 1)), t, [(24, 1), (24, 2)], "r2")
    sql = f"SELECT x, y, m FROM {t.name} WHERE y = 24"
    assert [tuple(r) for r in spark.sql(sql).collect()] == [(2, 24, 1)]
    spark.sql(f"DROP TABLE {t.name}")  # a catalog that didn't last
    register_swapped(spark, t)
    register_swapped(spark, t)
    assert [tuple(r) for r in spark.sql(sql).collect()] == [(2, 24, 1)]
    swap(_rows(spark, (7, 24, 3)), dataclasses.replace(t, name=None), [(24, 1), (24, 3)], "r3")  # stopped before the catalog
    register_swapped(spark, t)
    assert [tuple(r) for r in spark.sql(sql).collect()] == [(7, 24, 3)]


def test_runs_swap_the_fact(spark, tmp_root):
    p = dataclasses.replace(_paths(tmp_root), fact_table=fact_table(f"{tmp_root}/swapped"))
    write_bronze(_valid_month(spark, 1200, 2024, 1).unionByName(_valid_month(spark, 1100, 2024, 2, bad=100)), p.bronze)
    assert read_fact(spark, p).count() == 0
    backfill(spark, p, "r1")  # February fails the gate
    assert [tuple(r) for r in read_fact(spark, p).groupBy("source_month").count().collect()] == [(1, 1200)]
    run_period(spark, p, 2024, 2, "r2", enforce_gate=False)
    write_bronze(_valid_month(spark, 5, 2024, 1, bad=5), p.bronze)
    run_period(spark, p, 2024, 1, "r3", enforce_gate=False)  # empties January
    assert [tuple(r) for r in read_fact(spark, p).groupBy("source_month").count().collect()] == [(2, 1000)]


def test_quarantine(spark, tmp_root):
    p = dataclasses.replace(_paths(tmp_root), judged=f"{tmp_root}/judged")
    bad = _valid_month(spark, 30, 2024, 1, bad=20)
    write_bronze(bad.unionByName(bad.filter("trip_distance < 0")).unionByName(bad.limit(0)), p.bronze)
    run_period(spark, p, 2024, 1, "r1", enforce_gate=False)
    rejected = read_rejected(spark, p)
    assert rejected.count() == 40  # copies of a rejected row aren't folded
    assert rejected.selectExpr("explode(reject_reasons) AS r").distinct().collect() == [("distance_in_range",)]
    assert spark.read.parquet(p.sink("accepted")).count() == 10 == read_fact(spark, p).count()
    write_bronze(_valid_month(spark, 7, 2024, 1), p.bronze)
    run_period(spark, p, 2024, 1, "r2", enforce_gate=False)  # the earlier run's rejects go
    assert read_rejected(spark, p).count() == 0 and read_fact(spark, p).count() == 7


def test_rejected_rows_arent_shuffled(spark, tmp_root):
    """Nor are they folded: only accepted rows are dealt by their key."""
    raw = _valid_month(spark, 30, 2024, 1, bad=20)
    judged = judged_trips(raw.unionByName(raw), "r1", gather=True)
    parts = judged._jdf.queryExecution().executedPlan().initialPlan().children()
    accepted, *rejected = (parts.apply(k).toString() for k in range(parts.size()))
    assert "Exchange" in accepted and rejected and not any("Exchange" in part for part in rejected)
    assert {r.verdict: r["count"] for r in judged.groupBy("verdict").count().collect()} == {"accepted": 10, "rejected": 40}


def _zones(spark, path, ids):
    rows = [(str(k), "B", f"Z{k}", "S") for k in ids]
    spark.createDataFrame(rows, "LocationID string, Borough string, Zone string, service_zone string").coalesce(1).write.option(
        "header", "true").mode("overwrite").csv(path)


def test_contract_stops_the_load(spark, tmp_root):
    p = _paths(tmp_root)
    write_bronze(_valid_month(spark, 20), p.bronze)  # pickups in zone 1, dropoffs in zone 2
    _zones(spark, p.zone_lookup_csv, [1, 2])
    load_dimensions(spark, p, ("2024-01-01", "2024-12-31"))
    run_period(spark, p, 2024, 1, "r1", enforce_gate=False, contracts=["not_null", "foreign_key", "primary_key", "length"])
    _zones(spark, p.zone_lookup_csv, [1])
    load_dimensions(spark, p, ("2024-01-01", "2024-12-31"))
    write_bronze(_valid_month(spark, 9), p.bronze)
    for run in (lambda: run_period(spark, p, 2024, 1, "r2", enforce_gate=False, contracts=["foreign_key"]),
                lambda: backfill(spark, p, "r2", enforce_gate=False, contracts=["foreign_key"])):
        with pytest.raises(ContractBreach, match="dropoff_location_key") as e:
            run()
        assert e.value.findings == [("foreign_key", "dropoff_location_key", 9)]
    assert read_fact(spark, p).count() == 20  # the earlier load stays
    run_period(spark, p, 2024, 1, "r3", enforce_gate=False)  # no contract asked for
    assert read_fact(spark, p).count() == 9
    with pytest.raises(ValueError, match="no such contracts"):
        run_period(spark, p, 2024, 1, "r4", enforce_gate=False, contracts=["foreign"])


def test_stored_scd1(spark, tmp_root):
    p = dataclasses.replace(_paths(tmp_root), location_table=location_table(f"{tmp_root}/loc"))
    _zones(spark, p.zone_lookup_csv, [1, 2])
    load_dimensions(spark, p, ("2024-01-01", "2024-01-31"))
    _zones(spark, p.zone_lookup_csv, [2, 3])  # 1 is no longer in the feed, and stays
    load_dimensions(spark, p, ("2024-01-01", "2024-01-31"))
    assert sorted(r.location_key for r in read_star(spark, p).dim_location.collect()) == [0, 1, 2, 3]
    before = {tuple(r) for r in read_swapped(spark, p.location_table).collect()}
    broken = location_dim(spark.createDataFrame([(2, "b", "z", "s")], "location_id int, borough string, zone string, service_zone string"))
    with pytest.raises(PySparkException):
        merge_scd1(spark, p.location_table, broken.withColumn("zone", F.raise_error(F.lit("x")).cast("string")), "location_key", "r")
    assert {tuple(r) for r in read_swapped(spark, p.location_table).collect()} == before


def _keys(spark, keys, month=1):
    schema = "trip_key string, source_year short, source_month short"
    return spark.createDataFrame([(k, 2024, month) for k in keys], schema)


def test_identities_are_dense_and_stay(spark, tmp_root):
    keys = key_table(f"{tmp_root}/keys")
    first = _keys(spark, [f"k{i:03d}" for i in range(0, 200, 2)]).repartition(5)
    one = {r.trip_key: r.trip_identity for r in assign_identities(spark, first, keys, [(2024, 1)], "r1").collect()}
    assert sorted(one.values()) == list(range(1, 101)) and one["k000"] == 1 and one["k198"] == 100
    more = _keys(spark, [f"k{i:03d}" for i in range(200)]).repartition(3)
    two = {r.trip_key: r.trip_identity for r in assign_identities(spark, more, keys, [(2024, 1)], "r2").collect()}
    assert {k: two[k] for k in one} == one and sorted(two.values()) == list(range(1, 201))
    other = _keys(spark, ["z1", "z0"], month=2)
    three = {r.trip_key: r.trip_identity for r in assign_identities(spark, other, keys, [(2024, 2)], "r3").collect()}
    assert three == {"z0": 201, "z1": 202}
    again = {r.trip_key: r.trip_identity for r in assign_identities(spark, more, keys, [(2024, 1)], "r4").collect()}
    assert again == two
    assert read_swapped(spark, keys).select("trip_key").distinct().count() == read_swapped(spark, keys).count() == 202


def test_numbered(spark):
    rows = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v"), F.lit("x").alias("w")).repartition(7)
    got = sorted(tuple(r) for r in numbered(rows, ["v"], 10, "n").collect())
    assert got == [(k, "x", k + 11) for k in range(1000)]
    assert numbered(rows.limit(0), ["v"], 10, "n").collect() == []
