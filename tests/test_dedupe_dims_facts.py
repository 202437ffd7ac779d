import datetime as dt
from decimal import Decimal as D

from helpers import explain
from pyspark.sql import functions as F

from tripmart.operators.dedupe import dedupe
from tripmart.operators.dims import (
    date_dim,
    location_dim,
    payment_type_dim,
    rate_code_dim,
    scd1_upsert,
    vendor_dim,
)
from tripmart.operators.facts import build_fact, key_by_lookup

T = dt.datetime


def test_dedupe_null_keys_equal_and_survivor_is_first(spark):
    df = spark.createDataFrame(
        [(None, 1, "b"), (None, 1, "a"), (2, 1, "z"), (2, 1, "c"), (2, 2, "q")],
        "k1 int, k2 int, v string",
    )
    out = {(r.k1, r.k2): r.v for r in dedupe(df, ["k1", "k2"]).collect()}
    assert out == {(None, 1): "a", (2, 1): "c", (2, 2): "q"}
    last = {(r.k1, r.k2): r.v for r in dedupe(df, ["k1", "k2"], keep="last").collect()}
    assert last[(2, 1)] == "z"


def test_dedupe_order_by_column(spark):
    df = spark.createDataFrame([(1, 3, "x"), (1, 1, "y"), (1, 2, "a")], "k int, rank int, v string")
    assert dedupe(df, ["k"], order_by=["rank"]).first().v == "y"
    assert dedupe(df, ["k"]).columns == ["k", "rank", "v"]


def test_dedupe_hot_key_is_partially_aggregated(spark):
    # one key holds a third of the rows: the plan aggregates before the shuffle
    hot = spark.range(0, 30000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
        (F.col("id") % 7).alias("v"),
    )
    out = dedupe(hot, ["k"])
    assert out.count() == 20001
    assert out.filter("k = 0").first().v == 0
    plan = explain(out)
    assert plan.count("Aggregate") >= 2 and "partial_min" in plan


def test_calendar_dimension(spark):
    dim = date_dim(spark, "2026-03-02", "2026-03-08")
    rows = {r.date_key: r for r in dim.collect()}
    assert len(rows) == 7
    mon, sun = rows[20260302], rows[20260308]
    assert (mon.day_of_week, mon.day_name, mon.is_weekend) == (1, "Monday", False)
    assert (sun.day_of_week, sun.day_name, sun.is_weekend) == (7, "Sunday", True)
    assert (mon.month_name, mon.quarter, mon.year, mon.full_date) == ("March", 1, 2026, dt.date(2026, 3, 2))
    assert date_dim(spark, "2020-01-01", "2030-12-31").count() == 4018
    assert date_dim(spark, "1800-01-01", "2030-12-31").count() == 84371
    assert date_dim(spark, "2026-03-02", "2026-03-08", with_unknown=True).filter("date_key = 0").count() == 1


def test_location_dimension_natural_key_and_unknown(spark):
    zones = spark.createDataFrame(
        [(3, "Bronx", "Z", "Boro"), (3, "Bronx", "Z", "Boro"), (4, "Queens", "Q", "Air")],
        "location_id int, borough string, zone string, service_zone string",
    )
    dim = location_dim(zones)
    assert dim.count() == 2
    assert all(r.location_key == r.location_id for r in dim.collect())
    with_unknown = location_dim(zones, with_unknown=True)
    assert with_unknown.filter("location_key = 0").first().borough == "Unknown"
    assert with_unknown.count() == 3


def test_seed_dimensions(spark):
    assert rate_code_dim(spark).count() == 7
    assert payment_type_dim(spark).filter("payment_type_key = 0").count() == 1
    assert vendor_dim(spark).count() == 3


def test_scd1_upsert_overwrites_matches_and_is_idempotent(spark):
    cols = "location_key int, location_id int, borough string, zone string, service_zone string"
    current = spark.createDataFrame([(0, 0, "U", "U", "U"), (1, 1, "Old", "a", "b")], cols)
    incoming = spark.createDataFrame([(1, 1, "New", "a", "b"), (2, 2, "N2", "c", "d")], cols)
    once = scd1_upsert(current, incoming, "location_key")
    twice = scd1_upsert(once, incoming, "location_key")
    got = sorted((r.location_key, r.borough) for r in once.collect())
    assert got == [(0, "U"), (1, "New"), (2, "N2")]
    assert sorted(map(tuple, twice.collect())) == sorted(map(tuple, once.collect()))


SILVER = (
    "vendor_id int, pickup_datetime timestamp_ntz, dropoff_datetime timestamp_ntz, "
    "passenger_count int, trip_distance double, rate_code_id int, store_and_fwd_flag string, "
    "pu_location_id int, do_location_id int, payment_type int, fare_amount decimal(10,2), "
    "extra decimal(10,2), mta_tax decimal(10,2), tip_amount decimal(10,2), tolls_amount decimal(10,2), "
    "improvement_surcharge decimal(10,2), total_amount decimal(10,2), congestion_surcharge double, "
    "airport_fee double, source_year short, source_month short, pipeline_run_id string"
)


def _silver(spark):
    m = [D("12.00"), D("0.00"), D("0.50"), D("2.00"), D("0.00"), D("0.30"), D("14.80")]
    rows = [
        (2, T(2024, 2, 10, 9, 0), T(2024, 2, 10, 9, 20), 1, 2.0, 3, "N", 30, 40, 2, *m, 2.5, 0.0, 2024, 2, "r1"),
        (7, T(2024, 2, 11, 22, 0), T(2024, 2, 11, 22, 10), 2, 1.0, 99, "N", None, 41, 9, *m, 0.0, 0.0, 2024, 2, "r1"),
        (1, T(2024, 11, 3, 0, 30), T(2024, 11, 3, 3, 0), 1, 1.0, 1, "Y", 5, 6, 1, *m, 0.0, 0.0, 2024, 11, "r1"),
    ]
    return spark.createDataFrame(rows, SILVER)


def test_fact_keys_and_duration(spark):
    fact = build_fact(_silver(spark))
    assert len(fact.columns) == 26
    rows = {r.pickup_date_key: r for r in fact.collect()}
    a, b, dst = rows[20240210], rows[20240211], rows[20241103]
    assert a.trip_duration_seconds == 1200 and b.trip_duration_seconds == 600
    assert (a.vendor_key, a.rate_code_key, a.payment_type_key, a.pickup_location_key) == (2, 3, 2, 30)
    assert (b.vendor_key, b.rate_code_key, b.payment_type_key, b.pickup_location_key) == (0, 0, 0, 0)
    assert dst.trip_duration_seconds == 9000  # wall-clock timestamps: no DST shift


def test_duration_is_independent_of_session_time_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        d = build_fact(_silver(spark)).filter("pickup_date_key = 20241103").first().trip_duration_seconds
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert d == 9000


def test_trip_key_is_stable(spark):
    a = build_fact(_silver(spark), with_trip_key=True).select("trip_key").collect()
    b = build_fact(_silver(spark), with_trip_key=True).select("trip_key").collect()
    assert sorted(a) == sorted(b) and len({r.trip_key for r in a}) == 3


def test_key_by_lookup_maps_dangling_ids_to_unknown(spark):
    dim = spark.createDataFrame([(30, 30)], "location_id int, location_key int")
    keyed = key_by_lookup(_silver(spark), "pu_location_id", dim, "location_id", "location_key", "k")
    got = sorted((r.pu_location_id or -1, r.k) for r in keyed.collect())
    assert got == [(-1, 0), (5, 0), (30, 30)]


def test_fact_schema_is_enforced_before_load(spark):
    import pytest

    from tripmart.operators.load import enforce_schema
    from tripmart.schemas import FACT_SCHEMA

    fact = build_fact(_silver(spark), with_trip_key=True)
    assert enforce_schema(fact.select(*reversed(fact.columns)), FACT_SCHEMA).columns == FACT_SCHEMA.fieldNames()
    with pytest.raises(Exception):
        enforce_schema(fact.drop("trip_distance"), FACT_SCHEMA)
