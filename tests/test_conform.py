import datetime as dt

from pyspark.sql import functions as F

from tripmart.operators.conform import (
    add_lineage,
    cast_failures,
    conform,
    conform_zone_lookup,
    schema_drift_report,
)
from tripmart.schemas import TRIP_SPEC

RAW_COLS = (
    "VendorID long, tpep_pickup_datetime string, tpep_dropoff_datetime string, passenger_count long, "
    "trip_distance double, RatecodeID long, store_and_fwd_flag string, PULocationID long, "
    "DOLocationID long, payment_type long, total_amount double, congestion_surcharge double, "
    "Airport_fee double"
)


def _raw(spark):
    rows = [
        (2, "2024-03-05 08:00:00", "2024-03-05 08:25:00", 3, 4.2, 2, "Y", 48, 230, 1, 31.4, 2.5, 1.75),
        (1, "2024-03-05 09:00:00", "2024-03-05 09:12:00", None, 1.1, None, None, 7, 8, 2, 9.9, None, None),
    ]
    return spark.createDataFrame(rows, RAW_COLS)


def test_rename_impute_and_types(spark):
    out = conform(_raw(spark), TRIP_SPEC)
    for c in ("vendor_id", "pickup_datetime", "rate_code_id", "pu_location_id", "airport_fee"):
        assert c in out.columns
    assert "VendorID" not in out.columns
    types = dict(out.dtypes)
    assert types["pickup_datetime"] == "timestamp_ntz"
    assert types["passenger_count"] == "int"
    assert types["total_amount"] == "decimal(10,2)"
    r = out.filter(F.col("vendor_id") == 1).first()
    assert (r.passenger_count, r.rate_code_id, r.store_and_fwd_flag) == (0, 99, "N")
    assert (r.congestion_surcharge, r.airport_fee) == (0.0, 0.0)
    assert r.pickup_datetime == dt.datetime(2024, 3, 5, 9, 0)
    kept = out.filter(F.col("vendor_id") == 2).first()
    assert (kept.passenger_count, kept.rate_code_id, kept.store_and_fwd_flag) == (3, 2, "Y")


def test_bad_text_is_counted_and_imputed(spark):
    df = spark.createDataFrame([("abc", "2"), (None, "x")], "passenger_count string, VendorID string")
    out = conform(df, TRIP_SPEC).orderBy(F.col("vendor_id").asc_nulls_last()).collect()
    assert [r.passenger_count for r in out] == [0, 0]  # 'abc' fails the cast -> default
    assert [r.vendor_id for r in out] == [2, None]  # no default for vendor: stays NULL
    fails = {r.column_name: r.failures for r in cast_failures(df, TRIP_SPEC).collect()}
    assert fails == {"passenger_count": 1, "vendor_id": 1}


def test_missing_and_extra_columns_pass_through(spark):
    df = spark.createDataFrame([(1, "x", 2.0)], "VendorID int, notes string, airport_fee double")
    out = conform(df, TRIP_SPEC)
    assert out.columns == ["vendor_id", "notes", "airport_fee"]  # lower-case name still conforms
    drift = {(r.expected_column or r.source_column): r.status
             for r in schema_drift_report(spark, df, TRIP_SPEC).collect()}
    assert drift["VendorID"] == "mapped"
    assert drift["Airport_fee"] == "mapped"
    assert drift["tpep_pickup_datetime"] == "missing"
    assert drift["notes"] == "extra"


def test_decimal_overflow_does_not_fail_the_job(spark):
    df = spark.createDataFrame([(123456789012.5,)], "total_amount double")
    assert conform(df, TRIP_SPEC).first().total_amount is None


def test_lineage_columns(spark):
    df = spark.createDataFrame([(1, "a")], "id long, val string")
    out = add_lineage(df, "run-7", "2024-01-01T00:00:00", "f.parquet", 2024, 3).first()
    assert (out.source_file, out.source_year, out.source_month) == ("f.parquet", 2024, 3)
    assert out.pipeline_run_id == "run-7"
    assert out.processed_at_utc == "2024-01-01T00:00:00"


def test_zone_lookup_conform(spark):
    df = spark.createDataFrame(
        [("1", "Queens", "Astoria", "Boro Zone"), ("2", None, None, None)],
        "LocationID string, Borough string, Zone string, service_zone string",
    )
    out = conform_zone_lookup(df)
    assert out.columns == ["location_id", "borough", "zone", "service_zone"]
    assert dict(out.dtypes)["location_id"] == "int"
    r = out.filter("location_id = 2").first()
    assert (r.borough, r.zone, r.service_zone) == ("Unknown", "Unknown", "Unknown")


def test_cast_failures_routed_to_reject_column(spark):
    from tripmart.operators.conform import conform_with_rejects

    df = spark.createDataFrame(
        [("abc", "2", "2024-01-01 10:00:00"), ("3", "x", "not a time"), ("4", "1", None)],
        "passenger_count string, VendorID string, tpep_pickup_datetime string",
    )
    out = {r.passenger_count: r for r in conform_with_rejects(df, TRIP_SPEC).collect()}
    assert out[0].cast_failed_columns == ["passenger_count"]
    assert sorted(out[3].cast_failed_columns) == ["pickup_datetime", "vendor_id"]
    assert out[4].cast_failed_columns == []  # NULL source is not a cast failure


def test_partition_layout_names():
    from tripmart.sources.raw import period_dir, trip_file_name

    assert period_dir("s3://b/bronze/trips/", 2024, 1) == "s3://b/bronze/trips/year=2024/month=01"
    assert trip_file_name(2024, 1) == "yellow_tripdata_2024-01.parquet"
    assert trip_file_name(2023, 12) == "yellow_tripdata_2023-12.parquet"
