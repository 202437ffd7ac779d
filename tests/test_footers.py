import datetime as dt

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.operators.conform import conform_groups
from tripmart.schemas import TRIP_SPEC
from tripmart.sources import footers
from tripmart.sources.raw import landed, read_raw_groups


def _land(root, year, month, table, name="trips"):
    import os

    folder = f"{root}/year={year:04d}/month={month:02d}"
    os.makedirs(folder, exist_ok=True)
    pq.write_table(table, f"{folder}/{name}_{year:04d}-{month:02d}.parquet")


def _month(**columns):
    base = {"VendorID": pa.array([1, 2], pa.int64()), "trip_distance": pa.array([1.5, 2.5])}
    return pa.table({**base, **columns})


def test_footer_schema_of_foreign_files(tmp_path):
    """Files that Spark didn't write: 96-bit timestamps, unsigned numbers, nested columns."""
    at = pa.array([dt.datetime(2024, 1, 1)], pa.timestamp("us"))
    table = pa.table({
        "ntz": at, "utc": at.cast(pa.timestamp("us", "UTC")), "small": pa.array([1], pa.uint8()), "big": pa.array([1], pa.uint64()),
        "l": pa.array([[1]], pa.list_(pa.int32())), "d": pa.array([1.0], pa.float32()), "s": pa.array(["x"]).dictionary_encode(),
    })
    pq.write_table(table, tmp_path / "a.parquet")
    found = {f.name: f.dataType for f in footers.footer_schema(f"file:{tmp_path}/a.parquet").fields}
    assert found["ntz"] == T.TimestampNTZType() and found["utc"] == T.TimestampType()
    assert found["small"] == T.ShortType() and found["big"] == T.DecimalType(20, 0)
    assert found["l"] == T.ArrayType(T.IntegerType()) and found["d"] == T.FloatType() and found["s"] == T.StringType()
    pq.write_table(table.select(["ntz"]), tmp_path / "b.parquet", use_deprecated_int96_timestamps=True)
    assert footers.footer_schema(f"file:{tmp_path}/b.parquet")["ntz"].dataType == T.TimestampType()


def test_footer_schema_is_what_spark_infers(spark, tmp_root):
    path = f"{tmp_root}/own"
    spark.range(3).select(
        "id", F.current_timestamp().alias("t"), F.lit("x").alias("s"), F.lit(1).cast("decimal(10,2)").alias("m"),
        F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz").alias("n"), F.array(F.lit(1)).alias("l"),
    ).write.parquet(path)
    for file in spark.read.parquet(path).inputFiles():
        assert footers.fingerprint(footers.footer_schema(file)) == footers.fingerprint(spark.read.parquet(file).schema)


def test_fingerprint_ignores_order_and_case():
    a = T.StructType().add("Airport_fee", "double").add("x", "integer")
    b = T.StructType().add("X", "integer").add("airport_FEE", "double")
    assert footers.fingerprint(a) == footers.fingerprint(b)
    assert footers.fingerprint(a) != footers.fingerprint(T.StructType().add("x", "long").add("airport_fee", "double"))


def test_groups_lose_nothing(spark, tmp_root):
    """Columns that come and go make one frame; a column of two types makes two."""
    _land(tmp_root, 2024, 1, _month(passenger_count=pa.array([1.0, None])))
    _land(tmp_root, 2024, 2, _month(airport_fee=pa.array([0.5, 1.5])))
    _land(tmp_root, 2024, 3, _month(passenger_count=pa.array([3, 4], pa.int64()), Airport_fee=pa.array([2.5, 3.5])))
    _land(tmp_root, 2024, 4, _month(passenger_count=pa.array([5, 6], pa.int64())))
    groups = read_raw_groups(spark, tmp_root)
    assert sorted(g.count() for g in groups) == [4, 4]
    rows = conform_groups(groups, TRIP_SPEC).collect()
    assert sorted((r.month, r.passenger_count, r.airport_fee) for r in rows) == [
        (1, 0, 0.0), (1, 1, 0.0), (2, 0, 0.5), (2, 0, 1.5), (3, 3, 2.5), (3, 4, 3.5), (4, 5, 0.0), (4, 6, 0.0)]
    assert [g.count() for g in read_raw_groups(spark, tmp_root, [(2024, 3)])] == [2]
    assert read_raw_groups(spark, tmp_root, [(2025, 1)]) == [] == read_raw_groups(spark, f"{tmp_root}/none")


def test_driver_opens_no_file(spark, tmp_root, monkeypatch):
    """The number of jobs doesn't grow with the number of files, and nothing reads a footer here."""
    for k in range(1, 13):
        kind = pa.float64() if k % 2 else pa.int64()
        _land(tmp_root, 2023, k, _month(passenger_count=pa.array([1, 2], kind)))
        _land(tmp_root, 2024, k, _month(passenger_count=pa.array([1, 2], kind)))

    def no(*_, **__):
        raise AssertionError("the driver opened a file")

    monkeypatch.setattr(pq, "ParquetFile", no)
    tracker = spark.sparkContext.statusTracker()
    jobs = []
    for periods in ([(2023, 1), (2023, 2)], None):
        group = f"footers-{len(jobs)}"
        spark.sparkContext.setJobGroup(group, "")
        groups = read_raw_groups(spark, tmp_root, periods)
        assert len(groups) == 2
        jobs.append(len(tracker.getJobIdsForGroup(group)))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert sum(g.count() for g in groups) == 48
    assert jobs[1] <= jobs[0] + 1 and jobs[1] <= 8


def test_latest_landing(spark, tmp_root):
    _land(tmp_root, 2024, 1, _month())
    _land(tmp_root, 2024, 1, _month(), name="trips.20240305T101500")
    _land(tmp_root, 2024, 2, _month())
    paths = sorted(r.path.rpartition("/")[2] for r in landed(spark, tmp_root).collect())
    assert paths == ["trips.20240305T101500_2024-01.parquet", "trips_2024-02.parquet"]
    assert landed(spark, f"{tmp_root}/none") is None


@pytest.mark.parametrize("n", [1, 40])
def test_many_files_of_a_month(spark, tmp_root, n):
    for k in range(n):
        _land(tmp_root, 2024, 1, _month(x=pa.array(np.arange(2))), name=f"part{k}")
    (group,) = read_raw_groups(spark, tmp_root)
    assert group.count() == 2 * n
