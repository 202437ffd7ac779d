import datetime as dt
import math

from helpers import explain

from tripmart.operators.quality import (
    all_valid,
    apply_rules,
    assert_gate,
    quality_gate,
    quality_report,
    reject_reason_counts,
    trip_rules,
)
from tripmart.schemas import TRIP_KEYS

SCHEMA = (
    "vendor_id int, pickup_datetime timestamp_ntz, dropoff_datetime timestamp_ntz, "
    "trip_distance double, pu_location_id int, do_location_id int, total_amount decimal(10,2), "
    "year int, month int"
)
T = dt.datetime


def _trips(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_five_rows_one_accepted(spark):
    from decimal import Decimal as D

    base = (1, T(2024, 5, 3, 7, 0), T(2024, 5, 3, 7, 40), 6.0, 10, 20, D("22.00"), 2024, 5)
    rows = [
        base,
        (1, T(2024, 5, 3, 8, 0), T(2024, 5, 3, 7, 0), 2.0, 10, 20, D("9.00"), 2024, 5),  # reversed
        (1, T(2024, 5, 4, 8, 0), T(2024, 5, 4, 8, 9), -3.0, 10, 20, D("9.00"), 2024, 5),  # negative
        (1, T(2024, 6, 1, 0, 0), T(2024, 6, 1, 0, 9), 2.0, 10, 20, D("9.00"), 2024, 5),  # next month
        base,  # exact copy
    ]
    rep = quality_report(_trips(spark, rows), trip_rules(2024, 5), TRIP_KEYS).first()
    assert (rep.total_input_rows, rep.accepted_rows, rep.rejected_rows) == (5, 1, 4)
    assert rep.acceptance_rate_pct == 20.0
    reasons = {r.reason: r.rejected_rows for r in reject_reason_counts(_trips(spark, rows), trip_rules(2024, 5)).collect()}
    assert reasons == {"pickup_in_period": 1, "dropoff_after_pickup": 1, "distance_in_range": 1}


def test_december_rolls_into_next_year(spark):
    rows = [
        (1, T(2024, 12, 31, 23, 59, 59), T(2025, 1, 1, 0, 10), 1.0, 1, 1, None, 2024, 12),
        (1, T(2025, 1, 1, 0, 0, 0), T(2025, 1, 1, 0, 10), 1.0, 1, 1, None, 2024, 12),
    ]
    valid, rejected = apply_rules(_trips(spark, rows), trip_rules(2024, 12))
    assert [r.pickup_datetime for r in valid.collect()] == [T(2024, 12, 31, 23, 59, 59)]
    assert rejected.first().reject_reasons == ["pickup_in_period"]
    # per-row period (multi-month run) gives the same answer
    assert valid.count() == _trips(spark, rows).filter(all_valid(trip_rules())).count()


def test_distance_bounds(spark):
    dists = [0.0, 499.99, 500.0, -0.01, float("nan"), None]
    rows = [(1, T(2024, 1, 2, 1, 0), T(2024, 1, 2, 2, 0), d, i, 1, None, 2024, 1) for i, d in enumerate(dists)]
    valid = _trips(spark, rows).filter(all_valid(trip_rules(2024, 1)))
    got = sorted(r.trip_distance for r in valid.collect())
    assert got == [0.0, 499.99]
    assert not any(g is None or math.isnan(g) for g in got)


def test_null_operands_reject(spark):
    rows = [(1, None, T(2024, 1, 2, 2, 0), 1.0, 1, 1, None, 2024, 1)]
    assert _trips(spark, rows).filter(all_valid(trip_rules(2024, 1))).count() == 0


def test_empty_input_report_is_zero_rate(spark):
    from tripmart.operators.quality import quality_report_from_counts

    inputs = spark.createDataFrame([(2024, 1, 0)], "year int, month int, rows long")
    accepted = spark.createDataFrame([], "year int, month int, rows long")
    r = quality_report_from_counts(inputs, accepted).first()
    assert (r.accepted_rows, r.acceptance_rate_pct) == (0, 0.0)


def _report(spark, rows):
    return spark.createDataFrame(
        rows, "dataset string, year int, month int, accepted_rows long, acceptance_rate_pct double"
    )


def test_gate_thresholds(spark):
    rows = [
        ("d", 2024, 1, 999, 100.0),
        ("d", 2024, 2, 1000, 100.0),
        ("d", 2024, 3, 5000, 95.0),  # rejection exactly 5.0 passes
        ("d", 2024, 4, 5000, 94.99),  # 5.01 fails
        ("d", 2024, 5, None, None),  # missing fields -> fail
    ]
    gate = {(r.month): (r.passed, r.gate_reason) for r in quality_gate(_report(spark, rows)).collect()}
    assert gate[1] == (False, "too_few_rows")
    assert gate[2] == (True, "ok")
    assert gate[3] == (True, "ok")
    assert gate[4] == (False, "rejection_rate_too_high")
    assert gate[5] == (False, "too_few_rows")


def test_assert_gate_raises(spark):
    import pytest

    gate = quality_gate(_report(spark, [("d", 2024, 1, 10, 100.0)]))
    with pytest.raises(ValueError, match="2024-01"):
        assert_gate(gate)
    assert_gate(quality_gate(_report(spark, [("d", 2024, 1, 1000, 99.0)])))


def test_report_counts_duplicates_as_rejected_per_period(spark):
    rows = [
        (1, T(2024, 1, 2, 1, 0), T(2024, 1, 2, 2, 0), 1.0, 5, 6, None, 2024, 1),
        (1, T(2024, 1, 2, 1, 0), T(2024, 1, 2, 2, 0), 1.0, 5, 6, None, 2024, 1),
        (1, T(2024, 2, 2, 1, 0), T(2024, 2, 2, 2, 0), 1.0, None, 6, None, 2024, 2),
        (1, T(2024, 2, 2, 1, 0), T(2024, 2, 2, 2, 0), 1.0, None, 6, None, 2024, 2),
    ]
    rep = {(r.year, r.month): (r.total_input_rows, r.accepted_rows)
           for r in quality_report(_trips(spark, rows), trip_rules(), TRIP_KEYS).collect()}
    assert rep == {(2024, 1): (2, 1), (2024, 2): (2, 1)}  # NULL keys compare equal


def test_month_filter_is_pushed_to_parquet(spark, tmp_root):
    rows = [(1, T(2024, 1, 2, 1, 0), T(2024, 1, 2, 2, 0), 1.0, 5, 6, None, 2024, 1)]
    path = f"{tmp_root}/t"
    _trips(spark, rows).write.parquet(path)
    (rule,) = [r for r in trip_rules(2024, 1) if r.name == "pickup_in_period"]
    plan = explain(spark.read.parquet(path).filter(rule.predicate))
    assert "GreaterThanOrEqual(pickup_datetime" in plan
    assert "LessThan(pickup_datetime" in plan


def test_impossible_period_rejects_rows_instead_of_failing(spark):
    rows = [(1, T(2024, 1, 2, 1, 0), T(2024, 1, 2, 2, 0), 1.0, 1, 1, None, 2024, 13)]
    df = _trips(spark, rows)
    assert df.filter(all_valid(trip_rules())).count() == 0
    assert quality_report(df, trip_rules(), TRIP_KEYS).first().accepted_rows == 0
