"""Property tests: operators vs a plain-Python brute force on random small inputs."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tripmart.operators.dedupe import dedupe
from tripmart.operators.quality import quality_report, trip_rules
from tripmart.schemas import TRIP_KEYS

SETTINGS = dict(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

key = st.one_of(st.none(), st.integers(0, 2))
rows_kv = st.lists(st.tuples(key, key, st.one_of(st.none(), st.integers(0, 5))), max_size=25)


@settings(**SETTINGS)
@given(rows=rows_kv)
def test_dedupe_keeps_first_row_per_key(spark, rows):
    df = spark.createDataFrame(rows, "a int, b int, v int")
    got = {(r.a, r.b): r.v for r in dedupe(df, ["a", "b"]).collect()}
    groups = {}
    for a, b, v in rows:  # NULL keys compare equal
        groups.setdefault((a, b), []).append(v)
    null_first = lambda x: (x is not None, x if x is not None else 0)
    assert got == {k: min(vs, key=null_first) for k, vs in groups.items()}


T0 = dt.datetime(2024, 3, 31, 23, 0)
trip = st.tuples(
    st.one_of(st.none(), st.integers(1, 2)),  # vendor
    st.integers(-2, 3),  # pickup offset (hours) around the month end
    st.integers(-1, 2),  # duration (hours)
    st.sampled_from([0.0, 1.5, 499.99, 500.0, -1.0, float("nan")]),
    st.one_of(st.none(), st.integers(1, 2)),  # pickup location
)


@settings(**SETTINGS)
@given(trips=st.lists(trip, max_size=30))
def test_quality_report_matches_brute_force(spark, trips):
    rows = []
    for v, off, dur, dist, pu in trips:
        p = T0 + dt.timedelta(hours=off)
        rows.append((v, p, p + dt.timedelta(hours=dur), dist, pu, 7, None, 2024, 3))
    schema = (
        "vendor_id int, pickup_datetime timestamp_ntz, dropoff_datetime timestamp_ntz, "
        "trip_distance double, pu_location_id int, do_location_id int, total_amount decimal(10,2), "
        "year int, month int"
    )
    df = spark.createDataFrame(rows, schema) if rows else spark.createDataFrame([], schema)
    rep = quality_report(df, trip_rules(), TRIP_KEYS, processed_at="t").collect()
    lo, hi = dt.datetime(2024, 3, 1), dt.datetime(2024, 4, 1)

    def ok(r):
        _, p, d, dist, *_ = r
        return lo <= p < hi and d > p and dist == dist and 0 <= dist < 500

    accepted = {(r[0], r[1], r[2], r[4], r[5], r[6]) for r in rows if ok(r)}
    if not rows:
        assert rep == []
    else:
        (r,) = rep
        assert (r.total_input_rows, r.accepted_rows) == (len(rows), len(accepted))
        assert r.rejected_rows == len(rows) - len(accepted)
