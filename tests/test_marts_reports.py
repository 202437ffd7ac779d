from decimal import Decimal as D

from helpers import explain

from tripmart.operators.dims import date_dim, payment_type_dim, rate_code_dim, vendor_dim
from tripmart.plans import marts, reports
from tripmart.plans.star import Star

FACT = (
    "pickup_date_key int, dropoff_date_key int, pickup_location_key int, dropoff_location_key int, "
    "rate_code_key int, payment_type_key int, vendor_key int, trip_distance double, "
    "trip_duration_seconds long, fare_amount decimal(10,2), tip_amount decimal(10,2), "
    "total_amount decimal(10,2), source_year short, source_month short"
)


def _star(spark, rows, calendar=("2024-01-01", "2025-12-31")):
    loc = spark.createDataFrame(
        [(1, 1, "Queens", "JFK", "Airports"), (2, 2, "Manhattan", "Midtown", "Yellow")],
        "location_key int, location_id int, borough string, zone string, service_zone string",
    )
    return Star(
        fact=spark.createDataFrame(rows, FACT),
        dim_date=date_dim(spark, *calendar),
        dim_location=loc,
        dim_rate_code=rate_code_dim(spark),
        dim_payment_type=payment_type_dim(spark),
        dim_vendor=vendor_dim(spark),
    )


def _trip(day, loc=1, pay=1, fare="10.00", tip="1.00", total="12.00", dist=2.0, dur=600):
    y, m = day // 10000, day // 100 % 100
    return (day, day, loc, 2, 1, pay, 1, dist, dur, D(fare), D(tip), D(total), y, m)


def test_row_lag_vs_calendar_lag_across_a_gap(spark):
    rows = [_trip(20240105), _trip(20240106), _trip(20240210), _trip(20250115)] + [_trip(20250116)] * 3
    star = _star(spark, rows)
    row = {(r.year, r.month): r for r in marts.mart_mom(star).collect()}
    cal = {(r.year, r.month): r for r in marts.mart_mom(star, calendar=True).collect()}
    assert row[(2025, 1)].prev_month_trips == 1  # compares with February 2024
    assert row[(2025, 1)].mom_trip_growth_pct == 300.0
    assert cal[(2025, 1)].prev_month_trips is None and cal[(2025, 1)].mom_trip_growth_pct is None
    assert cal[(2024, 2)].prev_month_trips == 2 and cal[(2024, 2)].mom_trip_growth_pct == -50.0
    assert row[(2024, 1)].mom_trip_growth_pct is None
    assert row[(2024, 1)].period_label == "January 2024"


def test_left_vs_inner_calendar_join(spark):
    rows = [_trip(20240105), _trip(20230105)]  # second trip is outside the calendar
    star = _star(spark, rows)
    kpi = {r.year: r.total_trips for r in marts.monthly_kpi(star).collect()}
    assert kpi == {2024: 1, None: 1}
    assert [r.total_trips for r in marts.mart_daily(star).collect()] == [1]


def test_zero_fare_and_zero_previous_month(spark):
    rows = [_trip(20240105, fare="0.00", tip="1.00", total="0.00"), _trip(20240205, total="5.00")]
    star = _star(spark, rows)
    pay = marts.mart_payment(star).filter("month = 1").first()
    assert pay.effective_tip_rate_pct is None
    mom = {r.month: r for r in marts.mart_mom(star).collect()}
    assert mom[2].prev_month_revenue == 0.0 and mom[2].mom_revenue_growth_pct is None


def test_half_up_rounding_of_averages(spark):
    rows = [_trip(20240105, tip="1.00"), _trip(20240105, tip="1.01")]  # mean 1.005 -> 1.01
    mom = marts.mart_mom(_star(spark, rows)).first()
    assert mom.avg_tip_usd == 1.01


def test_top_zones_tie_break_and_null_group(spark):
    rows = [_trip(20240105, loc=1), _trip(20240105, loc=2), _trip(20240105, loc=9), _trip(20240106, loc=9)]
    top = marts.top_pickup_zones(_star(spark, rows), n=2).collect()
    assert [(r.borough, r.pickup_count) for r in top] == [(None, 2), ("Manhattan", 1)]


def test_reports_drop_null_groups_and_average_months(spark):
    rows = [_trip(20240105, loc=1, fare="10.00"), _trip(20240205, loc=1, fare="20.01"), _trip(20240205, loc=9)]
    star = _star(spark, rows)
    zr = reports.report_zones(marts.mart_zones(star)).collect()
    assert [(r.zone, r.total_trips) for r in zr] == [("JFK", 2)]  # NULL zone group dropped
    assert zr[0].avg_fare_usd == 15.005  # unweighted mean of monthly means
    share = reports.report_borough_share(reports.report_zones(marts.mart_zones(star))).first()
    assert share.revenue_share_pct == 100.0


def test_report_kpi_slices_and_empty(spark):
    rows = [_trip(20240105), _trip(20240205), _trip(20240206)]
    mom = marts.mart_mom(_star(spark, rows))
    all_ = reports.report_kpi(mom).first()
    assert (all_.total_trips, all_.periods) == (3, 2)
    feb = reports.report_kpi(mom, (2024, 2)).first()
    assert feb.total_trips == 2
    assert reports.report_kpi(mom, "February 2024").first().total_trips == 2
    empty = reports.report_kpi(mom, (1999, 1)).first()
    assert (empty.total_trips, empty.total_revenue_usd, empty.avg_distance_miles) == (0, 0.0, 0.0)
    latest = reports.report_latest_growth(mom).first()
    assert (latest.month, latest.trip_growth_label) == (2, "+100.0%")
    assert reports.report_latest_growth(mom, (2024, 1)).first().revenue_growth_label == "Baseline"


def test_top10_resorted_ascending(spark):
    rows = [_trip(20240105, loc=1)] * 3 + [_trip(20240105, loc=2)]
    zr = reports.report_zones(marts.mart_zones(_star(spark, rows)))
    assert [r.total_trips for r in reports.report_top_zones(zr, 10).collect()] == [1, 3]


def test_calendar_is_broadcast_and_location_join_is_size_checked(spark):
    star = _star(spark, [_trip(20240105)])
    df = marts.mart_zones(star)
    before = explain(df)
    assert "BroadcastExchange" in before  # calendar: proven bound, broadcast up front
    df.collect()
    after = explain(df)  # final adaptive plan: the location side was measured, then broadcast
    final = after.split("== Initial Plan ==")[0]
    assert "== Final Plan ==" in final
    assert "SortMergeJoin" not in final and final.count("BroadcastHashJoin") == 2


def test_formatted_report(spark):
    rows = [_trip(20240105, pay=1, total="1234.50")]
    pr = reports.report_payment(marts.mart_payment(_star(spark, rows)))
    r = reports.report_formatted(pr).first()
    assert (r.payment_type_name, r.transaction_count, r.total_volume_usd) == ("Credit card", "1", "$1,234.50")
