"""Dashboard-style reports over the marts: period slicing and cross-period rollups.

The marts have at most one row per (month x zone / payment type), so these are small
aggregates; they still run as Spark plans so a report never needs the marts on the driver.

Faithful behaviour: rollups drop NULL group keys and take the *unweighted* mean of the
monthly (already rounded) averages. Means of 2-decimal values are summed as DECIMAL, so
they do not depend on partition order. ``weighted=True`` gives trip-weighted means instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmart.functions.formats import fmt_count, fmt_growth, fmt_pct, fmt_usd
from tripmart.functions.measures import mean_2dp


def slice_period(mart: DataFrame, period: tuple[int, int] | str | None = None) -> DataFrame:
    """All rows (``None``), one (year, month), or one period label such as 'March 1997'."""
    if period is None:
        return mart
    if isinstance(period, str):
        return mart.filter(F.col("period_label") == F.lit(period))
    y, m = period
    return mart.filter((F.col("year") == F.lit(y)) & (F.col("month") == F.lit(m)))


def _sum_money(col: str) -> F.Column:
    return F.sum(F.col(col).cast("decimal(20,2)")).cast("double")


def _weighted(col: str, weight: str) -> F.Column:
    """Weight-averaged 2-decimal values; rows with a NULL value carry no weight."""
    num = F.sum(F.col(col).cast("decimal(20,2)") * F.col(weight))
    den = F.sum(F.when(F.col(col).isNotNull(), F.col(weight)))
    return F.try_divide(num.cast("double"), den)


def report_kpi(mom: DataFrame, period=None) -> DataFrame:
    """Scorecards: total trips and revenue, mean of monthly mean distance and duration.
    An empty slice gives zeros."""
    k = slice_period(mom, period)
    return k.agg(
        F.coalesce(F.sum("total_trips"), F.lit(0)).cast("long").alias("total_trips"),
        F.coalesce(_sum_money("total_revenue_usd"), F.lit(0.0)).alias("total_revenue_usd"),
        F.coalesce(mean_2dp("avg_distance_miles"), F.lit(0.0)).alias("avg_distance_miles"),
        F.coalesce(mean_2dp("avg_duration_minutes"), F.lit(0.0)).alias("avg_duration_minutes"),
        F.count(F.lit(1)).alias("periods"),
    )


def report_latest_growth(mom: DataFrame, period=None) -> DataFrame:
    """Growth of the last month in (year, month) order; no previous month -> 'Baseline'."""
    k = slice_period(mom, period)
    last = k.orderBy(F.col("year").desc_nulls_first(), F.col("month").desc_nulls_first()).limit(1)
    return last.select(
        "year",
        "month",
        "period_label",
        "mom_trip_growth_pct",
        "mom_revenue_growth_pct",
        fmt_growth(F.round("mom_revenue_growth_pct", 1)).alias("revenue_growth_label"),
        fmt_growth(F.round("mom_trip_growth_pct", 1)).alias("trip_growth_label"),
    )


def report_zones(zones: DataFrame, period=None, weighted: bool = False) -> DataFrame:
    """Zone rollup: trips and revenue summed, mean fare averaged over months; busiest first."""
    z = slice_period(zones, period).dropna(subset=["borough", "zone"])
    fare = _weighted("avg_fare_usd", "total_trips") if weighted else mean_2dp("avg_fare_usd")
    g = z.groupBy("borough", "zone").agg(
        F.sum("total_trips").cast("long").alias("total_trips"),
        _sum_money("total_revenue_usd").alias("total_revenue_usd"),
        fare.alias("avg_fare_usd"),
    )
    return g.orderBy(F.col("total_trips").desc(), "borough", "zone")


def report_payment(payment: DataFrame, period=None, weighted: bool = False) -> DataFrame:
    """Payment rollup: counts and volume summed, mean tip and tip rate averaged over months."""
    p = slice_period(payment, period).dropna(subset=["payment_type_name"])
    if weighted:
        tip = _weighted("avg_tip_usd", "transaction_count")
        rate = _weighted("effective_tip_rate_pct", "transaction_count")
    else:
        tip, rate = mean_2dp("avg_tip_usd"), mean_2dp("effective_tip_rate_pct")
    g = p.groupBy("payment_type_name").agg(
        F.sum("transaction_count").cast("long").alias("transaction_count"),
        _sum_money("total_volume_usd").alias("total_volume_usd"),
        tip.alias("avg_tip_usd"),
        rate.alias("effective_tip_rate_pct"),
    )
    return g.orderBy(F.col("transaction_count").desc(), "payment_type_name")


def report_borough_share(zone_report: DataFrame) -> DataFrame:
    """Revenue per borough and its share of the total (window over the few borough rows)."""
    b = zone_report.groupBy("borough").agg(
        F.sum(F.col("total_revenue_usd").cast("decimal(20,2)")).alias("_rev")
    )
    total = F.sum("_rev").over(Window.partitionBy())
    return b.select(
        "borough",
        F.col("_rev").cast("double").alias("total_revenue_usd"),
        F.round(F.try_divide(F.col("_rev").cast("double"), total.cast("double")) * F.lit(100.0), 2)
        .alias("revenue_share_pct"),
    ).orderBy(F.col("total_revenue_usd").desc(), "borough")


def report_top_zones(zone_report: DataFrame, n: int = 10) -> DataFrame:
    """Top-n zones by trips, then re-sorted ascending for a horizontal bar chart."""
    top = zone_report.orderBy(F.col("total_trips").desc(), "borough", "zone").limit(n)
    return top.orderBy(F.col("total_trips").asc(), F.col("borough").desc(), F.col("zone").desc())


def report_formatted(payment_report: DataFrame) -> DataFrame:
    """Display strings for the payment settlement table (missing values shown as '-')."""
    return payment_report.select(
        F.coalesce("payment_type_name", F.lit("-")).alias("payment_type_name"),
        fmt_count("transaction_count").alias("transaction_count"),
        fmt_usd("total_volume_usd").alias("total_volume_usd"),
        fmt_usd("avg_tip_usd").alias("avg_tip_usd"),
        fmt_pct("effective_tip_rate_pct").alias("effective_tip_rate_pct"),
    )
