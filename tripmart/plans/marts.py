"""Business marts over the star schema, as lazy DataFrames.

Join strategy:

* calendar and seeded code dimensions have a proven size bound (days in the calendar
  range, literal seed rows), so they are broadcast: the fact is never shuffled for them;
* ``dim_location`` comes from a lookup file whose size is not proven, so the fact is first
  pre-aggregated to the location-key grain (partial aggregation before the shuffle) and
  only that small result is joined; Spark's size-checked planner picks the strategy;
* money is summed as DECIMAL (exact, order-independent) and turned into DOUBLE at the end;
  averages of money are ``double(sum) / count``.

Ordering follows the reports' ORDER BY with NULLS LAST made explicit.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmart.functions.calendar import day_label, month_index, period_label
from tripmart.functions.measures import avg_exact, growth_pct, ratio_pct
from tripmart.plans.partials import merged
from tripmart.plans.star import Star

def _minutes() -> Column:
    return F.col("trip_duration_seconds") / F.lit(60.0)


def _fact(star: Star, period: tuple[int, int] | None = None) -> DataFrame:
    """The fact, optionally restricted to one source period.

    Accepted trips always have their pickup inside their source month, so filtering on the
    partition columns selects exactly that calendar month's trips, and the scan reads only
    that month's partition.
    """
    if period is None:
        return star.fact
    y, m = period
    return star.fact.filter((F.col("source_year") == F.lit(y)) & (F.col("source_month") == F.lit(m)))


def _dates(star: Star, cols: list[str], key_alias: str, prefix: str = "") -> DataFrame:
    """Calendar columns keyed by ``key_alias``; how they are joined is left to the planner."""
    return star.dim_date.select(
        F.col("date_key").alias(key_alias), *[F.col(c).alias(prefix + c) for c in cols]
    )


def _with_dates(fact: DataFrame, star: Star, cols: list[str], how: str, role: str = "pickup",
                prefix: str = "") -> DataFrame:
    key = f"_{role}_dk"
    dates = _dates(star, cols, key, prefix)
    return fact.join(dates, fact[f"{role}_date_key"] == dates[key], how).drop(key)


def _seed_join(fact: DataFrame, dim: DataFrame, key: str, name_col: str) -> DataFrame:
    d = F.broadcast(dim.select(F.col(key).alias("_sk"), F.col(name_col)))
    return fact.join(d, fact[key] == d["_sk"], "left").drop("_sk")


def _locations(star: Star, prefix: str = "") -> DataFrame:
    return star.dim_location.select(
        F.col("location_key").alias(f"_{prefix}lk"),
        F.col("borough").alias(f"{prefix}borough"),
        F.col("zone").alias(f"{prefix}zone"),
    )


def _r2(c: Column) -> Column:
    return F.round(c, 2)


def _money(c: Column) -> Column:
    return c.cast("double")


# ---------------------------------------------------------------------------------------
# Warehouse validation queries
# ---------------------------------------------------------------------------------------


def monthly_kpi(star: Star, period: tuple[int, int] | None = None) -> DataFrame:
    """Trips, revenue, mean distance and duration per calendar month (LEFT calendar join:
    trips outside the calendar form one NULL group)."""
    f = _fact(star, period).select("pickup_date_key", "total_amount", "trip_distance", "trip_duration_seconds")
    j = _with_dates(f, star, ["year", "month_name"], "left")
    return j.groupBy("year", "month_name").agg(
        F.count(F.lit(1)).alias("total_trips"),
        _money(F.sum("total_amount")).alias("total_revenue_usd"),
        F.avg("trip_distance").alias("avg_distance_miles"),
        F.avg(_minutes()).alias("avg_duration_minutes"),
    )


def monthly_recap(star: Star, period: tuple[int, int] | None = None) -> DataFrame:
    """Month recap grouped also by the source period (one row per calendar month and
    source period), rounded, ordered by source period."""
    f = _fact(star, period).select(
        "pickup_date_key", "source_year", "source_month", "total_amount", "trip_distance",
        "trip_duration_seconds",
    )
    j = _with_dates(f, star, ["year", "month_name"], "left")
    g = j.groupBy("year", "month_name", "source_year", "source_month").agg(
        F.count(F.lit(1)).alias("total_trips"),
        _money(_r2(F.sum("total_amount"))).alias("total_revenue_usd"),
        _r2(F.avg("trip_distance")).alias("avg_distance_miles"),
        _r2(F.avg(_minutes())).alias("avg_duration_minutes"),
    )
    return g.orderBy(
        F.col("source_year").asc_nulls_last(), F.col("source_month").asc_nulls_last()
    ).select("year", "month_name", "total_trips", "total_revenue_usd", "avg_distance_miles",
             "avg_duration_minutes")


def top_pickup_zones(star: Star, n: int = 5, period: tuple[int, int] | None = None) -> DataFrame:
    """Top-n pickup zones by trip count (ties broken by borough, zone; NULLS LAST)."""
    pre = _fact(star, period).groupBy("pickup_location_key").agg(
        F.count(F.lit(1)).alias("_n"), F.sum("total_amount").alias("_rev")
    )
    loc = _locations(star)
    j = pre.join(loc, pre["pickup_location_key"] == loc["_lk"], "left")
    g = j.groupBy("borough", "zone").agg(
        F.sum("_n").cast("long").alias("pickup_count"),
        _money(F.sum("_rev")).alias("total_revenue_usd"),
    )
    return g.orderBy(
        F.col("pickup_count").desc(), F.col("borough").asc_nulls_last(), F.col("zone").asc_nulls_last()
    ).limit(n)


def tip_by_payment(star: Star, period: tuple[int, int] | None = None) -> DataFrame:
    """Transactions and mean tip / total per payment type, busiest first."""
    f = _fact(star, period).select("payment_type_key", "tip_amount", "total_amount")
    j = _seed_join(f, star.dim_payment_type, "payment_type_key", "payment_type_name")
    g = j.groupBy("payment_type_name").agg(
        F.count(F.lit(1)).alias("total_transactions"),
        avg_exact("tip_amount").alias("avg_tip_usd"),
        avg_exact("total_amount").alias("avg_total_usd"),
    )
    return g.orderBy(F.col("total_transactions").desc(), F.col("payment_type_name").asc_nulls_last())


# ---------------------------------------------------------------------------------------
# Dashboard marts
# ---------------------------------------------------------------------------------------


def _monthly_rollup(star: Star, period: tuple[int, int] | None = None) -> DataFrame:
    f = _fact(star, period).select(
        "pickup_date_key", "total_amount", "trip_distance", "trip_duration_seconds", "tip_amount"
    )
    j = _with_dates(f, star, ["year", "month", "month_name"], "left")
    return j.groupBy("year", "month", "month_name").agg(
        F.count(F.lit(1)).alias("total_trips"),
        _r2(F.sum("total_amount")).alias("_revenue"),
        _r2(F.avg("trip_distance")).alias("avg_distance_miles"),
        _r2(F.avg(_minutes())).alias("avg_duration_minutes"),
        _r2(avg_exact("tip_amount")).alias("avg_tip_usd"),
    )


def mart_mom(star: Star, calendar: bool = False) -> DataFrame:
    """Monthly rollup with previous-month values and month-over-month growth.

    ``calendar=False`` (reference behaviour): previous = previous *row* in (year, month)
    order, so a gap in the months compares with whatever month came before.
    ``calendar=True``: previous = exactly the preceding calendar month, NULL across gaps.
    The window is unpartitioned, which is safe because it runs on the rollup (one row per
    month), never on trips.
    """
    r = _monthly_rollup(star)
    if calendar:
        idx = month_index(F.col("year"), F.col("month"))
        w = Window.orderBy(idx.asc_nulls_last()).rangeBetween(-1, -1)

        def prev(c: str) -> Column:
            return F.when(idx.isNotNull(), F.max(c).over(w))
    else:
        w = Window.orderBy(F.col("year").asc_nulls_last(), F.col("month").asc_nulls_last())

        def prev(c: str) -> Column:
            return F.lag(c, 1).over(w)

    r = r.withColumns({"_prev_trips": prev("total_trips"), "_prev_rev": prev("_revenue")})
    return r.select(
        "year",
        "month",
        "month_name",
        "total_trips",
        _money(F.col("_revenue")).alias("total_revenue_usd"),
        "avg_distance_miles",
        "avg_duration_minutes",
        "avg_tip_usd",
        F.col("_prev_trips").alias("prev_month_trips"),
        _money(F.col("_prev_rev")).alias("prev_month_revenue"),
        growth_pct("total_trips", "_prev_trips").alias("mom_trip_growth_pct"),
        growth_pct("_revenue", "_prev_rev").alias("mom_revenue_growth_pct"),
        period_label("month_name", "year").alias("period_label"),
    ).orderBy(F.col("year").asc_nulls_last(), F.col("month").asc_nulls_last())


def mart_daily(star: Star, period: tuple[int, int] | None = None) -> DataFrame:
    """Daily trips, revenue, duration and distance (INNER calendar join)."""
    f = _fact(star, period).select("pickup_date_key", "total_amount", "trip_distance", "trip_duration_seconds")
    j = _with_dates(f, star, ["year", "month", "day_of_month", "full_date", "month_name"], "inner")
    g = j.groupBy("year", "month", "day_of_month", "full_date", "month_name").agg(
        F.count(F.lit(1)).alias("total_trips"),
        _money(_r2(F.sum("total_amount"))).alias("total_revenue_usd"),
        _r2(F.avg(_minutes())).alias("avg_duration_minutes"),
        _r2(F.avg("trip_distance")).alias("avg_distance_miles"),
    )
    return g.withColumns(
        {
            "period_label": period_label("month_name", "year"),
            "day_label": day_label("month_name", "day_of_month"),
        }
    ).orderBy(F.col("full_date").asc_nulls_last())


def mart_daily_quarter(star: Star, year: int, quarter: int) -> DataFrame:
    """:func:`mart_daily` of one quarter, chosen in the calendar alone.

    An accepted trip's pickup lies in its source month, so the calendar also joins on the fact's
    partition columns: its few months then prune the fact's folders at run time (dynamic
    partition pruning), where the day keys would let all of them be read."""
    days = star.dim_date.filter((F.col("year") == F.lit(year)) & (F.col("quarter") == F.lit(quarter))).withColumns(
        {"_y": F.col("year").cast("short"), "_m": F.col("month").cast("short")})
    pruned = star.fact.join(
        days.select("_y", "_m").distinct(), (F.col("source_year") == F.col("_y")) & (F.col("source_month") == F.col("_m")), "left_semi")
    return mart_daily(replace(star, fact=pruned, dim_date=days.drop("_y", "_m")))


def mart_zones(star: Star, period: tuple[int, int] | None = None) -> DataFrame:
    """Trips, revenue and mean fare per month and pickup zone (INNER calendar join, LEFT
    location join). The fact is reduced to (day, location) partials before any join."""
    pre = _fact(star, period).groupBy("pickup_date_key", "pickup_location_key").agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum("total_amount").alias("_rev"),
        F.sum("fare_amount").alias("_fare"),
        F.count("fare_amount").alias("_fare_n"),
    )
    return _zones_of(pre, star)


def mart_zones_from_partials(star: Star, states: DataFrame) -> DataFrame:
    """:func:`mart_zones` from the stored monthly states, without the fact."""
    by = merged(states, ("pickup_date_key", "pickup_location_key"))
    return _zones_of(by.select(
        "pickup_date_key", "pickup_location_key", F.col("trips").alias("_n"), F.col("total_amount_sum").alias("_rev"),
        F.col("fare_amount_sum").alias("_fare"), F.col("fare_amount_n").alias("_fare_n"),
    ), star)


def _zones_of(pre: DataFrame, star: Star) -> DataFrame:
    j = _with_dates(pre, star, ["year", "month", "month_name"], "inner")
    loc = _locations(star)
    j = j.join(loc, j["pickup_location_key"] == loc["_lk"], "left")
    g = j.groupBy("year", "month", "month_name", "borough", "zone").agg(
        F.sum("_n").cast("long").alias("total_trips"),
        _money(_r2(F.sum("_rev"))).alias("total_revenue_usd"),
        _r2(F.try_divide(F.sum("_fare").cast("double"), F.sum("_fare_n"))).alias("avg_fare_usd"),
    )
    return g.withColumn("period_label", period_label("month_name", "year"))


def mart_payment(star: Star, period: tuple[int, int] | None = None) -> DataFrame:
    """Transactions, volume, mean tip and effective tip rate per month and payment type."""
    f = _fact(star, period).select("pickup_date_key", "payment_type_key", "total_amount", "tip_amount", "fare_amount")
    j = _with_dates(f, star, ["year", "month", "month_name"], "inner")
    j = _seed_join(j, star.dim_payment_type, "payment_type_key", "payment_type_name")
    g = j.groupBy("year", "month", "month_name", "payment_type_name").agg(
        F.count(F.lit(1)).alias("transaction_count"),
        _money(_r2(F.sum("total_amount"))).alias("total_volume_usd"),
        _r2(avg_exact("tip_amount")).alias("avg_tip_usd"),
        ratio_pct(F.sum("tip_amount"), F.sum("fare_amount")).alias("effective_tip_rate_pct"),
    )
    return g.withColumn("period_label", period_label("month_name", "year"))


# ---------------------------------------------------------------------------------------
# Declared-but-unqueried relationships: role-playing dimensions, vendor and rate code
# ---------------------------------------------------------------------------------------


def role_playing_dates(star: Star, period: tuple[int, int] | None = None) -> DataFrame:
    """Trips by pickup month x dropoff month: the calendar joined in both roles."""
    f = _fact(star, period).select("pickup_date_key", "dropoff_date_key", "total_amount", "trip_duration_seconds")
    j = _with_dates(f, star, ["year", "month"], "left", "pickup", "pickup_")
    j = _with_dates(j, star, ["year", "month"], "left", "dropoff", "dropoff_")
    return j.groupBy("pickup_year", "pickup_month", "dropoff_year", "dropoff_month").agg(
        F.count(F.lit(1)).alias("total_trips"),
        _money(F.sum("total_amount")).alias("total_revenue_usd"),
        _r2(F.avg(_minutes())).alias("avg_duration_minutes"),
    )


def route_pairs(star: Star, period: tuple[int, int] | None = None) -> DataFrame:
    """Trips and revenue per (pickup zone, dropoff zone): the location dimension in both
    roles, joined after reducing the fact to location-pair partials."""
    pre = _fact(star, period).groupBy("pickup_location_key", "dropoff_location_key").agg(
        F.count(F.lit(1)).alias("_n"), F.sum("total_amount").alias("_rev")
    )
    pu, do = _locations(star, "pickup_"), _locations(star, "dropoff_")
    j = pre.join(pu, pre["pickup_location_key"] == pu["_pickup_lk"], "left")
    j = j.join(do, j["dropoff_location_key"] == do["_dropoff_lk"], "left")
    g = j.groupBy("pickup_borough", "pickup_zone", "dropoff_borough", "dropoff_zone").agg(
        F.sum("_n").cast("long").alias("total_trips"),
        _money(F.sum("_rev")).alias("total_revenue_usd"),
    )
    return g.orderBy(F.col("total_trips").desc(), *[F.col(c).asc_nulls_last() for c in
                     ("pickup_borough", "pickup_zone", "dropoff_borough", "dropoff_zone")])


def _kpi_by_seed(star: Star, dim: DataFrame, key: str, name_col: str,
                 period: tuple[int, int] | None = None) -> DataFrame:
    f = _fact(star, period).select(key, "total_amount", "trip_distance")
    j = _seed_join(f, dim, key, name_col)
    return j.groupBy(name_col).agg(
        F.count(F.lit(1)).alias("total_trips"),
        _money(F.sum("total_amount")).alias("total_revenue_usd"),
        _r2(F.avg("trip_distance")).alias("avg_distance_miles"),
    ).orderBy(F.col("total_trips").desc(), F.col(name_col).asc_nulls_last())


def kpi_by_vendor(star: Star, period: tuple[int, int] | None = None) -> DataFrame:
    return _kpi_by_seed(star, star.dim_vendor, "vendor_key", "vendor_name", period)


def kpi_by_rate_code(star: Star, period: tuple[int, int] | None = None) -> DataFrame:
    return _kpi_by_seed(star, star.dim_rate_code, "rate_code_key", "rate_code_name", period)
