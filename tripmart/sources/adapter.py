"""Test/bench adapter: the driver's star-schema tables -> raw monthly trip records.

Base = lineitem JOIN orders JOIN customer JOIN supplier on the natural keys; rows with
total_amount < 10000 appear twice (exact duplicates for the dedupe stage). The Spark plan
and the SQL text below use the same expressions, so every operator downstream can be
checked against an independent SQL engine.

Raw columns carry the trip feed's published names. ``year``/``month`` emulate the bronze
partition directories (``year=YYYY/month=MM``): each record sits in the file of its
pickup month.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _dec(col: str, p: int, s: int):
    return F.col(col).cast(f"decimal({p},{s})")


def raw_trips(spark: SparkSession, sf_dir: str, with_period: bool = True,
              spread: int | None = None) -> DataFrame:
    """Raw trip records from the driver tables.

    ``spread`` round-robins lineitem over that many partitions before the joins. The test
    tables store lineitem as one row group (one input split, so one task); the bench uses
    this to occupy all local cores. It pins no key distribution, so the joins keep their
    planner-chosen (and skew-splittable) shuffles.
    """
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
    )
    if spread:
        li = li.repartition(spread)
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority"
    )
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")

    # Joins are left to the size-checked planner: broadcast below the threshold, else a
    # sort-merge join whose planner-inserted shuffles AQE can split when a key is hot.
    # (An explicit repartition on the order key would pin that distribution and disable
    # the skew split.)
    base = (
        li.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    )
    price = _dec("l_extendedprice", 12, 2)
    cols = [
        F.col("l_linenumber").cast("int").alias("VendorID"),
        F.col("o_orderdate").alias("tpep_pickup_datetime"),
        F.col("l_shipdate").alias("tpep_dropoff_datetime"),
        F.nullif(F.col("l_linenumber") % 5, F.lit(0)).cast("long").alias("passenger_count"),
        (F.col("l_quantity") * F.lit(12.0)).alias("trip_distance"),
        F.when(F.col("l_linenumber") == 7, F.lit(None))
        .otherwise(F.col("l_linenumber"))
        .cast("long")
        .alias("RatecodeID"),
        F.when(F.col("l_linestatus") == "O", F.lit("Y")).alias("store_and_fwd_flag"),
        F.when(F.col("l_tax") == 0, F.lit(None))
        .otherwise(F.col("s_nationkey") + 1)
        .cast("int")
        .alias("PULocationID"),
        (F.col("c_nationkey") + 1).cast("int").alias("DOLocationID"),
        F.substring("o_orderpriority", 1, 1).cast("long").alias("payment_type"),
        (price * (F.lit(1) - _dec("l_discount", 4, 2))).cast("decimal(10,2)").alias("fare_amount"),
        F.lit(0.50).cast("decimal(10,2)").alias("extra"),
        (price * _dec("l_tax", 4, 2)).cast("decimal(10,2)").alias("mta_tax"),
        (price * _dec("l_discount", 4, 2)).cast("decimal(10,2)").alias("tip_amount"),
        F.lit(0.00).cast("decimal(10,2)").alias("tolls_amount"),
        F.lit(1.00).cast("decimal(10,2)").alias("improvement_surcharge"),
        _dec("l_extendedprice", 10, 2).alias("total_amount"),
        F.when(F.col("l_returnflag") == "N", F.lit(None))
        .otherwise(F.lit(2.5))
        .cast("double")
        .alias("congestion_surcharge"),
        F.when(F.col("l_returnflag") == "R", F.lit(None))
        .otherwise(F.lit(1.75))
        .cast("double")
        .alias("Airport_fee"),
    ]
    trips = base.select(*cols)
    # Duplicate injection without a second scan/join: one row fans out to 1 or 2 copies.
    copies = F.when(F.col("total_amount") < 10000, F.lit(2)).otherwise(F.lit(1))
    trips = trips.withColumn("_copy", F.explode(F.sequence(F.lit(1), copies))).drop("_copy")
    if with_period:
        trips = trips.withColumns(
            {
                "year": F.year("tpep_pickup_datetime"),
                "month": F.month("tpep_pickup_datetime"),
            }
        )
    return trips


def raw_zone_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone lookup as the raw all-string CSV would deliver it (nation JOIN region)."""
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        (F.col("n_nationkey") + 1).cast("string").alias("LocationID"),
        F.col("r_name").alias("Borough"),
        F.col("n_name").alias("Zone"),
        F.when(F.col("n_nationkey") == 0, F.lit(None).cast("string"))
        .otherwise(F.col("r_name"))
        .alias("service_zone"),
    )


# ---------------------------------------------------------------------------------------
# The same adapter as SQL text (DuckDB dialect, views named after the driver tables).
# ---------------------------------------------------------------------------------------

RAW_TRIPS_SQL = """
raw_base AS (
    SELECT
        CAST(l.l_linenumber AS INTEGER) AS VendorID,
        o.o_orderdate AS tpep_pickup_datetime,
        l.l_shipdate AS tpep_dropoff_datetime,
        CAST(NULLIF(l.l_linenumber % 5, 0) AS BIGINT) AS passenger_count,
        l.l_quantity * CAST(12.0 AS DOUBLE) AS trip_distance,
        CAST(CASE WHEN l.l_linenumber = 7 THEN NULL ELSE l.l_linenumber END AS BIGINT) AS RatecodeID,
        CASE WHEN l.l_linestatus = 'O' THEN 'Y' END AS store_and_fwd_flag,
        CAST(CASE WHEN l.l_tax = 0 THEN NULL ELSE s.s_nationkey + 1 END AS INTEGER) AS PULocationID,
        CAST(c.c_nationkey + 1 AS INTEGER) AS DOLocationID,
        CAST(substr(o.o_orderpriority, 1, 1) AS BIGINT) AS payment_type,
        CAST(CAST(l.l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l.l_discount AS DECIMAL(4,2))) AS DECIMAL(10,2)) AS fare_amount,
        CAST(0.50 AS DECIMAL(10,2)) AS extra,
        CAST(CAST(l.l_extendedprice AS DECIMAL(12,2)) * CAST(l.l_tax AS DECIMAL(4,2)) AS DECIMAL(10,2)) AS mta_tax,
        CAST(CAST(l.l_extendedprice AS DECIMAL(12,2)) * CAST(l.l_discount AS DECIMAL(4,2)) AS DECIMAL(10,2)) AS tip_amount,
        CAST(0.00 AS DECIMAL(10,2)) AS tolls_amount,
        CAST(1.00 AS DECIMAL(10,2)) AS improvement_surcharge,
        CAST(l.l_extendedprice AS DECIMAL(10,2)) AS total_amount,
        CAST(CASE WHEN l.l_returnflag = 'N' THEN NULL ELSE 2.5 END AS DOUBLE) AS congestion_surcharge,
        CAST(CASE WHEN l.l_returnflag = 'R' THEN NULL ELSE 1.75 END AS DOUBLE) AS Airport_fee
    FROM lineitem l
    JOIN orders o ON l.l_orderkey = o.o_orderkey
    JOIN customer c ON o.o_custkey = c.c_custkey
    JOIN supplier s ON l.l_suppkey = s.s_suppkey
),
raw_copies AS (
    SELECT * FROM raw_base
    UNION ALL
    SELECT * FROM raw_base WHERE total_amount < 10000
),
raw_trips AS (
    SELECT *,
        CAST(year(tpep_pickup_datetime) AS INTEGER) AS year,
        CAST(month(tpep_pickup_datetime) AS INTEGER) AS month
    FROM raw_copies
)"""

RAW_ZONE_SQL = """
raw_zone AS (
    SELECT
        CAST(n.n_nationkey + 1 AS VARCHAR) AS LocationID,
        r.r_name AS Borough,
        n.n_name AS Zone,
        CASE WHEN n.n_nationkey = 0 THEN NULL ELSE r.r_name END AS service_zone
    FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
)"""
