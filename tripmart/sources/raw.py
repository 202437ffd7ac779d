"""Bronze/silver readers and the partition path layout.

Raw monthly files land as ``<root>/year=YYYY/month=MM/<dataset>_YYYY-MM.parquet``. Months may
differ in their columns and types: files of one schema are read together, with the root as
base path, so ``year``/``month`` stay partition columns and many months make one job.

A corrected month lands beside the first one, with its landing time in the file names
(``<dataset>_YYYY-MM.20240305T101500.parquet``, or such a part before Spark's own file
names); the files of a month's latest landing supersede the others.
"""

from __future__ import annotations

from collections import defaultdict

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripmart.schemas import DATASET_NAME, RAW_ZONE_SCHEMA
from tripmart.sources.footers import file_schemas, schema_groups


def period_dir(root: str, year: int, month: int) -> str:
    return f"{root.rstrip('/')}/year={year:04d}/month={month:02d}"


def trip_file_name(year: int, month: int, dataset: str = DATASET_NAME) -> str:
    return f"{dataset}_{year:04d}-{month:02d}.parquet"


def trip_file_name_col(year: Column, month: Column, dataset: str = DATASET_NAME) -> Column:
    """Column form of :func:`trip_file_name` for per-row lineage."""
    return F.format_string(f"{dataset}_%04d-%02d.parquet", year, month)


def read_raw_trips(
    spark: SparkSession,
    root: str,
    year: int | None = None,
    month: int | None = None,
) -> DataFrame:
    """Scan the raw trip table, or its months of ``year`` and ``month``, as one frame.

    For months whose columns all have one type each; others can't be one raw frame (take
    :func:`read_raw_groups` and conform each). A column that some month lacks is NULL there.
    """
    files = landed_files(spark, root, year, month)
    paths = [p for some in files.values() for p in some]
    return spark.read.option("basePath", root).option("mergeSchema", "true").parquet(*paths)


def landed(spark: SparkSession, root: str, year: int | None = None, month: int | None = None) -> DataFrame | None:
    """``year, month, path`` of the files of each month's latest landing, without their
    contents; None for a root where no month ever landed."""
    try:
        listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(root)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
    if not {"year", "month"} <= set(listed.columns):  # a root without any month
        return None
    if year is not None:
        listed = listed.filter(F.col("year") == F.lit(year))
    if month is not None:
        listed = listed.filter(F.col("month") == F.lit(month))
    # landing time in a file's name; empty for a first landing without one
    landing = F.regexp_extract(F.element_at(F.split("path", "/"), -1), r"(\d{8}T\d{6})", 1)
    files = listed.where("year IS NOT NULL AND month IS NOT NULL").select(
        F.col("year").cast("int").alias("year"), F.col("month").cast("int").alias("month"), "path", landing.alias("_landing")
    )
    latest = F.max("_landing").over(Window.partitionBy("year", "month"))
    return files.withColumn("_latest", latest).where("_landing = _latest").select("year", "month", "path")


def landed_files(
    spark: SparkSession, root: str, year: int | None = None, month: int | None = None
) -> dict[tuple[int, int], list[str]]:
    """Files of each month's latest landing; no entry for a month that never landed.

    A listing without contents: one short row per file reaches the driver, which holds the
    listing of every scan anyway."""
    files = landed(spark, root, year, month)
    found: dict[tuple[int, int], list[str]] = defaultdict(list)
    for r in files.collect() if files is not None else ():
        found[r.year, r.month].append(r.path)
    return {k: sorted(found[k]) for k in sorted(found)}


def read_raw_groups(
    spark: SparkSession, root: str, periods: list[tuple[int, int]] | None = None
) -> list[DataFrame]:
    """The raw months, or those of ``periods``, as one frame per group of file schemas.

    Usually that is a single frame, in which a column that some month lacks is NULL there.
    Where a column changed its type, its months make frames of their own. No column is lost.
    The tasks read the footers (``sources.footers``); the driver opens no file."""
    if periods is not None and len(set(periods)) == 1:
        files = landed(spark, root, *periods[0])
    else:
        files = landed(spark, root)
    if files is None:
        return []
    if periods is not None:
        codes = sorted({y * 100 + m for y, m in periods})
        files = files.where((F.col("year") * 100 + F.col("month")).isin(codes) if codes else F.lit(False))
    reader = spark.read.option("basePath", root)
    return [reader.schema(g.schema).parquet(*g.paths) for g in schema_groups(file_schemas(files))]


def read_period_leaf(spark: SparkSession, root: str, year: int, month: int) -> DataFrame:
    """Read one partition leaf but keep ``year``/``month`` columns (``basePath``).

    Accepts both the zero-padded landing layout (``month=02``) and the layout Spark's
    ``partitionBy`` writes (``month=2``).
    """
    leaf = f"{root.rstrip('/')}/year={year:04d}/month={{{month:02d},{month}}}"
    return spark.read.option("basePath", root).parquet(leaf)


def read_zone_lookup_csv(spark: SparkSession, path: str) -> DataFrame:
    """Zone lookup CSV with header; every column read as string (no inference pass)."""
    return (
        spark.read.schema(RAW_ZONE_SCHEMA)
        .option("header", "true")
        .option("mode", "PERMISSIVE")
        .csv(path)
    )


def write_zone_lookup_csv(df: DataFrame, path: str) -> None:
    """Bounded reference table: a single CSV file with header."""
    df.coalesce(1).write.mode("overwrite").option("header", "true").csv(path)


def write_bronze(df: DataFrame, root: str) -> None:
    """Land raw records partitioned by ``year``/``month`` (one directory per period).

    The rebalance hint groups each period into few writer tasks (few files per period)
    while AQE splits an oversized period over several tasks.
    """
    (
        df.hint("rebalance", "year", "month")
        .write.mode("overwrite")
        .partitionBy("year", "month")
        .option("compression", "snappy")
        .parquet(root)
    )
