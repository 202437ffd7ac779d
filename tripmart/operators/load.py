"""Sinks: idempotent partition replacement, bounded dimension tables, report files.

``replace_partitions`` is the warehouse's "delete period, then copy" by dynamic partition
overwrite: the new files are written aside and take the place of a period's directory when
the whole write has succeeded, so a task that fails leaves the old rows. Only the periods
present in the output are replaced; re-running a period yields the same data. A period that
is to become empty is emptied by name (``clear_period``), never by a write that had no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from tripmart.schemas import QUALITY_REPORT_SCHEMA

# Rows per output file; keeps files reasonably sized however skewed a period is.
MAX_RECORDS_PER_FILE = 5_000_000


def replace_partitions(
    df: DataFrame,
    path: str,
    by: Sequence[str] = ("source_year", "source_month"),
    cluster_by: Sequence[str] = (),
    rebalance: bool = True,
) -> None:
    """Overwrite only the partitions (``by`` values) present in ``df``.

    With ``rebalance`` (default) rows are rebalanced on the partition columns before the
    write: each period goes to few writer tasks (few, large files instead of tasks x periods
    small ones), and AQE splits an oversized period over several tasks, so a hot month never
    lands on a single writer. Pass ``rebalance=False`` when the input is already clustered
    by period (e.g. read from a table partitioned the same way): every input split then
    covers whole files of one or a few periods and the write needs no shuffle at all.
    ``cluster_by`` sorts rows inside each task's files (e.g. by pickup date key), so parquet
    min/max statistics prune row groups for range filters.
    """
    by, cluster_by = list(by), list(cluster_by)
    out = df.hint("rebalance", *by) if rebalance else df
    if cluster_by:
        out = out.sortWithinPartitions(*by, *cluster_by)
    (
        out.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
        .option("compression", "snappy")
        .partitionBy(*by)
        .parquet(path)
    )


def period_leaf(root: str, year: int, month: int,
                by: Sequence[str] = ("source_year", "source_month")) -> str:
    """Directory of one period in a table written with ``partitionBy(*by)``."""
    return f"{root.rstrip('/')}/{by[0]}={year}/{by[1]}={month}"


def clear_period(spark: SparkSession, schema: StructType, root: str, year: int, month: int,
                 by: Sequence[str] = ("source_year", "source_month")) -> None:
    """Empty one period of a partitioned table: the decision that it has no rows."""
    spark.createDataFrame([], schema).drop(*by).write.mode("overwrite").option(
        "partitionOverwriteMode", "static").parquet(period_leaf(root, year, month, by))


def replace_period(
    df: DataFrame,
    root: str,
    year: int,
    month: int,
    rows: int,
    by: Sequence[str] = ("source_year", "source_month"),
    cluster_by: Sequence[str] = (),
) -> None:
    """Replace exactly one period of a partitioned table by ``df``, which has ``rows`` rows of
    that period; none empties it. Other periods are never touched."""
    if rows:
        replace_partitions(df, root, by, cluster_by, rebalance=False)
    else:
        clear_period(df.sparkSession, df.schema, root, year, month, by)


def enforce_schema(df: DataFrame, schema: StructType) -> DataFrame:
    """Match a target table's column list and types by name (the explicit-column COPY).

    Fails before any data is written: a missing column raises here (``DataFrame.to`` alone
    would fill it with NULLs), an unconvertible type raises in ``to`` at analysis time;
    columns are reordered to the table's order.
    """
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"columns missing for the target table: {missing}")
    return df.to(schema)


def write_dimension(df: DataFrame, path: str, one_file: bool = True) -> None:
    """SCD0/SCD1 dimension: full overwrite, as one file where its size is bounded."""
    out = df.coalesce(1) if one_file else df
    out.write.mode("overwrite").option("compression", "snappy").parquet(path)


def write_quality_report(report: DataFrame, root: str) -> None:
    """Append the run's report rows (one per period) as one JSON file under ``root``.

    The folder is an append-only log of runs; readers take the latest report per period,
    which is the per-period replacement the gate needs, plus the history of earlier runs.
    A retried append only duplicates identical rows, which the latest-wins read absorbs.
    """
    report.coalesce(1).write.mode("append").json(root)


def read_quality_report(spark: SparkSession, root: str, year: int | None = None,
                        month: int | None = None, processed_at: str | None = None) -> DataFrame:
    """Latest report per period (by ``processed_at_utc``), optionally of one period or of the
    run that was processed at a time."""
    df = spark.read.schema(QUALITY_REPORT_SCHEMA).json(root)
    if processed_at is not None:
        df = df.filter(F.col("processed_at_utc") == F.lit(processed_at))
    if year is not None:
        df = df.filter(F.col("year") == year)
    if month is not None:
        df = df.filter(F.col("month") == month)
    cols = QUALITY_REPORT_SCHEMA.fieldNames()
    rest = [c for c in cols if c not in ("year", "month", "processed_at_utc")]
    latest = df.groupBy("year", "month").agg(
        F.max(F.struct("processed_at_utc", *rest)).alias("_r")
    )
    return latest.select(*[F.col(c) if c in ("year", "month") else F.col(f"_r.{c}") for c in cols])


def read_written(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A table's folder by its schema; no rows where nothing was ever written (a first run
    that loads no period is a normal outcome, and its readers see an empty table)."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def partition_counts(spark: SparkSession, path: str,
                     by: Sequence[str] = ("source_year", "source_month")) -> DataFrame:
    """Rows per partition of a written table (reads no data columns); none for a table that
    was never written."""
    keys = StructType([StructField(c, IntegerType()) for c in by])
    return read_written(spark, path, keys).groupBy(*by).agg(F.count(F.lit(1)).alias("rows"))
