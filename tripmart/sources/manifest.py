"""Landing audit and period bookkeeping.

* ``file_manifest``  - one row per landed file: path, size, sha-256, period, status.
* ``completed_periods`` - months whose stored manifest and loaded data both say done.
* ``period_spine``   - every calendar month between two bounds (or spanned by data).
* ``pending_periods`` - requested months that have source data but are not done yet.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.operators.load import read_written
from tripmart.schemas import DATASET_NAME, MANIFEST_SCHEMA
from tripmart.session import importable, scratch_dir

_YEAR_RE = r"year=(\d{4})"
_MONTH_RE = r"month=(\d{1,2})"


#: Bytes of a file that are read at once.
CHUNK_BYTES = 1 << 20


def _checksums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """SHA-256 of each row's file, read in chunks: any size, in little memory."""
    from pyarrow import fs

    for batch in batches:
        sums = []
        for uri in batch["path"]:
            store, path = fs.FileSystem.from_uri(uri)
            digest = hashlib.sha256()
            with store.open_input_stream(path) as file:
                while chunk := file.read(CHUNK_BYTES):
                    digest.update(chunk)
            sums.append(digest.hexdigest())
        yield batch.assign(sha256_checksum=sums)


def file_manifest(
    spark: SparkSession, root: str, glob: str = "*.parquet", dataset: str = DATASET_NAME
) -> DataFrame:
    """One row per landed file with its checksum, in ``MANIFEST_SCHEMA``. Files are listed
    without their contents and hashed by the tasks."""
    return _audited(_listing(spark, root, glob), dataset)


def _listing(spark: SparkSession, root: str, glob: str) -> DataFrame:
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true")
        .load(root)
        .select("path", "length", "modificationTime")
    )


def _audited(files: DataFrame, dataset: str) -> DataFrame:
    importable(files.sparkSession)
    hashed = files.mapInPandas(_checksums, "path string, length long, modificationTime timestamp, sha256_checksum string")
    return hashed.select(
        F.lit(dataset).alias("dataset"),
        F.regexp_extract("path", _YEAR_RE, 1).cast("int").alias("year"),
        F.regexp_extract("path", _MONTH_RE, 1).cast("int").alias("month"),
        F.col("path").alias("source_path"),
        F.col("length").alias("file_size_bytes"),
        "sha256_checksum",
        F.col("modificationTime").alias("modified_at"),
        F.lit("SUCCESS").alias("status"),
    )


def new_files(
    spark: SparkSession, root: str, stored: DataFrame, glob: str = "*.parquet", dataset: str = DATASET_NAME
) -> DataFrame:
    """Manifest rows of the files that a stored manifest doesn't have as they are: another path,
    size or time. Only these are opened and hashed."""
    known = stored.select(
        F.col("source_path").alias("path"), F.col("file_size_bytes").alias("length"), F.col("modified_at").alias("modificationTime")
    )
    return _audited(_listing(spark, root, glob).join(known, known.columns, "left_anti"), dataset)


def update_manifest(
    spark: SparkSession, root: str, manifest_root: str, glob: str = "*.parquet", dataset: str = DATASET_NAME
) -> DataFrame:
    """Bring the stored manifest up to date with the landed files; returns the rows of the
    files that were hashed for it.

    The months of new, changed or vanished files are written anew, with the stored rows of
    their other files; the rest stays as it is. A second run without landings hashes nothing."""
    stored = read_manifest(spark, manifest_root)
    # fixed in a file of its own: the months to write are read from it twice
    path = scratch_dir(spark, "new-files")
    new_files(spark, root, stored, glob, dataset).write.parquet(path)
    fresh = spark.read.schema(MANIFEST_SCHEMA).parquet(path)
    there = _listing(spark, root, glob).select(
        F.col("path").alias("source_path"), F.col("length").alias("file_size_bytes"), F.col("modificationTime").alias("modified_at"))
    kept = stored.join(there, there.columns, "left_semi")
    gone = stored.join(there, there.columns, "left_anti")
    months = fresh.select("year", "month").unionByName(gone.select("year", "month")).distinct()
    rows = fresh.unionByName(kept.select(*fresh.columns).join(months, ["year", "month"], "left_semi").select(*fresh.columns))
    write_manifest(rows, manifest_root)
    return fresh


def write_manifest(manifest: DataFrame, root: str) -> None:
    """Store a manifest by period; the periods in it replace their earlier rows."""
    manifest.select([F.col(f.name).cast(f.dataType) for f in MANIFEST_SCHEMA]).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy("year", "month").parquet(root)


def read_manifest(spark: SparkSession, root: str) -> DataFrame:
    """The stored manifest; no rows where none was stored yet."""
    return read_written(spark, root, MANIFEST_SCHEMA)


def completed_periods(manifest: DataFrame, loaded: DataFrame, keys=("year", "month")) -> DataFrame:
    """Periods that are done: all their landed files were taken in well, and the loaded table
    has rows of them."""
    keys = list(keys)
    good = manifest.groupBy(*keys).agg(F.bool_and(F.coalesce(F.col("status") == "SUCCESS", F.lit(False))).alias("_ok"))
    return good.filter("_ok").select(*keys).join(loaded.select(*keys).distinct(), keys, "left_semi")


def period_spine(spark: SparkSession, start: str, end: str) -> DataFrame:
    """Months from ``start`` to ``end`` inclusive (ISO dates, day ignored)."""
    return _spine(
        spark.range(1).select(
            F.trunc(F.to_date(F.lit(start)), "month").alias("lo"),
            F.trunc(F.to_date(F.lit(end)), "month").alias("hi"),
        )
    )


def period_spine_of(df: DataFrame, ts_col: str) -> DataFrame:
    """Months spanned by ``ts_col`` in ``df`` (one global min/max aggregate, then expand)."""
    bounds = df.agg(
        F.trunc(F.to_date(F.min(ts_col)), "month").alias("lo"),
        F.trunc(F.to_date(F.max(ts_col)), "month").alias("hi"),
    )
    return _spine(bounds)


def _spine(bounds: DataFrame) -> DataFrame:
    months = bounds.select(
        F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 MONTH"))).alias("period_start")
    )
    return months.select(
        F.year("period_start").alias("year"),
        F.month("period_start").alias("month"),
        "period_start",
    )


def pending_periods(
    requested: DataFrame, available: DataFrame, done: DataFrame, keys=("year", "month")
) -> DataFrame:
    """Requested months with source data (semi join) and no completed run (anti join)."""
    keys = list(keys)
    return requested.join(available.select(*keys).distinct(), keys, "left_semi").join(
        done.select(*keys), keys, "left_anti"
    )
