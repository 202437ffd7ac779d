"""Incremental processing of newly landed monthly files with Structured Streaming.

The batch pipeline decides "what still needs work" from files on disk. Here the file
stream source does that bookkeeping: its checkpoint remembers which bronze files were
already processed, so each run (``availableNow`` trigger) picks up only new or re-landed
files and stops.

Every micro-batch is reduced to the set of periods it touches (at most one row per
landed file reaches the driver) and those periods are re-run with the idempotent
``backfill``: silver, report and fact partitions of exactly those months are replaced.
A micro-batch that fails half-way is replayed from the checkpoint and converges to the
same tables.

The file source recognises files by path: land a corrected month with the landing time in
its file names (see ``sources.raw``) and it is picked up and supersedes the earlier files of
that month. A file overwritten in place is not seen again; re-run that month with
``run_period`` instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tripmart.operators.load import read_written
from tripmart.plans.runs import Paths, backfill
from tripmart.schemas import FACT_SCHEMA
from tripmart.session import configure


def start_incremental(
    spark: SparkSession,
    paths: Paths,
    run_id: str,
    checkpoint: str,
    enforce_gate: bool = True,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Start a run over all not-yet-processed bronze files; returns the (finishing) query.

    ``checkpoint`` must be a durable shared location and stay the same across runs: it is
    what remembers the files that were processed.
    """
    configure(spark)
    # The stream only tells which months have new files; these two columns are partitions.
    schema = "year int, month int"
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(paths.bronze)

    def process(batch: DataFrame, epoch_id: int) -> None:
        periods = [
            (r.year, r.month)
            for r in batch.select("year", "month").distinct().collect()
            if r.year is not None and r.month is not None
        ]
        if periods:
            backfill(spark, paths, f"{run_id}-{epoch_id}", periods=periods,
                     enforce_gate=enforce_gate)

    return (
        stream.select("year", "month")
        .writeStream.foreachBatch(process)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def run_incremental(spark: SparkSession, paths: Paths, run_id: str, checkpoint: str,
                    enforce_gate: bool = True) -> None:
    """Process everything new and wait until done."""
    q = start_incremental(spark, paths, run_id, checkpoint, enforce_gate)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def processed_periods(spark: SparkSession, paths: Paths) -> DataFrame:
    """Periods present in the fact table (what the incremental runs have loaded)."""
    return read_written(spark, paths.gold_fact, FACT_SCHEMA).select(
        F.col("source_year").cast("int").alias("year"), F.col("source_month").cast("int").alias("month")
    ).distinct()
