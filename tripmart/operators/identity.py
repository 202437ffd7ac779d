"""Dense bigint identities of a fact's business keys, kept in a key table.

New keys get the numbers after the greatest one given so far, in key order; keys that the table
has keep theirs, whatever a rerun loads. Numbers come from per-partition counts plus offsets of a
range-sorted table: no global sort in one task, and no gaps.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.operators.swap import SwappedTable, locations, read_swapped, swap
from tripmart.session import scratch_dir

KEY_SCHEMA = T.StructType(
    [
        T.StructField("trip_key", T.StringType()),
        T.StructField("trip_identity", T.LongType()),
        T.StructField("source_year", T.ShortType()),
        T.StructField("source_month", T.ShortType()),
        T.StructField("batch", T.IntegerType()),
    ]
)


def key_table(root: str, name: str | None = None) -> SwappedTable:
    """A key table: a part per month and batch, so a month's load reads that month's keys only."""
    return SwappedTable(root, KEY_SCHEMA, ("source_year", "source_month", "batch"), name)


def numbered(rows: DataFrame, order: Sequence[str], after: int, out: str) -> DataFrame:
    """``rows`` with ``out``: ``after + 1`` and so on in ``order``, without gaps.

    The sorted rows are written once, with their partition and place; offsets are sums over one
    row per partition."""
    spark = rows.sparkSession
    by = [F.col(c).asc_nulls_first() for c in order]
    path = scratch_dir(spark, "numbered")
    rows.repartitionByRange(*by).sortWithinPartitions(*by).withColumns(
        {"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))}
    ).write.parquet(path)
    written = spark.read.parquet(path)
    counts = written.groupBy(F.col("_part").alias("_p")).agg(F.count(F.lit(1)).alias("_n"))
    # this window runs on one row per partition
    before = F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("_p", F.coalesce(before, F.lit(0)).alias("_before"))
    met = written.join(offsets, F.col("_part") == F.col("_p"))
    return met.select(*rows.columns, (F.lit(after + 1) + F.col("_before") + F.col("_at")).cast("long").alias(out))


def assign_identities(
    spark: SparkSession, fact: DataFrame, keys: SwappedTable, periods: Sequence[tuple[int, int]], run_id: str
) -> DataFrame:
    """Give each new ``trip_key`` of ``fact`` (rows of ``periods``) a number and store it; returns
    the fact with ``trip_identity``. A key belongs to one month, so only these months' keys are read.

    The batch is swapped in when its numbers are complete: a load that fails gives none."""
    parts = [r.part for r in locations(spark, keys).select("part").collect()]
    taken = [tuple(int(x.split("=")[1]) for x in p.split("/")) for p in parts]
    wanted = {(int(y), int(m)) for y, m in periods}
    own = [t for t in taken if t[:2] in wanted]
    batch = 1 + max((t[2] for t in taken), default=0)
    last = read_swapped(spark, keys).agg(F.max("trip_identity")).first()[0] if taken else None
    known = read_swapped(spark, keys, own).select("trip_key")
    seen = fact.select("trip_key", "source_year", "source_month").dropDuplicates(["trip_key"])
    fresh = numbered(seen.join(known, "trip_key", "left_anti"), ["trip_key"], last or 0, "trip_identity")
    swap(fresh.withColumn("batch", F.lit(batch)), keys, [(y, m, batch) for y, m in sorted(wanted)], run_id)
    own += [(y, m, batch) for y, m in sorted(wanted)]
    numbers = read_swapped(spark, keys, own).select("trip_key", "trip_identity")
    return fact.join(numbers, "trip_key")
