"""Tables whose periods are swapped by location.

A run writes the new rows of its periods into a folder of its own, and only when all of it is
there do the periods point to it: the swap log gets one record per period, in one file that
appears whole, and a registered catalog table gets its partitions' new locations (``ALTER TABLE
... PARTITION ... SET LOCATION``). So a reader sees a period's old rows or its new ones, also
while the write runs, after it failed, and when the period becomes empty (no location).

A table without partition columns is one such part: its readers go from version to version, and
a new version may be computed from the one it replaces.

One writer at a time per table, as with the partition overwrite.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tripmart.operators.dims import scd1_upsert
from tripmart.operators.load import MAX_RECORDS_PER_FILE, enforce_schema

LOG_SCHEMA = StructType([StructField(c, StringType()) for c in ("part", "folder", "swapped_at", "run_id")])


@dataclass(frozen=True)
class SwappedTable:
    """A table below ``root``: run folders in ``data``, the swap log in ``swaps``. ``name`` is
    its catalog table, where it has one."""

    root: str
    schema: StructType
    by: tuple[str, ...] = ("source_year", "source_month")
    name: str | None = None

    @property
    def data(self) -> str:
        return f"{self.root.rstrip('/')}/data"

    @property
    def log(self) -> str:
        return f"{self.root.rstrip('/')}/swaps"

    def part(self, values: Sequence[int]) -> str:
        """The name of a part, which is its folder's path within a run's: empty without
        partition columns."""
        if len(values) != len(self.by):
            raise ValueError(f"a part of {self.root} has values of {self.by}, not {tuple(values)}")
        return "/".join(f"{c}={int(v)}" for c, v in zip(self.by, values, strict=True))


def swap_log(spark: SparkSession, table: SwappedTable) -> DataFrame:
    """Every swap so far: ``part, folder`` (null: emptied), ``swapped_at, run_id``."""
    try:
        return spark.read.schema(LOG_SCHEMA).json(table.log)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LOG_SCHEMA)


def locations(spark: SparkSession, table: SwappedTable) -> DataFrame:
    """``part, folder`` as they are now; emptied parts aren't listed."""
    last = F.max(F.struct("swapped_at", "folder")).alias("last")
    return swap_log(spark, table).groupBy("part").agg(last).select("part", "last.folder").where("folder IS NOT NULL")


def read_swapped(spark: SparkSession, table: SwappedTable, parts: Sequence[Sequence[int]] | None = None) -> DataFrame:
    """The table's rows now, or those of some parts; none where nothing was loaded. One short
    row per part reaches the driver, and the files of other parts aren't listed."""
    now = locations(spark, table)
    if parts is not None:
        now = now.where(F.col("part").isin([table.part(p) for p in parts]))
    folders = sorted(r.folder for r in now.collect())
    if not folders:
        return spark.createDataFrame([], table.schema)
    read = spark.read.schema(table.schema).option("basePath", table.data).parquet(*folders)
    return read.select(*table.schema.fieldNames())


def swap(
    df: DataFrame, table: SwappedTable, parts: Sequence[Sequence[int]], run_id: str,
    cluster_by: Sequence[str] = (), rebalance: bool = False,
) -> dict[tuple[int, ...], int]:
    """Replace ``parts`` by the rows of ``df``; those that it has no rows of become empty. Returns
    the rows per part.

    Nothing points to the new rows before all are written: a write that fails, and rows of
    a part not named, leave the table as it is."""
    spark, by = df.sparkSession, list(table.by)
    wanted = {tuple(int(v) for v in p) for p in parts}
    names = {p: table.part(p) for p in wanted}
    folder = f"{table.data}/run={run_id}-{uuid.uuid4().hex[:12]}"
    out = enforce_schema(df, table.schema)
    if by and rebalance:
        out = out.hint("rebalance", *by)
    if cluster_by:
        out = out.sortWithinPartitions(*by, *cluster_by)
    writer = out.write.mode("errorifexists").option("maxRecordsPerFile", MAX_RECORDS_PER_FILE).option("compression", "snappy")
    (writer.partitionBy(*by) if by else writer).parquet(folder)
    # row counts come from what was written, and no column is read for them
    written = spark.read.schema(table.schema).parquet(folder)
    rows = {tuple(int(v) for v in r[:-1]): r[-1] for r in written.groupBy(*by).agg(F.count(F.lit(1))).collect()}
    if not by:
        rows = {(): rows.get((), 0)}
    stray = sorted(set(rows) - wanted)
    if stray:
        raise ValueError(f"rows of {stray} in a swap of {sorted(wanted)}")
    at = dt.datetime.now(dt.UTC).isoformat(timespec="microseconds")
    # a whole table keeps a folder when it becomes empty, a part doesn't
    places = {p: f"{folder}/{names[p]}".rstrip("/") if rows.get(p) or not by else None for p in sorted(wanted)}
    records = [(names[p], place, at, run_id) for p, place in places.items()]
    spark.createDataFrame(records, LOG_SCHEMA).coalesce(1).write.mode("append").json(table.log)
    if table.name:
        _point(spark, table, {names[p]: place for p, place in places.items()})
    return {p: rows.get(p, 0) for p in wanted}


def _partition(part: str) -> str:
    return ", ".join(part.split("/"))


def _point(spark: SparkSession, table: SwappedTable, places: dict[str, str | None]) -> None:
    """Lead the catalog table's parts to their folders; one statement makes the change of each."""
    for part, folder in places.items():
        if not table.by:
            spark.sql(f"ALTER TABLE {table.name} SET LOCATION '{folder}'")
        elif folder is None:
            spark.sql(f"ALTER TABLE {table.name} DROP IF EXISTS PARTITION ({_partition(part)})")
        elif spark.sql(f"SHOW PARTITIONS {table.name} PARTITION ({_partition(part)})").isEmpty():
            spark.sql(f"ALTER TABLE {table.name} ADD IF NOT EXISTS PARTITION ({_partition(part)}) LOCATION '{folder}'")
        else:
            spark.sql(f"ALTER TABLE {table.name} PARTITION ({_partition(part)}) SET LOCATION '{folder}'")
    spark.sql(f"REFRESH TABLE {table.name}")


def register_swapped(spark: SparkSession, table: SwappedTable) -> None:
    """Create the catalog table if it is absent and lead all its parts to where the swap log has
    them: also after a session whose catalog didn't last, or one that stopped between log and
    catalog. Idempotent."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table.schema.fields)
    by = f"PARTITIONED BY ({', '.join(table.by)}) " if table.by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table.name} ({columns}) USING parquet {by}LOCATION '{table.data}'")
    places: dict[str, str | None] = {r.part: r.folder for r in locations(spark, table).collect()}
    if table.by:
        for row in spark.sql(f"SHOW PARTITIONS {table.name}").collect():
            places.setdefault(row.partition, None)
    _point(spark, table, places)


def superseded(spark: SparkSession, table: SwappedTable) -> DataFrame:
    """``folder`` of the parts that a later swap has replaced: free to go once no reader that
    began before it is left. (Folders of failed runs are those in no record.)"""
    now = locations(spark, table).select("folder")
    return swap_log(spark, table).where("folder IS NOT NULL").select("folder").distinct().join(now, "folder", "left_anti")


def merge_scd1(spark: SparkSession, table: SwappedTable, incoming: DataFrame, key: str, run_id: str) -> DataFrame:
    """Type-1 maintenance of a stored dimension (a table without partition columns): incoming
    rows replace the stored rows of their keys, the rest stays. The new version is computed from
    the old one's files and takes its place when it is written; returns it.

    Loading the same rows again changes nothing, and a load that fails leaves the old version."""
    merged = scd1_upsert(read_swapped(spark, table), incoming, key)
    swap(merged, table, [()], run_id)
    return read_swapped(spark, table)
