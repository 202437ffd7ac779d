"""Scratch tables, batch sizes and row tokens shared by the operators."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm.files import opened
from tripmart.session import importable, scratch_dir

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Rows per Arrow batch where rows carry whole texts: bounds a Python worker's memory.
TEXT_BATCH_ROWS = 128


def text_batches(spark: SparkSession, rows: int = TEXT_BATCH_ROWS) -> None:
    """Get the session ready for tasks on whole texts: workers can import the package, and
    Arrow batches have ``rows`` rows at most (a smaller setting stays).

    The setting is read when a plan runs, so it has to stay in the session."""
    importable(spark)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key))
    if now <= 0 or now > rows:
        spark.conf.set(key, str(rows))


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet below ``spark.checkpoint.dir`` and read again.

    It cuts the lineage and fixes the rows, and the files outlive executors."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    schema = df.schema
    # what was shuffled to make the table isn't read again once it is written
    cleanup = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path, compression="zstd")
    finally:
        spark.conf.set(_CLEANUP, cleanup)
    table = spark.read.schema(schema).parquet(path)
    table.scratch_path = path
    return table


def release(*tables: DataFrame) -> None:
    """Delete what ``stored`` wrote for these, once no frame still to be computed reads it."""
    for table in tables:
        store, path = opened(table.scratch_path)
        store.delete_dir(path)


def text_or_empty(column: str = "text") -> Column:
    """A text column in which null counts as the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def strings(column: pa.Array | pa.ChunkedArray) -> list[str]:
    """A string column as Python strings, null as the empty one."""
    return ["" if x is None else x for x in column.to_pylist()]


def batches_of(rows: Iterator[tuple], schema: pa.Schema, size: int = 4096) -> Iterator[pa.RecordBatch]:
    """Record batches of at most ``size`` rows from tuples in the schema's order."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield batch_of(held, schema)
            held = []
    if held:
        yield batch_of(held, schema)


def batch_of(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else ([] for _ in schema)
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )
