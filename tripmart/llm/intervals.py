"""Stitching of half-open integer intervals by window functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def stitched(rows: DataFrame, by: list[str], first: str, past: str, *more: Column) -> DataFrame:
    """``by, first, past`` of the unions of overlapping or touching intervals of each ``by``
    group, with the aggregates ``more`` over the pieces of each.

    A group is one sorted stream: the furthest end so far decides where a union begins."""
    order = Window.partitionBy(*by).orderBy(first, past)
    reach = F.max(past).over(order.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.coalesce(F.col(first) > reach, F.lit(True))
    marked = rows.withColumn("__begins", begins.cast("int")).withColumn(
        "__part", F.sum("__begins").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    )
    found = marked.groupBy(*by, "__part").agg(F.min(first).alias(first), F.max(past).alias(past), *more)
    return found.drop("__part")
