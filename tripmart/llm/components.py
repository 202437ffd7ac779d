"""Distributed union-find: connected components of a link table.

Alternating star steps. The large-star step hangs every larger neighbour of a node on the
smallest node of its neighbourhood; the small-star step does so for the smaller neighbours
and the node itself. Repeated, both turn each component into one star round its smallest
node. Both steps are a grouped minimum (combined before the shuffle) and an equality join
(split by adaptive execution where a key is hot); no neighbour list is ever gathered in one
place. Each round is a written table, so lost executors cost one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import release, stored


def _stars(edges: DataFrame) -> DataFrame:
    """Both steps on links from larger to smaller nodes. Repeats between them do no harm."""
    ends = edges.unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    low = ends.groupBy(F.col("src").alias("node")).agg(F.min("dst").alias("low"))
    # sorted, as scratch tables of ids are far larger than their compressed files tell Spark
    hung = edges.join(low.hint("merge"), F.col("dst") == F.col("node")).select("src", F.least("dst", "low").alias("dst"))
    least = hung.groupBy(F.col("src").alias("node")).agg(F.min("dst").alias("low"))
    near = hung.join(least.hint("merge"), F.col("src") == F.col("node")).where("dst <> low")
    return near.select(F.col("dst").alias("src"), F.col("low").alias("dst")).unionByName(
        least.select(F.col("node").alias("src"), F.col("low").alias("dst"))
    )


def _mark(edges: DataFrame) -> tuple:
    """Row count and an order-free sum of row hashes: equal when a round changed nothing."""
    h = F.xxhash64("src", "dst")
    row = edges.agg(F.count(F.lit(1)), F.sum(F.shiftright(h, 32)), F.sum(h.bitwiseAND(0xFFFFFFFF))).first()
    return tuple(row)


def connected_components(links: DataFrame, name: str = "components") -> DataFrame:
    """Component of every linked node.

    ``links`` has two columns of one orderable type, ``src`` and ``dst``; direction,
    repeats, self links and order don't matter; null ends aren't allowed. Returns
    ``node, component`` (the smallest node reachable) for each node that has a link to
    another one; a node without links is its own component and isn't listed.
    """
    down = links.select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst"))
    edges = stored(down.where("src <> dst").distinct(), name)
    before = _mark(edges)
    while before[0]:
        edges, last = stored(_stars(edges).distinct(), name), edges
        release(last)
        now = _mark(edges)
        if now == before:
            break
        before = now
    centres = edges.select("dst").distinct().select(F.col("dst").alias("src"), "dst")
    return edges.unionByName(centres).select(F.col("src").alias("node"), F.col("dst").alias("component"))
