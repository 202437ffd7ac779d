"""Deterministic de-duplication on a column subset.

``dropDuplicates(subset)`` keeps an arbitrary survivor. Here the survivor is the first row
in a total order (by default: all non-key columns ascending), so reruns give identical
output. The plan is an aggregate ``min(struct(order..., rest...))`` per key: Spark runs a
partial aggregate before the shuffle, so exact copies and hot keys are collapsed map-side
and no key's rows are ever collected into one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedupe(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str] | None = None,
    keep: str = "first",
) -> DataFrame:
    """One row per distinct ``keys`` tuple (NULL keys compare equal).

    ``order_by`` names the columns that rank duplicates (ascending; ``keep="last"`` takes
    the greatest). Remaining columns break ties, which makes the order total.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.select(*keys).distinct()
    order = [c for c in (order_by or []) if c in rest]
    ranked = order + [c for c in rest if c not in order]
    pick = F.min if keep == "first" else F.max
    survivor = pick(F.struct(*[F.col(c) for c in ranked])).alias("_survivor")
    out = df.groupBy(*keys).agg(survivor)
    return out.select(*[F.col(c) if c in keys else F.col(f"_survivor.{c}").alias(c) for c in df.columns])
