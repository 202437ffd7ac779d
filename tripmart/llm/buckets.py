"""Links between the members of candidate buckets, without all pairs of a dense bucket.

A bucket of two members is one pair. In larger ones every member is first verified against
the smallest and the largest, from four members on also against a few other leaders, and the
links found are united. A bucket whose members are
then all of one component is done; the others may get new leaders, and only what is still
apart is joined across components. So each pair that shares a bucket is verified or known to
be connected, and a dense group costs a few rows a member.

Joins of the members are held to sorting. Spark takes an exploded frame for as small as the
table that it came from, and a scratch table for the size of its compressed files, so that it
would send tables of many times the broadcast threshold through the driver.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import release, stored
from tripmart.llm.components import connected_components

#: Leaders of a bucket beside its smallest and largest member, unless given.
LEADERS = 6


def _mask(k: int) -> int:
    """The k-th of a row of fixed 64-bit patterns, signed."""
    x = (k + 1) * 0x9E3779B97F4A7C15 % (1 << 64)
    x = (x ^ (x >> 31)) * 0xBF58476D1CE4E5B9 % (1 << 64)
    return x - (1 << 64) if x >> 63 else x


def _leader_pairs(rows: DataFrame, n: int, first_mask: int, near: Callable[[str, str], Column]) -> DataFrame:
    """Pairs of the members ``key, id`` with leaders of their bucket: those nearest to some
    patterns (an exclusive or orders the ids anew, and is undone)."""
    masks = [_mask(first_mask + k) for k in range(n)]
    nearest = [F.min(F.col("id").bitwiseXOR(F.lit(m))).bitwiseXOR(F.lit(m)) for m in masks]
    leaders = rows.groupBy("key").agg(F.array_distinct(F.array(*nearest)).alias("leaders"))
    met = rows.join(leaders.hint("merge"), "key").select("id", F.explode("leaders").alias("leader"))
    return _pairs(met, "id", "leader", near)


def _pairs(rows: DataFrame, a: str, b: str, near: Callable[[str, str], Column]) -> DataFrame:
    pair = rows.where(F.col(a) != F.col(b)).select(F.least(a, b).alias("src"), F.greatest(a, b).alias("dst"))
    return pair.where(near("src", "dst"))


def united(
    members: DataFrame | list[DataFrame], verified: Callable[[DataFrame], DataFrame], near: Callable[[str, str], Column], name: str,
    ends: tuple[str, ...] = ("low", "high"), leaders: int = LEADERS, rounds: int = 0,
    across: Callable[[DataFrame], DataFrame] | None = None, marked: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """``node, component`` of all ids that link to another one.

    ``members``: distinct rows ``key, id`` (a long), cheap to compute twice; or several such
    frames without common keys, which are counted one after the other, each shuffle's files
    gone before the next. ``verified``
    keeps the rows of ``src, dst`` that link; ``near`` is a condition on two id columns that
    no linked pair fails, applied within the join across components. Members meet the ``ends``
    of their bucket (smallest, largest) and that many ``leaders`` first; ``rounds`` of new
    leaders come before that join at most. ``across`` gives the links across components of
    rows ``key, id, component`` in place of that join. ``marked``, of members that have a long
    ``mark`` too, is a condition on the exclusive or of two marks that no linked pair fails: buckets
    of two that fail it are dropped when they are counted.
    """
    tables = []
    for part in members if isinstance(members, list) else [members]:
        counted = part.groupBy("key").agg(
            F.min("id").alias("low"), F.max("id").alias("high"), F.count("*").alias("n"),
            *([F.bit_xor("mark").alias("marks")] if marked else []),
        )
        met = counted.where((F.col("n") > 2) | ((F.col("n") == 2) & marked(F.col("marks"))) if marked else F.col("n") > 1)
        own = stored(met.select("key", "low", "high", "n"), f"{name}-shared")
        large = part.select("key", "id").hint("merge").join(own.where("n > 2"), "key")
        tables.append((own, stored(large, f"{name}-large")))
    shared, large = (reduce(DataFrame.unionByName, some) for some in zip(*tables, strict=True))
    # two ends leave no pair of a bucket of three unmet
    dense = large.where("n > 3" if len(ends) > 1 else "n > 2").select("key", "id")
    pairs = _pairs(shared.where("n = 2"), "low", "high", near)
    for end in ends:
        pairs = pairs.unionByName(_pairs(large, "id", end, near))
    if leaders:
        pairs = pairs.unionByName(_leader_pairs(dense, leaders, 0, near))
    links = stored(verified(pairs.distinct()), f"{name}-links")
    release(*(own for own, _ in tables))
    groups = connected_components(links, f"{name}-groups")
    large, done = dense, [rows for _, rows in tables]
    for k in range(rounds + 1):
        large = _apart(large, groups, f"{name}-apart")
        release(*done)
        done = [large]
        if large.isEmpty():
            break
        if k < rounds:
            again = _leader_pairs(large.select("key", "id"), leaders, (k + 1) * leaders, near)
            found = verified(_between(again.distinct(), groups))
        else:
            found = across(large) if across else verified(_across(large, near))
        found = stored(found, f"{name}-more")
        if not found.isEmpty():
            links = links.unionByName(found)
            groups = connected_components(links, f"{name}-groups")
    release(*done)
    return groups


def _across(large: DataFrame, near: Callable[[str, str], Column]) -> DataFrame:
    """Pairs of a bucket's members of different components that ``near`` doesn't rule out."""
    other = large.select(F.col("key").alias("key2"), F.col("id").alias("id2"), F.col("component").alias("component2"))
    met = large.hint("merge").join(
        other, (F.col("key") == F.col("key2")) & (F.col("component") < F.col("component2")) & near("id", "id2")
    )
    return met.select(F.col("id").alias("src"), F.col("id2").alias("dst")).distinct()


def _apart(large: DataFrame, groups: DataFrame, name: str) -> DataFrame:
    """Rows ``key, id, component`` of the buckets whose members are of several components."""
    rows = large.select("key", "id").join(groups.hint("merge"), F.col("id") == F.col("node"), "left")
    rows = stored(rows.select("key", "id", F.coalesce("component", "id").alias("component")), name)
    spread = rows.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    several = spread.where("low <> high").select("key").hint("merge")
    apart = stored(rows.join(several, "key", "left_semi"), name)
    release(rows)
    return apart


def _between(pairs: DataFrame, groups: DataFrame) -> DataFrame:
    """The pairs whose ends aren't in one component."""
    for end in ("src", "dst"):
        side = groups.select(F.col("node").alias(f"{end}_node"), F.col("component").alias(f"{end}_group"))
        pairs = pairs.join(side.hint("merge"), F.col(end) == F.col(f"{end}_node"), "left")
    apart = F.coalesce("src_group", "src") != F.coalesce("dst_group", "dst")
    return pairs.where(apart).select("src", "dst")
