"""Merkle manifest of a dataset by checkpoint and recompute.

Each row is a leaf; the leaves of a tree (one per source) stand in order, and ``ARITY``
consecutive nodes make one of the level above until one is left. The trees' roots, in order,
are the leaves of a last tree, whose root covers the dataset.

Only every ``DEPTH``-th level is kept, as rows of one aligned subtree's ``WIDTH`` nodes: a
level is a grouping by place, and a task climbs ``DEPTH`` levels within a row. Proofs go down
again from the root: a kept row meets the path of its own subtree's top, makes the interior
nodes between once more, hands each of its nodes the siblings on the way, and drops them. So
storage is that of the leaves and about 1/``WIDTH`` of it, and each kept level is one join of
rows, not of leaves.

Places come from a range sort and the counts of its partitions: no window over a hot source.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmart.llm.common import batches_of, stored, text_batches

#: Children of a node, levels between those that are kept, and the nodes of a kept row.
ARITY, DEPTH = 3, 5
WIDTH = ARITY**DEPTH


def leaf_hash(*fields: Column) -> Column:
    """The digest of some fields: each ``-`` if null, else its UTF-8 byte count, ``:`` and value."""
    texts = [f.cast("string") for f in fields]
    coded = [F.when(t.isNull(), "-").otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts]
    return F.sha2(F.concat(*coded), 256)


def _digest(parts: list[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _same(a: str, b: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b))


def placed(leaves: DataFrame, order: list[str], name: str) -> DataFrame:
    """``leaves`` with the ``place`` of each in its ``tree`` and that tree's ``total``."""
    by = [F.col(c).asc_nulls_first() for c in ("tree", *order)]
    ordered = leaves.repartitionByRange(*by).sortWithinPartitions(*by).withColumns(
        {"part": F.spark_partition_id(), "at": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))}
    )
    ordered = stored(ordered, f"{name}-ordered")
    # one row per tree and partition that holds some of it
    counts = ordered.groupBy(F.col("tree").alias("tree2"), F.col("part").alias("part2")).agg(
        F.min("at").alias("first"), F.count("*").alias("n")
    )
    tree = Window.partitionBy("tree2")
    before = F.coalesce(F.sum("n").over(tree.orderBy("part2").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = counts.withColumns({"before": before, "total": F.sum("n").over(tree)})
    met = ordered.join(counts, _same("tree", "tree2") & (F.col("part") == F.col("part2")))
    place = F.col("at") - F.col("first") + F.col("before")
    return met.select(*leaves.columns, place.alias("place"), "total")


def climb(digests: list[str], levels: int) -> list[list[str]]:
    """The levels above some digests, themselves first; it ends with ``levels`` of them made,
    or, where ``levels`` is negative, with one digest left."""
    made = [digests]
    while len(made) <= levels if levels >= 0 else len(made[-1]) > 1:
        now = made[-1]
        made.append([_digest(now[k : k + ARITY]) for k in range(0, len(now), ARITY)])
    return made


def siblings(made: list[list[str]], place: int) -> list[dict[str, str]]:
    """For each step up from a place, the digests of its run before it and after it."""
    path = []
    for now in made[:-1]:
        first = place - place % ARITY
        path.append({"left": "".join(now[first:place]), "right": "".join(now[place + 1 : first + ARITY])})
        place //= ARITY
    return path


def fold(digest: str, path: list[dict[str, str]]) -> str:
    """The root that a leaf's digest and its siblings make."""
    for step in path:
        digest = _digest([step["left"], digest, step["right"]])
    return digest


_NODES = "array<struct<place: long, digest: string, load: {load}>>"
_PATH_DDL = "array<struct<left: string, right: string>>"
_PATH = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))


def _rows_of(nodes: DataFrame, load: str, name: str) -> DataFrame:
    """A kept level: ``tree, row, total, nodes``, a row for each aligned subtree's nodes."""
    node = F.struct("place", "digest", "load")
    rows = nodes.groupBy("tree", F.expr(f"place div {WIDTH}").alias("row"), "total").agg(
        F.array_sort(F.collect_list(node)).cast(_NODES.format(load=load)).alias("nodes")
    )
    return stored(rows, name)


def _levels(total: int) -> int:
    """Levels that a kept row climbs: all of them where it is a whole tree."""
    return -1 if total <= WIDTH else DEPTH


def _tops(kept: DataFrame) -> DataFrame:
    """``tree, place, total, digest`` of the node above each kept row."""
    schema = pa.schema([("tree", pa.string()), ("place", pa.int64()), ("total", pa.int64()), ("digest", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True)
            yield from batches_of(
                ((tree, row, -(-total // WIDTH), climb(digests, _levels(total))[-1][0]) for tree, row, total, digests in rows),
                schema,
            )

    return kept.select("tree", "row", "total", F.col("nodes.digest")).mapInArrow(
        run, "tree string, place long, total long, digest string"
    )


def build(leaves: DataFrame, name: str) -> tuple[list[DataFrame], DataFrame]:
    """The kept levels of all trees, the leaves' first, and ``tree, digest`` of their roots.

    ``leaves``: ``tree, place, total, digest, load``, where ``load`` goes along with a leaf."""
    kept = [_rows_of(leaves, leaves.schema["load"].dataType.simpleString(), f"{name}-level-0")]
    largest = kept[0].agg(F.max("total")).first()[0] or 0
    roots = None
    while True:
        tops = stored(_tops(kept[-1]), f"{name}-tops")
        done = tops.where("total <= 1").select("tree", "digest")
        roots = done if roots is None else roots.unionByName(done)
        largest = -(-largest // WIDTH)
        if largest <= 1:
            return kept, roots
        above = tops.where("total > 1").withColumn("load", F.lit(None).cast("int"))
        kept.append(_rows_of(above, "int", f"{name}-level-{len(kept)}"))


def _met(kept: DataFrame, paths: DataFrame) -> DataFrame:
    """Kept rows with the path from their own top; ``paths``: ``tree, row, path``."""
    above = paths.select(F.col("tree").alias("tree2"), F.col("row").alias("row2"), "path")
    return kept.join(above, _same("tree", "tree2") & (F.col("row") == F.col("row2"))).select(
        "tree", "row", "total", "nodes", "path"
    )


def paths_down(kept: list[DataFrame], above: DataFrame, name: str) -> DataFrame:
    """The rows of leaves with the path from their own top to the root of everything: to make
    the paths of its leaves, a task needs no other row. ``above``: ``tree, path``, the path from
    each tree's root on."""
    schema = pa.schema([("tree", pa.string()), ("row", pa.int64()), ("path", _PATH)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from batches_of(_steps(batch), schema)

    whole = above.withColumn("row", F.lit(0).cast("long"))
    paths = whole
    for level in range(len(kept) - 1, 0, -1):
        met = _met(kept[level], paths).select("tree", "total", F.col("nodes.place"), F.col("nodes.digest"), "path")
        lower = met.mapInArrow(run, f"tree string, row long, path {_PATH_DDL}")
        # trees that end on the level below start there from their roots
        small = kept[level - 1].where(F.col("total") <= WIDTH).select("tree")
        ending = whole.select(F.col("tree").alias("tree2"), "row", "path").join(small, _same("tree2", "tree"))
        paths = stored(lower.unionByName(ending.select("tree", "row", "path")), f"{name}-paths-{level}")
    return _met(kept[0], paths)


def _steps(batch: pa.RecordBatch) -> Iterator[tuple]:
    """``tree, place, path`` of each node of the kept rows."""
    for tree, total, places, digests, path in zip(*(c.to_pylist() for c in batch.columns), strict=True):
        made = climb(digests, _levels(total))
        for k, place in enumerate(places):
            yield tree, place, siblings(made, k) + path


def merkle_manifest(
    docs: DataFrame, fields: list[str], tree: str = "source", order: str = "doc_id", claimed: dict[str, Column] | None = None
) -> DataFrame:
    """``tree, doc_id, leaf, subroot, root, path, folded_root`` for each row of ``docs``.

    A leaf is the digest of the row's ``fields`` and the leaves of a tree ascend by ``order``
    (a long, nulls first; rows equal in it by their digests, rows equal in all by chance, which changes nothing
    but which of the copies has which place). ``path`` lists for each level the digests left
    and right of the row's own, from the leaf through its tree's root to the root.
    ``claimed`` has other columns for some fields, as a receiver holds them: ``folded_root`` is
    recomputed from the digest of these and the path. Trees ascend by name, a null one first. An
    empty table has no rows and no root; other columns are never read, whatever their names.
    """
    text_batches(docs.sparkSession)
    claimed = claimed or {}
    leaves = docs.select(
        F.col(tree).cast("string").alias("tree"), F.col(order).cast("long").alias("doc_id"),
        leaf_hash(*(F.col(f) for f in fields)).alias("digest"),
        leaf_hash(*(claimed.get(f, F.col(f)) for f in fields)).alias("claim"),
    )
    leaves = placed(leaves, ["doc_id", "digest"], "merkle")
    leaves = leaves.select("tree", "place", "total", "digest", F.struct("doc_id", "claim").alias("load"))
    kept, roots = build(leaves, "merkle")
    tops = roots.select(F.lit("").alias("tree"), F.col("tree").alias("load"), "digest")
    top_kept, root = build(placed(tops, ["load"], "merkle-top"), "merkle-top")
    start = root.select("tree", F.expr(f"cast(array() as {_PATH_DDL})").alias("path"))
    trees = _paths_of(paths_down(top_kept, start, "merkle-top"))
    rows = paths_down(kept, trees, "merkle")
    return _proofs(rows)


def _paths_of(rows: DataFrame) -> DataFrame:
    """``tree, path`` of each leaf of the tree of trees."""
    schema = pa.schema([("tree", pa.string()), ("path", _PATH)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = [name for names in batch.column(5).to_pylist() for name in names]
            steps = _steps(batch.select([0, 1, 2, 3, 4]))
            yield from batches_of(((name, path) for name, (_, _, path) in zip(names, steps, strict=True)), schema)

    columns = ("tree", "total", "nodes.place", "nodes.digest", "path", "nodes.load")
    return rows.select(*(F.col(c) for c in columns)).mapInArrow(run, f"tree string, path {_PATH_DDL}")


_PROOF = pa.schema(
    [("tree", pa.string()), ("doc_id", pa.int64()), ("leaf", pa.string()), ("subroot", pa.string()), ("root", pa.string()),
     ("path", _PATH), ("folded_root", pa.string())]
)


def _proofs(rows: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from batches_of(_proved(batch), _PROOF, 1024)

    columns = ("tree", "total", "nodes.digest", "path", "nodes.load.doc_id", "nodes.load.claim")
    return rows.select(*(F.col(c) for c in columns)).mapInArrow(
        run, f"tree string, doc_id long, leaf string, subroot string, root string, path {_PATH_DDL}, folded_root string"
    )


def _height(total: int) -> int:
    """Levels of a tree of so many leaves above them."""
    levels = 0
    while total > 1:
        total, levels = -(-total // ARITY), levels + 1
    return levels


def _proved(batch: pa.RecordBatch) -> Iterator[tuple]:
    for tree, total, digests, above, ids, claims in zip(*(c.to_pylist() for c in batch.columns), strict=True):
        made = climb(digests, _levels(total))
        within = _height(total) - (len(made) - 1)  # steps of the path above that stay in the tree
        subroot = fold(made[-1][0], above[:within])
        root = fold(subroot, above[within:])
        for k, (doc_id, leaf, claim) in enumerate(zip(ids, digests, claims, strict=True)):
            path = siblings(made, k) + above
            yield tree, doc_id, leaf, subroot, root, path, fold(claim, path)
