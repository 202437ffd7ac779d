"""Embedding near-duplicates by int8 tile products with exact error bounds.

Equal vectors of a label collapse to one class first. A class's unit vector x is quantised
to s*q with int8 q, and its residual r = |x - s*q| and length a = |s*q| are kept. For two of
them |<x,y> - s s' <q,q'>| <= a r' + r a' + r r', so a tile product of the int8 vectors
names all pairs that may reach the threshold; only those are recomputed in double precision
from the given components. Tiles are pairs of blocks of one label; a label has as many
blocks as its size asks for, so a hot label is many tiles. A tile sends no pairs: for each
class the weight of its links, and a spanning forest of the links, which the distributed
union-find joins to components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.llm.common import stored
from tripmart.llm.components import connected_components
from tripmart.session import importable

#: Classes of a block, and pairs recomputed at once.
BLOCK, PAIRS = 1024, 1 << 15
#: Room for the rounding of the bound's own arithmetic.
SLACK = 1e-7


def quantised(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 rows q, scales s, residuals |x - s*q| and lengths |s*q| of unit rows x."""
    s = np.abs(x).max(axis=1) / 127
    q = np.rint(x / s[:, None]).astype(np.int8)
    back = q * s[:, None]
    return q, s, np.linalg.norm(x - back, axis=1), np.linalg.norm(back, axis=1)


def may_reach(a: tuple, b: tuple, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of two quantised blocks whose cosine may be ``threshold`` or more."""
    (q, s, r, n), (q2, s2, r2, n2) = a, b
    # products of int8 vectors are whole numbers, exact in float32 below 2**24
    kind = np.float32 if q.shape[1] * 127**2 < 1 << 24 else np.float64
    product = (q.astype(kind) @ q2.astype(kind).T).astype(np.float64)
    product *= s[:, None] * s2
    product += n[:, None] * r2 + r[:, None] * (n2 + r2)
    return np.nonzero(product >= threshold - SLACK)


def cosines(x: np.ndarray, y: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Cosines in double precision of the given pairs of rows."""
    nx, ny = np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1)
    out = np.empty(len(i))
    for k in range(0, len(i), PAIRS):
        a, b = i[k : k + PAIRS], j[k : k + PAIRS]
        out[k : k + PAIRS] = np.einsum("ij,ij->i", x[a], y[b]) / (nx[a] * ny[b])
    return out


def roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each of n over the links (i, j)."""
    label = np.arange(n)
    while True:
        low = label.copy()
        np.minimum.at(low, label[i], label[j])
        np.minimum.at(low, label[j], label[i])
        while (low[low] != low).any():
            low = low[low]
        new = low[label]
        if (new == label).all():
            return label
        label = new


def _tile(threshold: float, kind: str):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        low = int(rows["i"].iloc[0])
        parts = [rows[rows["block"] == low], rows[rows["block"] != low]]
        same = rows["i"].iloc[0] == rows["j"].iloc[0]
        if not same and not all(map(len, parts)):  # a block that no class fell into
            return pd.DataFrame({"node": [], "other": [], "n": []})
        sides = []
        for p in parts[: 1 if same else 2]:
            x = np.frombuffer(b"".join(p["data"]), dtype=kind).astype(np.float64).reshape(len(p), -1)
            q = np.frombuffer(b"".join(p["q"]), dtype=np.int8).reshape(len(p), -1)
            sides.append((x, (q, *(p[c].to_numpy() for c in ("s", "r", "a")))))
        (x, a), (y, b) = sides[0], sides[-1]
        i, j = may_reach(a, b, threshold)
        if same:
            i, j = i[i < j], j[i < j]
        linked = cosines(x, y, i, j) >= threshold
        i, j = i[linked], j[linked] + (0 if same else len(x))
        all_rows = pd.concat(parts)
        node, weight = all_rows["node"].to_numpy(), all_rows["weight"].to_numpy().astype(float)
        n = np.bincount(i, weight[j], len(node)) + np.bincount(j, weight[i], len(node))
        root = roots(len(node), i, j)
        has, hangs = np.flatnonzero(n), np.flatnonzero(root != np.arange(len(node)))
        return pd.DataFrame(
            {
                "node": np.concatenate([node[has], node[hangs]]),
                "other": pd.array([*([None] * len(has)), *node[root[hangs]]], dtype="Int64"),
                "n": np.concatenate([n[has], np.zeros(len(hangs))]).astype(np.int64),
            }
        )

    return run


def _packed(kind: str):
    """Rows with their components as bytes, null where the vector links with nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = []
            for vector in batch.column(2):
                x = None
                if vector.is_valid and len(vector.values) and not vector.values.null_count:
                    x = vector.values.to_numpy(zero_copy_only=False).astype(kind)
                    norm = np.linalg.norm(x.astype(np.float64)) if np.isfinite(x).all() else 0.0
                    x = x.tobytes() if np.isfinite(norm) and norm > 0 else None
                data.append(x)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(data, pa.binary())], ["vec_id", "label", "data"]
            )

    return run


def _quantise(kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["label", "data", "node", "weight", "dim", "q", "s", "r", "a"]
        for batch in batches:
            dims, out = [], []
            for data in batch.column(1).to_pylist():
                x = np.frombuffer(data, dtype=kind).astype(np.float64)
                q, s, r, a = quantised((x / np.linalg.norm(x))[None])
                dims.append(len(x))
                out.append((q.tobytes(), s[0], r[0], a[0]))
            more = zip(*out, strict=True) if out else ([], [], [], [])
            kinds = (pa.binary(), pa.float64(), pa.float64(), pa.float64())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(dims, pa.int32()), *(pa.array(list(c), k) for c, k in zip(more, kinds, strict=True))],
                names,
            )

    return run


def embedding_dedup(
    vectors: DataFrame, threshold: float = 0.93, vec_id: str = "vec_id", embedding: str = "embedding",
    label: str = "label", block: int = BLOCK,
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for each row of ``vectors``.

    Rows link when their labels are equal and not null and their cosine is at least
    ``threshold`` (above 0). A row whose id is null, or whose vector is null, empty, zero or
    holds null or non-finite components, or has another number of components, links with
    nothing: it is its own component. Repeated rows are vectors of their own, which link;
    rows that share an id share a component. ``kept``: the id is the component's smallest.
    """
    spark = vectors.sparkSession
    importable(spark)
    kind = "<f8" if isinstance(vectors.schema[embedding].dataType.elementType, T.DoubleType) else "<f4"
    given = vectors.select(
        F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("string").alias("label"), F.col(embedding)
    )
    rows = stored(given.mapInArrow(_packed(kind), "vec_id long, label string, data binary"), "embedding-rows")
    able = rows.where("vec_id is not null and label is not null and data is not null")
    classes = able.groupBy("label", "data").agg(F.min("vec_id").alias("node"), F.count("*").alias("weight"))
    ddl = "label string, data binary, node long, weight long, dim int, q binary, s double, r double, a double"
    classes = stored(classes.mapInArrow(_quantise(kind), ddl), "embedding-classes")
    sizes = classes.groupBy("label", "dim").agg(F.ceil(F.count("*") / F.lit(block)).cast("int").alias("blocks"))
    placed = classes.join(sizes, ["label", "dim"]).withColumn("block", F.expr("cast(pmod(xxhash64(data), blocks) as int)"))
    tiles = placed.withColumn("with", F.explode(F.expr("sequence(0, blocks - 1)")))
    tiles = tiles.withColumn("i", F.least("block", "with")).withColumn("j", F.greatest("block", "with"))
    found = stored(
        tiles.select("label", "dim", "i", "j", "block", "node", "weight", "data", "q", "s", "r", "a")
        .groupBy("label", "dim", "i", "j")
        .applyInPandas(_tile(threshold, kind), "node long, other long, n long"),
        "embedding-tiles",
    )
    links = found.where("other is not null").select(F.col("node").alias("src"), F.col("other").alias("dst"))
    groups = connected_components(links, "embedding-components").withColumnRenamed("node", "linked")
    counts = found.groupBy("node").agg(F.sum("n").alias("n"))
    classed = (
        classes.select("label", "data", "node", "weight")
        .join(counts, "node", "left")
        .join(groups, F.col("node") == F.col("linked"), "left")
        .select(
            "label", "data",
            (F.col("weight") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"),
            F.coalesce("component", "node").alias("component"),
        )
    )
    able_rows = able.join(classed, ["label", "data"]).select("vec_id", "n_links", "component")
    others = rows.where("vec_id is null or label is null or data is null").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component")
    )
    return able_rows.unionByName(others).select(
        "vec_id", "n_links", F.col("component").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.col("component"), F.lit(False)).alias("kept"),
    )
