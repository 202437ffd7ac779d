"""Periodic runs of words by scale-tiled distribution.

A run is a stretch of words that repeats with a period ``q``, at least ``TIMES`` times over,
and that no neighbour extends. Word ``i`` matches at ``q`` if word ``i + q`` equals it, and a run of
length ``m`` is a maximal interval of ``m - q`` matching places.

Periods are taken by octaves. An octave sets boundaries so close that each interval long
enough holds one. A boundary is worth solving only if some period of the octave matches for
several words after or before it, which one pass over strided views of the document tells
for all boundaries at once. What is left goes out as overlapping tiles of the document, one
row each, dealt over the cluster by document, octave and tile; a tile is solved by itself. At a
boundary, the Z-function of the words after it, and that of the words before it read backward,
give for all periods of the octave how far matching places reach to either side, up to the next
boundaries. These fragments are shuffled by document and period and stitched: fragments that touch
or overlap are one interval. Of periods that give the same stretch the smallest is its period.

Documents without any tile, most of them, never leave their task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import stored, strings, text_batches, text_or_empty
from tripmart.llm.intervals import stitched

#: A run has ``LEAST`` words at least and its period ``TIMES`` times.
LEAST, TIMES = 6, 4
#: Words of a tile between its first and last boundary: this many, or so many times its octave's periods.
TILE, TILE_PERIODS = 4096, 8
#: Bytes of output rows held back by a task.
_HELD = 8 << 20


def octaves(n: int) -> Iterator[tuple[int, int, int]]:
    """Smallest period, first period of the next octave and distance of boundaries. A run of
    ``n`` words has a period of ``n // TIMES`` at most.

    An interval of period ``q`` has ``max(LEAST, TIMES * q) - q`` places, more than a distance."""
    low, high, stride = 1, 8, LEAST - 2
    while low <= n // TIMES:
        yield low, min(high, n // TIMES + 1), stride
        low, high, stride = high, 2 * high, 2 * high


def worth_solving(ids: np.ndarray, low: int, high: int, stride: int) -> np.ndarray:
    """The boundaries (multiples of ``stride``) with a period of the octave that may match for
    ``stride`` places around them: one side then has half of these, of which some are tried."""
    depth = min((stride + 1) // 2 + (stride < 8), 8)
    n = len(ids)
    arr = np.concatenate([np.full(depth, -1, ids.dtype), ids, np.full(high + stride + depth, -2, ids.dtype)])
    places = np.arange(depth, n + depth, stride)
    step = arr.itemsize
    shifted = np.lib.stride_tricks.as_strided(arr[depth + low :], (len(places), high - low), (stride * step, step))
    at, period = np.nonzero(shifted == arr[places][:, None])
    if not len(at):
        return at
    at, period = places[at], period + low
    found = []
    for side in (1, -1):
        a, q = at, period
        for k in range(1, depth if side == 1 else depth + 1):
            same = arr[a + side * k] == arr[a + side * k + q]
            a, q = a[same], q[same]
            if not len(a):
                break
        found.append(a)
    return np.unique(np.concatenate(found)) - depth


def tiles(ids: np.ndarray) -> Iterator[tuple[int, int, int, int, np.ndarray, np.ndarray]]:
    """Tiles of a document given as word numbers: octave (three numbers), place of the first word,
    words, and the boundaries to solve, as document places."""
    for low, high, stride in octaves(len(ids)):
        marks = worth_solving(ids, low, high, stride)
        if len(marks):
            span = max(TILE, TILE_PERIODS * high)
            for some in np.split(marks, np.flatnonzero(np.diff(marks // span)) + 1):
                first = max(0, int(some[0]) - stride)
                yield low, high, stride, first, ids[first : int(some[-1]) + stride + high], some


def z_function(s: list[int], n: int) -> list[int]:
    """The first ``n`` values: how long ``s`` and its suffix from each place agree."""
    size, z, a, b = len(s), [0] * min(n, len(s)), 0, 0
    if z:
        z[0] = size
    for k in range(1, len(z)):
        m = min(b - k, z[k - a]) if k < b else 0
        while k + m < size and s[m] == s[k + m]:
            m += 1
        if k + m > b:
            a, b = k, k + m
        z[k] = m
    return z


def solve(low: int, high: int, stride: int, first: int, ids: list[int], marks: list[int]) -> list[tuple[int, int, int]]:
    """Fragments ``period, first, past`` of the matching places round a tile's boundaries, at most
    ``stride`` to either side. Those shorter than ``stride`` belong to no run."""
    found: dict[int, list[list[int]]] = {}
    for mark in marks:
        b = mark - first
        ahead = z_function(ids[b : b + stride + high], high)
        before, past = ids[max(0, b - stride) : b], ids[b : b + high - 1]
        n = len(before)
        # backward from the boundary, then backward from the place one period on
        back = z_function([*before[::-1], -1, *past[::-1], *before[::-1]], n + 1 + len(past)) if n else []
        for q in range(low, len(ahead)):
            right = min(ahead[q], stride)
            if not right:
                continue
            left = back[n + 1 + len(past) - q] if n else 0
            if left + right >= stride:
                some = found.setdefault(q, [])
                if some and mark - left <= some[-1][1]:
                    some[-1][1] = mark + right
                else:
                    some.append([mark - left, mark + right])
    return [(q, a, b) for q, some in found.items() for a, b in some]


def numbered(words: list[bytes]) -> np.ndarray:
    """Words as numbers, equal for equal words."""
    number = {w: k for k, w in enumerate(dict.fromkeys(words))}
    return np.fromiter(map(number.__getitem__, words), dtype=np.int32, count=len(words))


_PARTS = pa.schema(
    [("row", pa.int64()), ("doc_id", pa.int64()), ("words", pa.binary()), ("low", pa.int64()), ("high", pa.int64()),
     ("stride", pa.int64()), ("first", pa.int64()), ("ids", pa.binary()), ("marks", pa.list_(pa.int64()))]
)
_PARTS_DDL = (
    "row long, doc_id long, words binary, low long, high long, stride long, first long, ids binary, marks array<long>"
)


def _tiled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of the documents with tiles one row for its words, and its tiles."""
    for batch in batches:
        held, size = [], 0
        for row, doc_id, text in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
            words = text.encode().split()  # bytes.split() parts at \x20 and \x09-\x0D alone
            found = tiles(numbered(words))
            head = next(found, None)
            if head is None:
                continue
            held.append((row, doc_id, b" ".join(words), *[None] * 6))
            size += len(text)
            while head is not None:
                low, high, stride, first, ids, marks = head
                held.append((row, None, None, low, high, stride, first, ids.tobytes(), marks.tolist()))
                size += ids.nbytes + marks.nbytes
                if size > _HELD:
                    yield _batch(held)
                    held, size = [], 0
                head = next(found, None)
        yield _batch(held)


def _untiled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Results of the documents without tiles, which have no runs."""
    for batch in batches:
        out: list[list] = [[], [], [], [], []]
        for doc_id, text in zip(*(batch.column(k).to_pylist() for k in (1, 2)), strict=True):
            words = text.encode().split()
            if next(tiles(numbered(words)), None) is None:
                _add_result(out, doc_id, words, [])
        yield _results(out)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else ([] for _ in _PARTS)
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, _PARTS, strict=True)], schema=_PARTS)


_FRAGMENT = pa.schema([("row", pa.int64()), ("period", pa.int64()), ("start", pa.int64()), ("past", pa.int64())])


def _solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: list[list[int]] = [[], [], [], []]
        for row, low, high, stride, first, ids, marks in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            for fragment in solve(low, high, stride, first, np.frombuffer(ids, np.int32).tolist(), marks):
                for column, value in zip(out, (row, *fragment), strict=True):
                    column.append(value)
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], schema=_FRAGMENT)


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_RESULT = pa.schema(
    [("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(_RUN)), ("best", _RUN), ("collapsed", pa.string())]
)
_RUN_DDL = "struct<start: long, length: long, period: long>"
_RESULT_DDL = f"doc_id long, n_words long, runs array<{_RUN_DDL}>, best {_RUN_DDL}, collapsed string"


def best_run(runs: list[dict[str, int]]) -> dict[str, int] | None:
    """The run with the greatest exact ``length / period``, the first of several."""
    best = None
    for r in runs:
        if best is None or r["length"] * best["period"] > best["length"] * r["period"]:
            best = r
    return best


def collapse(words: list[bytes], runs: list[dict[str, int]]) -> bytes:
    """The words that stay, by single spaces: those in no run after its first period."""
    if not runs:
        return b" ".join(words)
    delta = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(delta, [r["start"] + r["period"] for r in runs], 1)
    np.add.at(delta, [r["start"] + r["length"] for r in runs], -1)
    gone = (np.cumsum(delta[:-1]) > 0).tolist()
    return b" ".join([w for w, x in zip(words, gone, strict=True) if not x])


def _add_result(out: list[list], doc_id: int | None, words: list[bytes], runs: list[dict[str, int]]) -> None:
    row = (doc_id, len(words), runs, best_run(runs), collapse(words, runs).decode())
    for column, value in zip(out, row, strict=True):
        column.append(value)


def _results(out: list[list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, _RESULT, strict=True)], schema=_RESULT)


def _collapsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: list[list] = [[], [], [], [], []]
        for doc_id, words, runs in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            _add_result(out, doc_id, words.split(), runs or [])
        yield _results(out)


def periodic_runs(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id, n_words, runs, best, collapsed`` for each row of ``docs``.

    Words are the runs of characters other than space and ``\\t`` to ``\\r``, numbered from 0.
    ``runs`` lists all runs as ``start, length, period`` by start, then period; ``best`` is that
    with the greatest exact length / period (of equal ones the first), null without runs;
    ``collapsed`` is the words joined by one space without those that some run holds after its
    first period. Null and empty texts have no words. Rows that share an id, and null ids, are
    each returned; columns other than these are never read, whatever their names."""
    text_batches(docs.sparkSession)
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(doc_id).cast("long").alias("doc_id"), text_or_empty(text).alias("text")
    )
    parts = stored(rows.mapInArrow(_tiled, _PARTS_DDL), "run-tiles")
    tiled = parts.where("words IS NULL").select("row", "low", "high", "stride", "first", "ids", "marks")
    dealt = tiled.repartition("row", "low", "first")
    fragments = dealt.mapInArrow(_solved, "row long, period long, start long, past long")
    whole = stitched(fragments, ["row", "period"], "start", "past")
    long = whole.withColumn("length", F.col("past") - F.col("start") + F.col("period")).where(
        F.col("length") >= F.greatest(F.lit(LEAST), TIMES * F.col("period"))
    )
    runs = long.groupBy("row", "start", "length").agg(F.min("period").alias("period"))
    # ascending by start, then period: of one start, the shorter period's run is listed first
    listed = F.array_sort(F.collect_list(F.struct("start", "period", "length")))
    per_doc = runs.groupBy("row").agg(
        F.transform(listed, lambda r: F.struct(r["start"].alias("start"), r["length"].alias("length"), r["period"].alias("period"))).alias("runs")
    )
    pending = parts.where("words IS NOT NULL").select("row", "doc_id", "words").join(per_doc, "row", "left").select("doc_id", "words", "runs")
    # results at once: two Python steps in a row would hold two workers for each task
    plain = rows.mapInArrow(_untiled, _RESULT_DDL)
    return pending.mapInArrow(_collapsed, _RESULT_DDL).unionByName(plain)
