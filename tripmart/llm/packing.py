"""Best-fit packing of token pieces by a configuration linear program.

Documents longer than a sequence are cut; what is packed are piece lengths, and there are at
most ``capacity`` different ones. So the problem is solved on the length histogram, whatever
the number of documents: a configuration is a multiset of lengths that fits one sequence,
and the linear program covers the histogram with the fewest configurations. It is solved by
multiplicative weights: each round prices the lengths, a knapsack dynamic program finds the
configurations of the highest price, and covered lengths lose weight. The solution is
rounded down to whole sequences, then up by the largest fraction where the pieces left allow
it, and the rest of the histogram is packed best-fit, largest first. Only the histogram
reaches the driver.

Pieces find their places without a hot key: each is numbered among those of its length in
its task, tasks' counts are summed up before it, and the number points into the solution.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmart.llm.common import batches_of, stored, strings, text_batches, text_or_empty
from tripmart.llm.word_ids import word_ids

#: Rounds of multiplicative weights, the step of the weights and how near to the best price a
#: configuration must come to be used.
ROUNDS, STEP, NEAR = 60, 0.5, 0.02

Config = tuple[tuple[int, int], ...]  # (length, copies), longest first


def _knapsack(price: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Best total price for each capacity (any number of copies), and the length used last
    (0: leave one token empty). ``price[s]`` is that of length s."""
    best, used = np.zeros(capacity + 1), np.zeros(capacity + 1, dtype=np.int64)
    for c in range(1, capacity + 1):
        totals = price[1 : c + 1] + best[c - 1 :: -1] if c else price[:0]
        k = int(np.argmax(totals))
        if totals[k] > best[c - 1]:
            best[c], used[c] = totals[k], k + 1
        else:
            best[c] = best[c - 1]
    return best, used


def _config(first: int, used: np.ndarray, capacity: int) -> Config:
    counts = Counter({first: 1}) if first else Counter()
    c = capacity - first
    while c > 0:
        s = int(used[c])
        if s:
            counts[s] += 1
            c -= s
        else:
            c -= 1
    return tuple(sorted(counts.items(), reverse=True))


def solve_lp(counts: dict[int, int], capacity: int, rounds: int = ROUNDS) -> tuple[dict[Config, float], float]:
    """Fractional configurations that cover the histogram, and a lower bound on any packing."""
    lengths = np.array(sorted(counts), dtype=np.int64)
    need = np.array([counts[int(s)] for s in lengths], dtype=float)
    place = {int(s): k for k, s in enumerate(lengths)}
    weight, covered = lengths / capacity, np.zeros(len(lengths))
    used_so_far: Counter = Counter()
    bound = float((lengths * need).sum()) / capacity
    for _ in range(rounds):
        price = np.full(capacity + 1, -1.0)
        price[lengths] = weight
        best, last = _knapsack(price, capacity)
        bound = max(bound, float((weight * need).sum()) / best[capacity])
        worth = weight + best[capacity - lengths]
        chosen = {_config(int(s), last, capacity) for s in lengths[worth >= (1 - NEAR) * best[capacity]]}
        gain, steps = np.zeros(len(lengths)), {}
        for config in chosen:
            t = steps[config] = min(need[place[s]] / n for s, n in config)
            for s, n in config:
                gain[place[s]] += n * t / need[place[s]]
        scale = 1 / gain.max()
        for config, t in steps.items():
            used_so_far[config] += t * scale
        gain *= scale
        covered += gain
        weight = weight * np.exp(-STEP * gain)
        # a length that the prices never reach still gets its turn
        weight = np.where(covered < 0.5 * covered.max(), weight * (1 + STEP / 4), weight)
    low = covered.min()
    if low > 0:
        return {c: x / low for c, x in used_so_far.items()}, bound
    return {c: x / covered.max() for c, x in used_so_far.items()}, bound


def _best_fit(left: dict[int, int], capacity: int) -> list[tuple[Config, int]]:
    """Pack a histogram greedily: the longest length, then always the longest that fits; the
    same configuration is used as often as the counts allow."""
    out = []
    lengths = sorted((s for s, n in left.items() if n), reverse=True)
    left = dict(left)
    while lengths:
        room, counts = capacity, Counter()
        k = 0
        while k < len(lengths):
            s = lengths[k]
            n = min(room // s, left[s])
            if n:
                counts[s] = n
                room -= n * s
            k += 1
        times = min(left[s] // n for s, n in counts.items())
        out.append((tuple(sorted(counts.items(), reverse=True)), times))
        for s, n in counts.items():
            left[s] -= n * times
        lengths = [s for s in lengths if left[s]]
    return out


def solve(counts: dict[int, int], capacity: int) -> list[tuple[Config, int]]:
    """Configurations and how many sequences use each, covering the histogram exactly."""
    counts = {s: n for s, n in counts.items() if n}
    if not counts:
        return []
    left, out = dict(counts), []
    fractional, _ = solve_lp(counts, capacity)

    def take(config: Config, wanted: int) -> None:
        times = min(wanted, *(left[s] // n for s, n in config))
        if times:
            out.append((config, times))
            for s, n in config:
                left[s] -= n * times

    for config, x in sorted(fractional.items(), key=lambda e: (-e[1], e[0])):
        take(config, int(x))
    # rounded up within what is left, so that the program carries small inputs, too
    for config, _ in sorted(fractional.items(), key=lambda e: (int(e[1]) - e[1], e[0])):
        take(config, 1)
    return out + _best_fit(left, capacity)


def segments(solution: list[tuple[Config, int]]) -> np.ndarray:
    """Rows (length, first rank, first sequence, offset): the pieces of a length with ranks
    from the first one on go to the sequences from the first one on, at the offset."""
    rows, ranks, sequence = [], Counter(), 0
    for config, times in solution:
        offset = 0
        for length, copies in config:
            for _ in range(copies):
                rows.append((length, ranks[length], sequence, offset))
                ranks[length] += times
                offset += length
        sequence += times
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 4)


PIECES = pa.schema(
    [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
     ("ids_crc32", pa.int64()), ("ids", pa.binary()), ("task", pa.int64()), ("number", pa.int64())]
)
PIECES_DDL = (
    "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary, task long, number long"
)


def token_pieces(
    docs: DataFrame, path: str, end_id: int, capacity: int, with_ids: bool = False,
    text: str = "text", doc_id: str = "doc_id",
) -> DataFrame:
    """The pieces of all documents, stored: ids by the tokenizer file, ``end_id`` appended,
    cut at ``capacity`` where longer. ``ids`` (little-endian unsigned 32-bit) is null unless
    asked for. ``number`` counts the pieces of a length within a task."""
    text_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, coder, numbers = TaskContext.get().partitionId(), word_ids(path), Counter()
        end = np.array([end_id], dtype="<u4").tobytes()

        def rows() -> Iterator[tuple]:
            for batch in batches:
                coded = coder.encode_many(strings(batch.column(1)))
                for doc, ids in zip(batch.column(0).to_pylist(), coded, strict=True):
                    ids += end
                    for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                        part = ids[at : at + 4 * capacity]
                        n = len(part) // 4
                        yield doc, piece, at // 4, n, zlib.crc32(part), part if with_ids else None, task, numbers[n]
                        numbers[n] += 1

        yield from batches_of(rows(), PIECES)

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_or_empty(text).alias("text"))
    return stored(rows.mapInArrow(run, PIECES_DDL), "pieces")


def pack(pieces: DataFrame, capacity: int) -> DataFrame:
    """``pieces`` (from ``token_pieces``) with ``sequence_id`` and ``offset``: every piece lies
    in one sequence, pieces of a sequence are gapless from 0 and sum to ``capacity`` at most."""
    counts = pieces.groupBy("task", "length").count()
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("count").alias("n")).collect()}
    plan = segments(solve(histogram, capacity))
    keys = plan[:, 0] << 40 | plan[:, 1] if len(plan) else np.zeros(0, np.int64)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("length", "rank"))
            k = np.searchsorted(keys, length << 40 | rank, side="right") - 1
            sequence, offset = plan[k, 2] + rank - plan[k, 1], plan[k, 3]
            columns = [c for c, f in zip(batch.columns, batch.schema, strict=True) if f.name != "rank"]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sequence), pa.array(offset)], names)

    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("task", "length", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
    kept = [c for c in pieces.columns if c not in ("task", "number")]
    ranked = pieces.join(bases, ["task", "length"]).select(*kept, (F.col("base") + F.col("number")).alias("rank"))
    names = [*kept, "sequence_id", "offset"]
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema if f.name in kept)
    return ranked.mapInArrow(place, f"{fields}, sequence_id long, offset long")


def pack_documents(
    docs: DataFrame, path: str, end_id: int = 0, capacity: int = 2048, with_ids: bool = False,
    text: str = "text", doc_id: str = "doc_id",
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, ids, sequence_id, offset`` for all pieces.

    Null texts count as empty and give the one-token piece of ``end_id``; null ids and
    repeated rows are packed like any other; an empty table gives none."""
    return pack(token_pieces(docs, path, end_id, capacity, with_ids, text, doc_id), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, ids``: each sequence's ids (of pieces with ids) in order; a group holds
    at most a sequence."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id",
        F.aggregate("parts", F.lit(b""), lambda a, p: F.concat(a, p["ids"])).alias("ids"),
    )
