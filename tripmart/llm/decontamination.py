"""Benchmark decontamination by an Aho-Corasick automaton.

Items and documents are normalised alike: A-Z become small, and words are the runs of letters,
digits and non-ASCII characters. Windows of consecutive item words (a shorter item is one
window) are joined by single spaces and closed by one at either end, so a match in a
normalised document is one of whole words. One automaton over all distinct windows scans each
document once; match ends give word numbers, and word numbers offsets in the original text.

Windows go to the tasks as a broadcast of at most about ``AUTOMATON_BYTES`` of window text. A
benchmark beyond that is dealt into blocks by hash and the documents are scanned once per
block, each with an automaton of its own; what the blocks find is united by document. Lists of
items never enter an automaton: matches carry window numbers, which an equality join turns
into items.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import stored, strings, text_batches, text_or_empty
from tripmart.llm.intervals import stitched

WINDOW = 10
#: Window text of an automaton; a node takes some 30 bytes for each byte of it at most.
AUTOMATON_BYTES = 4 << 20

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
#: A-Z to small letters, every other ASCII character that isn't a letter or digit to a space.
_NORMAL = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def normal_words(text: str) -> list[bytes]:
    """The normalised words, in UTF-8."""
    return text.encode().translate(_NORMAL).split()


def item_windows(items: DataFrame, window: int, parts: tuple[str, ...], item_id: str) -> DataFrame:
    """``item_id, window`` for the windows of each part (a question, an answer) of each item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, found = [], []
            for k, item in enumerate(batch.column(0).to_pylist()):
                for part in batch.columns[1:]:
                    words = normal_words(part[k].as_py() or "")
                    own = {b" ".join(words[at : at + window]) for at in range(max(1, len(words) - window + 1))} - {b""}
                    ids += [item] * len(own)
                    found += own
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.string()), pa.array([w.decode() for w in found], pa.string())], ["item_id", "window"]
            )

    rows = items.select(F.col(item_id).cast("string"), *(text_or_empty(p).alias(f"part{k}") for k, p in enumerate(parts)))
    return rows.mapInArrow(run, "item_id string, window string")


class Scanner:
    """The automaton over some windows, given as ``number, window`` pairs."""

    def __init__(self, windows: list[tuple[int, str]]):
        self.automaton = ahocorasick.Automaton() if windows else None
        for number, window in windows:
            # a character for each byte of UTF-8, in patterns and texts
            key = f" {window} ".encode().decode("latin-1")
            self.automaton.add_word(key, (number, window.count(" ") + 1))
        if windows:
            self.automaton.make_automaton()

    def scan(self, text: str) -> tuple[int, list[dict], list[int]]:
        """Words of a text, its stretches of hit words (word numbers and code points, ends
        exclusive) and the numbers of the windows that occur."""
        words = normal_words(text)
        if not words or self.automaton is None:
            return len(words), [], []
        line = b" ".join([b"", *words, b""]).decode("latin-1")
        found = list(self.automaton.iter(line))
        if not found:
            return len(words), [], []
        spaces = np.cumsum([len(w) + 1 for w in words])  # the space after each word
        last = np.searchsorted(spaces, [end for end, _ in found])
        delta = np.zeros(len(words) + 1, dtype=np.int64)
        np.add.at(delta, last + 1, -1)
        np.add.at(delta, last + 1 - [n for _, (_, n) in found], 1)
        hit = np.concatenate(([0], np.cumsum(delta[:-1]) > 0, [0]))
        edges = np.flatnonzero(np.diff(hit)).reshape(-1, 2).tolist()
        places = [m.span() for m in _WORD.finditer(text)]
        stretches = [
            {"first": a, "past": b, "start": places[a][0], "end": places[b - 1][1]} for a, b in edges
        ]
        return len(words), stretches, sorted({number for _, (number, _) in found})


#: The scanners of this worker, by block; of an earlier query none is kept.
_SCANNERS: dict[str, Scanner] = {}

_STRETCH = pa.struct([("first", pa.int64()), ("past", pa.int64()), ("start", pa.int64()), ("end", pa.int64())])
_SCAN = pa.schema(
    [("row", pa.int64()), ("doc_id", pa.int64()), ("n_words", pa.int64()),
     ("stretches", pa.list_(_STRETCH)), ("windows", pa.list_(pa.int64()))]
)
_SCAN_DDL = (
    "row long, doc_id long, n_words long, "
    "stretches array<struct<first: long, past: long, start: long, end: long>>, windows array<long>"
)


def _scanned(rows: DataFrame, windows: list[tuple[int, str]], name: str) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(windows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = _SCANNERS.get(name)
        if scanner is None:
            _SCANNERS.clear()
            scanner = _SCANNERS[name] = Scanner(shared.value)
        for batch in batches:
            found = [scanner.scan(text) for text in strings(batch.column(2))]
            columns = zip(*found, strict=True) if found else ([], [], [])
            arrays = [pa.array(list(c), f.type) for c, f in zip(columns, list(_SCAN)[2:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *arrays], schema=_SCAN)

    return rows.mapInArrow(run, _SCAN_DDL)


def decontaminate(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, parts: tuple[str, ...] = ("text",),
    text: str = "text", doc_id: str = "doc_id", item_id: str = "item_id", automaton_bytes: int = AUTOMATON_BYTES,
) -> DataFrame:
    """``doc_id, n_words, n_hit, spans, items`` for each row of ``docs``: its words, those
    within an occurrence of some item's window, the stretches of such words as ``start, end``
    in code points of the original text (end exclusive), and the ids of the items whose windows
    occur, as sorted strings.

    ``parts`` are the text columns of an item; windows don't cross from one to the next. Null
    texts have no words; an item without words has no window. Rows that share an item id are one
    item. Items without an id hit words but aren't listed. Rows of ``docs`` that share an id
    are each returned, null ids too; columns other than these are never read, whatever their names.
    """
    spark = docs.sparkSession
    text_batches(spark)
    pairs = stored(item_windows(items, window, parts, item_id).distinct(), "item-windows")
    numbered = stored(
        pairs.select("window").distinct().withColumn("number", F.monotonically_increasing_id()), "windows"
    )
    size = numbered.agg(F.sum(F.octet_length("window"))).first()[0] or 0
    blocks = 1 + size // automaton_bytes
    numbered = numbered.withColumn("block", F.pmod(F.xxhash64("window"), F.lit(blocks)))
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(doc_id).cast("long").alias("doc_id"), text_or_empty(text).alias("text")
    )
    run = uuid.uuid4().hex
    scans = None
    for block in range(blocks):  # one, unless the benchmark is larger than an automaton's bound
        windows = [tuple(r) for r in numbered.where(F.col("block") == block).select("number", "window").collect()]
        scan = stored(_scanned(rows, windows, f"{run}-{block}").withColumn("block", F.lit(block)), "scan")
        scans = scan if scans is None else scans.unionByName(scan)
    hit = scans.where(F.size("windows") > 0)
    pieces = hit.select("row", F.inline("stretches"))
    whole = stitched(pieces, ["row"], "first", "past", F.min("start").alias("start"), F.max("end").alias("end"))
    spans = whole.groupBy("row").agg(
        F.sum(F.col("past") - F.col("first")).alias("n_hit"), F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans")
    )
    of = pairs.where("item_id IS NOT NULL").join(numbered, "window").select("number", "item_id")
    met = hit.select("row", F.explode("windows").alias("number")).join(of, "number").select("row", "item_id").distinct()
    listed = met.groupBy("row").agg(F.array_sort(F.collect_list("item_id")).alias("items"))
    out = scans.where("block = 0").select("row", "doc_id", "n_words").join(spans, "row", "left").join(listed, "row", "left")
    return out.select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("spans", F.expr("cast(array() as array<struct<start: bigint, end: bigint>>)")).alias("spans"),
        F.coalesce("items", F.expr("cast(array() as array<string>)")).alias("items"),
    )
