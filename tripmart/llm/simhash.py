"""SimHash near-duplicates by deletion-variant signatures.

A fingerprint has 64 bits, one per majority vote of its shingles' hashes. To find all pairs
within ``max_distance`` bits it is cut into ``max_distance // 2 + 1`` segments: of two such
fingerprints, one segment differs by at most one bit. Each segment is indexed once per bit
position with that bit as a wildcard, so the pair meets in a bucket, and an equality join
with a bit count verifies it.

Copies collapse to one row per fingerprint first, and dense groups of near ones never give
all pairs (see ``buckets``, also for why the joins are held to sorting).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.llm.buckets import united
from tripmart.llm.common import stored, strings, text_batches, text_or_empty

BITS = 64
SEED = 42
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
#: Shingle hashes that are unpacked at once.
_CHUNK = 1 << 15


def simhash(text: str, shingle: int = 4) -> int:
    """The signed 64-bit fingerprint of a text; 0 without words. A bit is set when it is set
    in over half of the hashes of the shingles, repeats included."""
    words = _WORD.findall(text.encode().lower())  # bytes.lower() changes A-Z alone
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(line, SEED)]
    else:
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1
        ends = np.cumsum(sizes)
        starts = (ends - sizes)[: len(words) - shingle + 1].tolist()
        digest = xxhash.xxh64_intdigest
        hashes = [digest(line[a:b], SEED) for a, b in zip(starts, (ends[shingle - 1 :] - 1).tolist(), strict=True)]
    votes = np.zeros(BITS, dtype=np.int64)
    for k in range(0, len(hashes), _CHUNK):
        part = np.array(hashes[k : k + _CHUNK], dtype=">u8")
        votes += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > len(hashes)).view(">i8")[0])


def _fingerprints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = pa.array([simhash(t, shingle) for t in strings(batch.column(1))], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), prints, *batch.columns[2:]], ["doc_id", "fp", *batch.schema.names[2:]]
            )

    return run


def _text_hash(text: Column) -> list[Column]:
    """128 bits of a text; with the id they are a row's key."""
    return [F.xxhash64(text).alias("__t1"), F.xxhash64(F.lit(1), text).alias("__t2")]


def fingerprints(
    docs: DataFrame, shingle: int = 4, text: str = "text", doc_id: str = "doc_id", keyed: bool = False
) -> DataFrame:
    """``doc_id, fp`` for each row of ``docs``, and ``__t1, __t2`` of its text if ``keyed``;
    null texts count as empty."""
    text_batches(docs.sparkSession)
    content = text_or_empty(text)
    key = _text_hash(content) if keyed else []
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), content.alias("text"), *key)
    return rows.mapInArrow(_fingerprints(shingle), "doc_id long, fp long" + ", __t1 long, __t2 long" * keyed)


def hex_of(fp: Column) -> Column:
    """16 lowercase hex digits of a fingerprint."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _variants(max_distance: int) -> Column:
    """Keys of all one-wildcard variants of all segments of ``fp``."""
    segments = max_distance // 2 + 1
    cuts = [round(BITS * k / segments) for k in range(segments + 1)]
    keys = []
    for low, high in zip(cuts, cuts[1:], strict=False):
        mask = ((1 << high) - 1) ^ ((1 << low) - 1)
        for bit in range(low, high):
            kept = mask & ~(1 << bit)
            signed = kept - (1 << BITS) if kept >> (BITS - 1) else kept
            keys.append(
                F.struct(F.lit(bit).cast("byte").alias("bit"), F.col("fp").bitwiseAND(F.lit(signed)).alias("kept"))
            )
    return F.explode(F.array(*keys))


def _near(a: str, b: str, max_distance: int) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= max_distance


def near_links(prints: DataFrame, max_distance: int = 4) -> DataFrame:
    """Components of the distinct fingerprints ``fp`` under links of at most ``max_distance``
    differing bits: ``node, component`` of each fingerprint that has a link."""
    spark = prints.sparkSession
    distinct = stored(prints.select("fp").distinct(), "simhash-fp")
    # a fingerprint becomes many rows, so its small table is spread first
    spread = distinct.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    members = spread.select(_variants(max_distance).alias("key"), F.col("fp").alias("id"))
    return united(
        members,
        lambda pairs: pairs.where(_near("src", "dst", max_distance)),
        lambda a, b: _near(a, b, max_distance),
        "simhash",
    )


def simhash_dedup(
    docs: DataFrame, shingle: int = 4, max_distance: int = 4, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """``doc_id, fp, component_id`` for each row of ``docs``.

    Words are runs of characters other than space and ``\\t``-``\\r`` with A-Z lower-cased; a
    text of fewer than ``shingle`` words counts as one shingle, one without words (null too)
    has fingerprint 0, linked like any other. Documents link when their fingerprints differ
    in at most ``max_distance`` bits; ``component_id`` is the smallest id reachable (null ids
    are skipped, and it is null if there is no other). Repeated rows keep their own row.
    """
    prints = stored(fingerprints(docs, shingle, text, doc_id), "simhash-docs")
    links = near_links(prints, max_distance)
    first = prints.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    classes = first.join(links.hint("merge"), F.col("fp") == F.col("node"), "left").select(
        "fp", "first_id", F.coalesce("component", "fp").alias("group")
    )
    lowest = classes.groupBy("group").agg(F.min("first_id").alias("component_id"))
    classes = classes.join(lowest.hint("merge"), "group").select("fp", "component_id")
    return prints.join(classes.hint("merge"), "fp").select("doc_id", "fp", "component_id")


def simhash_keep(
    docs: DataFrame, shingle: int = 4, max_distance: int = 4, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """One row of each group of ``docs``, with all its columns: the one of the smallest id, and
    of rows that share this id that of the smallest text hash. Rows are told apart by id and
    text, so documents of different groups stay even if they share an id. Of a group's rows
    without an id one stays, too."""
    prints = stored(fingerprints(docs, shingle, text, doc_id, keyed=True), "simhash-docs")
    groups = prints.join(near_links(prints, max_distance).hint("merge"), F.col("fp") == F.col("node"), "left")
    group = F.coalesce("component", "fp").alias("group")
    first = F.min(F.struct("doc_id", "__t1", "__t2")).alias("first")
    stay = groups.groupBy(group, F.col("doc_id").isNull()).agg(first).select(
        F.col("first.doc_id").alias("__stays"), F.col("first.__t1").alias("__s1"), F.col("first.__t2").alias("__s2")
    )
    t1, t2 = _text_hash(text_or_empty(text))
    rows = docs.withColumns({"__id": F.col(doc_id).cast("long"), "__t1": t1, "__t2": t2})
    same = F.col("__id").eqNullSafe(F.col("__stays")) & (F.col("__t1") == F.col("__s1")) & (F.col("__t2") == F.col("__s2"))
    found = rows.join(stay, same, "left_semi").dropDuplicates(["__id", "__t1", "__t2"])
    return found.select(*docs.columns)
