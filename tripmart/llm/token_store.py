"""Token ids in binary shards with a shared zstandard dictionary.

A shard is ``TOKD``, a version, the id width in bytes, the SHA-256 of the dictionary, one
zstandard frame per document, the index (id, place of the frame, frame size, id count per
document, in order) and a trailer (index place, count, ``TOKD``). One document is read with
the trailer, the index and its own frame; the dictionary serves all shards and makes small
frames small. Shards are in ascending order of ids, by a range shuffle, and are written
below ``spark.checkpoint.dir``; a shard appears only when complete, under the name of the
task attempt, and only those in the manifest count.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripmart.llm.common import batches_of, stored, strings, text_batches, text_or_empty
from tripmart.llm.files import NewFile, opened
from tripmart.llm.word_ids import word_ids
from tripmart.session import scratch_dir

MAGIC = b"TOKD"
HEAD, TAIL = "<4sHH32s", "<QQ4s"
HEAD_SIZE, TAIL_SIZE = struct.calcsize(HEAD), struct.calcsize(TAIL)
INDEX = np.dtype([("doc_id", "<i8"), ("null_id", "u1"), ("place", "<u8"), ("size", "<u4"), ("n", "<u8")])
#: Documents that the dictionary is trained on at most, ids of each, and its size in bytes.
SAMPLE_DOCS, SAMPLE_IDS, DICT_BYTES = 1000, 2048, 64 << 10
LEVEL = 3
#: Bytes of frames that a reader holds.
READ_BYTES = 4 << 20
MANIFEST_DDL = "shard int, path string, docs long, tokens long"
MANIFEST = pa.schema([("shard", pa.int32()), ("path", pa.string()), ("docs", pa.int64()), ("tokens", pa.int64())])


def _id_width(path: str) -> int:
    return 2 if word_ids(path).tokenizer.get_vocab_size() <= 1 << 16 else 4


def train_dictionary(docs: DataFrame, path: str, end_id: int) -> bytes:
    """A dictionary from the id arrays of at most ``SAMPLE_DOCS`` rows (those with the smallest
    id hashes), of each ``SAMPLE_IDS`` at most from a hashed place; empty where there is too
    little to train on. It decides the shards' size alone, never their content."""
    chosen = docs.select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_DOCS)
    sample = docs.join(F.broadcast(chosen), "doc_id", "left_semi").limit(SAMPLE_DOCS)
    width = _id_width(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = word_ids(path)
        for batch in batches:
            coded = coder.encode_many(strings(batch.column(1)))
            arrays = [_slice(_serialized(ids, end_id, width), width) for ids in coded]
            yield pa.RecordBatch.from_arrays([pa.array(arrays, pa.binary())], ["ids"])

    arrays = [bytes(r.ids) for r in sample.mapInArrow(run, "ids binary").collect()]
    if len(arrays) < 8 or sum(map(len, arrays)) < 16 * 1024:
        return b""
    size = min(DICT_BYTES, max(1024, sum(map(len, arrays)) // 16))
    try:
        return zstandard.train_dictionary(size, arrays).as_bytes()
    except zstandard.ZstdError:  # too little variety for a dictionary
        return b""


def _serialized(ids: bytes, end_id: int, width: int) -> bytes:
    return np.append(np.frombuffer(ids, "<u4"), np.uint32(end_id)).astype(f"<u{width}").tobytes()


def _slice(ids: bytes, width: int) -> bytes:
    """``SAMPLE_IDS`` ids in a row at most, from a place that the ids' checksum decides."""
    first = zlib.crc32(ids) % (max(0, len(ids) // width - SAMPLE_IDS) + 1)
    return ids[first * width : (first + SAMPLE_IDS) * width]


def _dict_of(data: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(data) if data else None


def write_shards(
    docs: DataFrame, path: str, end_id: int, folder: str | None = None, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """Write all documents' ids, ``end_id`` appended, as shards; returns the manifest
    ``shard, path, docs, tokens, dictionary, start`` (ids in the shards before).

    Null texts count as empty, null ids come first, rows that share an id are all kept and
    ordered by a hash of their text. An empty table gives an empty manifest."""
    spark = docs.sparkSession
    text_batches(spark)
    folder = folder or scratch_dir(spark, "token-shards")
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_or_empty(text).alias("text"))
    dictionary = train_dictionary(rows, path, end_id)
    dict_path = f"{folder}/dictionary-{hashlib.sha256(dictionary).hexdigest()}.zdict"
    with NewFile(dict_path) as out:
        out.write(dictionary)
    width = _id_width(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        coder, index = word_ids(path), []
        shared = _dict_of(dictionary)
        if shared:
            shared.precompute_compress(level=LEVEL)  # once, not for each document
        pack = zstandard.ZstdCompressor(level=LEVEL, dict_data=shared)
        uri = f"{folder}/shard-{task.partitionId():06d}-{task.taskAttemptId()}.tokd"
        first = next(batches, None)
        if first is None:
            return
        with NewFile(uri) as out:
            out.write(struct.pack(HEAD, MAGIC, 1, width, hashlib.sha256(dictionary).digest()))
            batch = first
            while batch is not None:
                coded = coder.encode_many(strings(batch.column(1)))
                for doc, ids in zip(batch.column(0).to_pylist(), coded, strict=True):
                    data = _serialized(ids, end_id, width)
                    frame = pack.compress(data)
                    index.append((doc or 0, doc is None, out.size, len(frame), len(data) // width))
                    out.write(frame)
                batch = next(batches, None)
            entries = np.array(index, dtype=INDEX)
            place = out.size
            out.write(entries.tobytes())
            out.write(struct.pack(TAIL, place, len(index), MAGIC))
        yield from batches_of([(task.partitionId(), uri, len(index), int(entries["n"].sum()))], MANIFEST)

    # a hash of the text deals out the rows of one id, too
    keyed = rows.withColumn("tie", F.xxhash64("text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = keyed.repartitionByRange(parts, "doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    manifest = stored(ordered.select("doc_id", "text").mapInArrow(run, MANIFEST_DDL), "token-manifest")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # a row per shard
    return manifest.withColumn("dictionary", F.lit(dict_path)).withColumn(
        "start", F.coalesce(F.sum("tokens").over(before), F.lit(0))
    )


class Shard:
    """A shard opened for reading."""

    def __init__(self, uri: str, dictionary: bytes):
        store, path = opened(uri)
        self.file = store.open_input_file(path)
        size = self.file.size()
        magic, _, self.width, digest = struct.unpack(HEAD, self.file.read_at(HEAD_SIZE, 0))
        place, n, end = struct.unpack(TAIL, self.file.read_at(TAIL_SIZE, size - TAIL_SIZE))
        if magic != MAGIC or end != MAGIC or place + n * INDEX.itemsize + TAIL_SIZE != size:
            raise ValueError(f"{uri} is no complete shard")
        if digest != hashlib.sha256(dictionary).digest():
            raise ValueError(f"{uri} was written with another dictionary")
        self.index = np.frombuffer(self.file.read_at(n * INDEX.itemsize, place), dtype=INDEX)
        self.unpack = zstandard.ZstdDecompressor(dict_data=_dict_of(dictionary))

    def _ids(self, frame: bytes, n: int) -> np.ndarray:
        return np.frombuffer(self.unpack.decompress(frame, max_output_size=int(n) * self.width), f"<u{self.width}")

    def document(self, k: int) -> np.ndarray:
        """Ids of the k-th document, by reading its frame alone."""
        e = self.index[k]
        return self._ids(self.file.read_at(int(e["size"]), int(e["place"])), e["n"])

    def documents(self) -> Iterator[tuple[int | None, np.ndarray]]:
        """All documents in order, a few megabytes of frames at a time."""
        k = 0
        while k < len(self.index):
            first, end = int(self.index["place"][k]), k
            while end < len(self.index) and (end == k or int(self.index["place"][end]) - first < READ_BYTES):
                end += 1
            last = self.index[end - 1]
            data = self.file.read_at(int(last["place"]) + int(last["size"]) - first, first)
            for e in self.index[k:end]:
                at = int(e["place"]) - first
                yield None if e["null_id"] else int(e["doc_id"]), self._ids(data[at : at + int(e["size"])], e["n"])
            k = end


_DOCS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])


def read_shards(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` (little-endian unsigned 32-bit) of all shards' documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, dict_uri, start in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                store, path = opened(dict_uri)
                with store.open_input_file(path) as f:
                    shard = Shard(uri, f.read())
                yield from batches_of(_rows(shard, start), _DOCS, 256)

    def _rows(shard: Shard, start: int) -> Iterator[tuple]:
        for doc, ids in shard.documents():
            yield doc, start, len(ids), ids.astype("<u4").tobytes()
            start += len(ids)

    listed = manifest.select("path", "dictionary", "start")
    spread = listed.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "path")
    return spread.mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")
