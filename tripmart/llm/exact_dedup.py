"""Exact deduplication by Patricia tries.

Every task first builds tries of its own rows, so that copies met in one task collapse
before any shuffle. The texts that remain (one per task and text) go to owner tasks by
length and content hash; an owner inserts the full byte strings into a trie per length and
so compares every byte. Terminal nodes hold the smallest identifier (or the largest), the
row that has it and the number of copies.

Memory is bounded. A task's trie that outgrows ``memory_bytes`` hands over subtrees, the
largest first: their terminal nodes leave as finished rows and later copies of those texts
start new nodes, which the owners unite. At an owner, rows come sorted by length and hash,
so all copies of a text arrive together, and each subtree that leaves is final but for the
text at hand, which stays.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import batches_of, stored, text_batches, text_or_empty

#: Bytes of text that one trie holds before subtrees leave it.
MEMORY_BYTES = 64 << 20
#: What a node costs beside its bytes, roughly.
NODE_BYTES = 400


class Node:
    """A compressed edge (``label``), the children by their first byte and a terminal value."""

    __slots__ = ("children", "label", "value")

    def __init__(self, label: bytes, value: list | None = None):
        self.label = label
        self.children: dict[int, Node] | None = None
        self.value = value


class PatriciaTrie:
    """A radix trie of byte strings. ``insert`` returns the list kept at the terminal node."""

    def __init__(self) -> None:
        self.root = Node(b"")
        self.bytes = 0

    def insert(self, key: bytes) -> list:
        node, at = self.root, 0
        while True:
            if at == len(key):
                if node.value is None:
                    node.value = []
                    self.bytes += NODE_BYTES
                return node.value
            child = node.children.get(key[at]) if node.children else None
            if child is None:
                leaf = Node(key[at:], [])
                if node.children is None:
                    node.children = {}
                node.children[key[at]] = leaf
                self.bytes += len(leaf.label) + NODE_BYTES
                return leaf.value
            label = child.label
            if key.startswith(label, at):
                node, at = child, at + len(label)
                continue
            same = _common(label, key, at)
            upper = Node(label[:same])
            child.label = label[same:]
            upper.children = {child.label[0]: child}
            node.children[key[at]] = upper
            self.bytes += NODE_BYTES
            node, at = upper, at + same

    def terminals(self, top: Node | None = None, prefix: bytes = b"") -> Iterator[tuple[bytes, list]]:
        """Full string and value of each terminal node below ``top``, which ``prefix`` leads to."""
        todo = [(top or self.root, prefix)]
        while todo:
            node, key = todo.pop()
            key += node.label
            if node.value is not None:
                yield key, node.value
            if node.children:
                todo.extend((child, key) for child in node.children.values())

    def release(self, goal: int, stays=None) -> Iterator[tuple[bytes, list]]:
        """Take out whole subtrees, the largest first, until ``goal`` bytes are left; yields
        their terminals. The subtree that holds the string ``stays`` is entered instead."""
        level, prefix = self.root, b""
        while level is not None and level.children:
            sizes = {k: _weight(c) for k, c in level.children.items()}
            deeper = None
            for k in sorted(sizes, key=sizes.get, reverse=True):
                if self.bytes <= goal:
                    return
                child = level.children[k]
                if stays is not None and stays.startswith(prefix + child.label):
                    deeper = child
                    continue
                yield from self.terminals(child, prefix)
                del level.children[k]
                self.bytes -= sizes[k]
            if deeper is not None:
                prefix += deeper.label
            level = deeper


def _common(label: bytes, key: bytes, at: int) -> int:
    """Length of the common prefix of ``label`` and ``key[at:]``, by bisection on slices."""
    low, high = 1, min(len(label), len(key) - at)
    while low < high:
        mid = (low + high + 1) // 2
        if label[:mid] == key[at : at + mid]:
            low = mid
        else:
            high = mid - 1
    return low


def _weight(top: Node) -> int:
    total, todo = 0, [top]
    while todo:
        node = todo.pop()
        total += len(node.label) + NODE_BYTES
        if node.children:
            todo.extend(node.children.values())
    return total


def _better(new: tuple, old: tuple, largest: bool) -> bool:
    """Is (id, row) ``new`` the one to keep? A null id loses; of equal ids the first row stays."""
    if new[0] == old[0]:
        return new[1] < old[1]
    if new[0] is None or old[0] is None:
        return old[0] is None
    return (new[0] > old[0]) == largest


MEMBERS = pa.schema(
    [("row", pa.int64()), ("doc_id", pa.int64()), ("text_sha256", pa.string()), ("class", pa.int64()),
     ("n_bytes", pa.int64()), ("content_hash", pa.int64()), ("content", pa.binary()),
     ("best_id", pa.int64()), ("best_row", pa.int64()), ("copies", pa.int64())]
)
MEMBERS_DDL = (
    "row long, doc_id long, text_sha256 string, class long, n_bytes long, content_hash long, "
    "content binary, best_id long, best_row long, copies long"
)


def local_classes(largest: bool, memory_bytes: int):
    """Map side: one row per document with its local class, and one row with the content
    for each local class (``row`` is null there)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 33

        def rows() -> Iterator[tuple]:
            trie, row, classes = PatriciaTrie(), first, first
            for batch in batches:
                for doc_id, sha, h, content in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    value = trie.insert(content)
                    if not value:
                        value.extend((classes, h, doc_id, row, 1))
                        classes += 1
                    else:
                        value[4] += 1
                        if _better((doc_id, row), (value[2], value[3]), largest):
                            value[2], value[3] = doc_id, row
                    yield row, doc_id, sha, value[0], None, None, None, None, None, None
                    row += 1
                if trie.bytes > memory_bytes:
                    yield from map(out, trie.release(memory_bytes // 2))
            yield from map(out, trie.terminals())

        def out(terminal: tuple[bytes, list]) -> tuple:
            key, (cls, h, best, best_row, copies) = terminal
            return None, None, None, cls, len(key), h, key, best, best_row, copies

        yield from batches_of(rows(), MEMBERS, 256)

    return run


OWNED = pa.schema(
    [("class", pa.int64()), ("keep_id", pa.int64()), ("keep_row", pa.int64()), ("group_size", pa.int64())]
)


def own_classes(largest: bool, memory_bytes: int):
    """Owner side: rows sorted by length and hash; one row per local class with its verdict."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            trie, length = PatriciaTrie(), -1
            for batch in batches:
                for n, _, content, cls, best, row, copies in zip(
                    *(c.to_pylist() for c in batch.columns), strict=True
                ):
                    if n != length:
                        yield from (x for t in trie.terminals() for x in out(t))
                        trie, length = PatriciaTrie(), n
                    value = trie.insert(content)
                    if not value:
                        value.extend((best, row, copies, [cls]))
                    else:
                        value[2] += copies
                        value[3].append(cls)
                        if _better((best, row), (value[0], value[1]), largest):
                            value[0], value[1] = best, row
                    if trie.bytes > memory_bytes:
                        yield from (x for t in trie.release(memory_bytes // 2, content) for x in out(t))
            yield from (x for t in trie.terminals() for x in out(t))

        def out(terminal: tuple[bytes, list]) -> Iterator[tuple]:
            best, best_row, size, classes = terminal[1]
            return ((cls, best, best_row, size) for cls in classes)

        yield from batches_of(rows(), OWNED)

    return run


def exact_dedup(
    docs: DataFrame, keep: str = "smallest", text: str = "text", doc_id: str = "doc_id",
    memory_bytes: int = MEMORY_BYTES,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when their UTF-8 bytes are; a null text counts as empty. ``keep`` says
    whether the row with the ``smallest`` or the ``largest`` id stays. Exactly one row of a
    group is ``kept``: rows with a null id come last, and of rows that share the id one
    stays (``keep_id`` is null only if all ids of a group are). Other columns are ignored;
    an empty table gives an empty result.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError(f"keep must be smallest or largest, not {keep}")
    spark, largest = docs.sparkSession, keep == "largest"
    text_batches(spark)
    content = text_or_empty(text)
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.sha2(content.cast("binary"), 256).alias("text_sha256"),
        F.xxhash64(content).alias("content_hash"),
        content.cast("binary").alias("content"),
    )
    met = stored(rows.mapInArrow(local_classes(largest, memory_bytes), MEMBERS_DDL), "exact-dedup")
    classes = (
        met.where("row is null")
        .select("n_bytes", "content_hash", "content", "class", "best_id", "best_row", "copies")
        .repartition("n_bytes", "content_hash")
        .sortWithinPartitions("n_bytes", "content_hash")
        .mapInArrow(
            own_classes(largest, memory_bytes), "class long, keep_id long, keep_row long, group_size long"
        )
    )
    members = met.where("row is not null").select("row", "doc_id", "text_sha256", "class")
    return members.join(classes, "class").select(
        "doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), "text_sha256"
    )
