"""Secret scans through a trigram inverted index.

Documents are indexed in blocks (a task's Arrow batches): postings of the trigrams that the
rules ask for. Each rule's Boolean trigram query is derived from its pattern; postings are
intersected and only the documents named are verified with the pattern. A rule without
mandatory trigrams (a bare character run) scans every document of the block. Blocks are
independent, so there is no shuffle and a lost executor repeats only its own blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import strings, text_batches, text_or_empty
from tripmart.llm.trigrams import BlockIndex, compiled, trigram_query, trigrams_of


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches of ``pattern`` whose ``group`` has ``least`` characters."""

    kind: str
    pattern: str
    least: int = 0
    group: int = 0
    ignore_case: bool = False


# The base rules, in the order in which their kinds are listed.
BASE_RULES = (
    Rule(
        "assign",
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        least=6, group=2, ignore_case=True,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", least=20),
    Rule("hex", r"[0-9a-f]+", least=24),
)
#: Further kinds of secrets with a plain mark of their own.
MORE_RULES = (
    # to the END mark with nothing but a key's characters between, else over the lines of base64
    Rule(
        "private_key",
        r"-----BEGIN [A-Z ]*PRIVATE KEY-----"
        r"(?:[A-Za-z0-9+/=,:.\s-]*?-----END [A-Z ]*PRIVATE KEY-----|(?:\s+[A-Za-z0-9+/=]{16,})*)",
    ),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", least=40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", least=15),
)
RULES = BASE_RULES + MORE_RULES


class Scanner:
    """Rules with their compiled patterns and trigram queries."""

    def __init__(self, rules: tuple[Rule, ...]):
        self.rules = [(r, compiled(r.pattern, r.ignore_case), trigram_query(r.pattern)) for r in rules]
        self.wanted = set().union(*(trigrams_of(q) for _, _, q in self.rules))

    def scan(self, texts: list[str]) -> list[list[tuple[str, int, int]]]:
        """Spans (kind, start, end) of each text by start, then in the rules' order."""
        index = BlockIndex(texts, self.wanted)
        found: list[list] = [[] for _ in texts]
        for rank, (rule, pattern, query) in enumerate(self.rules):
            places = index.places(query)
            while places:
                k = (places & -places).bit_length() - 1
                places &= places - 1
                for m in pattern.finditer(texts[k]):
                    a, b = m.span(rule.group)
                    if b - a >= rule.least:
                        found[k].append((m.start(), rank, m.end(), rule.kind))
        return [[(kind, a, b) for a, _, b, kind in sorted(spans)] for spans in found]


SPANS_DDL = "array<struct<kind: string, start: int, end: int>>"
_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def scan_secrets(
    docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """``doc_id, spans`` for each row of ``docs``: all spans of the whole text by start, then
    by the rules' order. Offsets are code points, the end exclusive. Null and empty texts
    have no spans; null ids and repeated rows are returned as they come."""
    text_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(rules)
        for batch in batches:
            spans = [
                [{"kind": k, "start": a, "end": b} for k, a, b in found]
                for found in scanner.scan(strings(batch.column(1)))
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, _SPANS)], ["doc_id", "spans"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_or_empty(text).alias("text"))
    return rows.mapInArrow(run, f"doc_id long, spans {SPANS_DDL}")


def redact(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with each span, or run of overlapping spans, replaced by ``[kind]`` of its first."""
    out, at, reach = [], 0, -1
    for kind, a, b in spans:
        if a >= reach:
            out += [text[at:a], f"[{kind}]"]
        reach = max(reach, b)
        at = reach
    return "".join([*out, text[at:]])


def redact_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """``docs`` with the secrets in its text column replaced; every other column, and null or
    clean texts, stay as they are."""
    text_batches(docs.sparkSession)
    place = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(rules)
        for batch in batches:
            texts = batch.column(place)
            spans = scanner.scan(strings(texts))
            clean = [redact(t, s) if s else t for t, s in zip(texts.to_pylist(), spans, strict=True)]
            yield batch.set_column(place, batch.schema.field(place), pa.array(clean, texts.type))

    return docs.mapInArrow(run, docs.schema)
