"""Byte-level BPE as a lazily determinised finite-state transducer.

A token sequence is the encoding of its bytes exactly when every two neighbouring tokens
are the encoding of the two together. So each prefix of a piece has one last token, found
from its predecessor, and the prefixes form a tree of partial encodings. A state of the
transducer is the last emitted token and the bytes read since; reading a byte extends the
tree and emits the tokens that all branches which can still grow have in common. Branches
grow only while their bytes begin some token, so lookahead is bounded by the longest token.
States and transitions are made when first used and kept per Python worker, up to a limit.

Decoding runs an incremental UTF-8 machine over the tokens' bytes, so it can stream.
"""

from __future__ import annotations

import base64
import gc
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import strings, text_batches, text_or_empty
from tripmart.llm.latin import is_latin, latin_pieces
from tripmart.llm.memo import Memo

#: Transducer states, and pieces with their ids, that a worker keeps.
MAX_STATES = 300_000
MAX_PIECES = 250_000


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank from a file of lines ``base64 rank``."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Transducer:
    def __init__(self, ranks: dict[bytes, int], max_states: int = MAX_STATES):
        self.ranks, self.max_states = ranks, max_states
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.top = 1 + max(ranks.values())
        begins = {token[:k] for token in ranks for k in range(1, len(token))}
        #: the token that bytes are (or None), and whether they begin a longer one
        self.entries = {part: (ranks.get(part), part in begins) for part in begins | ranks.keys()}
        self.pairs: dict[tuple[int, int], bool] = {}
        self.parts: dict[int, tuple[int, int] | None] = {}  # the two tokens a token was merged from
        self.forget()

    def forget(self) -> None:
        """Drop all states but the start."""
        self.numbers: dict[tuple[int, bytes], int] = {}
        self.steps: dict[int, tuple[int, tuple[int, ...]]] = {}  # by state and byte
        self.tails: list[tuple[int, ...] | None] = []
        self.trees: list[tuple[int, bytes, list, list]] = []
        self._state(-1, b"", [], [])

    def merged(self, data: bytes, down_to: int = 1) -> list[int]:
        """The encoding by definition: merge the lowest-ranked pair, leftmost first, while there
        are more than ``down_to`` parts."""
        parts = [data[k : k + 1] for k in range(len(data))]
        while len(parts) > down_to:
            best, at = None, 0
            for k in range(len(parts) - 1):
                rank = self.ranks.get(parts[k] + parts[k + 1])
                if rank is not None and (best is None or rank < best):
                    best, at = rank, k
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def _halves(self, token: int) -> tuple[int, int] | None:
        """The tokens of the last merge of ``token``, (token, token) for a single byte; None where
        merging doesn't arrive at it, or not by ranks that rise from merge to merge."""
        if token not in self.parts:
            data = self.bytes_of[token]
            found = self.merged(data, 2) if len(data) > 1 else [token, token]
            rising = len(found) == 2 and (
                len(data) == 1
                or all(self._halves(t) and (t < token or len(self.bytes_of[t]) == 1) for t in found)
            )
            self.parts[token] = tuple(found) if rising else None
        return self.parts[token]

    def _fits(self, last: int, token: int) -> bool:
        """May ``token`` follow ``last`` (-1: nothing) in an encoding?"""
        key = (last, token)
        known = self.pairs.get(key)
        if known is None:
            if last >= 0 and self._halves(last) and self._halves(token):
                known = self._apart(last, token)
            else:
                before = self.bytes_of[last] if last >= 0 else b""
                want = [last, token] if last >= 0 else [token]
                known = self.merged(before + self.bytes_of[token]) == want
            self.pairs[key] = known
        return known

    def _apart(self, a: int, b: int) -> bool:
        """Do tokens of rising merges stay apart as neighbours? The merges beside the boundary
        are undone, the latest first; one across it that has a lower rank than the one undone
        (or the same rank and lies further left) would have come before that."""
        limit = self.top
        while True:
            across = self.ranks.get(self.bytes_of[a] + self.bytes_of[b])
            if across is not None and across < limit:
                return False
            right, left = self.parts[a][1], self.parts[b][0]
            if right != a and (left == b or a > b):
                limit, a = a, right
            elif left != b:
                limit, b = b + 1, left
            else:
                return True

    def _state(self, last: int, pending: bytes, tree: list, live: list[int]) -> int:
        """``tree[k]``: (start, token) of the last token of the first k + 1 pending bytes;
        ``live``: the starts whose bytes so far begin some longer token."""
        number = self.numbers.get((last, pending))
        if number is None:
            number = self.numbers[last, pending] = len(self.trees)
            self.tails.append(None)
            self.trees.append((last, pending, tree, live))
        return number

    def _path(self, tree: list, end: int) -> tuple[int, ...]:
        """Tokens on the way from the last emission to ``end``."""
        tokens = []
        while end:
            end, token = tree[end - 1]
            tokens.append(token)
        return tuple(tokens[::-1])

    def _step(self, state: int, byte: int) -> tuple[int, tuple[int, ...]]:
        last, pending, tree, live = self.trees[state]
        entry_of, pairs = self.entries.get, self.pairs
        data = pending + bytes((byte,))
        n = len(data)
        grown, still = None, []
        for start in (*live, n - 1):
            before = last
            if start:
                if tree[start - 1] is None:
                    continue
                before = tree[start - 1][1]
            entry = entry_of(data[start:])
            if entry is None:
                continue
            token, longer = entry
            if grown is None and token is not None:
                fits = pairs.get((before, token))
                if self._fits(before, token) if fits is None else fits:
                    grown = (start, token)
            if longer:
                still.append(start)
        tree = [*tree, grown]
        cut = n  # the last place that all branches have come through
        for branch in still:
            while cut != branch:
                if cut > branch:
                    cut = tree[cut - 1][0]
                else:
                    branch = tree[branch - 1][0]
        emitted = self._path(tree, cut) if cut else ()
        end, left = (emitted[-1], data[cut:]) if cut else (last, data)
        to = self.numbers.get((end, left))
        if to is None:  # most steps lead to a state that is there already
            if cut:
                tree = [t and (t[0] - cut, t[1]) if t and t[0] >= cut else None for t in tree[cut:]]
                still = [k - cut for k in still]
            to = self._state(end, left, tree, still)
        self.steps[state << 8 | byte] = to, emitted
        return to, emitted

    def encode(self, piece: bytes) -> list[int]:
        """Ids of one piece. A piece that is a token is that token, as in the merge tables."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        if len(self.trees) > self.max_states:
            self.forget()
        if len(self.pairs) > 4 * self.max_states:
            self.pairs.clear()
        out: list[int] = []
        state, known = 0, self.steps.get
        for byte in piece:
            state, emitted = known(state << 8 | byte) or self._step(state, byte)
            if emitted:
                out.extend(emitted)
        tail = self.tails[state]
        if tail is None:
            _, pending, tree, _ = self.trees[state]
            tail = self.tails[state] = self._path(tree, len(pending))
        out.extend(tail)
        return out


#: Packs that many ids.
_PACKED = Memo(lambda n: struct.Struct(f"<{n}i").pack, 1 << 10)


class Encoder:
    """Texts to ids: the pattern's pieces, each through the transducer."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.pieces, self.latin_pieces = regex.compile(pattern).findall, latin_pieces(pattern)
        self.transducer = Transducer(ranks)
        self.memo = Memo(self._piece, MAX_PIECES)

    def _piece(self, piece: str) -> bytes:
        ids = self.transducer.encode(piece.encode())
        return _PACKED[len(ids)](*ids)

    def encode(self, text: str) -> bytes:
        """The ids as little-endian 32-bit integers."""
        pieces = self.latin_pieces if is_latin(text) else self.pieces
        ids = b"".join(map(self.memo.__getitem__, pieces(text)))
        self.memo.trim()
        _PACKED.trim()
        return ids


def utf8_machine(pending: bytes, data: bytes) -> tuple[str, bytes]:
    """Text that ``pending + data`` completes, and the bytes of a character not yet complete.

    A byte that can't go on becomes U+FFFD, one for each maximal ill-formed part."""
    out: list[str] = []
    held = bytearray(pending)
    need, low, high = _expects(held)
    for byte in data:
        if held:
            if low <= byte <= high:
                held.append(byte)
                need, low, high = need - 1, 0x80, 0xBF
                if not need:
                    out.append(held.decode())
                    held = bytearray()
                continue
            out.append("�")
            held = bytearray()
        if byte < 0x80:
            out.append(chr(byte))
        elif 0xC2 <= byte <= 0xF4:
            held = bytearray((byte,))
            need, low, high = _expects(held)
        else:
            out.append("�")
    return "".join(out), bytes(held)


def _expects(held: bytearray | bytes) -> tuple[int, int, int]:
    """Bytes still needed and the range of the next one."""
    if not held:
        return 0, 0, 0
    lead = held[0]
    need = 1 + (lead >= 0xE0) + (lead >= 0xF0) + 1 - len(held)
    if len(held) > 1:
        return need, 0x80, 0xBF
    low = {0xE0: 0xA0, 0xF0: 0x90}.get(lead, 0x80)
    high = {0xED: 0x9F, 0xF4: 0x8F}.get(lead, 0xBF)
    return need, low, high


class Decoder:
    """A stream of ids to text. ``feed`` returns what is complete, ``end`` the rest."""

    def __init__(self, ranks: dict[bytes, int]):
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.moves: dict[tuple[bytes, int], tuple[str, bytes]] = {}
        self.whole = Memo(self._whole, len(ranks) + 1)
        self.pending = b""

    def _move(self, pending: bytes, token: int) -> tuple[str, bytes]:
        move = self.moves[pending, token] = utf8_machine(pending, self.bytes_of[token])
        return move

    def _whole(self, token: int) -> str:
        """The text of a token that is whole characters; "�" for another one."""
        text, rest = utf8_machine(b"", self.bytes_of[token])
        return "�" if rest else text

    def feed(self, ids: list[int]) -> str:
        if not self.pending:
            text = "".join(map(self.whole.__getitem__, ids))
            if "�" not in text:
                return text
        out, pending, moves = [], self.pending, self.moves
        for t in ids:
            text, pending = moves.get((pending, t)) or self._move(pending, t)
            out.append(text)
        self.pending = pending
        return "".join(out)

    def end(self) -> str:
        rest, self.pending = self.pending, b""
        return "�" if rest else ""


_ENCODERS: dict[tuple[str, str], Encoder] = {}
_DECODERS: dict[str, Decoder] = {}


def _encoder(path: str, pattern: str) -> Encoder:
    """One encoder for each vocabulary and worker, so its states serve many tasks."""
    if (path, pattern) not in _ENCODERS:
        _ENCODERS[path, pattern] = Encoder(read_ranks(path), pattern)
    return _ENCODERS[path, pattern]


def _decoder(path: str) -> Decoder:
    if path not in _DECODERS:
        _DECODERS[path] = Decoder(read_ranks(path))
    return _DECODERS[path]


def bpe_encode(docs: DataFrame, path: str, pattern: str, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id, ids`` (array of int) for each row of ``docs``.

    ``path``: a rank file; ``pattern``: the expression whose matches are encoded, each on its
    own; there are no special tokens. Null texts count as empty and give no ids."""
    text_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path, pattern)
        for batch in batches:
            coded = [encoder.encode(t) for t in strings(batch.column(1))]
            gc.freeze()  # the tables are many small tuples without cycles: not for the collector
            ends = np.cumsum([0, *(len(c) // 4 for c in coded)], dtype=np.int32)
            values = pa.array(np.frombuffer(b"".join(coded), dtype="<i4"))
            ids = pa.ListArray.from_arrays(pa.array(ends), values)
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], ["doc_id", "ids"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_or_empty(text).alias("text"))
    return rows.mapInArrow(run, "doc_id long, ids array<int>")


def bpe_decode(coded: DataFrame, path: str) -> DataFrame:
    """``doc_id, ids, text`` for rows of ``doc_id, ids``; null ids count as none. Bytes that are
    no UTF-8 become U+FFFD."""
    text_batches(coded.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = _decoder(path)
        for batch in batches:
            texts = []
            for ids in batch.column(1):
                values = ids.values.to_numpy(zero_copy_only=False).tolist() if ids.is_valid else []
                texts.append(decoder.feed(values) + decoder.end())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], ["doc_id", "ids", "text"])

    return coded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids array<int>, text string")
