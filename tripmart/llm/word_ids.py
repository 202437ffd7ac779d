"""Ids of whole texts by a tokenizer file, through the tokenizers library.

Where the file's rules say so, a text's pieces can be told by its own split pattern: lower
case, composed characters, white space dropped. Each distinct piece then goes through the
library once per worker, many together, and is looked up after that (bounded). That holds
for Latin-1 text, whose characters are composed already. Other parts between spaces go
through the library one by one, and texts that hold the string of an added token, or all
texts of another kind of tokenizer, as a whole.
"""

from __future__ import annotations

import gc
import json
import os

import numpy as np
from tokenizers import Tokenizer

from tripmart.llm.latin import is_latin, latin_pieces
from tripmart.llm.memo import Memo

#: Distinct pieces that a worker keeps, and pieces in one call of the library.
MAX_PIECES, AT_ONCE = 500_000, 64


def _split_pattern(rules: dict) -> str | None:
    """The pattern whose matches in lower-cased text are the pieces, by a tokenizer's rules."""
    steps = (rules.get("normalizer") or {}).get("normalizers") or []
    splits = (rules.get("pre_tokenizer") or {}).get("pretokenizers") or []
    lower = [s["type"] for s in steps] == ["NFC", "Replace", "Lowercase"]
    if not lower or steps[1].get("pattern") != {"Regex": "\\s+"} or steps[1].get("content") != " ":
        return None
    if [s["type"] for s in splits] != ["Split", "ByteLevel"]:
        return None
    first, last = splits
    if not first["invert"] or first["behavior"] != "Removed" or last["add_prefix_space"] or last["use_regex"]:
        return None
    return first["pattern"].get("Regex")


class WordIds:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        rules = json.loads(self.tokenizer.to_str())
        pattern = None if rules.get("truncation") or rules.get("padding") else _split_pattern(rules)
        if any(c.isspace() for a in self.added for c in a):
            pattern = None
        suffix = rules["model"].get("end_of_word_suffix")
        if not suffix:
            pattern = None
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), dtype=bool)
        self.ends[[i for t, i in self.tokenizer.get_vocab().items() if suffix and t.endswith(suffix)]] = True
        self.split = latin_pieces(pattern) if pattern else None
        self.pieces = Memo(self.whole, MAX_PIECES)
        self.parts = Memo(self.whole, MAX_PIECES // 4)

    def whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, dtype="<u4").tobytes()

    def _learn(self, pieces: list[str]) -> None:
        """Encode pieces that aren't known yet: many in a call, with spaces between; the last
        token of a piece is known by the word's end it holds."""
        groups = [pieces[k : k + AT_ONCE] for k in range(0, len(pieces), AT_ONCE)]
        coded = self.tokenizer.encode_batch_fast([" ".join(g) for g in groups], add_special_tokens=False)
        for group, found in zip(groups, coded, strict=True):
            ids = np.array(found.ids, dtype="<u4")
            ends = (np.flatnonzero(self.ends[ids]) + 1).tolist()
            if len(ends) != len(group) or ends[-1] != len(ids):
                self.pieces.update((p, self.whole(p)) for p in group)
                continue
            data = ids.tobytes()
            begin = 0
            for piece, end in zip(group, ends, strict=True):
                self.pieces[piece] = data[4 * begin : 4 * end]
                begin = end

    def _pieces(self, text: str) -> list[str] | None:
        """Pieces of a Latin-1 text, None for another one."""
        return self.split(text.lower()) if is_latin(text) else None

    def _known(self, text: str) -> tuple[list[bytes | None], list[tuple[int, str]]]:
        """The ids of a text's pieces, None where not known yet, and the places of these with the pieces."""
        get = self.pieces.get
        found = self._pieces(text)
        if found is None:
            found, ids = [], []
            for part in text.replace("\n", " ").split(" "):
                own = self._pieces(part)
                found.extend([part] if own is None else own)
                ids.extend([self.parts[part]] if own is None else map(get, own))
        else:
            ids = list(map(get, found))
        places, k = [], -1
        for _ in range(ids.count(None)):
            k = ids.index(None, k + 1)
            places.append((k, found[k]))
        return ids, places

    def encode_many(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, without special tokens, as little-endian unsigned 32-bit integers."""
        plan: list = []
        new: set[str] = set()
        for t in texts:
            if self.split is None or any(a in t for a in self.added):
                plan.append(([self.whole(t)], []))
            else:
                plan.append(self._known(t))
                new.update(p for _, p in plan[-1][1])
        self._learn(self.pieces.unknown(new))
        look, out = self.pieces.__getitem__, []
        for ids, places in plan:
            for k, piece in places:
                ids[k] = look(piece)
            out.append(b"".join(ids))
        self.pieces.trim()
        self.parts.trim()
        return out

    def encode(self, text: str) -> bytes:
        return self.encode_many([text])[0]


_KNOWN: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """One tokenizer for each file and worker, so its memo serves many tasks."""
    if path not in _KNOWN:
        gc.set_threshold(200_000, 20, 50)  # the memos are many small objects without cycles
        _KNOWN[path] = WordIds(path)
    return _KNOWN[path]
