"""Boolean trigram queries derived from regular expressions, and a block's trigram postings.

Text and patterns are taken in lower case, so a query never misses a match; it only names
documents worth verifying. A query is ``None`` (every document may match), or a tuple
``("and" | "or", parts)`` whose parts are queries or trigrams.
"""

from __future__ import annotations

import re
from re import _constants as op
from re import _parser

#: Exact strings followed at once. A class of more than ``FEW`` characters is spelled out, up to
#: that limit, only where the strings before it have no trigram yet.
MAX_STRINGS = 64
FEW = 4


def trigram_query(pattern: str):
    """The query of a pattern: what a text must hold for the pattern to match in it."""
    exact, query = _sequence(_parser.parse(pattern))
    return query if exact is None else _strings(exact)


def trigrams_of(query) -> set[str]:
    if query is None:
        return set()
    if isinstance(query, str):
        return {query}
    return set().union(*map(trigrams_of, query[1]))


def _strings(found: set[str]):
    """Some string of the set is there: an "or" of the trigrams of each."""
    parts = []
    for s in sorted(found):
        if len(s) < 3:
            return None
        parts.append(_join("and", sorted({s[k : k + 3] for k in range(len(s) - 2)})))
    return _join("or", parts)


def _join(kind: str, parts: list):
    if kind == "and":
        parts = [p for p in parts if p is not None]
    elif any(p is None for p in parts):
        return None
    if not parts:
        return None
    return parts[0] if len(parts) == 1 else (kind, tuple(parts))


def _sequence(items):
    """Exact strings of a sequence (None if not known in full) and its query."""
    whole, run, queries = True, {""}, []
    for item in items:
        exact, query, stops = _item(*item)
        wide = exact is not None and len(exact) > FEW and max(map(len, exact)) == 1
        needed = not wide or min(map(len, run)) < 3
        if exact is not None and needed and len(run) * len(exact) <= MAX_STRINGS:
            run = {a + b for a in run for b in exact}
        else:
            whole = False
            queries += [_strings(run), query if exact is None else _strings(exact)]
            run = {""}
        if stops:
            whole = False
            queries.append(_strings(run))
            run = {""}
    if whole:
        return run, None
    return None, _join("and", [*queries, _strings(run)])


def _item(kind, arg):
    """Exact strings or None, the query where they are None, and whether more may follow."""
    if kind is op.LITERAL:
        return {chr(arg).lower()}, None, False
    if kind in (op.AT, op.ASSERT, op.ASSERT_NOT):
        return {""}, None, False
    if kind is op.IN:
        return _class(arg), None, False
    if kind is op.SUBPATTERN:
        return (*_sequence(arg[-1]), False)
    if kind is op.BRANCH:
        parts = [_sequence(x) for x in arg[1]]
        if all(e is not None for e, _ in parts):
            return set().union(*(e for e, _ in parts)), None, False
        return None, _join("or", [q if e is None else _strings(e) for e, q in parts]), False
    if kind in (op.MAX_REPEAT, op.MIN_REPEAT, op.POSSESSIVE_REPEAT):
        low, high, inner = arg
        exact, query = _sequence(inner)
        if low == 0:
            return (exact | {""}, None, False) if high == 1 and exact is not None else (None, None, False)
        if exact is None:
            return None, query, False
        return exact, None, (low, high) != (1, 1)
    return None, None, False


def _class(items) -> set[str] | None:
    found: set[str] = set()
    for kind, arg in items:
        if kind is op.LITERAL:
            found.add(chr(arg).lower())
        elif kind is op.RANGE and arg[1] - arg[0] < MAX_STRINGS:
            found |= {chr(c).lower() for c in range(arg[0], arg[1] + 1)}
        else:
            return None
    return found if len(found) <= MAX_STRINGS else None


class BlockIndex:
    """Postings of the wanted trigrams over a block of texts; a list is a bit set of places."""

    def __init__(self, texts: list[str], wanted: set[str]):
        self.all = (1 << len(texts)) - 1
        self.postings = dict.fromkeys(wanted, 0)
        for k, text in enumerate(texts):
            low, bit = text.lower(), 1 << k
            for t in wanted:
                if t in low:
                    self.postings[t] |= bit

    def places(self, query) -> int:
        """Bit set of the texts that satisfy a query, by intersecting and uniting postings."""
        if query is None:
            return self.all
        if isinstance(query, str):
            return self.postings[query]
        kind, parts = query
        found = self.places(parts[0])
        for part in parts[1:]:
            if kind == "and":
                if not found:
                    break
                found &= self.places(part)
            else:
                found |= self.places(part)
        return found


def compiled(pattern: str, ignore_case: bool) -> re.Pattern:
    """Letters match in either case where asked, A-Z alone."""
    return re.compile(pattern, re.ASCII | (re.IGNORECASE if ignore_case else 0))
