"""A bounded memo for per-worker lookups."""

from __future__ import annotations

from collections.abc import Callable


class Memo(dict):
    """``memo[key]`` is ``make(key)``, kept. ``trim`` bounds it: over ``limit`` entries, those
    not used since the last trim go and the rest become the reserve."""

    def __init__(self, make: Callable, limit: int):
        super().__init__()
        self.make, self.limit, self.reserve = make, limit, {}

    def __missing__(self, key):
        value = self.reserve.get(key)
        if value is None:
            value = self.make(key)
        self[key] = value
        return value

    def unknown(self, keys: set) -> list:
        """The keys that are neither here nor in the reserve; those in the reserve move here."""
        out = []
        for key in keys:
            if key in self:  # a difference of the two would walk through all of the memo
                continue
            value = self.reserve.get(key)
            if value is None:
                out.append(key)
            else:
                self[key] = value
        return out

    def trim(self) -> None:
        if len(self) > self.limit:
            self.reserve = dict(self)
            self.clear()
