"""Per-worker cache of segmented words: each distinct word is encoded once, its ids are gathered in bulk."""

from __future__ import annotations

from collections.abc import Callable
from itertools import repeat

import numpy as np


class WordCache:
    """``encode(words)`` -> list of id sequences; at most about ``most`` words are kept."""

    def __init__(self, encode: Callable[[list[str]], list], most: int = 600_000):
        self.encode, self.most = encode, most
        self.forget()

    def forget(self) -> None:
        self.slot: dict[str, int] = {}
        self.flat, self.start = np.empty(0, np.int32), np.zeros(1, np.int64)
        self.used = 0

    def _add(self, parts: list) -> None:
        size = np.fromiter(map(len, parts), np.int64, len(parts))
        end = self.start[-1] + np.cumsum(size)
        need = int(end[-1]) if len(end) else self.used
        if need > len(self.flat):
            grown = np.empty(max(need, 2 * len(self.flat)), np.int32)
            grown[:self.used] = self.flat[:self.used]
            self.flat = grown
        self.flat[self.used:need] = np.concatenate(parts) if len(parts) else 0
        self.used, self.start = need, np.concatenate([self.start, end])

    def lookup(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words in order, offsets per word)."""
        if len(self.slot) > self.most:
            self.forget()
        slot = np.fromiter(map(self.slot.get, words, repeat(-1)), np.int64, len(words))
        lost = np.flatnonzero(slot < 0)
        if len(lost):
            new = list(dict.fromkeys([words[i] for i in lost.tolist()]))
            at = len(self.start) - 1
            self._add(self.encode(new))
            self.slot.update(zip(new, range(at, at + len(new)), strict=True))
            slot[lost] = np.fromiter((self.slot[words[i]] for i in lost.tolist()), np.int64, len(lost))
        first = self.start[slot]
        size = self.start[slot + 1] - first
        off = np.concatenate([[0], np.cumsum(size)])
        return self.flat[np.arange(off[-1]) + np.repeat(first - off[:-1], size)], off
