"""A cache of what is known about stretches of text (words, or words with the blanks before them).

Equal stretches are worked off once: ``SpanCache`` numbers the distinct stretches of a chunk and gives new ones to ``learn``.
They are found by a 64-bit hash and compared byte by byte, so a collision can't change a result. The cache holds
``max_entries`` stretches and what one chunk adds to them, and starts anew beyond that.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from .common import ranges, span_hash
from .pieces import Grown


class SpanCache:
    def __init__(self, learn: Callable[[list[str]], None], forget: Callable[[], None], max_entries: int = 400_000):
        self.learn, self.forget, self.max_entries = learn, forget, max_entries
        self.reset()

    def reset(self) -> None:
        self.known: dict[int, int] = {}
        self.bytes, self.at, self.size = Grown(np.uint8), Grown(np.int64), Grown(np.int64)
        self.forget()

    def add(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        sizes, first = ends - starts, self.at.n
        flat = data[ranges(starts, sizes)]
        at = np.cumsum(sizes) - sizes
        self.at.add(self.bytes.n + at)
        self.size.add(sizes)
        self.bytes.add(flat)
        raw = flat.tobytes()
        self.learn([raw[a:a + n].decode() for a, n in zip(at.tolist(), sizes.tolist(), strict=True)])
        return np.arange(first, first + len(starts))

    def __call__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The entry of each stretch of ``data``; entries count up in the order in which ``learn`` sees them."""
        if len(self.known) > self.max_entries:
            self.reset()
        distinct, at, which = np.unique(span_hash(data, starts, ends), return_index=True, return_inverse=True)
        known = self.known.get
        entry = np.array([known(h, -1) for h in distinct.tolist()], np.int64)
        new = np.flatnonzero(entry < 0)
        if len(new):
            entry[new] = self.add(data, starts[at[new]], ends[at[new]])
            self.known.update(zip(distinct[new].tolist(), entry[new].tolist(), strict=True))
        entry = entry[which]
        sizes = ends - starts
        same = self.size.data[entry] == sizes
        odd = np.flatnonzero(~same)
        if len(odd):
            entry[odd] = self.add(data, starts[odd], ends[odd])
        place = ranges(starts, sizes)
        wrong = np.flatnonzero(data[place] != self.bytes.data[ranges(self.at.data[entry], sizes)])
        if len(wrong):
            odd = np.unique(np.searchsorted(np.cumsum(sizes), wrong, "right"))
            entry[odd] = self.add(data, starts[odd], ends[odd])
        return entry
