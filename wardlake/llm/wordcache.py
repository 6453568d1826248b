"""Token ids of texts through a table of the words seen so far.

Runs inside tasks. A text is cut into units whose ids do not depend on their
neighbours; each distinct unit is encoded once and texts are put together from
the table. The table is bounded: when it is full it starts anew.
"""

from __future__ import annotations

import ctypes
import gc
import sys
import types
from collections.abc import Callable, Hashable
from itertools import repeat
from typing import Any

import numpy as np
import pyarrow as pa

#: Distinct units kept at a time.
MOST_UNITS = 300_000


def kept_in_worker(key: Hashable, build: Callable[[], Any]) -> Any:
    """``build()``, once for a Python worker, which serves many tasks.

    Functions reach the workers by value, so what a module holds does not last
    beyond a task; what a module in ``sys.modules`` holds does.
    """
    held = sys.modules.setdefault("wardlake_worker", types.ModuleType("wardlake_worker")).__dict__.setdefault("held", {})
    if key not in held:
        held[key] = build()
    return held[key]


def give_back_memory() -> None:
    """Return freed memory to the system at the end of a task; a Python worker lives on and serves other stages."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if sys.platform.startswith("linux"):
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
        if trim is not None:
            trim(0)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places ``starts[i] .. starts[i] + lengths[i]`` of all i, one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


class UnitTable:
    """``encode`` gives the ids of many units at once: flat ids and the count of each unit."""

    def __init__(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], flag: Callable[[str], bool] | None = None,
                 most: int = MOST_UNITS):
        self.encode, self.flag, self.most = encode, flag, most
        self.clear()

    def clear(self) -> None:
        self.places: dict[str, int] = {}
        self.ids = np.zeros(0, np.uint32)
        self.starts = np.zeros(0, np.int64)
        self.lengths = np.zeros(0, np.int64)
        self.flags = np.zeros(0, bool)

    def look_up(self, units: list[list[str]]) -> list[np.ndarray]:
        """The places of the units of each text; what is new is encoded, all at once."""
        places = [self._known(u) for u in units]
        missing = [np.flatnonzero(p < 0) for p in places]
        new = {u[k] for u, m in zip(units, missing) for k in m.tolist()}
        if not new:
            return places
        if self.places and len(self.places) + len(new) > self.most:  # full: keep what these texts need
            self.clear()
            self._add(list(set().union(*units)))
            return [self._known(u) for u in units]
        self._add(list(new))
        for u, p, m in zip(units, places, missing):
            if len(m):
                p[m] = [self.places[u[k]] for k in m.tolist()]
        return places

    def _known(self, units: list[str]) -> np.ndarray:
        return np.fromiter(map(self.places.get, units, repeat(-1)), np.int64, len(units))

    def _add(self, new: list[str]) -> None:
        ids, lengths = self.encode(new)
        starts = np.cumsum(lengths) - lengths + len(self.ids)
        n = len(self.places)
        self.places.update(zip(new, range(n, n + len(new))))
        self.ids = np.concatenate([self.ids, ids.astype(np.uint32)])
        self.starts = np.concatenate([self.starts, starts])
        self.lengths = np.concatenate([self.lengths, lengths])
        if self.flag:
            self.flags = np.concatenate([self.flags, np.fromiter(map(self.flag, new), bool, len(new))])

    def ids_of(self, places: np.ndarray) -> np.ndarray:
        return self.ids[ragged(self.starts[places], self.lengths[places])]
