"""Memory of Python workers: a dictionary of bounded size for results that are costly to make again, and tasks that give
back what they have used."""

from __future__ import annotations

import ctypes

import pyarrow as pa


def lean(run):
    """``run``, for mapInArrow, that returns memory to the system when its task ends. Workers live on, and what
    their allocators keep of one stage would stand beside the memory of the next."""

    def task(batches):
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only some C libraries have it
            if trim:
                trim(0)

    return task


class Memo(dict):
    """Two generations: what the old one still knows moves to the young one when it is asked for;
    when the young one is full it becomes the old one. Holds ``2 * limit`` entries at most."""

    def __init__(self, make, limit: int = 300_000):
        self.make, self.limit, self.old = make, limit, {}

    def __missing__(self, key):
        found = self.old.get(key)
        if found is None:
            found = self.make(key)
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[key] = found
        return found
