"""Memory of Python workers, which Spark reuses from one stage to the next."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa


@lru_cache(maxsize=1)
def _trim() -> Callable[[int], int]:
    """glibc's ``malloc_trim``; nothing where the C library has none."""
    try:
        return ctypes.CDLL(None).malloc_trim
    except (AttributeError, OSError):
        return lambda keep: 0


def give_back() -> None:
    """Hand memory that is free to the system; the allocators keep it otherwise, for as long as the worker lives."""
    pa.default_memory_pool().release_unused()
    _trim()(0)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``run`` for ``mapInArrow``, whose worker gives back at the end of a task what the task has freed.

    An executor holds its workers beside its own heap, so what a stage left in them is missing in the next.
    """

    def tidied(batches):
        try:
            yield from run(batches)
        finally:
            give_back()

    return tidied
