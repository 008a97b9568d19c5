"""What Python workers keep between tasks."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa


def give_back() -> None:
    """Return freed memory to the system: idle workers share an executor's memory with whatever runs next."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:
        pass  # a C library without it


def trimmed(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``run`` for ``mapInArrow``, giving memory back when its task is done."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return whole
