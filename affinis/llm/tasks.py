"""What tasks of all operators share."""

from __future__ import annotations

import ctypes
import ctypes.util
from collections.abc import Callable, Iterator

import pyarrow as pa

Mapper = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def give_back() -> None:
    """Return freed memory to the system: a worker lives on, and what one task needed once is not needed by the next."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(ctypes.util.find_library("c") or "libc.so.6").malloc_trim(0)
    except (AttributeError, OSError):  # another system's library has no such call
        pass


def releasing(mapper: Mapper) -> Mapper:
    """``mapper``, after which the task's memory is given back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from mapper(batches)
        finally:
            give_back()

    return run
