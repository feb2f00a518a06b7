"""What Python workers hold: Spark keeps them between tasks and stages, beside an executor's full heap.

A worker has the tables of one operator at a time, works through a batch in slices of texts, and gives back to the
system what a task has freed. None of this changes a result; a table that is asked for again is made again.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps
from typing import Any

import pyarrow as pa

#: Bytes of texts in a slice; what is made of them takes some times as much.
SLICE_BYTES = 4_000_000

_held: list[Any] = []  # at most one table: its maker and arguments, and itself


def held(make: Callable[..., Any], *args: Any) -> Any:
    """``make(*args)``, one per worker; tasks that follow find it, until another operator's table takes its place."""
    if not _held or _held[0] != (make, args):
        _held.clear()
        _held[:] = [(make, args), make(*args)]
    return _held[1]


def let_go() -> None:
    """For tasks that need no table: what an earlier operator left goes."""
    _held.clear()


def slices(batches: Iterator[pa.RecordBatch], place: int) -> Iterator[pa.RecordBatch]:
    """The batches' rows in slices of about ``SLICE_BYTES`` in the column at ``place``; a single text is never cut."""
    for batch in batches:
        step = max(1, batch.num_rows * SLICE_BYTES // max(1, batch.column(place).nbytes))
        for begin in range(0, batch.num_rows, step):
            yield batch.slice(begin, step)


def give_back() -> None:
    """Returns freed memory to the system; the C library would keep tens of MB of it."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc's
        trim(0)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function for ``mapInArrow`` after whose task the worker gives back what was freed."""

    @wraps(run)
    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return tidied
