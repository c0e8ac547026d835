"""What a Python worker keeps from one task to the next, of one operator at a time.

Spark uses its workers again for whatever comes next.  What an operator keeps there for its later tasks (words, their
hashes or ids) would stay beside the memory of all operators after it, so a task forgets what others kept, and gives
back to the system what is free.
"""

from __future__ import annotations

import contextlib
import ctypes
import functools
import gc
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa

#: What makes this process forget what an operator keeps.
_FORGET: dict[str, list[Callable[[], None]]] = {}
_last: list[str] = []


def kept_by(operator: str, forget: Callable[[], None]) -> None:
    """``forget`` drops something that tasks of ``operator`` keep for each other; dropping it must cost time only."""
    _FORGET.setdefault(operator, []).append(forget)


def give_back() -> None:
    """Return free memory to the system; allocators hold on to it otherwise."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only glibc has it
        ctypes.CDLL(None).malloc_trim(0)


def turn_of(operator: str) -> None:
    """A task of ``operator`` begins: what others keep in this worker is dropped."""
    if _last == [operator]:
        return
    _last[:] = [operator]
    for other, forgets in _FORGET.items():
        if other != operator:
            for forget in forgets:
                forget()
    gc.collect()
    give_back()


def in_turn(operator: str, function: Callable, *groups):
    """The function of these groups, as a task of ``operator``."""
    turn_of(operator)
    out = function(*groups)
    give_back()
    return out


def task_of(operator: str) -> Callable:
    """For functions on the Arrow batches of a task."""

    def wrap(function: Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
        @functools.wraps(function)
        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            turn_of(operator)
            yield from function(batches)
            give_back()

        return run

    return wrap
