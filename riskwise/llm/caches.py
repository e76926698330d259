"""Memory of a Python worker between tasks.

Spark reuses its Python workers, so what one operator remembers there stays while the next ones run.  A task
function marked with ``task`` first gives back what other operators remember, and hands free
memory back to the system when its partition is done.
"""

from __future__ import annotations

import ctypes
import functools
import gc
from collections.abc import Callable

import pyarrow as pa

_clear: dict[str, Callable[[], None]] = {}
_last: list[str] = [""]


def remember(owner: str, clear: Callable[[], None]) -> None:
    """``clear`` drops what the operator ``owner`` keeps in a worker."""
    _clear[owner] = clear


def trim() -> None:
    """Free memory goes back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):       # another C library
        pass


def begin(owner: str) -> None:
    """The worker turns to the operator ``owner``."""
    if _last[0] != owner:
        _last[0] = owner
        for other, clear in _clear.items():
            if other != owner:
                clear()
        trim()


def task(owner: str):
    """Marks a function over the batches of one partition as a task of the operator ``owner``."""
    def wrap(run):
        @functools.wraps(run)
        def held(batches):
            begin(owner)
            try:
                yield from run(batches)
            finally:
                trim()
        return held
    return wrap
