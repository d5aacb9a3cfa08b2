"""Objects kept for the life of a Python worker.

Import this module inside a task's function: a function that travels to a
worker by value brings copies of its globals, a module does not."""

from __future__ import annotations

from collections.abc import Callable

_MADE: dict[str, object] = {}


def once(key: str, make: Callable[[], object]) -> object:
    """``make()`` on the first call with ``key`` in this worker, then the same object."""
    if key not in _MADE:
        _MADE[key] = make()
    return _MADE[key]
