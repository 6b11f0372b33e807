"""What a Python worker keeps from task to task, one operator's at a time: a worker serves many, and its memory is small."""

from __future__ import annotations

from collections.abc import Callable

_clear: dict[str, Callable[[], None]] = {}


def claim(name: str, clear: Callable[[], None]) -> None:
    """The caller's caches may grow from here on; those of all others are emptied."""
    for other in [k for k in _clear if k != name]:
        _clear.pop(other)()
    _clear[name] = clear
