"""Memory of a Python worker, which serves the operators of a session in turn."""

from __future__ import annotations

import pyarrow

_caches: dict[str, dict] = {}


def cache(owner: str) -> dict:
    """The operator's own dictionary; what other operators have left is dropped."""
    for name, held in _caches.items():
        if name != owner and held:
            held.clear()
            pyarrow.default_memory_pool().release_unused()
    return _caches.setdefault(owner, {})
