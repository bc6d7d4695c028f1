"""Shared inputs within one query: built once, reused by every branch of its plan."""

from __future__ import annotations

import contextlib
import threading

_LOCAL = threading.local()


def _scopes() -> list[dict]:
    if not hasattr(_LOCAL, "scopes"):
        _LOCAL.scopes = []
    return _LOCAL.scopes


@contextlib.contextmanager
def query_scope():
    """Within one registered query, the panel and calendar are materialised once and
    shared by every branch of the plan (history, forecasts, elasticities, ...).  Scopes
    are per thread, so queries built concurrently do not share or pop each other's."""
    _scopes().append({})
    try:
        yield
    finally:
        _scopes().pop()


def inside() -> bool:
    return bool(_scopes())


def memo(key, build):
    """``build()`` once per scope and key; outside of a scope, each time."""
    scopes = _scopes()
    if not scopes:
        return build()
    kept = scopes[-1]
    if key not in kept:
        kept[key] = build()
    return kept[key]


def drop(key) -> None:
    """Forget ``key``, whose tables go: a later use builds it again."""
    if inside():
        _scopes()[-1].pop(key, None)


def known(key) -> bool:
    """Whether this scope has built ``key`` already."""
    return inside() and key in _scopes()[-1]
